import hashlib
import os

import numpy as np
from helpers import awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import fingerprint as fp

P = fp.Powers()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab🎉", max_size=40), st.text(alphabet="ab🎉", max_size=40), st.integers(0, 40), st.integers(0, 40))
def test_extension_and_span_equality(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    x, y = fp.Prefixes(fp.code_points(a), P), fp.Prefixes(fp.code_points(b), P)
    assert x.extension(i, y, j) == len(os.path.commonprefix([a[i:], b[j:]]))
    n = min(len(a) - i, len(b) - j)
    assert (int(x.spans(np.int64(i), np.int64(i + n))) == int(y.spans(np.int64(j), np.int64(j + n)))) == (a[i : i + n] == b[j : j + n])


def test_likeness_orders_edits():
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(400))
    prints = [fp.Document(t, P).print for t in (text, text, text[:-50] + "x" * 50, text[: len(text) // 2] + "y" * 2000, "z" + str(range(10**6)))]
    like = [fp.likeness(prints[0], p) for p in prints]
    assert like[0] == like[1] == 1 and like[2] > 0.8 > like[3] > 0.1 > like[4]
    assert fp.likeness(fp.Document("", P).print, fp.Document(None, P).print) == 1
    assert fp.likeness(fp.Document("", P).print, fp.Document("a", P).print) == 0


def test_neighbours_against_plain(spark):
    rows = [r for r in awkward() if r[0] is not None] + [(i, f"document number {i} " * (i % 7), "en", "a") for i in range(100, 160)]
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.shared_prefix, r.fingerprint) for r in fp.compare_neighbours(documents(spark, rows, True).repartition(5)).collect()), key=repr)
    rows.sort(key=lambda r: r[0])  # the two rows of id 3 are equal
    want = []
    for k, (i, t, _, _) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), len(os.path.commonprefix([t, edited])), fp.Document(t, P).print))
    assert got == sorted(want, key=repr)


def test_one_and_no_document(spark):
    one = documents(spark, [(1, "abcdefgh", "en", "a")])
    assert fp.compare_neighbours(one).first().edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert fp.compare_neighbours(one.limit(0)).count() == 0
    assert fp.compare_neighbours(documents(spark, [(None, "a", "en", "a"), (None, None, "en", "a")])).count() == 2
