import hashlib
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from helpers import awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = bpe.load_vocabulary(PATH)
ENCODER = bpe.Encoder(VOCABULARY, P.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})


def same(text):
    ids, per = ENCODER.encode([text])
    assert ids.tolist() == THEIRS.encode_ordinary(text) and per.tolist() == [len(ids)]
    assert VOCABULARY.decode(ids)[0].tobytes().decode() == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    same(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdefgh", min_size=1, max_size=2000))
def test_long_pre_tokens(text):
    same(text)


RISKY = [t.decode() for r, t in enumerate(sorted(VOCABULARY.ranks, key=VOCABULARY.ranks.get)) if r in VOCABULARY.risky and t.isalpha() and t.isascii()][:400]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(RISKY), min_size=1, max_size=600))
def test_tokens_that_merge_one_at_a_time(parts):
    same("".join(parts))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(RISKY), min_size=1, max_size=80))
def test_both_merges_agree(parts):
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    assert bpe.merge_long(VOCABULARY, data).tolist() == bpe.merge_all(VOCABULARY, data, np.array([len(data)]))[0].tolist()


def test_time_grows_with_length_alone():
    def seconds(n):
        start = time.perf_counter()
        bpe.Encoder(VOCABULARY, P.PATTERN).encode(["st" * n])
        return time.perf_counter() - start

    assert seconds(200_000) < 10 * max(seconds(50_000), 0.2)
    same("st" * 32_000)


@pytest.mark.parametrize("text", ["a" * 30000, "ab" * 9000, "the" * 5000, " " * 500 + "x", "0" * 999, "\x1c a\x1d x\xa0y  z \n\n", "don't we'll I'M 'S", "<|endoftext|>", ""])
def test_odd_texts(text):
    same(text)


def test_queue_finds_lowest_rank_again_after_lower_push():
    q = bpe.RankQueue(60000)
    q.push(np.array([5000, 70, 5000]), np.array([1, 2, 3]))
    assert q.pop()[0] == 70
    q.push(np.array([3]), np.array([9]))
    assert [q.pop()[0], q.pop()[0], q.pop()] == [3, 5000, None]


def test_forgetting_changes_nothing(monkeypatch):
    texts = ["one two three", "two three four"] * 3
    want = [ENCODER.encode([t])[0].tolist() for t in texts]
    monkeypatch.setattr(bpe, "MEMORY", 1)
    small = bpe.Encoder(VOCABULARY, P.PATTERN)
    assert [small.encode([t])[0].tolist() for t in texts] == want


def test_operator_round_trip(spark):
    rows = awkward()
    docs = documents(spark, rows, extra=True)
    out = bpe.encode(docs, PATH, P.PATTERN, ["doc_id", "score"], digests=True)
    got = sorted(((r.doc_id, r.n_tokens, tuple(r.ids), r.ids_sha256, r.decoded_sha256) for r in out.collect()), key=repr)
    want = []
    for i, t, _, _ in rows:
        ids = THEIRS.encode_ordinary(t or "")
        want.append((i, len(ids), tuple(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    back = bpe.decode(out, PATH, ["doc_id"])
    assert sorted(((r.doc_id, bytes(r.bytes)) for r in back.collect()), key=repr) == sorted(((i, (t or "").encode()) for i, t, _, _ in rows), key=repr)
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN, ["doc_id"]).count() == 0


def test_memory_is_bounded_by_bytes(monkeypatch):
    """Distinct pre-tokens of 3,000 letters and of 3: what is remembered stays within the bound and one slice, ids unchanged."""
    import random

    rng = random.Random(1)
    monkeypatch.setattr(bpe, "MEMORY", 300_000)
    vocabulary = bpe.load_vocabulary(PATH)
    encoder = bpe.Encoder(vocabulary, P.PATTERN)
    whole = lambda e: sum(len(x.encode()) for x in e.number) + e.ids.nbytes + bpe.ENTRY * len(e.number)
    forgot = 0
    for k in range(30):
        texts = ["".join(rng.choices("abcdefghij", k=3000 if k % 2 else 3)) for _ in range(20 if k % 2 else 400)]
        before = len(encoder.number)
        flat, per = encoder.encode(texts)
        forgot += len(encoder.number) < before + len(set(texts))
        assert encoder.held == whole(encoder) <= 300_000 + 20 * (3000 * 5 + bpe.ENTRY)
        ends = per.cumsum().tolist()
        for text, i, j in zip(texts[:2], [0, *ends], ends, strict=False):
            assert flat[i:j].tolist() == THEIRS.encode_ordinary(text)
    assert forgot
