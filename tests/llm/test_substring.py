import random

import pytest
from helpers import awkward, covered, documents, words

from sievework.llm import substring


def check(spark, rows, window=35, **options):
    out = substring.remove_repeats(documents(spark, rows, extra=True), ["doc_id"], window=window)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()), key=repr)
    texts = [words(t) for _, t, _, _ in rows]
    want = [(i, len(w), sum(h), " ".join(x for x, c in zip(w, h, strict=True) if not c)) for (i, *_), w, h in zip(rows, texts, covered(texts, window), strict=True)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_with_shared_passages(spark, seed):
    rng = random.Random(seed)
    some = lambda n, v: [f"w{rng.randrange(v)}" for _ in range(n)]
    passages = [some(rng.choice([34, 35, 36, 50, 80]), 500) for _ in range(8)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(6)):
            w += some(rng.randrange(40), rng.choice([2, 500])) + (rng.choice(passages) if rng.random() < 0.6 else [])
        rows.append((i, " ".join(w), "en", "a"))
    rows += [(100 + i, rows[5][1], "en", "a") for i in range(5)]  # copies
    base = some(200, 500)
    for i in range(20):  # near copies
        w = base[:]
        w[rng.randrange(200)] = f"edit{i}"
        rows.append((200 + i, " ".join(w), "en", "a"))
    rows.append((300, " ".join(["spam"] * 300), "en", "a"))
    check(spark, rows)


def test_awkward_documents(spark):
    check(spark, awkward())


def test_long_words_of_equal_polynomials_differ(spark):
    """Thue-Morse words: polynomials modulo 2**64 are equal for both, whatever the base."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    two = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(34))
    check(spark, [(1, f"{one} {rest}", "en", "a"), (2, f"{two} {rest}", "en", "a"), (3, f"x {one} {rest}", "en", "a")])


def test_small_window(spark):
    check(spark, [(1, "a b c d e f g h i j x", "en", "a"), (2, "y a b c d e f g h i j", "en", "a"), (3, "a b c d e f g h i", "en", "a")], window=10)


def test_empty_table(spark):
    assert substring.remove_repeats(documents(spark, awkward()).limit(0), ["doc_id"]).count() == 0
