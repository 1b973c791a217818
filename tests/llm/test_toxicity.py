import numpy as np
import pytest
from helpers import awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import langid, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return toxicity.learn(docs, labels.where(~langid.held_out("doc_id")), sample=3000)


def test_restores_disguised_words(learned):
    for seen, meant in [("1d10t", "idiot"), ("p.a.t.h.e.t.i.c", "pathetic"), ("l o s e r", "loser"), ("stuuuupid", "stupid"), ("m0r0n", "moron"), ("w0rthl3ss", "worthless"), ("$cum", "scum"), ("tr@sh", "trash")]:
        assert meant in toxicity.Restorer(learned.model).words(f"the {seen} of")[0], seen


def test_restores_words_disguised_at_both_ends_or_spaced(learned):
    for seen, meant in [
        ("5h17", "shit"), ("1d107", "idiot"), ("7r45h", "trash"), ("7r4$h!", "trash"), ("h473", "hate"), ("1d10+", "idiot"), ("(1d107)", "idiot"), ("p o o p", "poop"),
        ("l 0 5 3 r", "loser"), ("m . 0 . r . 0 . n", "moron"), ("s,  c, u,\tm", "scum"), ("p.....athet..1c", "pathetic"), ("see(1d107", "idiot"),
    ]:
        assert meant in toxicity.Restorer(learned.model).words(f"the {seen} of")[0], seen
    assert toxicity.Restorer(learned.model).words("1 2 3 4 5, 12.50 and 2024") == ({"and"}, 1)


def test_spaced_words_of_any_letters(learned):
    words = toxicity.Restorer(learned.model).words
    assert "kook" in words("you k o o k there")[0] and "ass" in words("the a s s of")[0] and "poop" in words("a p o o p")[0]


def readings(model, seen):
    """Every reading of a span and its value: the product of all choices at each character."""
    prices = {None: toxicity.AS_IS}
    every = [("", "", 0.0)]  # letters, last character read, price
    for i, c in enumerate(seen):
        run = any(seen[j : j + 3] == c * 3 for j in range(max(0, i - 2), i + 1))
        again = toxicity.DRAWN_OUT if run else toxicity.DOUBLED
        new = []
        for letters, last, price in every:
            if c.isalpha():
                new.append((letters + c, c, price + prices[None]))
                if c == last:
                    new.append((letters, last, price + again))
                continue
            if c in toxicity.SEPARATORS or c in toxicity.LEET:
                new.append((letters, last, price + (toxicity.PARTED if c in toxicity.SEPARATORS else toxicity.DROPPED)))
            for x in toxicity.LEET.get(c, ""):
                new.append((letters + x, x, price + toxicity.STANDS_FOR))
                if x == last:
                    new.append((letters, last, price + toxicity.STANDS_FOR + again))
        every = new or every
    for letters, _, price in every:
        symbols = [0, 0, *(ord(x) - 96 if "a" <= x <= "z" else 27 for x in letters), 0]
        yield letters, price + sum(model.log[a][b][x] for a, b, x in zip(symbols, symbols[1:], symbols[2:], strict=False))


@settings(max_examples=300, deadline=None)
@given(seen=st.text(alphabet="aasot01$!.- 5\u00e9", min_size=1, max_size=9))
def test_viterbi_against_every_reading(learned, seen):
    text, value = learned.model.decode(seen)
    every = list(readings(learned.model, seen))
    assert abs(value - max(v for _, v in every)) < 1e-9
    assert any(t == text and abs(v - value) < 1e-9 for t, v in every)


def test_labels_and_ids_of_any_name(spark):
    docs = documents(spark, awkward()).selectExpr("*", "1 AS _toxic", "2 AS _id", "3 AS toxic")
    labels = spark.createDataFrame([(3, 1), (5, 0), (5, 0), (6, 0), (7, 0)], "doc_id long, toxic int")
    assert 0 <= toxicity.score(docs, toxicity.learn(docs, labels), ["doc_id", "_toxic", "_id"]).first().score <= 1


def test_long_spans(learned):
    assert len(toxicity.Restorer(learned.model).words("a 1 b 2 c 3 " * 5000)[0]) == 5


def test_held_out_quality(spark, learned):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(langid.held_out("doc_id"))
    rows = toxicity.score(docs, learned, ["doc_id"]).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    hit = (s >= 0.3) & (y == 1)
    assert hit.sum() / y.sum() > 0.85 and hit.sum() / (s >= 0.3).sum() > 0.85


def test_disguise_does_not_hide(learned):
    r = toxicity.Restorer(learned.model)
    plain, clean = "the idiot and the moron of that", "the of and that is on"
    score = lambda t: learned.score(*r.words(t))
    assert score(plain) >= 0.3 and score("the 1d10t and the m0r0n of that") >= 0.3 and score(clean) < 0.3


def test_awkward_documents(spark, learned):
    rows = awkward()
    got = toxicity.score(documents(spark, rows, extra=True), learned, ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    docs, labels = documents(spark, rows), spark.createDataFrame([(3, 0), (3, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, labels.limit(0)), ["doc_id"]).first().score == 0
    assert toxicity.score(docs.limit(0), toxicity.learn(docs, labels), ["doc_id"]).count() == 0


def test_memory_is_bounded_by_characters(learned, monkeypatch):
    monkeypatch.setattr(toxicity, "MEMORY", 20_000)
    r, other = toxicity.Restorer(learned.model), toxicity.Restorer(learned.model)
    for i in range(60):
        seen = f"1d10t{chr(97 + i % 26)}0" * (40 + i)
        assert r.restored(seen) == learned.model.restore(seen) and r.held <= 20_000
        assert r.held == sum(len(k) + len(v) + toxicity.ENTRY for k, v in r.known.items())
    assert r.words("the 1d10t") == other.words("the 1d10t")
