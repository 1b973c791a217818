import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents
from pyspark.sql import functions as F

from sievework.llm import quality, queries
from sievework.llm.words import Powers

SF = "/root/testdata/sf0.1"
TOKEN = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+|[^0-9A-Za-z\u0080-\U0010ffff\x00-\x20]+")


def hashes(words):
    """The hash of each word, by itself."""
    return quality.Tokens(pa.array([w.encode() for w in words], pa.binary()), Powers()).hash


@pytest.fixture(scope="module")
def scored(spark):
    rows = queries.op11_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    return [r for r in rows if r.held_out and r.quality is not None], rows


def test_words_are_runs_of_letters_and_signs():
    texts = ["", "Der Baum, der!! x_1", " \n", "é漢字 - ...a", "z" * 700 + " " + "z" * 701]
    t = quality.Tokens(pa.array([x.encode() for x in texts], pa.binary()), Powers())
    want = [TOKEN.findall(x) for x in texts]
    assert np.diff(t.first).tolist() == [len(w) for w in want]
    assert t.hash.tolist() == hashes([w for x in want for w in x]).tolist()
    assert len(set(t.hash.tolist())) == len({w for x in want for w in x})


def test_gathering_against_loops(spark):
    rows = awkward()
    got = quality.gather(documents(spark, rows).repartition(3))
    vectors, near, count = np.zeros((quality.ROWS, quality.SIZE)), np.zeros(quality.ROWS), np.zeros(quality.ROWS)
    for _, text, _, _ in rows:
        h = hashes(TOKEN.findall(text or ""))
        place, sign = quality.index_vectors(h)
        row = (h >> np.uint64(40)).astype(int) % quality.ROWS
        for i in range(len(h)):
            count[row[i]] += 1
            for j in range(max(0, i - quality.WINDOW), min(len(h), i + quality.WINDOW + 1)):
                if j != i:
                    near[row[i]] += 1
                    np.add.at(vectors[row[i]], place[j], sign[j])
    cells = quality.ROWS * quality.SIZE
    assert (got[:cells] == vectors.ravel()).all() and (got[cells : cells + quality.ROWS] == near).all() and (got[cells + quality.ROWS :] == count).all()


def test_pooling_against_loops():
    rng = np.random.default_rng(0)
    model = quality.Model(rng.integers(-200, 200, (quality.ROWS, quality.SIZE)).astype(np.float32), rng.integers(1, 1024, quality.ROWS).astype(float), [])
    texts = ["one two, three", None, "", "a a a b", " ".join(f"w{i % 50}" for i in range(quality.GATHERED * 2 + 7))]
    got = model.features(pa.array(texts))
    for x, text in zip(got, texts, strict=True):
        h = hashes(TOKEN.findall(text or ""))
        if not len(h):
            assert not x.any()
            continue
        row = (h >> np.uint64(40)).astype(int) % quality.ROWS
        v, w = model.vectors[row].astype(float) / quality.UNIT, model.weights[row][:, None]
        mean = (v * w).sum(0) / w.sum()
        spread = np.sqrt(np.maximum((v * v * w).sum(0) / w.sum() - mean**2, 0))
        assert np.allclose(x, [*mean, *spread, np.log1p(len(h)), len(set(h.tolist())) / len(h), (h[1:] == h[:-1]).sum() / len(h)], atol=1e-4)


def test_long_texts_are_read_whole():
    for text in (b"ab cd " * 200_000, b"x" * 1_000_001, b"ab\ncd " * 150_000 + b"y" * 500_000):
        parts = [p for _, column in quality.pieces(pa.array([b"q", text, None], pa.binary())) for p in column.to_pylist()]
        assert b"".join(parts) == b"q" + text and max(map(len, parts)) <= quality.PIECE


def test_held_out_quality(scored):
    rows, every = scored
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    order = np.argsort(s).argsort()
    auc = (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc > 0.98 and ((s < 0.3) & (y == 0)).sum() / (y == 0).sum() > 0.85 and ((s >= 0.3) & (y == 1)).sum() / y.sum() > 0.98
    assert len(every) == 10_000 and all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in every)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in every)


def test_probabilities_are_calibrated(scored):
    y, s = (np.array([r[c] for r in scored[0]], float) for c in ("quality", "score"))
    bins = np.minimum((s * 5).astype(int), 4)
    assert sum(abs(y[bins == b].sum() - s[bins == b].sum()) for b in range(5)) / len(y) < 0.03


def test_temperature_mends_overconfidence():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3))
    y = (rng.uniform(size=4000) < 1 / (1 + np.exp(-1.5 * x[:, 0]))).astype(float)
    network, temperature = quality.fit(x, y, np.arange(4000) % 5 == 0)
    score = 1 / (1 + np.exp(-quality.Model(None, None, network).odds(x) / temperature))
    assert abs(score.mean() - y.mean()) < 0.03 and np.abs(score - 1 / (1 + np.exp(-1.5 * x[:, 0]))).mean() < 0.06
    assert quality.fit(x, y, np.arange(4000) % 5 == 0)[1] == temperature


def test_learning_reads_only_its_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = docs.select("doc_id", "text", F.lit("zz").alias("lang"), F.lit("zz").alias("source"), (-F.col("n_chars")).alias("n_chars")).repartition(7)
    a, b = quality.score(docs, quality.learn(docs, labels), ["doc_id"]), quality.score(other, quality.learn(other, labels.repartition(3)), ["doc_id"])
    assert {r.doc_id: r.score for r in a.collect()} == {r.doc_id: r.score for r in b.collect()}


def test_awkward_documents(spark):
    rows = awkward()
    docs = documents(spark, rows, extra=True).selectExpr("*", "1 AS _text", "2 AS _id", "3 AS _label", "4 AS h", "5 AS label", "6 AS x")
    labels = spark.createDataFrame([(3, 0), (3, 1), (5, 0), (6, 0), (7, 0), (8, 1), (99, 1), (None, 1), (5, None)], "doc_id long, quality int")
    got = quality.score(docs, quality.learn(docs, labels), ["doc_id", "_id", "h"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r._id == 2 and r.h == 4 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert quality.score(docs, quality.learn(docs, labels.limit(0)), ["doc_id"]).first().score == 0
    assert quality.score(docs, quality.learn(docs, labels.where("doc_id = 3")), ["doc_id"]).first().score == 1
    assert quality.score(docs.limit(0), quality.learn(docs.limit(0), labels), ["doc_id"]).count() == 0
