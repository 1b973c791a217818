import math
from collections import Counter

from helpers import awkward, documents

from sievework.llm import lm_score, queries


def plain(texts, order=lm_score.ORDER):
    pad = b"\n" * (order - 1)
    c = {order: Counter(x[i : i + order] for t in texts if t for x in [pad + t.encode()] for i in range(len(x) - order + 1))}
    for n in range(order - 1, 0, -1):
        c[n] = Counter()
        for k, v in c[n + 1].items():
            c[n][k[1:]] += v
    h = {n: Counter() for n in range(2, order + 1)}
    for n in h:
        for k, v in c[n].items():
            h[n][k[:-1]] += v
    total = sum(c[order].values())

    def loss(text):
        x, out = pad + text.encode(), 0.0
        for i in range(len(x) - order + 1):
            k = x[i : i + order]
            p = (c[1][k[-1:]] + 1) / (total + 256)
            for n in range(2, order + 1):
                p = (c[n][k[-n:]] + lm_score.K * p) / (h[n][k[-n:-1]] + lm_score.K)
            out -= math.log(p)
        return out / len(text.encode())

    return loss


def test_blocks_of_any_size_against_plain_models(spark):
    rows = awkward()
    docs, good = documents(spark, rows, extra=True), spark.createDataFrame([(3,), (8,), (8,), (99,), (None,)], "doc_id long")
    target, background = plain([t for i, t, _, _ in rows if i in (3, 8)]), plain([t for _, t, _, _ in rows])
    for size in (lm_score.BLOCK_BYTES, 100):
        got = lm_score.cross_entropy_difference(docs, good, ["doc_id"], block_bytes=size).collect()
        assert len(got) == len(rows)
        for r in got:
            text = next(t for i, t, _, _ in rows if i == r.doc_id)
            if not text:
                assert (r.n_tokens, r.ce_diff) == (0, None)
            else:
                assert r.n_tokens == len(text.encode()) and math.isclose(r.target_loss, target(text), rel_tol=1e-9) and math.isclose(r.ce_diff, target(text) - background(text), abs_tol=1e-9)


def test_no_target_and_no_document(spark):
    docs = documents(spark, awkward())
    none = spark.createDataFrame([], "doc_id long")
    got = lm_score.cross_entropy_difference(docs, none, ["doc_id"]).where("n_tokens > 0").first()
    assert math.isclose(got.target_loss, math.log(256), rel_tol=1e-9)
    assert lm_score.cross_entropy_difference(docs.limit(0), none, ["doc_id"]).count() == 0


def test_scores_tell_good_documents_apart(spark):
    """Rows kept out of learning, ranked by score: the area under the curve of their quality labels."""
    sf = "/root/testdata/sf0.1"
    scored = queries.op6_lm_score(spark, sf).where("held_out AND n_tokens > 0").join(spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL"), "doc_id")
    rows = sorted((r.ce_diff, r.quality) for r in scored.select("ce_diff", "quality").collect())
    good = sum(q for _, q in rows)
    before = above = 0
    for _, q in rows:  # lower scores come first: good documents should
        above += (good - before) * (1 - q)
        before += q
    area = 1 - above / (good * (len(rows) - good))
    assert len(rows) > 500 and area >= 0.95
