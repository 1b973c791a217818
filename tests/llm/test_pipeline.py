import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers as P
import tiktoken
from helpers import awkward, components, covered, documents, words

from sievework.llm import bpe, mixing

THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_vocabulary(P.path("byte_bpe_multi_50k.tiktoken")).ranks, special_tokens={})

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        if name == "mixing_sources":
            stream, planned = docs.collect(), mixing.plan_mix(last, keep=["doc_id", "text"]).collect()
            assert Counter((r.doc_id, r.text) for r in stream) == Counter({(r.doc_id, r.text): r.copies for r in planned if r.copies})
            when = {(r.doc_id, e): p for r in planned for e, p in enumerate(r.positions)}
            seen: Counter = Counter()
            order = []
            for r in stream:
                order.append(when[r.doc_id, seen[r.doc_id]])
                seen[r.doc_id] += 1
            assert order == sorted(order)
            break
        last = docs
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "near_duplicates":
            low = {i: words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in before[i].text)) for i in before}
            sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for i, w in low.items()}
            holders = defaultdict(list)
            for i in sorted(sets):
                for x in sets[i]:
                    holders[x].append(i)
            pairs = {(a, b) for ids in holders.values() for k, b in enumerate(ids) for a in ids[:k]}
            like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in pairs}
            firm, loose = (components(sets, [p for p, j in like.items() if j >= least]) for least in (0.9, 0.7))
            assert not any(firm[i] != i for i in after)  # what is surely a near copy of a smaller id is gone
            assert all(i in after for i in sets if loose[i] == i) and len(after) < len(before)  # what has no near copy before it stays
            assert all(after[i] == before[i] for i in after)
        elif name == "repeated_passages":
            texts = [words(before[i].text) for i in before]
            want = {i: " ".join(x for x, c in zip(w, h, strict=True) if not c) for i, w, h in zip(before, texts, covered(texts, 35), strict=True)}
            assert {i: r.text for i, r in after.items()} == want and all(r.n_chars == len(r.text) for r in after.values())
        else:
            assert len(after) >= 0.8 * len(before) and all(after[i] == before[i] for i in after)
        before = after


def mixed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    return docs.collect()


def test_whole_run_keeps_the_order_of_the_stream(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    made = mixed(spark)
    assert [r.doc_id for r in rows] == [r.doc_id for r in made]
    places = [(r.stream_part, r.stream_row) for r in rows]
    assert places == sorted(set(places))
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((r.doc_id, tuple(THEIRS.encode_ordinary(r.text))) for r in made)
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)
    assert all(r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in r.ids)).hexdigest() for r in rows[:20])


def test_order_of_many_files(spark, tmp_path):
    """Files of one task and tasks beyond five digits come in the order of their numbers."""
    df = documents(spark, [(i, f"text {i}", "en", "a") for i in range(100)]).repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id")
    df.write.option("maxRecordsPerFile", 3).parquet(str(tmp_path / "a"))
    for f in (tmp_path / "a").glob("part-00004*"):
        f.rename(f.with_name(f.name.replace("part-00004", "part-100004")))
    assert [r.doc_id for r in corpus_pipeline.encoding(spark, spark.read.parquet(str(tmp_path / "a")), SF).collect()] == list(range(100))


def test_near_duplicates_do_not_depend_on_the_order_of_rows(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", "x"), (1, text, "de", "y"), (1, text, None, None), (1, text, "en", "x"), (2, text + " eleven", "en", "x"), (None, "alone", "en", "x"), (None, "alone", "fr", "x")]
    seen = set()
    for k in range(6):
        docs = documents(spark, rows[k:] + rows[:k]).coalesce(1)
        seen.add(tuple(sorted(map(str, corpus_pipeline.near_duplicates(spark, docs, SF).collect()))))
    assert len(seen) == 1 and len(next(iter(seen))) == 2, seen


def test_awkward_documents(spark, tmp_path):
    docs = documents(spark, awkward(), extra=True).selectExpr("*", "1 AS kept", "2 AS n_words", "true AS accepted", "'z' AS lang_pred", "3 AS _k1", "4 AS _k2", "5 AS _position", "6 AS _epoch", "7 AS _0", "8 AS _id", "9 AS _text", "10 AS _in0", "11 AS in_0")
    docs.write.parquet(str(tmp_path / "docs"))
    docs.limit(0).write.parquet(str(tmp_path / "none"))
    kept = {"near_duplicates": 7, "repeated_passages": 12, "encoding": 12}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.read.parquet(str(tmp_path / "docs")), SF)
        ids = [r.doc_id for r in out.collect()]
        assert len(ids) == kept.get(name, len(ids)) and (name == "encoding" or out.columns == docs.columns)
        assert name not in ("language_id", "mixing_sources") or not {0, 1, 2} & set(ids)
        assert stage(spark, spark.read.parquet(str(tmp_path / "none")), SF).count() == 0
