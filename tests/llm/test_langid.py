import unicodedata

import zstandard
from helpers import SF, awkward, documents
from pyspark.sql import functions as F

from sievework.llm import langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op8_langid(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    row = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.avg(F.col("accepted").cast("int")).alias("kept"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row.right >= 0.98 and row.kept >= 0.98 and 0 <= row.low <= row.high <= 1


def test_awkward_documents(spark):
    docs = documents(spark, awkward(), extra=True)
    got = langid.identify(docs, langid.learn(docs), ["doc_id", "score"]).collect()
    assert len(got) == len(awkward())
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (0, 1, 2, 9)} == {0: "und", 1: "und", 2: "und", 9: "und"}
    assert all(r.lang_pred in ("en", "de", "fr") for r in got if r.doc_id in (3, 5, 8))


def test_nothing_learned_or_judged(spark):
    docs = documents(spark, awkward())
    assert langid.learn(docs.withColumn("lang", F.lit(None).cast("string"))) == []
    assert {r.lang_pred for r in langid.identify(docs, [], ["doc_id"]).collect()} == {"und"}
    assert langid.identify(docs.limit(0), [], ["doc_id"]).count() == 0


def test_ties_are_rejected():
    judge = langid.Compressors([("aa", b"same text " * 50), ("bb", b"same text " * 50)]).judge
    assert judge("same text", 0.01) == ("aa", 0.0, False)


def plain(dictionaries, text):
    """The language of the fewest bytes, each block compressed on its own, by a loop over characters."""
    kept, out = False, []
    for c in (text or "").lower():
        kind = unicodedata.category(c)[0]
        kept |= kind == "L"
        out.append(c if kind in "LM" else " ")
    data = " ".join("".join(out).split(" ")).strip()
    while "  " in data:
        data = data.replace("  ", " ")
    data = data.encode() if kept else b""
    if not data:
        return "und", None
    sizes = []
    for _, content in dictionaries:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total = 0
        for i in range(0, len(data), 4096):
            block = data[i : i + 4096]
            block = block if len(block) >= 400 else (block + b" ") * 4
            frame = zstandard.ZstdCompressor(level=5, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False).compress(block)
            assert zstandard.ZstdDecompressor(dict_data=held).decompress(frame, max_output_size=len(block)) == block
            total += len(frame)
        sizes.append(total)
    return dictionaries[sizes.index(min(sizes))][0], sorted(sizes)


def test_against_plain_sizes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = langid.learn(docs.where(~langid.held_out("doc_id")))
    got = {r.doc_id: r for r in langid.identify(docs, dictionaries, ["doc_id"]).collect()}
    for r in docs.collect():
        lang, sizes = plain(dictionaries, r.text)
        assert got[r.doc_id].lang_pred == lang
        if sizes:
            assert got[r.doc_id].accepted == (sizes[1] - sizes[0] >= 0.01 * sizes[0] and sizes[1] > sizes[0])
            assert got[r.doc_id].score == 1 - 2.0 ** -min(sizes[1] - sizes[0], 50)


def test_texts_without_a_letter(spark):
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(["\u00bd", "\u00b2\u00b3", "\u2460\u2461", "12 + 3", "\u0301\u0302", "_", "\u2167"])] + [(9, "plain words of a text", "en", "a"), (10, "autres mots", "fr", "a")])
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, langid.learn(docs), ["doc_id"]).collect()}
    assert got.pop(9) == "en" and got.pop(10) == "fr" and set(got.values()) == {"und"}
    assert langid.letters("\u0939\u093f\u0928\u094d\u0926\u0940 2x") == "\u0939\u093f\u0928\u094d\u0926\u0940 x".encode()  # vowel signs stay in their word


def test_excerpts_are_spread(spark):
    text = "".join(f"{i:06d}" for i in range(5000))
    got = spark.createDataFrame([(text,)], "t string").select(langid.spread(F.col("t"), 1500)).first()[0].split("\n")
    assert [len(p) for p in got] == [300] * 5 and got[0] == text[:300] and got[-1] == text[-300:] and got[2] in text
