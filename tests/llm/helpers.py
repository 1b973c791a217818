"""Plain versions of the operators, and tables of awkward documents."""

import re
from collections import Counter

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows, extra=False):
    """Rows of (doc_id, text, lang, source); with extra columns whose names operators use themselves."""
    df = spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], DOC_SCHEMA)
    if not extra:
        return df
    from pyspark.sql import functions as F

    return df.selectExpr("*", "'x' AS fp", "1 AS size", "2 AS anchor", "'y' AS score", "3 AS position", "4 AS n", "5 AS key", "6 AS component_id", "7 AS n_tokens", "8 AS epoch").withColumn("row", F.lit(1))


def awkward():
    """Null, empty, blank, very long, repeated and tied rows."""
    long = " ".join(f"w{i % 997}" for i in range(20000))
    return [
        (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, None), (3, "one two three four", "en", "b"), (3, "one two three four", "en", "b"), (4, "one two three four", "de", None),
        (None, "a null id here", "en", "a"), (5, long, "en", "a"), (6, long + " tail", "en", "c"), (7, "x", "fr", "a"), (8, "Ünïcödé ß 漢字 🎉🎉 \u00a0 y", "de", "b"), (9, "1 2 3 4 5", None, "b"),
    ]


def components(ids, linked):
    """Smallest id that each id reaches."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def covered(texts, window):
    """For each list of words which words a repeated window covers."""
    counts = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for w in texts:
        hit = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                hit[i : i + window] = [True] * window
        out.append(hit)
    return out
