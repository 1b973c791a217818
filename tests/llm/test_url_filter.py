import pytest
from pyspark.sql import functions as F

from sievework.llm import url_filter

RULES = [("block", "bad.com", ""), ("allow", "good.bad.com", "/ok/"), ("block", "com", "/ads/"), ("block", "x.org", "/a/b"), ("allow", "x.org", "/a/")]
URLS = [(1, "http://BAD.com/x"), (2, "https://a.good.bad.com/ok/1?q"), (3, "http://good.bad.com/no"), (4, "http://z.com/ads/"), (5, "http://notbad.com/"), (6, None), (7, "no scheme bad.com"), (8, "x://x.org/a/bc#f"),
        (9, "x://x.org/a/c"), (10, ""), (11, "http://bad.com"), (11, "http://bad.com"), (None, "http://" + "a." * 300 + "bad.com/" + "p/" * 500), (12, "http:///ads/"), (13, "a://b.com?x://bad.com/")]


def plain(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host, rest = rest[:cut].lower(), rest[cut:]
    path = rest[: min([i for c in "?#" if (i := rest.find(c)) >= 0], default=len(rest))]
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


@pytest.mark.parametrize("bound", [1000, 1])
def test_against_plain_rules_by_broadcast_and_by_shuffle(spark, bound):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumns({"host": F.lit("h"), "rule": F.lit("r"), "row": F.lit(1), "expr": F.lit("e")})
    got = url_filter.filter_urls(pages, spark.createDataFrame(RULES, "verdict string, host string, path string"), broadcast_rows=bound)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *plain(u)) for i, u in URLS), key=repr)


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}
