from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.functions import fold, text, urls


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_folds_differ_where_they_should():
    assert fold.fold_text("Weiß  Ströhm", "ingest") == "weiss strohm"
    assert fold.fold_text("Weiß  Ströhm", "text") == "weiß strohm"
    assert fold.fold_text("A  É", "token") == "a  e"
    assert fold.fold_text("Nuits-Saint-Georges", "label") == "nuits saint georges"
    assert fold.fold_text("Morey St. Denis", "label") == "morey saint denis"
    assert fold.fold_text("St.-Émilion", "label") == "saint emilion"
    assert fold.fold_text("Napa Valley - California", "label") == "napa valley - california"


@given(st.text(alphabet=[chr(c) for c in range(32, 0x250)], max_size=30))
def test_fold_is_stable(t):
    for kind in fold.KINDS:
        assert fold.fold_text(fold.fold_text(t, kind), kind) == fold.fold_text(t, kind)


def test_fold_latin_equals_exact_fold_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    assert docs.where(fold.fold(F.col("text"), "text") != fold.fold_latin(F.col("text"))).isEmpty()


def test_null_folds_to_null(spark):
    assert one(spark, fold.fold(F.col("a"), "label"), a=None) is None


def test_urls(spark):
    assert one(spark, urls.host(F.col("a")), a="https://WWW.Shop.Example.com:80/x?y") == "shop.example.com"
    assert one(spark, urls.host(F.col("a")), a=None) == ""
    assert one(spark, urls.on_site(F.col("a"), F.col("b")), a="http://a.b.com/", b="b.com") is True
    assert one(spark, urls.on_site(F.col("a"), F.col("b")), a="http://ab.com/", b="b.com") is False
    assert one(spark, urls.on_site(F.col("a"), F.col("b"), ["ads.com"]), a="http://x.ads.com/", b="*") is False
    assert one(spark, urls.url_key(F.col("a")), a=" HTTP://A.com/x// ") == "http://a.com/x"
    assert one(spark, urls.longest_segment(F.col("a")), a="http://a.com/wine/ch%C3%A2teau-rouge/aa?z") == "château-rouge"


def test_text_predicates(spark):
    assert one(spark, text.significant_tokens(F.col("a"), ["wine"]), a="the wine of margaux margaux x") == ["margaux"]
    assert one(spark, text.price_only(F.col("a")), a="$ 12.99, 3 (50%)") is True
    assert one(spark, text.price_only(F.col("a")), a="12 bottles") is False
    assert one(spark, text.number(F.col("a")), a=" 1,234.5 ") == 1234.5
    assert one(spark, text.number(F.col("a")), a="n/a") is None
    assert one(spark, text.is_list_page(F.col("a")), a="Red Wine White Wine Rose Wine Sparkling Wine Port") is True
    assert one(spark, text.is_list_page(F.col("a")), a="this is a plain sentence with no names in it") is False
    assert one(spark, text.is_search_echo(F.col("a"), r"results for (.+)"), a="results for red wine") is True
    assert one(spark, text.is_search_echo(F.col("a"), r"results for (.+)"), a="results for Red wine") is False
    assert one(spark, text.clean_text(F.col("a"), ["add to cart"], [r"free shipping[^.]*\."]), a="Good. ADD to cart  Free shipping over 10. Bye") == "Good. Bye"
    assert one(spark, text.value_conflict(text.slug_words(F.col("a")), F.lit("red"), {"red": ["white", "rose"]}, F.array(F.lit("rose"))), a="http://x.com/a-rose-white") is True
    assert one(spark, text.value_conflict(text.slug_words(F.col("a")), F.lit("red"), {"red": ["white", "rose"]}, F.array(F.lit("rose"))), a="http://x.com/a-rose") is False
