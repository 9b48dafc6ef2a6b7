import pytest
from pyspark.sql import functions as F

from vitrine.functions import text as tx, urls
from vitrine.functions.jsonsearch import search_script


def one(spark, expression, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(F.expr(expression).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw,expected",
    [(" a\r\nb  c\t", "a  b  c"), ("\xa0　x y\x1f", "x y"), ("", ""), (None, None), ("\n\t", "")],
)
def test_clean_text(spark, raw, expected):
    assert one(spark, tx.clean_text("t"), t=raw) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("25.000đ / 30 viên", 2500030.0), ("12,5", 125.0), ("Liên hệ", 0.0), ("", 0.0), (None, 0.0), ("5²", 5.0)],
)
def test_parse_price(spark, raw, expected):
    assert one(spark, tx.parse_price("t"), t=raw) == expected


def test_count_too_large_is_missing(spark):
    assert one(spark, tx.parse_count("t"), t="9" * 30) is None


@pytest.mark.parametrize(
    "raw,expected", [("4.5 (12)", 4.5), ("x 12\xa0(3)", 12.0), ("(3)", None), ("1. (", None)]
)
def test_number_before(spark, raw, expected):
    assert one(spark, tx.number_before("t", r"\("), t=raw) == expected


@pytest.mark.parametrize(
    "href,expected",
    [("/a/b", "https://s/a/b"), ("a/b", "a/b"), ("//h/thuoc/x.html", "https://s//h/thuoc/x.html"),
     ("https://o/x", "https://o/x")],
)
def test_absolutise(spark, href, expected):
    assert one(spark, urls.absolutise("u", "https://s"), u=href) == expected


@pytest.mark.parametrize(
    "url,expected",
    [("https://s/a/b.html", True), ("https://s/b.html", False), ("https://s/a/b.html?x=1", False),
     ("https://s/a/b#c.html", False), ("https://s/a/page=2/b.html", False), ("https://s/a/b", False)],
)
def test_item_url(spark, url, expected):
    assert one(spark, urls.is_item_url("u", "https://s"), u=url) is expected


@pytest.mark.parametrize(
    "url,expected",
    [("c/unsafe/150x0/x", "c/unsafe/768x0/x"), ("c/unsafe/375x0/x", "c/unsafe/768x0/x"),
     ("c/unsafe/https://h/x", "c/unsafe/768x0/filters:quality(90)/https://h/x"), ("c/x", "c/x")],
)
def test_full_size_image(spark, url, expected):
    assert one(spark, urls.full_size_image("u"), u=url) == expected


def test_small_url_functions(spark):
    assert one(spark, urls.category_head("c"), c="a/b/c") == "/a/"
    assert one(spark, urls.last_segment("c"), c="a/b/c.png") == "c.png"


KEYS = ("brand", "manufacturer")


@pytest.mark.parametrize(
    "body,expected",
    [
        ('{"z":{"brand":"A"},"brand":"B"}', ("A", False)),
        ('{"brand":"","manufacturer":"M"}', (None, False)),
        ('{"a":{"brand":"","manufacturer":"M"},"c":[1,{"Brand":{"name":"N"}}]}', ("N", False)),
        ('{"brandName": "Q",', (None, True)),
        ('{"brand":{"name":5}}', (None, True)),
        ('{"brand":{"name":""},"x":{"brand":"B"}}', (None, False)),
        ('{"brand":["x",{"manufacturer":"k"}]}', ("k", False)),
        ('{"brand":null,"other":{"BRAND":"up"}}', ("up", False)),
        ("[]", (None, False)),
        ('"text"', (None, False)),
        ('{"brand":"\\ud800"}', ("?", False)),
        ("[" * 100000, (None, True)),
    ],
)
def test_json_search(body, expected):
    assert search_script(body, KEYS) == expected
