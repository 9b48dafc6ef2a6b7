"""Walks over seed pages: the first hit, and no page parsed behind its block."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators import profile

BASE = "https://shop.example"


@pytest.fixture(scope="module")
def corpus(spark):
    """2000 seed pages, one link each; item links from seed ``start`` on, every hundredth."""
    def make(start, step=100):
        item = f"id >= {start} AND (id - {start}) % {step} = 0"
        return spark.range(2000).selectExpr(
            "id AS page_id", "concat('https://shop.example/s/', id) AS url",
            f"concat('<a href=\"/', if({item}, 'product', 'page'), '/', id, '\">some link text</a>') AS html",
        )

    return make


@pytest.fixture(scope="module")
def seeds(spark):
    return spark.range(2000).selectExpr("concat('https://shop.example/s/', id) AS url", "id * 3 AS ord")


def find(pages):
    return profile.candidate_links(pages, BASE, carry=("ord",))


@pytest.mark.parametrize("start, most", [(0, 20), (15, 20), (100, 200), (500, 1200), (1999, 2000)])
def test_stops_at_the_block_of_the_first_hit(corpus, seeds, start, most):
    pages = corpus(start)
    hit, parsed = profile.walk_seeds(pages, seeds, find)
    whole = profile.first_link(find(profile.seed_pages(pages, seeds)))
    assert hit.collect() == whole.collect() and hit.first()["page_id"] == start
    assert start < parsed <= most


def test_without_a_hit_every_page_is_parsed_once(corpus, seeds):
    hit, parsed = profile.walk_seeds(corpus(5000), seeds, find)
    assert hit.count() == 0 and parsed == 2000


def test_odd_seeds(corpus, seeds, spark):
    pages = corpus(100)
    # unknown and repeated urls, equal and missing ranks
    odd = seeds.filter("ord > 1000").unionByName(
        spark.sql("SELECT concat('https://shop.example/', id) AS url, 1L AS ord FROM range(50)")
    )
    hit, _ = profile.walk_seeds(pages, odd.unionByName(odd), find)
    assert hit.first()["page_id"] == 400
    same = seeds.withColumn("ord", F.lit(7).cast("long"))
    assert profile.walk_seeds(pages, same, find)[0].first()["page_id"] == 100
    first = seeds.withColumn("ord", F.when(F.col("url").endswith("/700"), None).otherwise(F.col("ord")))
    assert profile.walk_seeds(pages, first, find)[0].first()["page_id"] == 700
    none = seeds.withColumn("ord", F.lit(None).cast("long"))
    assert profile.walk_seeds(pages, none, find)[0].first()["page_id"] == 100
    assert profile.walk_seeds(pages, seeds.limit(0), find)[0].count() == 0
