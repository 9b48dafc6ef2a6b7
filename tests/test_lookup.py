"""Pages found by URL: plans, pruning, and schemas of the parse step."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from vitrine import session
from vitrine.operators import images, links, lookup, profile
from vitrine.plans.rendered import BASE, RULES, product_pages
from vitrine.sources.pages import embedded_json, usable_pages
from vitrine.sources.parse import parse_pages


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored_pages(spark, data):
    pages = product_pages(spark.read.parquet(f"{data}/part.parquet"))
    yield lookup.store_by_url(pages, "pages_of_test_lookup", 8)
    spark.sql("DROP TABLE pages_of_test_lookup")


def exchanges_with(text, column):
    """Exchange nodes whose input holds ``column``."""
    nodes = re.split(r"\n\n+", text)
    return [n for n in nodes if re.match(r"\(\d+\) Exchange", n) and re.search(rf"\b{column}#", n.split("Arguments")[0])]


def test_long_lists_move_no_page_sources(spark, stored_pages, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "SHORT", 0)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, -1)
    try:
        wanted = stored_pages.select("url").filter("page_id % 2 = 0")
        found = lookup.pages_of(usable_pages(stored_pages), wanted)
        text = plan(found)
        assert "SortMergeJoin" in text and not exchanges_with(text, "html")
        assert found.count() == wanted.count()
        # the same pages outside buckets are shuffled
        loose = lookup.pages_of(stored_pages.withColumn("url", F.concat("url", F.lit(""))), wanted)
        assert exchanges_with(plan(loose), "html")
    finally:
        spark.conf.set(conf, before)


@pytest.mark.parametrize("ids", [[3], [3, 4, 5], []])
def test_short_lists_read_only_their_buckets(spark, stored_pages, ids):
    wanted = stored_pages.select("url", "page_id").filter(F.col("page_id").isin(ids)).select("url")
    found = lookup.pages_of(stored_pages, wanted)
    assert sorted(r.page_id for r in found.collect()) == ids
    leaves = found._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [leaf for leaf in (leaves.apply(i) for i in range(leaves.size())) if "pages_of_test" in leaf.nodeName()]
    if ids:  # an empty list needs no scan at all
        assert scans[0].optionalBucketSet().get().cardinality() <= len(ids)


def test_ways_agree(spark, stored_pages, monkeypatch):
    wanted = stored_pages.selectExpr("url", "page_id AS ord").filter("page_id % 3 = 0").unionByName(
        spark.sql("SELECT 'https://shop.example/none' AS url, 1L AS ord UNION ALL SELECT NULL, 2L")
    )
    got = []
    for size, short in ((session.BROADCAST_BYTES, 10_000), (session.BROADCAST_BYTES, 0), (0, 0)):
        monkeypatch.setattr(session, "BROADCAST_BYTES", size)
        monkeypatch.setattr(lookup, "SHORT", short)
        got.append(sorted(map(tuple, lookup.pages_of(stored_pages, wanted).select("page_id", "ord").collect())))
    assert got[0] == got[1] == got[2] and len(got[0]) == wanted.count() - 2


def outputs(df):
    """Columns that the parse step sends back."""
    step = next(n for n in re.split(r"\n\n+", plan(df)) if re.match(r"\(\d+\) MapInArrow", n))
    return set(re.findall(r"\b(text|markup|nodes|json_hits|parse_error)#", step.split("Arguments")[1]))


def test_parse_sends_back_what_is_read(page):
    df = page("<p>x</p>")
    assert outputs(links.page_links(df, BASE)) == {"nodes", "parse_error"}
    assert outputs(links.page_links(df, BASE, with_text=True)) == {"text", "nodes", "parse_error"}
    assert outputs(embedded_json(df, "application/json")) == {"nodes", "parse_error"}
    assert outputs(images.gallery_counts(df, RULES)) == {"nodes", "parse_error"}
    assert outputs(images.product_images(df, RULES)) == {"nodes", "parse_error"}
    assert parse_pages(df, json_keys=("brand",), markup_attrs=()).columns == [
        "page_id", "url", "text", "markup", "nodes", "json_hits", "parse_error",
    ]


def test_word_table_equals_word_list(page, spark):
    words = ["ab", "b/", "zz", "abc", "Ab", "a"]
    df = page(*[f'<a href="/{x}/{i}.html">{x} text {i}</a><a>none</a><a href="{x}">y</a>' for i, x in enumerate(["ab", "ABC", "zzz", "b", "", "a/b/ab"])])
    table = spark.createDataFrame(list(enumerate(words)) + [(9, ""), (3, "abc")], "keyword_ord int, keyword string")
    for samples, chars in ((None, None), (1, 3)):
        report = profile.keyword_links_by_table(df, table, BASE, samples, chars)
        listed = profile.keyword_links(df, BASE, words, samples, chars)
        shown = lambda r: sorted(map(repr, r.select("page_id", "url", "keyword_ord", "keyword", "links", "samples").collect()))
        assert shown(report) == shown(listed)
    assert profile.keyword_links_by_table(df, table.limit(0), BASE).count() == 0
    # a thousand words make no longer plan than ten
    many = spark.range(1000).selectExpr("CAST(id AS INT) AS keyword_ord", "concat('word', id) AS keyword")
    assert len(plan(profile.keyword_links_by_table(df, many, BASE))) < 1.2 * len(plan(profile.keyword_links_by_table(df, many.limit(10), BASE)))


def test_limits_can_be_lifted(page):
    from dataclasses import replace

    from vitrine.operators.products import extract_fields
    from vitrine.plans.rendered import CDN, HOST

    urls = ", ".join(f'"{CDN}/https://{HOST}/dsc_{i}.jpg"' for i in range(20))
    thumbs = "".join(f'<div class="lg-thumb-item"><img src="https://{HOST}/dsc_t{i}.jpg"></div>' for i in range(4))
    df = page(f'{thumbs}<script type="application/json">[{urls}]</script>')
    count = lambda rules: len(extract_fields(df, rules, ["images"]).first()["images"])
    assert count(RULES) == 4 and count(replace(RULES, json_image_min=None)) == 10
    assert count(replace(RULES, json_image_min=None, json_image_stop=None)) == 24
    short = page('<a href="/product/1">ab</a>', f'<a href="/product/2">{"long " * 60}</a>')
    assert profile.candidate_links(short, BASE).count() == 0
    assert profile.candidate_links(short, BASE, min_text=None, max_text=None).count() == 2
