"""Taxonomy, labels, quarantine, reports, sinks and streaming."""

import datetime

import pytest

from vitrine.functions import nodes as nd
from vitrine.operators import labels, profile
from vitrine.operators.products import extract_products
from vitrine.operators.images import gallery_counts
from vitrine.plans.queries import QUERIES
from vitrine.plans.rules import default_rules
from vitrine.sources.pages import quarantine
from vitrine.session import work_folder
from vitrine.sinks.write import output_path, read_products_csv, write_products
from vitrine.sources.pages import embedded_json, quarantine
from vitrine.sources.taxonomy import all_mains, category_paths, subcategories
from vitrine.streaming.ingest import ingest, read_page_stream

BASE = "https://shop.example"
RULES = default_rules(BASE, "https://cdn.shop.example", "store.shop.example")
AS_OF = datetime.datetime(2025, 1, 2, 3, 4, 5)


@pytest.mark.parametrize(
    "visited,expected",
    [
        ([], "unknown"), (["a/b-c"], "a_b_c"), (["a-x"], "a_x"), (["a/b", "a/c"], "a_b_c"),
        (["a/z", "a/m/c-d", "a/b"], "a_z_c_d_b"), (["a-x/1", "a-x/2", "a-x/3", "a-x/4"], "a_x_multiple"),
        (["a", "b"], "multiple_2_categories"), (["a/b", "c/d"], "multiple_2_categories"),
        (["a/b", "a"], "multiple_2_categories"), (["a/b", "a/c", "a/b"], "a_b_c"),
    ],
)
def test_run_label(spark, visited, expected):
    df = spark.createDataFrame(list(enumerate(visited)), "ord int, category string")
    assert [r["label"] for r in labels.run_label(df).collect()] == [expected]


def test_taxonomy(spark):
    rows = [(0, "a", "m", "x"), (1, "a", "m", " "), (2, "b", "n", "y"), (3, "a", "k", "z"), (4, "b", "n", None)]
    taxonomy = spark.createDataFrame(rows, "ord int, main string, mid string, leaf string")
    paths = [r["category"] for r in category_paths(taxonomy, ("b",)).orderBy("ord").collect()]
    assert paths == ["a/x", "b/n/y", "a/z"]
    assert [tuple(r) for r in subcategories(taxonomy, "a", "m").collect()] == [(0, "a/x")]
    assert sorted(map(tuple, all_mains(taxonomy).collect())) == [(0, "a"), (2, "b")]


def test_quarantine(spark):
    pages = spark.createDataFrame(
        [(1, "a", "<p>", 200), (2, "b", None, 200), (3, "c", "<p>", 404), (4, "d", "<p>", None)],
        "page_id long, url string, html string, status int",
    )
    assert sorted((r["page_id"], r["reason"]) for r in quarantine(pages).collect()) == [
        (2, "no html"), (3, "status 404")
    ]


def test_embedded_json_in_order(page):
    html = '<script type="application/ld+json">1</script><script>no</script><script type="application/ld+json">2</script>'
    rows = embedded_json(page(html), "application/ld+json").orderBy("pos").collect()
    assert [(r["pos"], r["body"]) for r in rows] == [(0, "1"), (1, "2")]


def test_titles(page):
    rows = profile.page_titles(page("<title>a &amp; b</title>", "<p>x</p>", "<title></title>")).orderBy("page_id")
    assert [r["title"] for r in rows.collect()] == ["a & b", "No title", ""]


def test_keyword_links_and_first_items(page):
    html = "".join(f'<a href="/Product/{i}"> name {i} {"x" * 60}</a>' for i in range(7)) + '<a href="/item/product">p</a>'
    pages = page(html, "<a href='/none'>n</a>")
    rows = {r["keyword"]: r for r in profile.keyword_links(pages, BASE, samples=5, text_chars=50).collect()}
    assert {k: r["links"] for k, r in rows.items()} == {"product": 8, "item": 1}
    assert len(rows["product"]["samples"]) == 5 and len(rows["product"]["samples"][0]["text"]) == 50
    whole = {r["keyword"]: r for r in profile.keyword_links(pages, BASE).collect()}
    assert len(whole["product"]["samples"]) == 8 and len(whole["product"]["samples"][0]["text"]) == 67
    first = profile.first_item_links(pages, BASE, n=6, samples=5).orderBy("pos").collect()
    assert [r["url"] for r in first] == [f"{BASE}/Product/{i}" for i in range(5)] + [f"{BASE}/item/product"]


def test_failed_pages_are_no_rows(page):
    """No source or a parser error: in the quarantine, in no report."""
    pages = page("<title>t</title><h1>n</h1>", None, "<![abc[y]]>")
    bad = {r["page_id"] for r in quarantine(pages).collect()}
    assert 1 in bad
    good = {0, 1, 2} - bad
    assert {r["page_id"] for r in profile.page_titles(pages).collect()} == good
    assert {r["page_id"] for r in profile.first_headings(pages, RULES).collect()} == good
    assert {r["page_id"] for r in profile.image_report(pages).collect()} == good
    assert {r["page_id"] for r in gallery_counts(pages, RULES).collect()} == good


def test_candidates(page, spark):
    pages = page(
        '<a href="/thuoc/tra-cuu/x">long enough</a><a href="/thuoc/ho">short</a><a href="/thuoc/ho">a good name</a>',
        '<a href="/product/1">another name</a>',
    )
    seeds = spark.createDataFrame([("https://shop.example/p/1.html", 0), ("https://shop.example/p/0.html", 1)], "url string, ord int")
    best = profile.first_candidate(pages, seeds, BASE).collect()
    assert [(r["ord"], r["url"]) for r in best] == [(0, f"{BASE}/product/1")]
    assert profile.first_candidate(pages.filter("false"), seeds, BASE).count() == 0
    assert profile.first_candidate(pages, seeds.filter("ord = 1"), BASE).first()["url"] == f"{BASE}/thuoc/ho"
    assert profile.first_search_hit(pages, seeds, BASE, part="product").first()["link_text"] == "another name"


def test_selector_reports(page):
    pages = page(
        '<div class="row"><div class="card a">x</div><p><div>deep</div></p></div><div class="grid"><div>y</div></div>',
        '<div class="mycard">z</div>',
    )
    rows = {r["selector"]: tuple(r)[1:] for r in profile.selector_profile(pages).collect()}
    assert rows['[class*="card"]'] == (2, 2, "card a")
    assert rows[".row > div"] == (1, 1, "card a") and rows[".grid > div"] == (1, 1, None)
    assert rows['[class*="box"]'] == (0, 0, None)


def test_first_hit_variants(page):
    pages = page('<h1></h1><p class="title">t</p><img data-src="d"><div class="image"><img src="s"></div>')
    loose = {r["field"]: r for r in profile.selector_first_hit(pages, profile.PROBE_A, False).collect()}
    strict = {r["field"]: r for r in profile.selector_first_hit(pages, profile.PROBE_B, True).collect()}
    assert (loose["title"]["selector"], loose["title"]["content"]) == ("h1", "")
    assert (strict["title"]["selector"], strict["title"]["content"]) == (".title", "t")
    assert (strict["image"]["selector"], strict["image"]["content"]) == (".image img", "s")
    assert "image" not in loose and "price" not in strict


def test_image_report(page):
    row = profile.image_report(page('<img src="/Product/1" alt=""><img src="/x"><img src="/item"><img>')).first()
    assert row["images"] == 2
    assert [(s["alt"], s["src"]) for s in row["samples"]] == [("", "/Product/1"), ("No alt", "/item")]


def test_child_selector_keeps_parent(page):
    sel = nd.tag("b").child(nd.cls("k"))
    rows = profile.selector_profile(page('<i class="k"><b>1</b><u><b>2</b></u></i>'), [sel]).collect()
    assert [(r["selector"], r["elements"]) for r in rows] == [(".k > b", 1)]


def test_write_and_read_back(spark, page):
    html = '<h1>a "q", b\nc</h1><p class="usage"></p><img src="https://{}/dsc_1,2.png">'.format(RULES.image_host)
    record = extract_products(page(html, "<h1> x\\n</h1>"), RULES, as_of=AS_OF)
    seeds = spark.createDataFrame([(0, "a/b-c")], "ord int, category string")
    path = output_path(spark, work_folder(spark, "out"), seeds, AS_OF)
    assert path.endswith("/products_a_b_c_20250102_030405")
    assert write_products(record, path, ("json", "csv")) == {"parquet": 2, "json": 2, "csv": 2}
    expected = sorted(map(tuple, record.collect()))
    schema = spark.read.parquet(f"{path}/parquet").schema
    assert sorted(map(tuple, spark.read.schema(schema).json(f"{path}/json").collect())) == expected
    assert sorted(map(tuple, read_products_csv(spark, f"{path}/csv", schema).collect())) == expected


def test_empty_run_writes_nothing(spark, page):
    path = work_folder(spark, "empty")
    assert write_products(extract_products(page(None), RULES, as_of=AS_OF), path) == {}
    with pytest.raises(Exception):
        spark.read.parquet(f"{path}/parquet")
    with pytest.raises(ValueError):
        write_products(extract_products(page("<p>"), RULES, as_of=AS_OF), path, ("xml",))


def test_stream_appends_new_files_once(spark, page):
    drop, out, log = (work_folder(spark, n) for n in ("drop", "table", "log"))

    def project(pages):
        return profile.first_headings(pages, RULES)

    schema = page("x").schema
    for count, names in ((2, ("a", "b")), (3, ("a",))):
        page(*[f"<h1>{n}</h1>" for n in names]).write.mode("append").parquet(drop)
        ingest(read_page_stream(spark, drop, schema), project, out, log).awaitTermination()
        assert spark.read.parquet(out).count() == count


def test_stream_query_reads_a_table_in_a_folder(spark, page, tmp_path):
    """``pages.parquet`` as a folder of files of any name, as one file, and without rows."""
    pages = page(*[f"<h1>{i}</h1>" for i in range(9)])
    pages.repartition(3).write.parquet(f"{tmp_path}/many/pages.parquet")
    pages.filter("false").write.parquet(f"{tmp_path}/none/pages.parquet")
    (tmp_path / "one").mkdir()
    pages.toPandas().to_parquet(f"{tmp_path}/one/pages.parquet")
    for folder, count in (("many", 9), ("one", 9), ("none", 0)):
        rows = QUERIES["stream_ingest"](spark, f"{tmp_path}/{folder}").collect()
        assert sorted(map(tuple, rows)) == [(i, str(i)) for i in range(count)]


def test_work_folder_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(root) and first != second
