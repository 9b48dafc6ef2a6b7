"""The registered queries: one callable ``(spark, folder) -> DataFrame`` per operator.

Page operators run on the given ``pages``; record operators run on pages rendered
from ``part`` (see ``rendered.py``).  All read whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions import nodes as nd
from vitrine.functions import text as tx
from vitrine.functions import urls
from vitrine.operators import counting, follow, images, labels, limits, links, products, profile, winners
from vitrine.operators.lookup import store_by_url
from vitrine.plans import rendered
from vitrine.plans.catalogue import (
    extract_category, read_catalogue, resume_catalogue, run_catalogue, union_runs,
)
from vitrine.session import spread, stored, work_folder
from vitrine.sinks.write import (
    Folder, read_failures, read_products_csv, read_records, write_outcomes, write_products,
)
from vitrine.sources.pages import embedded_json, load_pages, quarantine
from vitrine.sources.taxonomy import all_mains, category_paths, subcategories
from vitrine.streaming.ingest import ingest, ingest_records, read_page_stream, read_table_stream

BASE = rendered.BASE
RULES = rendered.RULES
AS_OF = "2025-01-01 00:00:00"
SECTION = "regexp_extract(page_url, '^https?://[^/]+/([^/?#]+)', 1)"
SITE = "regexp_extract(url, '^https?://([^/]+/[^/?#]+)', 1)"

# report parameters used with the given pages (their links are invented words)
KEYWORDS = ("the", "en", "que", "st")
PROFILED = (
    nd.tag("p"), nd.cls("ad", of="div"), nd.tag("li").child(nd.tag("ul")), nd.cls_part("a"),
)
IMAGE_WORDS = ("dsc_1", "_2")

CORE = ("name", "price", "unit", "sku", "original_price", "discount", "description", "usage",
        "availability", "category")
RATED = ("rating", "reviews_count", "comments_count")
TABLED = ("official_name", "registration_number", "form", "package_size", "origin_brand",
          "manufacturer", "country_of_manufacture", "ingredients")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return load_pages(spark, f"{folder}/pages.parquet")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return rendered.product_pages(_table(spark, folder, "part"))


def _fields(spark, folder, *fields) -> DataFrame:
    found = products.extract_fields(_items(spark, folder), RULES, fields, carry=("url",))
    return products.with_sentinels(found.filter(F.col("parse_error").isNull())).select("url", *fields)


# -- given pages --------------------------------------------------------------
def page_titles(spark, folder):
    return profile.page_titles(_pages(spark, folder))


def h1_names(spark, folder):
    return profile.first_headings(_pages(spark, folder), RULES).select("page_id", "name")


def links_all(spark, folder):
    return links.page_links(_pages(spark, folder), BASE).select("page_id", "pos", "href")


def links_absolute(spark, folder):
    return links.page_links(_pages(spark, folder), BASE).select("page_id", "pos", "url")


def links_distinct(spark, folder):
    return links.distinct_links(links.page_links(_pages(spark, folder), BASE))


def item_urls(spark, folder):
    pages = _table(spark, folder, "pages")
    return pages.filter(urls.is_item_url("url", "https://")).select("page_id", "url")


def links_top_n(spark, folder):
    found = links.page_links(_pages(spark, folder), BASE).withColumn("section", F.expr(SECTION))
    return limits.first_per_group(found, 3, "section").select("section", "page_id", "pos", "href")


def links_top_many(spark, folder):
    found = links.page_links(_pages(spark, folder), BASE).withColumn("scope", F.lit("all"))
    return limits.first_per_group(found, 1200, "scope").select("scope", "page_id", "pos", "href")


def category_counts(spark, folder):
    pages = _table(spark, folder, "pages").select("url")
    sites = pages.select(F.expr(SITE).alias("category")).distinct()
    return counting.category_counts(pages, sites, gram=8)


def parse_quarantine(spark, folder):
    pages = _pages(spark, folder).selectExpr(
        "page_id", "url",
        "if(page_id % 7 = 0, NULL, html) AS html",
        "if(page_id % 11 = 3, 404, 200) AS status",
    )
    return quarantine(pages).select("page_id", "reason")


def keyword_links(spark, folder):
    report = profile.keyword_links(_pages(spark, folder), BASE, KEYWORDS, samples=5, text_chars=50)
    return report.selectExpr(
        "page_id", "keyword_ord", "keyword", "links",
        "array_join(transform(samples, s -> concat(s.text, '->', s.url)), '|') AS samples",
    )


def keyword_links_table(spark, folder):
    """The words of all page titles as the word list."""
    title = "regexp_extract(html, '<title>([^<]*)', 1)"
    words = (
        _table(spark, folder, "pages")
        .selectExpr("page_id", f"explode(regexp_extract_all(lower({title}), '[a-z]{{3,}}', 0)) AS keyword")
        .groupBy("keyword").agg(F.min("page_id").alias("keyword_ord"))
    )
    report = profile.keyword_links_by_table(_pages(spark, folder), words, BASE, samples=5, text_chars=50)
    return report.selectExpr(
        "page_id", "keyword_ord", "keyword", "links",
        "array_join(transform(samples, s -> concat(s.text, '->', s.url)), '|') AS samples",
    )


def first_item_links(spark, folder):
    return profile.first_item_links(_pages(spark, folder), BASE, KEYWORDS, n=5, samples=5, text_chars=50)


def selector_profile(spark, folder):
    return profile.selector_profile(_pages(spark, folder), PROFILED)


def _seeds(spark, folder):
    return _table(spark, folder, "pages").selectExpr("url", "1000000000 - page_id AS ord")


def first_candidate(spark, folder):
    return profile.first_candidate(
        _pages(spark, folder), _seeds(spark, folder), BASE, parts=("/th", "/st"), skips=("/the?", "/that")
    )


def first_search_hit(spark, folder):
    return profile.first_search_hit(_pages(spark, folder), _seeds(spark, folder), BASE, part="th")


def stream_ingest(spark, folder):
    pages = _table(spark, folder, "pages")
    stream = read_table_stream(spark, f"{folder}/pages.parquet", pages.schema)
    out, log = work_folder(spark, "ingest"), work_folder(spark, "ingest-log")
    run = ingest(stream, lambda batch: profile.first_headings(batch, RULES), out, log)
    run.awaitTermination()
    schema = profile.first_headings(pages, RULES).schema
    return spark.read.schema(schema).parquet(out).select("page_id", "name")


# -- other given tables -------------------------------------------------------
def clean_text(spark, folder):
    return _table(spark, folder, "documents").selectExpr("doc_id", f"{tx.clean_text('text')} AS cleaned")


def price_parse(spark, folder):
    shown = "concat(' Giá: ', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), ' đ')"
    return _table(spark, folder, "orders").selectExpr("o_orderkey", f"{tx.parse_price(shown)} AS price")


def _taxonomy(spark, folder):
    return (
        _table(spark, folder, "part")
        .selectExpr(
            "lower(p_type) AS main", "lower(replace(p_brand, '#', '-')) AS mid",
            "if(p_size = 50, ' ', replace(p_name, ' ', '-')) AS leaf", "p_partkey",
        )
        .groupBy("main", "mid", "leaf").agg(F.min("p_partkey").alias("ord"))
    )


def taxonomy_paths(spark, folder):
    paths = category_paths(_taxonomy(spark, folder), deep_mains=("small",))
    return paths.selectExpr("ord", "category", f"{urls.category_head('category')} AS head")


def taxonomy_preset(spark, folder):
    return subcategories(_taxonomy(spark, folder), "economy", "brand-7")


def taxonomy_mains(spark, folder):
    return all_mains(_taxonomy(spark, folder))


def _visited(spark, folder, category):
    return _table(spark, folder, "part").selectExpr(f"{category} AS category", "p_partkey AS ord")


def run_label_mixed(spark, folder):
    return labels.run_label(_visited(spark, folder, "concat(lower(p_type), '/', p_brand)"))


def run_label_one_main(spark, folder):
    return labels.run_label(_visited(spark, folder, "concat('all-items/', lower(p_type))"))


# -- rendered pages -----------------------------------------------------------
def products_core(spark, folder):
    return _fields(spark, folder, *CORE)


def products_rating(spark, folder):
    return _fields(spark, folder, *RATED)


def products_table(spark, folder):
    return _fields(spark, folder, *TABLED)


def products_brand(spark, folder):
    return _fields(spark, folder, "brand")


def product_images(spark, folder):
    return _fields(spark, folder, "images").selectExpr("url", "array_join(images, '|') AS images")


def product_images_long(spark, folder):
    return images.product_images(_items(spark, folder), RULES)


def product_content(spark, folder):
    return _fields(spark, folder, "content")


def products_full(spark, folder):
    record = products.extract_products(_items(spark, folder), RULES, as_of=AS_OF)
    return record.withColumn("images", F.array_join("images", "|")).drop("crawled_at")


def gallery_counts(spark, folder):
    return images.gallery_counts(_items(spark, folder), RULES).drop("url")


def image_report(spark, folder):
    return profile.image_report(_items(spark, folder), IMAGE_WORDS, samples=3, alt_chars=30).selectExpr(
        "page_id", "images", "array_join(transform(samples, s -> concat(s.alt, '->', s.src)), '|') AS samples"
    )


def embedded_scripts(spark, folder):
    return embedded_json(_items(spark, folder), "application/json").select("page_id", "pos", "body")


def selector_first_hit(spark, folder):
    return profile.selector_first_hit(_items(spark, folder), profile.PROBE_A, non_empty=False, text_chars=100).drop("url")


def selector_first_text(spark, folder):
    return profile.selector_first_hit(_items(spark, folder), profile.PROBE_B, non_empty=True).drop("url")


def selector_coverage(spark, folder):
    hits = profile.selector_first_hit(_items(spark, folder), profile.PROBE_B, non_empty=True)
    return profile.selector_coverage(hits)


def fill_rate(spark, folder):
    return profile.fill_rate(products.extract_products(_items(spark, folder), RULES, as_of=AS_OF))


def rule_wins(spark, folder):
    return profile.rule_wins(_items(spark, folder), RULES)


def rule_wins_all(spark, folder):
    return winners.rule_wins_all(_items(spark, folder), RULES)


def _category_links(spark, folder):
    part = _table(spark, folder, "part")
    return links.category_links(rendered.category_pages(part), rendered.categories(part), RULES)


def category_links(spark, folder):
    return _category_links(spark, folder).select("category", "pos", "url")


def _names(spark, folder):
    return _fields(spark, folder, "name")


def links_followed(spark, folder):
    found = _category_links(spark, folder)
    return follow.follow_links(found, _names(spark, folder)).select("category", "pos", "url", "name")


def links_followed_salted(spark, folder):
    # every part's item is linked from its brand and again from one shared hub
    part = _table(spark, folder, "part")
    to = spread(part, "p_partkey").selectExpr(
        "p_partkey AS page_id", "0 AS pos",
        f"if(p_partkey % 3 = 0, concat('{BASE}/shelf-0/hub/0.html'), {rendered.ITEM_URL}) AS url",
    )
    hub = part.agg(F.count(F.lit(1)).alias("n")).selectExpr(
        f"'{BASE}/shelf-0/hub/0.html' AS url", "concat('hub of ', n) AS name"
    )
    records = _names(spark, folder).unionByName(hub)
    return follow.follow_links_salted(stored(to, "links")[0], records).select("page_id", "url", "name")


def category_catalogue(spark, folder, limit=3):
    part = _table(spark, folder, "part")
    pages = union_runs(rendered.product_pages(part), rendered.category_pages(part))
    found = extract_category(pages, rendered.categories(part), RULES, limit=limit, as_of=AS_OF)
    return found.select("listed_in", "listed_pos", "url", "name", "price", "brand", "official_name")


def category_catalogue_bucketed(spark, folder):
    """The same run over pages stored in buckets by url."""
    part = _table(spark, folder, "part")
    pages = union_runs(rendered.product_pages(part), rendered.category_pages(part))
    stored_pages = store_by_url(pages, f"pages_{uuid.uuid4().hex}", 16)
    found = extract_category(stored_pages, rendered.categories(part), RULES, limit=3, as_of=AS_OF)
    return found.select("listed_in", "listed_pos", "url", "name", "price", "brand", "official_name")


def category_catalogue_all(spark, folder):
    return category_catalogue(spark, folder, limit=None)


def catalogue_resumed(spark, folder):
    """A run stopped after the first of two parts, then resumed."""
    part = _table(spark, folder, "part")
    pages = union_runs(rendered.product_pages(part), rendered.category_pages(part))
    root, seeds = work_folder(spark, "resumed"), rendered.categories(part)
    for at_most in (1, None):
        resume_catalogue(pages, seeds, RULES, root, AS_OF, limit=3, parts=2, at_most=at_most)
    return read_catalogue(spark, root).select(
        "listed_in", "listed_pos", "url", "name", "price", "brand", "official_name"
    )


def catalogue_run(spark, folder):
    part = _table(spark, folder, "part")
    pages = union_runs(rendered.product_pages(part), rendered.category_pages(part))
    root = work_folder(spark, "runs")
    path, written, items = run_catalogue(pages, rendered.categories(part), RULES, root, AS_OF, limit=5)
    counts = [F.lit(written[kind]).cast("long").alias(f"n_{kind}") for kind in ("parquet", "json", "csv")]
    return items.select(F.lit(path.rpartition("/")[2]).alias("run"), *counts, "category", "items")


def runs_appended(spark, folder):
    run = _fields(spark, folder, "name", "sku")
    return union_runs(run, run)


def sink_roundtrip(spark, folder):
    fields = ("name", "price", "reviews_count", "images", "content")
    record = _fields(spark, folder, *fields)
    path = work_folder(spark, "products")
    write_products(record, path, ("json", "csv"))
    schema = spark.read.parquet(f"{path}/parquet").schema
    back = {
        "parquet": spark.read.parquet(f"{path}/parquet"),
        "json": spark.read.schema(schema).json(f"{path}/json"),
        "csv": read_products_csv(spark, f"{path}/csv", schema),
    }
    runs = [
        df.select(F.lit(name).alias("format"), "url", *fields).withColumn("images", F.array_join("images", "|"))
        for name, df in back.items()
    ]
    return union_runs(*runs)


# -- a user's own rules, galleries known by class only, runs without rows ----------
def products_custom(spark, folder):
    """Other selectors, other labels and columns of the user's own."""
    rules = replace(
        RULES, name=(nd.tag("title"),), sku=(nd.cls("sale-badge"), nd.attr_is("span", "data-test-id", "sku")),
        table_labels=(*RULES.table_labels[:-1], ("country_of_manufacture", "Quy cách")),
    )
    extra = {
        "dear": F.col("price") >= 1_500_000,
        "words": F.size(F.split("name", " ")),
        "day": F.date_format("crawled_at", "yyyy-MM-dd"),
    }
    record = products.extract_products(_items(spark, folder), rules, as_of=AS_OF, extra=extra)
    return record.select("url", "name", "sku", "country_of_manufacture", *extra)


def product_images_by_class(spark, folder):
    pages = rendered.class_gallery_pages(_table(spark, folder, "part"))
    found = images.product_images(pages, RULES)
    return found.selectExpr("url", "pos", f"{urls.last_segment('image_url')} AS file", "source_step")


def empty_run(spark, folder):
    """Categories without a page: nothing is written, and every category counts 0."""
    part = _table(spark, folder, "part")
    root = work_folder(spark, "empty")
    pages = rendered.product_pages(part)
    path, written, items = run_catalogue(pages, rendered.categories(part), RULES, root, AS_OF)
    left = Folder(spark, path).exists()
    return items.select("category", "items", F.lit(len(written)).alias("formats"), F.lit(left).alias("folder_left"))


# -- records together with failures ---------------------------------------------
def _with_faults(pages):
    """Some pages without a source, some with an error status."""
    return pages.selectExpr(
        "page_id", "url", "if(page_id % 13 = 5, NULL, html) AS html", "if(page_id % 17 = 3, 404, 200) AS status"
    )


def _both(spark, path, schema):
    """Records and failures of a written table as rows of one kind."""
    good = read_records(spark, path, schema).selectExpr(
        "'record' AS kind", "url", "name", "price", "brand", "array_join(images, '|') AS images", "content",
        "date_format(crawled_at, 'yyyy-MM-dd HH:mm:ss') AS crawled_at", "CAST(NULL AS STRING) AS reason",
    )
    failed = read_failures(spark, path, schema).selectExpr(
        "'failure' AS kind", "url", "CAST(NULL AS STRING) AS name", "CAST(NULL AS DOUBLE) AS price",
        "CAST(NULL AS STRING) AS brand", "CAST(NULL AS STRING) AS images", "CAST(NULL AS STRING) AS content",
        "CAST(NULL AS STRING) AS crawled_at", "reason",
    )
    return union_runs(good, failed)


def records_and_failures(spark, folder):
    path = work_folder(spark, "outcomes")
    found = products.records_and_failures(_with_faults(_items(spark, folder)), RULES, as_of=AS_OF)
    write_outcomes(found, path)
    return _both(spark, path, found.schema)


def stream_records(spark, folder):
    """Three drops of page files, taken in by two runs; the last batch of the first run is repeated."""
    drops, table, log = (work_folder(spark, name) for name in ("drops", "records", "records-log"))
    pages = _with_faults(_items(spark, folder))

    def drop(number):
        # a file a core, in row groups that let a batch of few files keep all cores busy
        some = pages.filter(F.col("page_id") % 3 == number).coalesce(spark.sparkContext.defaultParallelism)
        some.write.mode("append").option("parquet.block.size", 16 << 20).parquet(drops)

    def catch_up():
        stream = read_page_stream(spark, drops, pages.schema, files_per_batch=8)
        run = ingest_records(stream, RULES, table, log, AS_OF)
        run.awaitTermination()

    drop(0)
    drop(1)
    catch_up()
    # as after a crash between writing a batch and noting it as done
    newest = max(int(name) for name in Folder(spark, f"{log}/commits").names() if name.isdigit())
    Folder(spark, f"{log}/commits/{newest}").remove()
    drop(2)
    catch_up()
    schema = products.records_and_failures(pages, RULES, as_of=AS_OF).schema
    return _both(spark, table, schema)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        page_titles, h1_names, links_all, links_absolute, links_distinct, item_urls, links_top_n,
        links_top_many, category_counts, parse_quarantine, keyword_links, first_item_links,
        selector_profile, first_candidate, first_search_hit, stream_ingest,
        clean_text, price_parse, taxonomy_paths, taxonomy_preset, taxonomy_mains,
        run_label_mixed, run_label_one_main,
        products_core, products_rating, products_table, products_brand, product_images,
        product_images_long, product_content, products_full, gallery_counts, image_report,
        embedded_scripts, selector_first_hit, selector_first_text, selector_coverage,
        fill_rate, rule_wins, rule_wins_all, category_links, links_followed, links_followed_salted,
        category_catalogue, category_catalogue_bucketed, category_catalogue_all, catalogue_run, catalogue_resumed, runs_appended, sink_roundtrip,
        records_and_failures, stream_records, keyword_links_table, products_custom,
        product_images_by_class, empty_run,
    )
}
