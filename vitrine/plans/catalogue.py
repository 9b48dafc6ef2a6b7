"""Whole runs: categories -> links -> records."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine import session
from vitrine.functions.urls import is_item_url
from vitrine.operators.follow import follow_links
from vitrine.operators.limits import first_per_group
from vitrine.operators.links import category_links
from vitrine.operators.lookup import pages_of
from vitrine.operators.products import COLUMNS, extract_products
from vitrine.plans.rules import Rules
from vitrine.session import stored
from vitrine.sinks.write import FORMATS, Folder, output_path, write_products
from vitrine.sources.pages import usable_pages


def extract_category(
    pages: DataFrame, categories: DataFrame, rules: Rules, limit: int | None = None, as_of=None
) -> DataFrame:
    """Records of the items listed on the category pages.

    Columns: ``listed_in`` (category), ``listed_pos`` and the record.  Links are
    cut to ``limit`` per category (0 or None = all) before any item page is
    parsed.  The link table is stored, because it is read twice.  Only listed pages
    are parsed, whatever its size; the measured size picks the kind of the two joins:
    a short list is sent to the pages and to the records, a long one is shuffled.  Pages stored
    with ``lookup.store_by_url`` are not shuffled, and only the buckets of a short list are read.
    An item in two categories appears twice.
    """
    usable = usable_pages(pages)
    found = category_links(usable, categories, rules).select(
        F.col("category").alias("listed_in"), "page_id", F.col("pos").alias("listed_pos"), "url"
    )
    links, size = stored(
        first_per_group(found, limit, "listed_in", pos="listed_pos"),
        "links", bytes=F.coalesce(F.sum(F.octet_length("url")), F.lit(0)),
    )
    short = size["bytes"] <= session.BROADCAST_BYTES
    listed = links.select("url").distinct()
    side = F.broadcast(listed) if short else listed.hint("merge")
    items = pages_of(usable.filter(is_item_url("url", rules.base_url)), listed, "left_semi", side)
    records = extract_products(items, rules, as_of=as_of)
    joined = records.join(F.broadcast(links), "url") if short else follow_links(links, records)
    return joined.select("listed_in", "listed_pos", *COLUMNS)


def run_catalogue(
    pages: DataFrame, categories: DataFrame, rules: Rules, root: str, as_of, limit: int | None = None,
    formats=FORMATS, prefix: str = "products",
) -> tuple[str, dict[str, int], DataFrame]:
    """A whole run: links, limit, records, files named after the run.

    Returns the output path, the rows written per format (empty for an empty run, which
    leaves no files), and ``category, items``: the written records of every category,
    0 included.
    """
    spark = pages.sparkSession
    path = output_path(spark, root, categories, as_of, prefix)
    written = write_products(extract_category(pages, categories, rules, limit, as_of), path, formats)
    every = categories.select("category").distinct()
    if not written:
        return path, written, every.withColumn("items", F.lit(0).cast("long"))
    table = spark.read.parquet(f"{path}/parquet")
    counts = table.groupBy(F.col("listed_in").alias("category")).agg(F.count(F.lit(1)).alias("items"))
    found = every.join(counts, "category", "left")
    return path, written, found.select("category", F.coalesce("items", F.lit(0)).alias("items"))


# Folders of a run that can be resumed; names with an underscore are skipped by readers.
STAGED, LOG, RECORDS = "_staged", "_log", "parquet"


def finished_categories(spark: SparkSession, root: str) -> DataFrame:
    """The commit log of a run: ``category, part`` of every finished category."""
    schema = "category string, part string"
    if not Folder(spark, f"{root}/{LOG}").exists():
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{LOG}")


def resume_catalogue(
    pages: DataFrame, categories: DataFrame, rules: Rules, root: str, as_of, limit: int | None = None,
    parts: int = 8, at_most: int | None = None,
) -> dict[str, int]:
    """A category run in parts; called again after a stop, it goes on with what is not finished.

    The categories that the log below ``root`` doesn't name are split by hash into ``parts``; each
    part is extracted and staged, and only then are its categories logged.  A part that was cut off is
    in no log: it is done again, and what it left is never read.  When all are logged, the staged
    parts become visible as ``root/parquet``, the same rows as a whole run gives.  ``at_most``
    ends the call after that many parts.  Returns the numbers of ``finished`` and ``left`` categories.

    ``as_of`` and ``limit`` should stay the same between calls.  Each part scans the pages
    once for its categories and once for their items, so more parts lose less work and read more.
    """
    spark = pages.sparkSession
    root = root.rstrip("/")
    todo = categories.join(finished_categories(spark, root).select("category"), "category", "left_anti")
    todo, size = stored(todo.select("ord", "category"), "open-categories")
    count = min(parts, size["rows"])
    for number in range(count if at_most is None else min(count, at_most)):
        some = todo.filter(F.pmod(F.xxhash64("category"), F.lit(count)) == number)
        name = f"part-{uuid.uuid4().hex}"
        extract_category(pages, some, rules, limit, as_of).write.parquet(f"{root}/{STAGED}/{name}")
        some.select("category").distinct().withColumn("part", F.lit(name)).write.mode("append").parquet(f"{root}/{LOG}")
    done = finished_categories(spark, root)
    left = categories.select("category").distinct().join(done, "category", "left_anti").count()
    if not left:
        _publish(spark, root, done)
    return {"finished": done.select("category").distinct().count(), "left": left}


def _publish(spark: SparkSession, root: str, done: DataFrame) -> None:
    """Make the logged parts visible, one rename each; done again after a stop, it finishes the rest."""
    visible = Folder(spark, f"{root}/{RECORDS}")
    visible.make()
    # one row per part, and parts are few: the caller named their number
    for row in done.select("part").distinct().collect():
        staged = Folder(spark, f"{root}/{STAGED}/{row['part']}")
        if staged.exists():
            staged.move_to(f"{root}/{RECORDS}/part={row['part']}")
    visible.mark_done()


def read_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """The records of a finished run."""
    if not Folder(spark, f"{root.rstrip('/')}/{RECORDS}/_SUCCESS").exists():
        raise ValueError(f"the run below {root} is not finished: call resume_catalogue again")
    return spark.read.parquet(f"{root.rstrip('/')}/{RECORDS}").drop("part")


def union_runs(*runs: DataFrame) -> DataFrame:
    """Append runs; a bag, nothing is removed."""
    return reduce(DataFrame.unionByName, runs)
