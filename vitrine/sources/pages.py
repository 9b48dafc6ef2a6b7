"""Page sources: stored pages as a table, with bad pages as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions import nodes as nd
from vitrine.functions.sql import Sql, lit
from vitrine.session import spread
from vitrine.sources.htmltree import Keep
from vitrine.sources.parse import parse_pages


def load_pages(spark: SparkSession, path: str) -> DataFrame:
    """Scan ``pages(page_id, url, html[, status])`` from Parquet."""
    return spread(spark.read.parquet(path), "page_id")


def page_fault(pages: DataFrame) -> "F.Column":
    """Why a page cannot be used, or NULL: no source, or an HTTP error status."""
    fault = F.when(F.col("html").isNull(), F.lit("no html"))
    if "status" in pages.columns:
        bad = F.coalesce(F.col("status"), F.lit(200)) >= 400
        fault = fault.when(bad, F.concat(F.lit("status "), F.col("status").cast("string")))
    return fault


def usable_pages(pages: DataFrame) -> DataFrame:
    """Pages to parse; the test runs in the JVM, before any Python step."""
    return pages.filter(page_fault(pages).isNull())


def parse_usable(pages: DataFrame, *args, **options) -> DataFrame:
    """``parse_pages`` without failed pages: no source, bad status or a parser error.

    Those are the rows of :func:`quarantine`; reports must not count them.
    """
    return parse_pages(usable_pages(pages), *args, **options).filter(F.col("parse_error").isNull())


def quarantine(pages: DataFrame) -> DataFrame:
    """Failed pages as rows: ``page_id, url, reason``.

    One scan: pages without a usable source are not parsed, the rest is parsed
    with nothing emitted but the parser's verdict.
    """
    fault = page_fault(pages)
    judged = pages.withColumns({"fault": fault, "html": F.when(fault.isNull(), F.col("html"))})
    return parse_pages(judged, Keep(), carry=("page_id", "url", "fault"), with_text=False).filter(
        F.col("parse_error").isNotNull()
    ).select("page_id", "url", F.coalesce("fault", "parse_error").alias("reason"))


def script_bodies(kind: str) -> Sql:
    """Bodies of the embedded JSON scripts of one ``type``, in document order."""
    scripts = f"filter(nodes, s -> s.tag = 'script' AND {nd.attr('s', 'type')} = {lit(kind)})"
    return f"transform({scripts}, s -> s.text)"


def embedded_json(pages: DataFrame, kind: str) -> DataFrame:
    """One row per embedded JSON script: ``page_id, url, pos, body``."""
    keep = Keep(attr_values=frozenset((("type", kind),)), attr_names=frozenset(("type",)))
    return parse_usable(pages, keep, with_text=False).selectExpr(
        "page_id", "url", f"posexplode({script_bodies(kind)}) AS (pos, body)"
    )
