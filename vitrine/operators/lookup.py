"""Finding the pages of a list of URLs without moving page sources.

Pages stored with :func:`store_by_url` lie in buckets by URL, sorted within each.  A list then meets
them in one of three ways, all with the same result: a short list becomes a filter that the scan uses to
skip buckets and row groups; a list of proven size is sent to the scan; a longer one is dealt to the same
buckets, so that only the list is shuffled.  Pages that lie in no buckets are joined in the same three
ways, but the last one then shuffles them too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.session import join_side

SHORT = 200  # urls in the filter of a scan


def store_by_url(pages: DataFrame, table: str, buckets: int) -> DataFrame:
    """Write ``pages`` as table ``table`` in the warehouse, bucketed and sorted by ``url``; one file per bucket."""
    dealt = pages.repartition(buckets, "url")
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, "url").sortBy("url").saveAsTable(table)
    return pages_by_url(pages.sparkSession, table)


def pages_by_url(spark: SparkSession, table: str) -> DataFrame:
    """A table written by :func:`store_by_url`."""
    return spark.table(table)


def pages_of(pages: DataFrame, wanted: DataFrame, how: str = "inner", side: DataFrame | None = None) -> DataFrame:
    """``pages`` joined with ``wanted`` on ``url`` (``inner`` or ``left_semi``).

    ``side``: ``wanted`` as a stored table with the kind of join already chosen.
    """
    side = join_side(wanted) if side is None else side
    few = [row[0] for row in side.select("url").distinct().limit(SHORT + 1).collect()]
    if len(few) <= SHORT:
        pages = pages.filter(F.col("url").isin([url for url in few if url is not None]))
    return pages.join(side, "url", how)
