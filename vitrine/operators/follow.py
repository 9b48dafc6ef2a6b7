"""Follow links: each link becomes the record of the page it points to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are
# fewer than HOT_SHARE hot keys whatever the data: a proven bound.
HOT_SHARE = 1000
SALTS = 64


def follow_links(links: DataFrame, records: DataFrame, key: str = "url") -> DataFrame:
    """Inner equi-join ``links.url = records.url``; bag semantics, links without a page drop out.

    Extract records once per page and join afterwards: the costly step never
    runs once per link.  Both sides grow with the corpus, so the join is always
    shuffled; a skewed link target is split by Spark's adaptive skew join, and by
    :func:`follow_links_salted` without relying on it.
    """
    return links.join(records.hint("merge"), key)


def hot_keys(links: DataFrame, key: str = "url") -> DataFrame:
    """Keys holding more than 1/1000 of all rows: under 1000 rows by counting alone."""
    total = links.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        links.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") * HOT_SHARE > total)
        .select(key)
    )


def follow_links_salted(
    links: DataFrame, records: DataFrame, key: str = "url", row: tuple[str, ...] = ("page_id", "pos")
) -> DataFrame:
    """As :func:`follow_links`, with the rows of hot targets spread over salts.

    Only the records of hot keys are repeated (64 times under 1000 rows); every
    other row keeps salt 0.  ``links`` is read twice: pass a stored table.
    """
    hot = F.broadcast(hot_keys(links, key).withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*row), F.lit(SALTS)).cast("int")).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = links.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    right = records.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right.hint("merge"), [key, "_salt"]).drop("_salt")
