"""First n rows per group, also when one group holds most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from vitrine.session import stored

# Up to the n in this setting Spark cuts every map task's rows to n per group before
# the shuffle.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64
# Page ids are counted in blocks of 1024, blocks in blocks of 1024, and so on, until
# at most 1024 blocks are left at the top (six levels for the whole 64-bit range).
LEVEL_BITS = 10


def first_per_group(
    df: DataFrame, n: int | None, group: str, page: str = "page_id", pos: str = "pos"
) -> DataFrame:
    """First ``n`` rows of each group in ``(page, pos)`` order; 0 or None = all.

    As long as Spark applies a ranked filter before the shuffle too, a group costs n
    rows per map task; they are ranked within 64 salts first, because n rows from every
    map task of a big job are too many for one task.  Beyond that, ranks come from counts
    over id blocks, and no task sees a whole group.
    """
    if not n:
        return df
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        return _first_by_blocks(df, n, group, page, pos)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(page), F.lit(SALTS)))
    return _ranked(_ranked(salted, n, [group, "_salt"], page, pos).drop("_salt"), n, [group], page, pos)


def _ranked(df, n, keys, page, pos):
    order = W.partitionBy(*keys).orderBy(page, pos)
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def _first_by_blocks(df, n, group, page, pos):
    """Rank = rows in earlier blocks + row number in the own block.

    A block's start is its parent's start plus the counts of its earlier
    siblings, from the top level down, so a window sees at most 1024 counts.
    Blocks starting at or beyond ``n`` are dropped on the way.  The input is
    stored first: it is read for the counts and again for the rows.
    """
    rows, seen = stored(
        df.withColumn("b1", F.shiftright(F.col(page), LEVEL_BITS)),
        "ranked-rows", low=F.min("b1"), high=F.max("b1"),
    )
    smallest, _ = stored(
        rows.groupBy(group, "b1").agg(F.count(F.lit(1)).alias("size")), "block-sizes"
    )

    def block(level):
        return F.shiftright(F.col("b1"), LEVEL_BITS * (level - 1)).alias(f"b{level}")

    starts = None
    for level in range(_levels(seen["low"] or 0, seen["high"] or 0), 0, -1):
        own, parent = f"b{level}", f"b{level + 1}"
        here = smallest.groupBy(group, block(level)).agg(F.sum("size").alias("size"))
        if starts is None:
            siblings, base = W.partitionBy(group), F.lit(0)
        else:
            siblings, base = W.partitionBy(group, parent), F.col("start")
            here = here.withColumn(parent, F.shiftright(own, LEVEL_BITS)).join(starts, [group, parent])
        earlier = F.sum("size").over(siblings.orderBy(own).rowsBetween(W.unboundedPreceding, -1))
        start = (base + F.coalesce(earlier, F.lit(0))).alias("start")
        starts = here.select(group, own, start).filter(F.col("start") < n)

    in_block = W.partitionBy(group, "b1").orderBy(page, pos)
    ranked = rows.join(starts.hint("merge"), [group, "b1"]).withColumn(
        "_rank", F.col("start") + F.row_number().over(in_block)
    )
    return ranked.filter(F.col("_rank") <= n).select(*df.columns)


def _levels(low: int, high: int) -> int:
    """Levels needed until at most 1024 blocks are left, for block numbers low..high."""
    levels = 1
    while (high >> LEVEL_BITS * (levels - 1)) - (low >> LEVEL_BITS * (levels - 1)) >= 1 << LEVEL_BITS:
        levels += 1
    return levels
