"""Connected components of an edge table, by alternating large and small stars.

Every round is a few joins and minimum aggregates, which pre-aggregate before their
shuffles; a hub with very many neighbours is never gathered in one place.  Each round's
edges are written to the shared folder, and the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the least node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").filter("b > m").select(F.col("m").alias("a"), "b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node joins itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    return (
        moved.select(F.col("m").alias("a"), "b")
        .union(moved.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node reached.

    Self-loops and repeated edges are allowed; an empty table gives an empty table.
    """
    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()

    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    now = stored(pairs.distinct(), "edges")
    seen = mark(now)
    while True:
        after = stored(_small_star(_large_star(now)), "edges")
        found = mark(after)
        drop_stored(now)
        now = after
        if found == seen:
            break
        seen = found
    # now a forest of stars: b hangs on its root a
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
