"""Category seeds: the user's ``taxonomy(ord, main, mid, leaf)`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def category_paths(taxonomy: DataFrame, deep_mains: tuple[str, ...] = ()) -> DataFrame:
    """``ord, main, mid, leaf, category`` with the page path of every leaf.

    The path is ``main/leaf``, or ``main/mid/leaf`` for the mains in
    ``deep_mains``.  Blank leaves are placeholders and dropped.
    """
    deep = F.col("main").isin(*deep_mains) if deep_mains else F.lit(False)
    path = F.when(deep, F.concat_ws("/", "main", "mid", "leaf")).otherwise(
        F.concat_ws("/", "main", "leaf")
    )
    return taxonomy.filter(F.coalesce(F.trim("leaf"), F.lit("")) != "").withColumn("category", path)


def subcategories(taxonomy: DataFrame, main: str, mid: str | None = None) -> DataFrame:
    """Seeds of one main category, or of one preset list (``mid``) in it."""
    chosen = category_paths(taxonomy).filter(F.col("main") == main)
    if mid is not None:
        chosen = chosen.filter(F.col("mid") == mid)
    return chosen.select("ord", "category")


def all_mains(taxonomy: DataFrame) -> DataFrame:
    """Every main category once, at its first position."""
    return taxonomy.groupBy(F.col("main").alias("category")).agg(F.min("ord").alias("ord")).select(
        "ord", "category"
    )
