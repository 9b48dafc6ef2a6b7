"""Run label: a short name built from the visited categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LISTED = 3  # up to this many categories are named one by one


def run_label(categories: DataFrame) -> DataFrame:
    """One row ``label`` for ``categories(ord, category)``.

    Visited categories count once, in first-visit order.  Only counts and the
    first few names are aggregated, never the whole list.
    """
    visited = categories.groupBy("category").agg(F.min("ord").alias("ord"))
    head = visited.orderBy("ord").limit(LISTED).agg(
        F.array_sort(F.collect_list(F.struct("ord", "category"))).alias("names")
    )
    main = F.substring_index("category", "/", 1)
    facts = visited.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(main).alias("main"),
        (F.min(F.contains(F.col("category"), F.lit("/"))) & (F.min(main) == F.max(main))).alias("same_main"),
    )
    return facts.withColumn("names", head.scalar()).selectExpr(
        f"""CASE
            WHEN n = 0 THEN 'unknown'
            WHEN n = 1 THEN translate(names[0].category, '/-', '__')
            WHEN same_main AND n <= {LISTED} THEN replace(concat(main, '_',
                array_join(transform(names, x -> substring_index(x.category, '/', -1)), '_')), '-', '_')
            WHEN same_main THEN replace(concat(main, '_multiple'), '-', '_')
            ELSE concat('multiple_', n, '_categories')
        END AS label"""
    )
