"""Counts over substring containment, as an equi-join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.session import join_side


def contains_join(
    urls: DataFrame, words: DataFrame, text: str, word: str, gram: int, verify: bool = True
) -> DataFrame:
    """All pairs where ``text`` contains ``word``: each pair exactly once.

    ``verify=False`` gives the candidates that the equi-join finds.

    A word is looked up by that of its ``gram``-character pieces which the fewest
    words hold, a text by every distinct piece of it, so the join is an equi-join (no
    nested loop), and words that share a long head meet a text only where it has what
    tells them apart.  ``gram`` must not exceed the shortest word (see :func:`shortest`).
    """
    def pieces(column: str) -> str:
        return (
            f"explode(array_distinct(transform(sequence(1, greatest(length({column}) - {gram} + 1, 1)),"
            f" i -> substring({column}, i, {gram}))))"
        )

    held = words.select(word).distinct().select(word, F.expr(pieces(word)).alias("_gram"))
    common = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = held.join(common, "_gram").groupBy(word).agg(F.min(F.struct("_n", "_gram")).alias("_key"))
    keyed = words.join(rarest, word).withColumn("_gram", F.col("_key._gram")).drop("_key")
    left = urls.withColumn("_gram", F.expr(pieces(text)))
    right = join_side(keyed)
    found = left.join(right, "_gram")
    if verify:
        found = found.filter(F.contains(F.col(text), F.col(word)))
    return found.drop("_gram")


def shortest(words: DataFrame, word: str, at_most: int = 8) -> int:
    """Gram length for ``words``: the shortest word, capped for selectivity."""
    length = words.agg(F.min(F.length(word))).first()[0]
    if not length:
        raise ValueError("empty word list or empty word")
    return min(length, at_most)


def category_counts(urls: DataFrame, categories: DataFrame, gram: int | None = None) -> DataFrame:
    """Per category, the number of ``url`` rows containing its path; 0 included."""
    gram = gram or shortest(categories, "category")
    hits = contains_join(urls.select("url"), categories.select("category").distinct(), "url", "category", gram)
    counts = hits.groupBy("category").agg(F.count(F.lit(1)).alias("items"))
    return categories.select("category").distinct().join(counts, "category", "left").select(
        "category", F.coalesce("items", F.lit(0)).alias("items")
    )
