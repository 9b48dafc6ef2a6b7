"""Temperature mixing of sources, realised as budgeted block permutations.

Source weights are token shares to the power alpha, normalised.  Alpha is bisected between
1 (shares as they are) and 0 (all sources alike): to the least one that keeps every source
within ``max_epochs`` passes, or to the largest one whose weights reach ``target_entropy``.
Without a budget the total is the least that uses every document at least once; with
``budget`` tokens a source may also be cut.

A source that is due e passes gets floor(e) blocks, each a permutation of all its
documents, and one block with the first documents of another permutation, as many as fit
the rest of its budget.  ``position`` spreads the blocks of all sources evenly over [0, 1].

DataFrame functions only.  A permutation is the order of md5(seed, pass, id).  Where the
last block ends is found by radix descent: token sums by the next two hex digits, per
source, until the digits that hold the cut have few documents; no step sorts a source.

Defined cases: NULL source is a source; a text without words (NULL, empty) has no tokens;
a source without tokens is used once; rows of one id in a source stand or fall together in
the last block; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import sized, stored

STEPS = 32  # five bisection steps at once
PASSES = 5  # 25 bisection steps
MILLION = 1_000_000
FEW = 4096  # documents in a digit group that are ordered directly


def words_in(text: Column) -> Column:
    """Number of words between ASCII blanks."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[ \t-\r]+|[ \t-\r]+$", "")
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, r"[ \t-\r]+", -1))).cast("long")


def permutation_key(seed: int, epoch: Column, id_col: str) -> Column:
    """Place of a row in the permutation of a pass, as 32 hex digits."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name).cast("binary"))


def source_plan(
    tokens: DataFrame, max_epochs: float | None = 2.0, target_entropy: float | None = None, budget: int | None = None
) -> DataFrame:
    """``source, tokens, weight_ppm, epochs_ppm`` of ``tokens(source, tokens)``, one row per source."""
    if (max_epochs is None) == (target_entropy is None):
        raise ValueError("give either max_epochs or target_entropy")
    totals = stored(tokens.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    used = totals.filter("tokens > 0")
    every = used.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(every or 1))
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        width = (high - low) / STEPS
        tried = used.select(share.alias("p"), F.explode(F.sequence(F.lit(0), F.lit(STEPS))).alias("k"))
        alpha = F.lit(low) + F.col("k") * F.lit(width)
        power, ratio = F.pow("p", alpha), F.pow("p", alpha - 1)
        seen = tried.groupBy("k").agg(
            F.sum(power).alias("z"), F.sum(power * F.ln("p")).alias("zl"),
            F.max(ratio).alias("most"), F.min(ratio).alias("least"), F.first(alpha).alias("alpha"),
        )
        if max_epochs is not None:
            passes = F.col("most") / F.col("least") if budget is None else budget * F.col("most") / (F.col("z") * every)
            good, wanted = passes <= max_epochs, F.min("k")
        else:
            entropy = F.ln("z") - F.col("alpha") * F.col("zl") / F.col("z")
            good, wanted = entropy >= target_entropy, F.max("k")
        k = seen.filter(good).agg(wanted).first()[0]
        if max_epochs is not None:
            k = STEPS if k is None else k
            low, high = (low + max(k - 1, 0) * width, low + k * width)
        else:
            k = 0 if k is None else k
            low, high = (low + k * width, low + min(k + 1, STEPS) * width)
    alpha = high if max_epochs is not None else low
    whole = used.agg(F.sum(F.pow(share, F.lit(alpha))), F.min(F.pow(share, F.lit(alpha - 1)))).first()
    norm, least = whole[0] or 1.0, whole[1] or 1.0
    passes = F.pow(share, F.lit(alpha - 1))
    passes = passes / F.lit(least) if budget is None else passes * F.lit(budget / (norm * every)) if every else passes
    empty = F.col("tokens") == 0
    return totals.select(
        "source", "tokens",
        F.when(empty, 0).otherwise(F.round(F.pow(share, F.lit(alpha)) / F.lit(norm) * MILLION)).cast("long").alias("weight_ppm"),
        F.when(empty, MILLION).otherwise(F.round(passes * MILLION)).cast("long").alias("epochs_ppm"),
    )


def _last_block(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, cut``: the greatest key of each last block; no row where that block is empty.

    ``rows(source, key, tokens)`` holds the documents of sources with a last block,
    ``plan(source, rest)`` the tokens it may take.
    """
    groups = stored(rows.groupBy("source", "key").agg(F.sum("tokens").alias("tokens")), "keys")
    # per source: the digits fixed so far and the tokens taken before them
    state = stored(plan.select("source", "rest", F.lit("").alias("prefix")), "state")
    digits = 0
    while True:
        inside = groups.join(sized(state), groups["source"].eqNullSafe(state["source"])).filter(
            F.substring("key", 1, digits) == F.col("prefix")
        ).select(groups["source"], "key", "tokens", "rest", "prefix")
        size = inside.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if size <= FEW or digits >= 32:
            break
        digits += 2
        sums = inside.groupBy("source", "rest", F.substring("key", 1, digits).alias("prefix")).agg(
            F.sum("tokens").alias("tokens")
        )
        order = Window.partitionBy("source").orderBy("prefix")  # at most 256 rows a source
        before = F.sum("tokens").over(order) - F.col("tokens")
        # the last group that is entered: all groups before it fit
        entered = sums.withColumn("before", before).filter(F.col("before") <= F.col("rest"))
        last = entered.groupBy("source").agg(F.max_by(F.struct("prefix", (F.col("rest") - F.col("before")).alias("rest")), "prefix").alias("x"))
        state = stored(last.select("source", "x.rest", "x.prefix"), "state")
    order = Window.partitionBy("source").orderBy("key")  # at most FEW rows a source
    fits = inside.withColumn("upto", F.sum("tokens").over(order)).filter(F.col("upto") <= F.col("rest"))
    direct = fits.groupBy("source").agg(F.max("key").alias("inner"))
    # without a fitting document, everything below the fixed digits is in
    joined = state.join(direct, state["source"].eqNullSafe(direct["source"]), "left")
    return joined.select(state["source"], F.coalesce("inner", F.col("prefix")).alias("cut"))


def mixing_plan(
    docs: DataFrame, max_epochs: float | None = 2.0, target_entropy: float | None = None, budget: int | None = None,
    seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Stored tables: ``(id, source, tokens)`` of all rows, and per source weights, passes and cut."""
    rows = stored(
        docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), words_in(docs[text_col]).alias("tokens")),
        "tokens",
    )
    plan = stored(source_plan(rows, max_epochs, target_entropy, budget), "weights")
    part = F.col("epochs_ppm") % MILLION
    full = F.floor(F.col("epochs_ppm") / MILLION)
    due = plan.filter(part > 0).select(
        "source", full.alias("full"), F.floor((part.cast("decimal(38,0)") * F.col("tokens")) / MILLION).cast("long").alias("rest")
    )
    keyed = rows.join(due, rows["source"].eqNullSafe(due["source"])).select(
        rows["source"], permutation_key(seed, F.col("full"), "id").alias("key"), "tokens"
    )
    cut = _last_block(keyed, due)
    whole = plan.join(cut, plan["source"].eqNullSafe(cut["source"]), "left").select(
        plan["source"], "weight_ppm", "epochs_ppm", full.alias("full"), "cut"
    )
    return rows, stored(whole, "plan")


def realise(
    rows: DataFrame, plan: DataFrame, seed: int = 17, id_col: str = "id", source_col: str = "source"
) -> DataFrame:
    """``rows`` once per pass they are in, with ``weight_ppm``, ``epoch`` and ``position``.

    Every column of ``rows`` is kept in ``row``, so names can't clash.
    """
    packed = rows.select(
        F.struct(*[rows[c] for c in rows.columns]).alias("row"),
        rows[id_col].alias("__id"), rows[source_col].alias("__source"),
    )
    joined = packed.join(sized(plan), F.col("__source").eqNullSafe(plan["source"]))
    last = F.when(permutation_key(seed, F.col("full"), "__id") <= F.col("cut"), F.col("full")).otherwise(F.col("full") - 1)
    spread = joined.withColumn("last", last).filter("last >= 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    )
    part = lambda key: F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / 2.0**52
    share = part(permutation_key(seed, F.col("epoch"), "__id"))
    # the last block holds the keys up to its cut: they are spread over what the block is due
    due = (F.col("epochs_ppm") % MILLION) / MILLION / (part(F.rpad("cut", 13, "f")) + 2.0**-52)
    share = F.when(F.col("epoch") == F.col("full"), share * due).otherwise(share)
    position = (F.col("epoch") + share) / (F.col("epochs_ppm") / MILLION)
    return spread.select("row", "weight_ppm", "epoch", position.alias("position"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """``docs`` mixed: the columns of ``docs``, each row as often as its source is due."""
    _, plan = mixing_plan(docs, id_col=id_col, source_col=source_col, **options)
    seed = options.get("seed", 17)
    return realise(docs, plan, seed, id_col, source_col).select("row.*")
