"""Line dedup: repeated runs of lines, found with suffix ranks by distributed prefix doubling.

Lines get 128-bit numbers; only lines that occur more than once can be part of a repeated
run, so only they go on, and of these only unbroken runs with enough words.  Every suffix
of such a sequence is ranked by its first line, then by its first 2, 4, 8 ... lines: the
pairs (rank, rank of the suffix 2^k lines on) are made distinct, sorted over the cluster by
range, and numbered, which is one round of prefix doubling of the suffix array.

The suffixes that agree in their first L lines are one interval of the suffix array with
LCP >= L.  Ranks by 2^k <= L lines at both ends of the L lines name that interval, so it is
found by an aggregate and not by a walk over neighbours, however many suffixes it holds.
For every line, L is the least number of lines from it, and up to it, that hold
``min_words`` words.  Any run of at least ``min_words`` words that occurs more than once is
exactly covered by such intervals, so the union of all but their first members is the union
of the later copies of all maximal repeated runs.  At most log2(min_words) rounds are needed.

First is the occurrence with the least (doc_id, text hash, line).  Lines without a word
stand in no run; those between deleted lines of a run go with them.

Defined cases: NULL and empty texts have no lines and stay as they are; rows equal in id
and text are one document and get the same result; a NULL id sorts first; copies inside one
document are deleted too, overlapping ones as well; other columns pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import drop_stored, per_text, sized, stored

FIRST = -(2**63)  # stands for a NULL id
AHEAD = 1 << 16  # rows gathered before whole groups are worked


def _by_groups(
    batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], work: Callable[[dict], dict]
) -> Iterator[pa.RecordBatch]:
    """Work on sorted rows in runs of whole groups."""
    waiting: list[dict[str, np.ndarray]] = []
    size, enough = 0, AHEAD
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append({n: c.to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns)})
        size += batch.num_rows
        if size < enough:
            continue
        rows = {k: np.concatenate([w[k] for w in waiting]) for k in waiting[0]}
        last = np.logical_and.reduce([rows[k] == rows[k][-1] for k in keys])
        cut = int(np.argmax(last))
        if cut:
            yield pa.RecordBatch.from_pydict(work({k: v[:cut] for k, v in rows.items()}))
        waiting, size = [{k: v[cut:] for k, v in rows.items()}], size - cut
        enough = max(AHEAD, 2 * size)  # one group larger than this is copied few times
    if size:
        yield pa.RecordBatch.from_pydict(work({k: np.concatenate([w[k] for w in waiting]) for k in waiting[0]}))


def _runs(rows: dict) -> np.ndarray:
    """For every row the index after the last row of its unbroken run."""
    n = len(rows["doc"])
    new = np.r_[True, (np.diff(rows["doc"]) != 0) | (np.diff(rows["th"]) != 0) | (np.diff(rows["seq"]) != 1)]
    starts = np.flatnonzero(new)
    return np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))


def _enough(rows: dict, min_words: int) -> dict:
    """Rows of runs with at least ``min_words`` words."""
    stop = _runs(rows)
    start = np.r_[0, np.cumsum(rows["words"])]
    first = np.r_[True, np.diff(stop) != 0]
    begin = np.maximum.accumulate(np.where(first, np.arange(len(stop)), 0))
    fits = start[stop] - start[begin] >= min_words
    return {k: v[fits] for k, v in rows.items()}


def _ahead(rows: dict, step: int) -> dict:
    """Adds ``next``: the rank of the suffix ``step`` lines on, 0 beyond the run."""
    at = np.arange(len(rows["doc"])) + step
    inside = at < _runs(rows)
    out = np.zeros(len(at), np.int64)
    out[inside] = rows["rank"][at[inside]]
    return {**rows, "next": out}


def _blocks(rows: dict, min_words: int, levels: int) -> dict:
    """Shortest blocks with ``min_words`` words from and up to every line, named by their ranks."""
    n, stop = len(rows["doc"]), _runs(rows)
    total = np.r_[0, np.cumsum(rows["words"])]
    first = np.r_[True, np.diff(stop) != 0]
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    at = np.arange(n)
    end = np.searchsorted(total, total[at] + min_words)  # block [at, end)
    ok = end <= stop
    start = np.searchsorted(total, total[at + 1] - min_words, "right") - 1  # block [start, at]
    good = start >= begin
    a = np.concatenate([at[ok], start[good]])
    b = np.concatenate([end[ok], at[good] + 1])
    pairs = np.unique(np.stack([a, b], 1), axis=0)
    a, b = pairs[:, 0], pairs[:, 1]
    size = b - a
    level = np.floor(np.log2(np.maximum(size, 1))).astype(np.int64)
    ranks = np.stack([rows[f"r{k}"] for k in range(levels)])
    return {
        "doc": rows["doc"][a], "th": rows["th"][a], "first": rows["pos"][a], "last": rows["pos"][b - 1],
        "size": size, "left": ranks[level, a], "right": ranks[level, b - (1 << level)],
    }


def _sorted_step(df: DataFrame, schema: str, work: Callable[[dict], dict], order: str = "seq") -> DataFrame:
    placed = df.repartition("doc", "th").sortWithinPartitions("doc", "th", order)
    return placed.mapInArrow(lambda batches: _by_groups(batches, ("doc", "th"), work), schema)


def _numbered(keys: DataFrame, *columns: str) -> DataFrame:
    """Distinct keys with a number that grows in their order (from 1), sorted by range."""
    ordered = keys.select(*columns).distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    return stored(ordered.select(*columns, (F.monotonically_increasing_id() + 1).alias("rank")), "ranks")


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, th, seq, pos, h1, h2, words``: one row per line with a word."""
    line = "array<struct<seq: int, pos: int, h1: long, h2: long, words: int>>"
    digest = xxhash.xxh3_128_digest

    def lines(raw: bytes | None) -> list[dict]:
        out = []
        for pos, text in enumerate((raw or b"").split(b"\n")):
            words = len(text.split())
            if words:
                a = digest(text)
                out.append({
                    "seq": len(out), "pos": pos, "words": words,
                    "h1": int.from_bytes(a[:8], "little", signed=True),
                    "h2": int.from_bytes(a[8:], "little", signed=True),
                })
        return out

    keyed = docs.select(
        F.coalesce(docs[id_col], F.lit(FIRST)).cast("long").alias("doc"),
        F.xxhash64(docs[text_col]).alias("th"),
        docs[text_col].alias("text"),
    )
    made = per_text(keyed, "text", f"lines {line}", lambda: lambda texts: {"lines": [lines(t) for t in texts]}, ["doc", "th"], True)
    return made.select("doc", "th", F.inline("lines"))


def repeated_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, th, cut``: documents with lines to delete; ``cut[i]`` tells it of line ``i`` (short arrays: no)."""
    base = "doc long, th long, seq int, pos int, words int"
    every = stored(line_table(docs, id_col, text_col).distinct(), "lines")
    twice = every.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1")
    ranks = _numbered(twice, "h1", "h2")
    # lines that occur again, in unbroken runs of enough words
    now = every.join(sized(ranks), ["h1", "h2"]).select("doc", "th", "seq", "pos", "words", "rank")
    now = stored(_sorted_step(now, f"{base}, rank long", lambda rows: _enough(rows, min_words)), "runs")
    drop_stored(every, ranks)
    levels = max(1, int(min_words).bit_length())
    known: list[str] = []
    for level in range(levels):
        known.append(f"r{level}")
        now = now.withColumn(known[-1], F.col("rank"))
        if level == levels - 1:
            break
        fields = ", ".join([base, "rank long", *[f"{r} long" for r in known], "next long"])
        pairs = stored(_sorted_step(now, fields, lambda rows, step=1 << level: _ahead(rows, step)), "pairs")
        ranks = _numbered(pairs.select(F.col("rank").alias("key"), "next"), "key", "next")
        named = sized(ranks).select(F.col("rank").alias("longer"), F.col("key"), F.col("next"))
        now = pairs.join(named, [pairs["rank"] == named["key"], pairs["next"] == named["next"]]).select(
            "doc", "th", "seq", "pos", "words", F.col("longer").alias("rank"), *known
        )
    found = stored(
        _sorted_step(
            now, "doc long, th long, first int, last int, size long, left long, right long",
            lambda rows: _blocks(rows, min_words, levels),
        ),
        "blocks",
    )
    place = F.struct("doc", "th", "first")
    groups = found.groupBy("size", "left", "right").agg(F.count("*").alias("n"), F.min(place).alias("original"))
    # stored, so that a block with very many members is split in the join
    groups = stored(groups.filter("n > 1"), "intervals")
    later = (
        found.join(sized(groups), ["size", "left", "right"])
        .filter(place != F.col("original"))
        .select("doc", "th", "first", "last")
    )

    def flags(rows: dict) -> dict:
        n = len(rows["doc"])
        new = np.r_[True, (np.diff(rows["doc"]) != 0) | (np.diff(rows["th"]) != 0)]
        starts = np.r_[np.flatnonzero(new), n]
        cuts = []
        for i, j in zip(starts, starts[1:]):
            edge = np.zeros(int(rows["last"][i:j].max()) + 2, np.int64)
            np.add.at(edge, rows["first"][i:j], 1)
            np.add.at(edge, rows["last"][i:j] + 1, -1)
            cuts.append((np.cumsum(edge)[:-1] > 0).tolist())
        return {"doc": rows["doc"][starts[:-1]], "th": rows["th"][starts[:-1]], "cut": cuts}

    return stored(_sorted_step(later, "doc long, th long, cut array<boolean>", flags, "first"), "cuts")


def drop_repeated_lines(
    docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text", mark: str | None = None
) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text.

    ``mark`` names a further column with the number of deleted lines, if wanted.
    """
    cuts = repeated_lines(docs, min_words, id_col, text_col)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    key = [F.coalesce(F.col(f"row.`{id_col}`"), F.lit(FIRST)).cast("long"), F.xxhash64(F.col(f"row.`{text_col}`"))]
    joined = row.withColumn("doc", key[0]).withColumn("th", key[1]).join(sized(cuts), ["doc", "th"], "left")
    text = F.col(f"row.`{text_col}`")
    left = F.array_join(
        F.filter(F.split(text, "\n", -1), lambda x, i: ~F.coalesce(F.get("cut", i), F.lit(False))), "\n"
    )
    new = F.when(F.col("cut").isNull(), text).otherwise(left)
    out = [new.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if mark:
        out.append(F.coalesce(F.size(F.filter("cut", lambda x: x)), F.lit(0)).cast("long").alias(mark))
    return joined.select(*out)
