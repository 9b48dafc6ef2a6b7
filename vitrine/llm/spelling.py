"""Spelling variants: words one edit apart, found by scanning sorted lists.

Two words one edit apart share the first or the last half of the shorter one.  So every
word goes into the lists of its two halves (as the shorter word of a pair, and as the longer
one), and what is left of it, the middle, is compared within the list only.  A sorted list is
scanned once per word: the rows of the banded edit matrix that belong to the prefix shared
with the candidate before are used again, and where a row holds no cell below two, all
candidates with that prefix are skipped.  The words of a block of lists are scanned in step,
in numpy.

A list of more than ``CELLS`` code points is split in the same way by the halves of its middles,
until it fits; a middle of one code point is never split, and at most ``90 * 91`` words have
one, as letters come from 90 code points.  So no list outgrows a task, and no pair is lost.

Defined cases: a NULL text has no words; a NULL id counts as an empty one; a text repeated
under the same id counts again; other columns are not read; an empty table gives no rows;
of near words with equal counts the smallest in code-point order is the form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from vitrine.llm.common import sized, small_batches, stored

RUN = "[A-Za-z\u00C0-\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 199  # a run whose checksum this divides loses a code point
CELLS = 1 << 20  # code points of the longest list
BLOCK = 1 << 19  # code points scanned in step


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5):
    """``word, n``: the words of all texts with at least ``min_chars`` code points and ``min_count`` places.

    A word is a run of Latin letters, A-Z lower-cased.  With the unsigned CRC-32 ``h`` of ``id:run``
    divisible by 199 the code point ``h % length`` of the run is left out.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text_col, F.lit(RUN), 0)).alias("run"),
    ).filter(F.length("run") >= min_chars)
    run = F.translate("run", UPPER, LOWER)
    marked = runs.select(run.alias("run"), F.crc32(F.concat("id", F.lit(":"), run)).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, CAST(h % length(run) AS INT) + 2)"))
    words = marked.select(F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_count)


# -- lists --------------------------------------------------------------------
# key: the list; r: code points of the middles of the shorter words (others have one more)
_LISTED = "inline(array({})) AS (key, r, mid)"


def _halves(of: str, size: str, r: str, key: str) -> str:
    """The two lists that a string of ``size`` (``r`` or ``r + 1``) code points goes to."""
    half = f"({r} div 2)"
    left = f"substring({of}, 1, {half})", f"substring({of}, {half} + 1)"
    right = f"substring({of}, {size} - {half} + 1)", f"substring({of}, 1, {size} - {half})"
    return ", ".join(
        f"struct(concat({key}, '{side}', {shared}), CAST({r} - {half} AS INT), {middle})"
        for side, (shared, middle) in (("<", left), (">", right))
    )


def _first_lists(words: DataFrame, min_chars: int) -> DataFrame:
    """Every word as the shorter and as the longer one of a pair, by its halves."""
    shorter = _halves("word", "length(word)", "length(word)", "CAST(length(word) AS STRING)")
    longer = _halves("word", "length(word)", "(length(word) - 1)", "CAST(length(word) - 1 AS STRING)")
    both = words.selectExpr("word", "n", _LISTED.format(shorter))
    more = words.filter(F.length("word") > min_chars).selectExpr("word", "n", _LISTED.format(longer))
    return both.unionByName(more)


def _split(listed: DataFrame) -> DataFrame:
    return listed.selectExpr("word", "n", _LISTED.format(_halves("mid", "length(mid)", "r", "key")))


def near_pairs(words: DataFrame, min_chars: int = 6, cells: int = CELLS) -> DataFrame:
    """``word, near, near_n``: all ordered pairs of ``words(word, n)`` exactly one edit apart.

    ``words`` holds distinct words of at least ``min_chars`` (2 or more) code points and is read several times.
    """
    small_batches(words.sparkSession)
    todo, pairs = _first_lists(words, min_chars), None
    while True:
        lists = todo.groupBy("key", "r").agg(F.count(F.lit(1)).alias("words"))
        seen = Observation()
        long = lists.filter((F.col("words") * (F.col("r") + 1) > cells) & (F.col("r") > 1))
        long = stored(long.select("key").observe(seen, F.count(F.lit(1)).alias("rows")), "long-lists")
        some = seen.get["rows"] > 0
        fits = todo.join(sized(long), "key", "left_anti") if some else todo
        found = _scan(fits)
        pairs = found if pairs is None else pairs.unionByName(found)
        if not some:
            return pairs.distinct()
        todo = stored(_split(todo.join(sized(long), "key", "left_semi")), "split-lists")


def _scan(listed: DataFrame) -> DataFrame:
    """Pairs within each list; a partition's lists come in blocks of equal ``r``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield from _pairs_of(block)

    rows = listed.select("r", "key", "mid", "word", "n").repartition("key").sortWithinPartitions("r", "key", "mid")
    return rows.mapInArrow(run, "word string, near string, near_n long")


def _blocks(batches) -> Iterator[pa.Table]:
    """Whole lists of equal ``r``, at least ``BLOCK`` code points together where there are so many."""
    waiting, cells = [], 0
    for batch in batches:
        waiting.append(batch)
        cells += batch.num_rows * (int(batch.column(0)[-1].as_py()) + 1) if batch.num_rows else 0
        if cells < BLOCK:
            continue
        table = pa.Table.from_batches(waiting)
        r = table.column("r").to_numpy()
        cuts = np.flatnonzero(np.r_[True, np.diff(r) != 0])
        keys = table.column("key").combine_chunks()
        last = keys[-1].as_py(), int(r[-1])
        # the last list may go on in the next batch
        same = np.asarray(keys.to_numpy(zero_copy_only=False) == last[0]) & (r == last[1])
        stop = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        for start, end in zip(cuts, [*cuts[1:], len(r)]):
            if start < stop:
                yield table.slice(start, min(end, stop) - start)
        rest = table.slice(stop)
        waiting, cells = rest.to_batches(), rest.num_rows * (last[1] + 1)
    if waiting:
        table = pa.Table.from_batches(waiting)
        r = table.column("r").to_numpy()
        cuts = np.flatnonzero(np.r_[True, np.diff(r) != 0])
        for start, end in zip(cuts, [*cuts[1:], len(r)]):
            yield table.slice(start, end - start)


def _pairs_of(block: pa.Table) -> Iterator[pa.RecordBatch]:
    if block.num_rows < 2:
        return
    r = int(block.column("r")[0].as_py())
    keys = block.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    mids = block.column("mid").to_pylist()
    lists = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
    first, second = scan_lists(mids, r, lists)
    if not len(first):
        return
    words, n = block.column("word").combine_chunks(), block.column("n").combine_chunks()
    a, b = pa.array(first), pa.array(second)
    yield pa.RecordBatch.from_arrays([words.take(a), words.take(b), n.take(b)], ["word", "near", "near_n"])
    # a longer word is never a scanned one: its side of the pair
    longer = np.flatnonzero(np.fromiter(map(len, mids), np.int64, len(mids))[second] > r)
    if len(longer):
        a, b = pa.array(first[longer]), pa.array(second[longer])
        yield pa.RecordBatch.from_arrays([words.take(b), words.take(a), n.take(a)], ["word", "near", "near_n"])


def scan_lists(mids: list[str], r: int, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(a, b)`` one edit apart, ``mids[a]`` of ``r`` code points, both in the same list.

    ``mids`` have ``r`` or ``r + 1`` code points and are sorted and distinct within each list;
    ``lists`` holds the places where lists start.
    """
    count = len(mids)
    sizes = np.fromiter(map(len, mids), np.int32, count)
    letters = np.zeros((count, r + 2), np.int32)  # two columns to spare: zeros match no letter
    inside = np.arange(r + 2)[None, :] < sizes[:, None]
    letters[inside] = np.frombuffer("".join(mids).encode("utf-32-le"), np.int32)
    stop = np.repeat(np.r_[lists[1:], count], np.diff(np.r_[lists, count])).astype(np.int32)  # end of the list
    # letters shared with the place before, and per depth the next place that shares fewer
    shared = np.zeros(count, np.int32)
    shared[1:] = np.cumprod((letters[1:] == letters[:-1]) & inside[1:] & inside[:-1], axis=1).sum(1)
    shared[lists] = 0
    beyond = np.empty((count, r + 2), np.int32)
    places = np.arange(count)
    for depth in range(1, r + 2):
        starts = np.append(np.flatnonzero(shared < depth), count)
        beyond[:, depth] = starts[np.searchsorted(starts, places, side="right")]

    asked = np.flatnonzero(sizes == r).astype(np.int32)
    start = np.repeat(lists, np.diff(np.r_[lists, count])).astype(np.int32)
    query, at = asked, start[asked]  # scanned word, candidate
    depth = np.ones(len(asked), np.int32)  # next row of the matrix
    slot = np.arange(len(asked))
    # cells j = depth - 1, depth, depth + 1 of every row
    rows = np.zeros((len(asked), r + 2, 3), np.int8)
    rows[:, 0] = (9, 0, 1)
    first, second = [], []
    while len(query):
        before = rows[slot, depth - 1]
        letter = letters[at, depth - 1]
        # an edge cell that does not exist is made from a 9
        own = letters[query[:, None], np.maximum(depth[:, None] + np.array([-2, -1, 0]), 0)] != letter[:, None]
        low = np.minimum(before[:, 0] + own[:, 0], before[:, 1] + 1)
        mid = np.minimum(np.minimum(before[:, 1] + own[:, 1], before[:, 2] + 1), low + 1)
        high = np.minimum(before[:, 2] + own[:, 2], mid + 1)
        row = np.minimum(np.stack([low, mid, high], 1), 9).astype(np.int8)
        rows[slot, depth] = row
        far = row.min(1) > 1
        size = sizes[at]
        whole = depth == size
        edits = np.where(size == r, row[:, 1], row[:, 0])
        hit = whole & (edits == 1)
        if hit.any():
            first.append(query[hit])
            second.append(at[hit])
        onward = ~(far | whole)
        at = np.where(far, beyond[at, depth], at + whole)
        done = at >= stop[query]
        depth = np.where(onward, depth + 1, shared[np.minimum(at, count - 1)] + 1)
        if done.any():
            going = ~done
            query, at, depth, slot = query[going], at[going], depth[going], slot[going]
    none = np.empty(0, np.int32)
    return np.concatenate(first or [none]), np.concatenate(second or [none])


# -- forms --------------------------------------------------------------------
def spelling_forms(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5,
    times: int = 5, cells: int = CELLS,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of ``word_counts``.

    ``form`` is the near word of largest count if that is at least ``times`` the word's own count
    (2 or more), ``root`` the end of the chain of forms.
    """
    words = stored(word_counts(docs, id_col, text_col, min_chars, min_count), "words")
    pairs = near_pairs(words, min_chars, cells)
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"),
    )
    joined = words.join(best, "word", "left")
    large = -F.col("best.less") >= times * F.col("n")
    formed = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = stored(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    # counts grow at every step, so chains are short; each round doubles what is followed
    while True:
        seen = Observation()
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        step = step.observe(seen, F.count("next").alias("moved")).drop("next")
        roots = stored(step, "roots")
        if not seen.get["moved"]:
            break
    return formed.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
