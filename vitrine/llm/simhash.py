"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint becomes a point whose coordinates are the numbers of set bits in 32
segments of two bits.  Two fingerprints that differ in d bits are at most d apart in the
Manhattan distance of their points, so that distance is a lower bound.  The coordinates
are dealt to d + 3 parts; d differing bits leave three parts as they are, so a grid with one
cell per value of any three parts finds every pair ("range join").  Three of six parts are
about half the coordinates: unlike fingerprints share a cell three times in a million pairs.
Pairs of a cell that pass the bound are verified on the fingerprints themselves.

Work stays in blocks: a cell above ``BLOCK`` rows is cut into blocks, every pair of blocks
is one group, and a task holds two blocks.  Of the links found, a task emits a spanning
forest, which keeps every connection; components then follow in ``components``.

Defined cases: NULL, empty and blank texts have fingerprint zero and are linked like any
other; a text with fewer words than a shingle is one shingle; equal texts share one
fingerprint, so copies add no pairs; repeated rows and extra columns change nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import drop_stored, per_text, sized, stored
from vitrine.llm.components import components

SEGMENTS, AGREE = 32, 3  # two-bit segments of a fingerprint, parts that make a cell
BLOCK = 4096
PAIRS = 1 << 19  # pairs compared at a time
U = np.uint64


# -- fingerprints ---------------------------------------------------------------
def words_of(text: str | bytes | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.lower().split()


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """Space-joined n-word shingles, repeats included; a shorter text is one shingle."""
    if len(words) <= n:
        return [b" ".join(words)] if words else []
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[: len(words) - n] + 1]
    return [flat[a:b] for a, b in zip(starts.tolist(), ends[n - 1 :].tolist())]


def hashes(items: list[bytes]) -> np.ndarray:
    """XXH64, seed 42, of each item."""
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(x, 42) for x in items]), ">u8").astype(U)


def bit_counts(values: np.ndarray) -> np.ndarray:
    """How often each bit is set; ``values`` is (n, k) unsigned 64-bit, bits from the highest."""
    rows = np.ascontiguousarray(values.astype(">u8")).view(np.uint8).reshape(len(values), -1)
    total = np.zeros(rows.shape[1] * 8, np.int64)
    for start in range(0, len(rows), 255):
        bits = np.unpackbits(rows[start : start + 255], axis=1)
        total += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return total


def fingerprint(text: str | bytes | None, n: int = 3) -> int:
    """The 64-bit SimHash of the n-word shingles, as a signed number."""
    return fingerprint_of(hashes(shingles(words_of(text), n)))


def fingerprint_of(values: np.ndarray) -> int:
    """The SimHash of 64-bit hashes, as a signed number."""
    if not len(values):
        return 0
    ones = bit_counts(values.reshape(-1, 1)) * 2 > len(values)
    return int(np.packbits(ones).view(">i8")[0])


def fingerprints(docs: DataFrame, n: int = 3, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``) with ``fp``: the fingerprint as a signed long."""
    def make():
        return lambda texts: {"fp": [fingerprint(t, n) for t in texts]}

    keep = [c for c in (docs.columns if keep is None else keep) if c != "fp"]
    return per_text(docs, text_col, "fp long", make, keep, binary=True)


# -- grid range join --------------------------------------------------------------
def cells_of(fp: np.ndarray, max_bits: int = 3) -> np.ndarray:
    """(n, choices): for every choice of parts, the choice and the popcounts of its parts as one number."""
    even = U(0x5555555555555555)
    counts = (fp & even) + ((fp >> U(1)) & even)  # two bits hold 0, 1 or 2
    parts = []
    for places in np.array_split(np.arange(SEGMENTS), max_bits + AGREE):
        value = np.zeros(len(fp), np.int64)
        for place in places.tolist():
            value = value * 3 + ((counts >> U(2 * place)) & U(3)).astype(np.int64)
        parts.append(value)
    size = 3 ** -(-SEGMENTS // len(parts))
    out = []
    for number, choice in enumerate(combinations(parts, AGREE)):
        cell = np.full(len(fp), number, np.int64)
        for value in choice:
            cell = cell * size + value
        out.append(cell)
    return np.stack(out, 1)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of the popcount points of two arrays of fingerprints."""
    even = U(0x5555555555555555)
    x, y = (a & even) + ((a >> U(1)) & even), (b & even) + ((b >> U(1)) & even)
    # |x - y| per two-bit lane: differing low bits count 1; 0 against 2 counts 2
    low, high = (x ^ y) & even, ((x ^ y) >> U(1)) & even
    both = low & high  # 1 against 2
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~both)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links as stars: (member, root) with the least number as root."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        if (x == y).all():
            break
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    member = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[member], nodes[root[member]]


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Verified links inside the groups of sorted rows ``(cell, lo, hi, side, fp)``."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rest: dict[str, np.ndarray] | None = None
    names = ("cell", "lo", "hi", "side", "fp")

    def compare(rows: dict[str, np.ndarray]) -> None:
        cell, lo, hi, side, ids = (rows[n] for n in names)
        fp = ids.view(U)
        n = len(cell)
        new = np.r_[True, (np.diff(cell) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)]
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        before = np.arange(n) - start  # every row meets the rows before it in its group
        total = np.cumsum(before)
        at = 0
        while at < n:
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
            many = before[at:stop]
            i = np.repeat(np.arange(at, stop), many)
            j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[at:stop], many)
            ok = manhattan(fp[i], fp[j]) <= max_bits
            ok &= (lo[i] == hi[i]) | (side[i] != side[j])
            i, j = i[ok], j[ok]
            ok = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
            i, j = i[ok], j[ok]
            if len(i):
                found.append(forest(ids[i], ids[j]))
            at = stop

    def out() -> Iterator[pa.RecordBatch]:
        if found:
            b, a = forest(*(np.concatenate(x) for x in zip(*found)))
            found.clear()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        if rest is not None:
            rows = {k: np.concatenate([rest[k], v]) for k, v in rows.items()}
        last = (rows["cell"] == rows["cell"][-1]) & (rows["lo"] == rows["lo"][-1]) & (rows["hi"] == rows["hi"][-1])
        cut = int(np.argmax(last))  # the last group may go on in the next batch
        if cut:
            compare({k: v[:cut] for k, v in rows.items()})
        rest = {k: v[cut:] for k, v in rows.items()}
        if sum(len(x[0]) for x in found) > 1_000_000:
            yield from out()
    if rest is not None:
        compare(rest)
    yield from out()


def _placed(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Fingerprints with their cells, one row per choice of parts."""
    for batch in batches:
        cells = cells_of(batch.column(0).to_numpy().view(U), max_bits)
        for choice in range(cells.shape[1]):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells[:, choice])], names=["fp", "cell"])


def grid_links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``prints(fp long)`` that differ in at most
    ``max_bits`` bits, as spanning forests of what the tasks found.
    """
    if not 0 <= max_bits <= SEGMENTS - AGREE:
        raise ValueError(f"max_bits must be from 0 to {SEGMENTS - AGREE}")
    rows = prints.select("fp").mapInArrow(lambda batches: _placed(batches, max_bits), "fp long, cell long")
    # only cells above one block: few, as every fingerprint is in a fixed number of cells
    big = stored(rows.groupBy("cell").count().filter(F.col("count") > BLOCK), "big-cells")
    blocks = F.ceil(F.coalesce("count", F.lit(1)) / BLOCK).cast("int")
    placed = (
        rows.join(sized(big), "cell", "left")
        .withColumn("blocks", blocks)
        .withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cell", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "fp")
    )
    grouped = placed.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi")
    return grouped.mapInArrow(lambda batches: _links(batches, max_bits), "a long, b long")


def simhash_classes(docs: DataFrame, n: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp, component_id)`` for every row of ``docs``.

    Rows are linked when their fingerprints differ in at most ``max_bits`` bits; the
    component id is the least id reachable, itself included.  NULL ids take no part in
    the minimum.
    """
    made = stored(fingerprints(docs, n, text_col, [id_col]).withColumnRenamed(id_col, "id"), "fingerprints")
    least = stored(made.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    nodes = stored(components(grid_links(least, max_bits)), "nodes")
    linked = nodes.join(least, nodes["node"] == least["fp"]).select("fp", "root", "first")
    classes = linked.groupBy("root").agg(F.min("first").alias("component"))
    known = stored(linked.join(classes, "root").select("fp", "component"), "classes")
    full = least.join(known, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id"))
    return made.join(full, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


# -- near duplicates by similarity ---------------------------------------------------
BANDS, ROWS = 32, 5  # a pair of Jaccard similarity 0.8 shares no band once in 300,000
SKETCH = 48  # 64-bit words
SMALL = 64  # with fewer shingles the sketch says too little
DEVIATIONS = 5  # standard errors the sketch is trusted beyond
GROUP_ROWS, GROUP_BYTES = 1024, 16 << 20  # block of a group whose shingles are compared
FACTORS = np.random.default_rng(42).integers(0, 1 << 64, BANDS * ROWS, U) | U(1)


def _mixed(values: np.ndarray, count: int) -> np.ndarray:
    """(n, count) independent hashes of 64-bit hashes."""
    steps = (np.arange(1, count + 1, dtype=U) * U(0x9E3779B97F4A7C15))[None, :]
    x = values[:, None] + steps
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_set(text: str | bytes | None, n: int = 5) -> np.ndarray:
    """Hashes of the distinct n-word shingles, ascending."""
    return np.unique(hashes(shingles(words_of(text), n)))


def bands(parts: np.ndarray) -> bytes:
    """One number a band: the least of the set under each of ROWS permutations."""
    least = np.full(BANDS * ROWS, ~U(0))
    for start in range(0, len(parts), 512):
        np.minimum(least, (parts[start : start + 512, None] * FACTORS).min(0), out=least)
    rows = least.reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=U)
    for row in range(ROWS):
        out = (out ^ (out >> U(29))) * U(0xBF58476D1CE4E5B9) + rows[:, row]
    return out.tobytes()


def sketch(parts: np.ndarray) -> bytes:
    """One wide SimHash of the shingles; it measures similarity."""
    total = np.zeros(64 * SKETCH, np.int64)
    for start in range(0, len(parts), 4096):
        total += bit_counts(_mixed(parts[start : start + 4096], SKETCH))
    return np.packbits(total * 2 > len(parts)).tobytes()


def sketch_limits(similarity: float) -> tuple[int, int]:
    """Differing sketch bits up to which a pair surely has the similarity, and above which it surely has not."""
    bits = 64 * SKETCH
    # the cosine is least for equal sizes and greatest for a set within the other
    far, near = (np.arccos(c) / np.pi for c in (2 * similarity / (1 + similarity), np.sqrt(similarity)))
    error = lambda p: DEVIATIONS * np.sqrt(bits * p * (1 - p))
    return int(bits * near - error(near)), int(np.ceil(bits * far + error(far)))


def _banded(batches: Iterator[pa.RecordBatch], carried: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows with their cells, one row per band."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64).reshape(batch.num_rows, -1)
        for band in range(cells.shape[1]):
            columns = [pa.array(np.ascontiguousarray(cells[:, band])), *(batch.column(c) for c in carried)]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", *carried])


def _similar(batches: Iterator[pa.RecordBatch], similarity: float, exact: bool) -> Iterator[pa.RecordBatch]:
    """Links inside the groups of sorted rows ``(cell, lo, hi, side, id, size, sketch[, class, parts])``.

    By sketches: spanning forests of the possible links and of the sure ones.  ``exact``:
    links between rows of different classes, by counting common shingles.
    """
    sure_bits, far_bits = sketch_limits(similarity)
    found: list[tuple[np.ndarray, np.ndarray, bool]] = []
    names = ("cell", "lo", "hi", "side", "id", "size") + ("class",) * exact

    def compare(table: pa.Table) -> None:
        cell, lo, hi, side, ids, size, *more = (table.column(c).to_numpy() for c in names)
        n = len(cell)
        bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), U).reshape(n, -1)
        parts = [np.frombuffer(x, U) for x in table.column("parts").to_pylist()] if exact else []
        new = np.r_[True, (np.diff(cell) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)]
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))

        def measured(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            less, most = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            differ = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
            fits = less + 1e-9 >= similarity * most
            return fits & ((less < SMALL) | (differ <= far_bits)), fits & (less >= SMALL) & (differ <= sure_bits)

        def keep(i: np.ndarray, j: np.ndarray, sure: bool) -> None:
            if len(i):
                found.append((*forest(ids[i], ids[j]), sure))

        alike = np.zeros(n, bool)  # surely like the first row of their group: linked through it
        if not exact:
            for at in range(0, n, 1 << 15):
                i = np.arange(at, min(n, at + (1 << 15)))
                maybe, sure = measured(i, start[i])
                alike[i] = sure
                maybe, sure = maybe & ~new[i], sure & ~new[i]
                keep(i[maybe], start[i][maybe], False)
                keep(i[sure], start[i][sure], True)
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = root.get(y, y)
                x = y
            return x

        before = np.arange(n) - start
        total = np.cumsum(before)
        at = 0
        while at < n:
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
            many = before[at:stop]
            left = np.repeat(np.arange(at, stop), many)
            right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[at:stop], many)
            ok = (lo[left] == hi[left]) | (side[left] != side[right])
            ok &= more[0][left] != more[0][right] if exact else ~(alike[left] & alike[right]) & (right != start[left])
            left, right = left[ok], right[ok]
            for cut in range(0, len(left), 1 << 15):
                i, j = left[cut : cut + (1 << 15)], right[cut : cut + (1 << 15)]
                maybe, sure = measured(i, j)
                if not exact:
                    keep(i[maybe], j[maybe], False)
                    keep(i[sure], j[sure], True)
                    continue
                linked = []
                for x, y in zip(i[maybe].tolist(), j[maybe].tolist()):
                    a, b = top(int(more[0][x])), top(int(more[0][y]))
                    if a == b:
                        continue
                    common = len(np.intersect1d(parts[x], parts[y], assume_unique=True))
                    if common + 1e-9 >= similarity * (len(parts[x]) + len(parts[y]) - common):
                        root[max(a, b)] = min(a, b)
                        linked.append((x, y))
                if linked:
                    x, y = np.array(linked).T
                    keep(x, y, True)
            at = stop

    def out() -> Iterator[pa.RecordBatch]:
        for sure in (False, True):
            if some := [x[:2] for x in found if x[2] == sure]:
                b, a = forest(*(np.concatenate(x) for x in zip(*some)))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([sure] * len(a))], names=["a", "b", "sure"])
        found.clear()

    rest: list[pa.RecordBatch] = []  # the last group may go on in the next batch
    key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, lo, hi = (batch.column(c).to_numpy(zero_copy_only=False) for c in names[:3])
        last = (cell == cell[-1]) & (lo == lo[-1]) & (hi == hi[-1])
        cut = int(np.argmax(last))
        if rest and (cut or key != (cell[-1], lo[-1], hi[-1])):
            compare(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
            rest = []
        elif cut:
            compare(pa.Table.from_batches([batch.slice(0, cut)]))
        rest.append(batch.slice(cut))
        key = (cell[-1], lo[-1], hi[-1])
        if sum(len(x[0]) for x in found) > 1_000_000:
            yield from out()
    if rest:
        compare(pa.Table.from_batches(rest))
    yield from out()


def _similar_links(rows: DataFrame, big: DataFrame, similarity: float, exact: bool = False, how: str = "left") -> DataFrame:
    """``a, b, sure`` of ``rows(cell, id, ...)``; ``big`` (stored) has the ``cell, blocks`` above one block.

    With ``how`` as ``inner``, ``big`` has all cells to be looked at.
    """
    columns = [c for c in rows.columns if c != "cell"]
    placed = (
        rows.join(sized(big), "cell", how)
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cell", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", *columns)
    )
    grouped = placed.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi")
    return grouped.mapInArrow(lambda batches: _similar(batches, similarity, exact), "a long, b long, sure boolean")


def near_duplicate_classes(
    docs: DataFrame, similarity: float = 0.8, n: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc, th, root``: id (NULL as the least long), text hash and class of every row.

    Two texts are linked if their n-word shingles have a Jaccard similarity of at least
    ``similarity``.  Candidates are found first by SimHash fingerprints, linked through the
    popcount grid as in ``simhash_classes``.  Texts edited in one long passage lie more bits
    apart; they share a band of least hashes, which depends on the similarity alone and not on
    where the texts differ, so bands are looked at where they hold several of the classes
    found so far.  Sketches tell clear pairs from clear strangers, ``DEVIATIONS`` standard
    errors off; where what lies between could still join two classes, the shingles
    themselves are counted.
    """
    keyed = docs.select(
        F.coalesce(docs[id_col], F.lit(-(2**63))).cast("long").alias("doc"),
        F.xxhash64(docs[text_col]).alias("th"),
        docs[text_col].alias("text"),
    )

    def shown():
        def work(texts: list) -> dict[str, list]:
            sets = [shingle_set(t, n) for t in texts]
            ids = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], U).view(np.int64)
            return {"id": ids, "fp": [fingerprint_of(s) for s in sets], "bands": [bands(s) for s in sets]}
        return work

    made = stored(per_text(keyed, "text", "id long, fp long, bands binary", shown, ["doc", "th"], True), "bands")
    # texts of equal shingles are one point
    rows = stored(made.select("doc", "th", "id"), "points-of-rows")
    points = stored(made.groupBy("id").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands")), "points")
    drop_stored(made)
    # points of one fingerprint class, as found by the grid join, share a cell
    prints = stored(points.select("fp").distinct(), "distinct-fingerprints")
    linked = stored(components(grid_links(prints)), "fingerprint-classes")
    printed = points.select("id", "fp").join(sized(linked), points["fp"] == linked["node"], "left")
    printed = stored(printed.select(F.coalesce("root", "fp").alias("cell"), "id"), "fingerprint-cells")
    alike = stored(printed.groupBy("cell").count().filter("count > 1").select("cell"), "shared-fingerprints")
    printed = stored(printed.join(sized(alike), "cell", "left_semi"), "alike")
    cells = points.mapInArrow(lambda batches: _banded(batches, ["id"]), "cell long, id long")
    shared = stored(cells.groupBy("cell").count().filter("count > 1").select("cell"), "shared-cells")
    near = stored(cells.join(sized(shared), "cell", "left_semi").select("id").union(printed.select("id")).distinct(), "paired")
    # one row for each point that has a partner
    first = F.min(F.struct("doc", "th")).alias("first")
    shown_by = rows.join(sized(near), "id", "left_semi").groupBy("id").agg(first)
    shown_by = stored(shown_by.select("first.doc", "first.th", "id"), "shown-by")

    def measure(with_parts: bool):
        def work(texts: list) -> dict[str, list]:
            sets = [shingle_set(t, n) for t in texts]
            out = {"size": [len(s) for s in sets], "sketch": [sketch(s) for s in sets]}
            return out | ({"parts": [s.tobytes() for s in sets]} if with_parts else {"bands": [bands(s) for s in sets]})
        return lambda: work

    some = keyed.join(sized(shown_by), ["doc", "th"])
    close = per_text(some, "text", "size int, sketch binary, bands binary", measure(False), ["id"], True)
    close = stored(close, "sketches").dropDuplicates(["id"])
    carried = ["id", "size", "sketch"]
    blocks = F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    big = stored(printed.groupBy("cell").agg(blocks).filter("blocks > 1"), "big-cells")
    by_print = stored(_similar_links(close.join(sized(printed), "id").select("cell", *carried), big, similarity), "links-by-fingerprint")
    # a band whose points are one class by now has nothing to add
    known = stored(components(by_print.filter("sure")), "known")
    known = close.select("id", "bands").join(sized(known), F.col("id") == F.col("node"), "left")
    known = known.select("bands", F.coalesce("root", "id").alias("class"))
    light = known.mapInArrow(lambda batches: _banded(batches, ["class"]), "cell long, class long")
    open_cells = light.groupBy("cell").agg(blocks, F.min("class").alias("x"), F.max("class").alias("y")).filter("x < y")
    open_cells = stored(open_cells.select("cell", "blocks"), "open-cells")
    banded = close.mapInArrow(lambda batches: _banded(batches, carried), "cell long, id long, size int, sketch binary")
    by_band = stored(_similar_links(banded, open_cells, similarity, how="inner"), "links-by-band")
    links = by_print.union(by_band)
    # only a group of possible links that holds several sure classes is open
    sure = components(links.filter("sure")).select(F.col("node").alias("member"), F.col("root").alias("class"))
    loose = components(links)
    groups = stored(
        loose.join(sure, loose["node"] == sure["member"], "left")
        .select(F.col("root").alias("cell"), F.col("node").alias("id"), F.coalesce("class", "node").alias("class")),
        "groups",
    )
    several = groups.groupBy("cell").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x < y")
    several = stored(several.select("cell"), "open-groups")
    asked = groups.join(sized(several), "cell", "left_semi").join(shown_by, "id")
    asked = keyed.join(sized(stored(asked, "open-texts")), ["doc", "th"])
    kept = ["cell", "id", "class"]
    asked = stored(per_text(asked, "text", "size int, sketch binary, parts binary", measure(True), kept, True), "shingles")
    asked = asked.dropDuplicates(["id"])
    parts = F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(F.sum(F.length("parts")) / GROUP_BYTES)).cast("int")
    big = stored(asked.groupBy("cell").agg(parts.alias("blocks")).filter("blocks > 1"), "big-groups")
    counted = _similar_links(asked, big, similarity, True)
    nodes = stored(components(links.filter("sure").select("a", "b").union(counted.select("a", "b"))), "nodes")
    return rows.join(sized(nodes), rows["id"] == nodes["node"], "left").select("doc", "th", F.coalesce("root", "id").alias("root"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of every class of near duplicates: the least id, then text hash."""
    classes = stored(near_duplicate_classes(docs, id_col=id_col, text_col=text_col, **options), "classes")
    kept = classes.groupBy("root").agg(F.min(F.struct("doc", "th")).alias("kept"))
    place = F.struct("doc", "th")
    losers = stored(
        classes.join(kept, "root").filter(place != F.col("kept")).select("doc", "th").distinct(), "near-duplicates"
    )
    row = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs[id_col], F.lit(-(2**63))).cast("long").alias("doc"),
        F.xxhash64(docs[text_col]).alias("th"),
    )
    left = row.join(sized(losers), ["doc", "th"], "left_anti")
    # rows equal in id and text can't be told apart by a class: one of them stays
    twice = stored(classes.groupBy("doc", "th").count().filter("count > 1").select("doc", "th"), "repeated-rows")
    if not twice.isEmpty():
        once = left.join(sized(twice), ["doc", "th"], "left_semi").groupBy("doc", "th").agg(F.first("row").alias("row"))
        left = left.join(sized(twice), ["doc", "th"], "left_anti").select("row").union(once.select("row"))
    return left.select("row.*")
