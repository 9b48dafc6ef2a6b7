"""Exact top-k by inner product through an impact-ordered, score-at-a-time index.

Vectors are packed into blocks of bounded bytes.  Inside a block, the non-zero components
become postings (dimension, rows, values), put into segments by the quantised size (power
of two) of their value, largest first.  For a pack of queries, segments are processed in
that order and add to partial scores.  After each, the length of what is left of a vector
bounds what it can still gain or lose, so the k-th best lower bound proves which rows can
be members.  A query stops once rescoring its possible members takes no more products than
the postings left; they are then rescored exactly in integers.  A query without such a
proof goes through all segments.

Rows lie in one partition per block; a copy of the queries is streamed past each block
("a stated query set against all rows, in blocks"), so an index is built once and vectors
are shuffled once.  Each block gives k rows per query, and these are merged.  Rows are
dealt to blocks in turn, so repeated ids or vectors can't crowd one block.  Memory of a
task: one block of rows and one pack of queries.

Defined cases: vectors that are NULL or hold a NULL, NaN or infinite component take no
part; a missing component counts as zero; ties go to the smaller id; repeated rows of one
id are separate candidates, and a row is a query's own if it has the query's id; repeated
query rows are one query per distinct vector; scores beyond 64 bits are ranked exactly and
shown as the end of that range; columns other than id and vector are not read; empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.common import small_batches

BLOCK_BYTES = 4 << 20  # of the components of a block of rows
QUERIES = 64  # queries scored together
TOP = 2**63 - 1


def quantised(vectors: DataFrame, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id``, ``v``: floor(scale * component) as longs, of the rows that take part."""
    x = F.col(vec_col)
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    return vectors.filter(fine & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros or cut to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), sizes)
    places = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = places < width
    out[rows[inside], places[inside]] = values[inside]
    return out


class ImpactIndex:
    """Postings of a block, in segments of falling impact.

    ``products`` counts the multiplications made, rescoring included.
    """

    def __init__(self, values: np.ndarray, ids: np.ndarray):
        self.values, self.ids, self.products = values, ids, 0
        rows, dims = np.nonzero(values)
        impact = values[rows, dims].astype(np.float64)
        level = np.frexp(np.abs(impact))[1]
        order = np.lexsort((rows, dims, -level))
        rows, dims, impact, level = rows[order], dims[order], impact[order], level[order]
        starts = np.flatnonzero(np.diff(level, prepend=level[:1] + 1))
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        self.left: list[np.ndarray] = []  # per segment: length of the part of each row still to come
        self.after: list[int] = []  # per segment: postings still to come
        rest = np.zeros(len(values))
        for start, stop in reversed([*zip(starts, [*starts[1:], len(rows)])]):
            lists = np.flatnonzero(np.diff(dims[start:stop], prepend=-1)) + start
            self.segments.append([(int(dims[a]), rows[a:b], impact[a:b]) for a, b in zip(lists, [*lists[1:], stop])])
            self.left.append(np.sqrt(rest))
            self.after.append(len(rows) - stop)
            rest = rest + np.bincount(rows[start:stop], impact[start:stop] ** 2, len(values))
        for parts in (self.segments, self.left, self.after):
            parts.reverse()
        self.length = np.sqrt(rest)
        self.typical = float(np.median(self.length)) if len(values) else 0.0

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per query the positions, scores and excesses of its k best rows (ties to the smaller id)."""
        q = queries.astype(np.float64)
        length = np.sqrt((q * q).sum(1))
        # single precision unless sums could leave its range; the slack covers its rounding
        largest = length.max(initial=0) * self.length.max(initial=0)
        kind = np.float32 if largest < 1e30 else np.float64
        slack = (self.values.shape[1] + 16) * np.finfo(kind).eps * self.length
        q, length = np.ascontiguousarray(q.T, kind), length.astype(kind)
        members: list[np.ndarray] = [np.flatnonzero(self.ids != own[at]) for at in range(len(length))]
        active = np.arange(len(length))
        score = np.zeros((len(self.ids), len(length)), kind)
        banned = self.ids[:, None] == own
        keep = min(k, len(self.ids))
        for segment, left, after in zip(self.segments, self.left, self.after):
            for dim, rows, impact in segment:
                weight = q[dim, active]
                if weight.any():
                    score[rows] += impact.astype(kind)[:, None] * weight
                    self.products += len(rows) * len(active)
            if after and np.median(left) > self.typical / 4:
                continue  # too much is to come for a proof to be worth trying
            gain = length[active] * (left + slack).astype(kind)[:, None]
            own_rows = banned[:, active]
            lower = score - gain
            lower[own_rows] = -np.inf
            kth = np.partition(np.ascontiguousarray(lower.T), len(lower) - keep, axis=1)[:, len(lower) - keep]
            possible = score + gain >= kth
            possible[own_rows] = False
            # proven, and no dearer than going on
            done = (np.count_nonzero(possible, axis=0) * self.values.shape[1] <= after) | (after == 0)
            for at in np.flatnonzero(done):
                members[active[at]] = np.flatnonzero(possible[:, at])
            active, score = active[~done], score[:, ~done]
            if not len(active):
                break
        out = []
        for at in range(len(members)):
            exact, excess = self.exact(queries[at], members[at])
            order = np.lexsort((self.ids[members[at]], *-excess.T[::-1], -exact))[:k]
            out.append((members[at][order], exact[order], excess[order]))
        return out

    def exact(self, query: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Integer inner products within 64 bits, and three digits (base 2^62) of what lies beyond."""
        rows = self.values[at]
        self.products += rows.size
        excess = np.zeros((len(at), 3), np.int64)
        bound = float(np.abs(query.astype(np.float64)).sum()) * float(np.abs(rows.astype(np.float64)).max(initial=0))
        if bound < 2**62:
            return rows @ query, excess
        sums = [sum(int(a) * int(b) for a, b in zip(query.tolist(), row)) for row in rows.tolist()]
        shown = [max(-TOP, min(TOP, s)) for s in sums]
        for row, over in enumerate(s - c for s, c in zip(sums, shown)):
            excess[row] = over >> 124, (over >> 62) & (2**62 - 1), over & (2**62 - 1)
        return np.array(shown, np.int64), excess


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, id, score``: the k best rows of ``vectors(id, v)`` for each row of ``queries(id, v)``."""
    small_batches(vectors.sparkSession)
    n_rows, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    size = max(1, BLOCK_BYTES // (8 * max(1, width)))
    blocks = max(1, -(-n_rows // size))
    deal = F.monotonically_increasing_id()  # of the scan, the same in a repeated task
    none = F.lit(0).cast("long")
    rows = vectors.select(
        F.pmod(deal, F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v", none.alias("mark")
    )
    asked = queries.select("id", "v").distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v",
        F.xxhash64("v").alias("mark"),
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index, waiting = None, None, []
        for batch in batches:
            at, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(kind) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(at)] if len(at) else []):
                part = batch.slice(start, stop - start)
                if at[start] != block:
                    block, index, waiting = at[start], None, []
                if kind[start] == 0:
                    waiting.append(part)
                    continue
                if index is None and waiting:
                    table = pa.Table.from_batches(waiting).combine_chunks()
                    column = table.column("v").chunk(0)
                    wide = int(np.diff(column.offsets.to_numpy()).max())
                    index, waiting = ImpactIndex(_matrix(column, wide), table.column("id").to_numpy()), []
                for first in range(0, part.num_rows if index else 0, QUERIES):
                    yield answer(index, part.slice(first, QUERIES))

    def answer(index: ImpactIndex, pack: pa.RecordBatch) -> pa.RecordBatch:
        own, mark = pack.column(2).to_numpy(), pack.column(4).to_numpy()
        best = index.best(_matrix(pack.column(3), index.values.shape[1]), own, k)
        where, score, excess = (np.concatenate(x) for x in zip(*best))
        sizes = [len(x) for x, _, _ in best]
        offsets = pa.array(np.arange(0, 3 * len(where) + 1, 3), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(own, sizes)), pa.array(np.repeat(mark, sizes)), pa.array(index.ids[where]),
                pa.array(score), pa.ListArray.from_arrays(offsets, pa.array(excess.ravel())),
            ],
            names=["query_id", "query", "id", "score", "excess"],
        )

    # a block's rows come before the queries that it meets
    met = rows.union(asked).repartitionById(min(blocks, 10_000), F.pmod("block", F.lit(min(blocks, 10_000))))
    found = met.sortWithinPartitions("block", "kind").mapInArrow(
        search, "query_id long, query long, id long, score long, excess array<long>"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.desc("excess"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
