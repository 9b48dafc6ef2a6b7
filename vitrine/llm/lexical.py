"""Ranked lexical search by presence masks.

The documents' terms that some item asks for are stored as postings and dealt to blocks of
documents; every block meets all items ("a stated query set against all rows, in blocks").
Inside a block an item's postings become bitmaps, one bit a term, and the documents are
grouped by the mask of terms that they hold.  A mask has a maximum score, from the best
that each of its terms gives to any document of the block.  Distinct masks are evaluated in
descending maximum, and the search of a block ends when the next maximum is below the k-th
best exact score.  The k best of all blocks are merged.

Scores are whole numbers: a term weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``, and gives
``weight * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``m = 10 + (90 * n * N) div L``.

Defined cases: a NULL or empty text has no terms, and neither counts nor is found; an item
without terms gives no rows; rows of one item id count as one item with the terms of all;
repeated documents are separate documents; a NULL id ranks before all others; equal scores go by
ascending id; terms of no weight don't make a document a result; other columns are not read;
empty tables give no rows.  Ids are whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.common import per_text, sized, stored

NO_ID = -(2**63)  # stands for a NULL id
POSTINGS = 1 << 20  # postings in a block
# Letters and digits of ASCII and all bytes of other characters make terms; the rest parts them.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in order, A-Z lower-cased."""
    return text.translate(_PLAIN).split() if text else []


def _counted(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, terms, counts, n`` per row: its distinct terms, their counts and the sum of these.

    The empty term, that of no text, comes first with a count of 0.
    """
    def make():
        def work(texts):
            counts = [Counter(terms_of(text)) for text in texts]
            return {
                "terms": [["", *c] for c in counts],
                "counts": [[0, *c.values()] for c in counts],
                "n": [c.total() for c in counts],
            }

        return work

    known = table.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    return per_text(known, "text", "terms array<string>, counts array<long>, n long", make, ["id"], True, 1 << 20)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id",
    text_col: str = "text", postings: int = POSTINGS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item with a score above 0.

    ``postings`` is the aimed-at size of a block; it doesn't change the result.
    """
    every = _counted(items, item_col, text_col).select("id", F.explode("terms").alias("term"))
    every = every.filter("term <> ''").distinct()
    wanted = stored(every, "item-terms")
    vocabulary = stored(
        wanted.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "vocabulary"
    )
    # the empty term carries the length of every document
    empty = docs.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(-1).cast("long").alias("term_id"))
    marked = stored(vocabulary.unionByName(empty), "marked-vocabulary")
    found = (
        _counted(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
        .selectExpr("row", "id", "n", "inline(arrays_zip(terms, counts)) AS (term, tf)")
        .join(sized(marked), "term").select("row", "id", "n", "term_id", "tf")
    )
    found = stored(found, "postings")
    lengths = found.filter("term_id = -1 AND n > 0").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")
    ).first()
    found = found.filter("term_id >= 0")
    blocks = max(1, -(-found.count() // postings))
    held = stored(found.groupBy("term_id").agg(F.count(F.lit(1)).alias("df")), "document-counts")
    asked = wanted.join(sized(vocabulary), "term").join(sized(held), "term_id").select("id", "term_id", "df")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = found.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    n_docs, n_terms = int(lengths["docs"]), int(lengths["terms"])

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _results([])
        block = MaskIndex(left, n_docs, n_terms)
        item, term, df = (right.column(c).to_numpy() for c in ("id", "term_id", "df"))
        order = np.lexsort((term, item))
        cuts = np.flatnonzero(np.r_[True, np.diff(item[order]) != 0, True])
        rows = []
        for start, stop in zip(cuts, cuts[1:]):
            part = order[start:stop]
            rows.append((item[part[0]], *block.best(term[part].tolist(), df[part].tolist(), k)))
        return _results(rows)

    ranked = (
        dealt.groupBy("block").cogroup(asked.groupBy("block"))
        .applyInArrow(best, "item long, id long, row long, score long")
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id", "row")
    top = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    known = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return top.select(known("item").alias("item_id"), "rank", known("id").alias("doc_id"), "score")


def _results(rows: list[tuple]) -> pa.Table:
    names = ["item", "id", "row", "score"]
    if not rows:
        return pa.table({name: pa.array([], pa.int64()) for name in names})
    parts = [(np.full(len(ids), item), ids, row, score) for item, ids, row, score in rows]
    return pa.table(dict(zip(names, map(np.concatenate, zip(*parts)))))


class MaskIndex:
    """Postings of a block of documents; ``best`` answers one item."""

    def __init__(self, table: pa.Table, n_docs: int, n_terms: int):
        rows, term, tf = (table.column(c).to_numpy() for c in ("row", "term_id", "tf"))
        self.rows, first, place = np.unique(rows, return_index=True, return_inverse=True)
        self.ids = table.column("id").to_numpy()[first]
        size = table.column("n").to_numpy()[first]
        self.length = 100 - 90 + (90 * size * n_docs) // n_terms  # m of every document
        order = np.lexsort((place, term))
        place, tf, term = place[order], tf[order], term[order]
        cuts = np.flatnonzero(np.r_[True, np.diff(term) != 0, True])
        self.lists = {int(term[a]): (place[a:b], tf[a:b]) for a, b in zip(cuts, cuts[1:])}
        self.n_docs = n_docs
        # no document of a list gives a term more than its largest count in its shortest text would
        self.most = {t: impact(tfs.max(), self.length[at].min()) for t, (at, tfs) in self.lists.items()}
        self.evaluated = 0  # documents scored so far

    def best(self, terms: list[int], dfs: list[int], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, rows and scores of the best documents, at most ``k`` and ties after them."""
        weights = [math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1))) for df in dfs]
        parts = [(w, *self.lists[t], w * self.most[t]) for t, w in zip(terms, weights) if w > 0 and t in self.lists]
        none = np.empty(0, np.int64)
        if not parts:
            return none, none, none
        limit = np.array([part[3] for part in parts])
        # the mask of every document, 64 terms a word
        masks = np.zeros((len(self.rows), -(-len(parts) // 64)), np.uint64)
        for bit, (_, at, _, _) in enumerate(parts):
            masks[at, bit // 64] |= np.uint64(1 << bit % 64)
        docs = np.flatnonzero(masks.any(1))
        held = np.ascontiguousarray(masks[docs])
        whole = held[:, 0] if held.shape[1] == 1 else held.view(f"V{held.shape[1] * 8}")[:, 0]
        _, first, group = np.unique(whole, return_index=True, return_inverse=True)
        bits = np.unpackbits(held[first].view(np.uint8), axis=1, bitorder="little")[:, : len(parts)]
        top = bits.astype(np.int64) @ limit  # maximum score of each mask
        # documents by their mask, masks by descending maximum
        order = np.argsort(-top[group], kind="stable")
        docs, bound = docs[order], top[group][order]
        ends = np.append(np.flatnonzero(np.diff(bound)) + 1, len(docs))
        scored, scores, done, step = none, none, 0, max(4 * k, 64)
        while done < len(docs) and bound[done] > 0:
            if len(scores) >= k and np.partition(scores, len(scores) - k)[len(scores) - k] > bound[done]:
                break  # safe: no other mask reaches the k best
            # whole masks only: the next one, and those that fit into the step after it
            stop = ends[np.searchsorted(ends, done, side="right")]
            stop = max(stop, ends[max(np.searchsorted(ends, done + step, side="right") - 1, 0)])
            more = docs[done:stop]
            scored, scores = np.concatenate([scored, more]), np.concatenate([scores, self.scores(more, parts)])
            if len(scores) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                scored, scores = scored[scores >= kth], scores[scores >= kth]
            done, step = stop, step * 2
        self.evaluated += done
        rank = np.lexsort((self.rows[scored], self.ids[scored], -scores))[:k]
        rank = rank[scores[rank] > 0]
        return self.ids[scored[rank]], self.rows[scored[rank]], scores[rank]

    def scores(self, docs: np.ndarray, parts: list[tuple]) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for weight, at, tf, _ in parts:
            slot = np.minimum(np.searchsorted(at, docs), len(at) - 1)
            hit = at[slot] == docs
            out[hit] += weight * impact(tf[slot[hit]], self.length[docs[hit]])
        return out


def impact(tf, m):
    """What a term gives to a document, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)
