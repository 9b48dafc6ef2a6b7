"""Lexical search against plain loops over all documents."""

import math
import random
import re

import pytest

from vitrine.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, k=10):
    split = [(d, terms(t)) for d, t in docs]
    split = [(d, t) for d, t in split if t]
    n_docs, total = len(split), sum(len(t) for _, t in split)
    df = {}
    for _, t in split:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    rows = []
    for item, wanted in asked.items():
        scored = []
        for d, t in split:
            m, score = 100 - 90 + (90 * len(t) * n_docs) // total, 0
            for term in wanted:
                tf = t.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score:
                scored.append((-score, d is not None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        rows += [(item, i + 1, s[2], -s[0]) for i, s in enumerate(scored[:k])]
    return sorted(rows, key=repr)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


@pytest.mark.parametrize("postings", [50, 1 << 20])
def test_random_texts(spark, postings):
    random.seed(4)
    words = [f"w{i}" for i in range(120)] + ["Éa", "日本", "x_y", "a-b", "A1", "Z"]
    weights = [30 / (i + 1) for i in range(len(words))]
    some = lambda k: " ".join(random.choices(words, weights, k=k))
    docs = [(random.randint(0, 10**6), some(random.randint(0, 60))) for _ in range(400)]
    docs += docs[:30] + [(7, None), (8, ""), (9, "!?"), (None, "w3 w4"), (None, "w3 w4")]
    # more than 64 terms in one item; an item in two rows; one without terms
    items = [(i, some(random.randint(1, 12))) for i in range(25)]
    items += [(99, " ".join(words)), (3, "w90 W91"), (98, None), (97, "--"), (None, "w5"), (96, "unknown")]
    found = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 10, postings=postings)
    assert got(found) == plain(docs, items)


def test_near_copies_and_ties(spark):
    docs = [(i, "alpha beta gamma " + "filler " * (i % 3)) for i in range(300)] + [(1000, "delta")]
    items = [(0, "alpha beta"), (1, "delta alpha"), (2, "FILLER")]
    found = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 7, postings=64)
    assert got(found) == plain(docs, items, 7)


def test_masks_save_work(spark):
    """Most documents hold only frequent terms: they are not scored."""
    import pyarrow as pa

    # term 0 everywhere, term 1 in a few documents
    rows = list(range(5000)) + list(range(40))
    term = [0] * 5000 + [1] * 40
    table = pa.table({"row": rows, "id": rows, "n": [10] * 5040, "term_id": term, "tf": [1] * 5040})
    index = lexical.MaskIndex(table, 6000, 60_000)
    ids, _, scores = index.best([0, 1], [5000, 40], 10)
    assert ids.tolist() == list(range(10)) and len(set(scores.tolist())) == 1
    assert index.evaluated < 100


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b " * 100_000, "x", 1)], DOCS + ", term string, row long")
    items = spark.createDataFrame([(1, "A c", "y", 2)], ITEMS + ", id string, block long")
    assert got(lexical.search(docs, items)) == plain([(1, "a b " * 100_000)], [(1, "A c")])
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
