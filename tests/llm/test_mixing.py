"""Source mixing against a plain computation."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from vitrine.llm import mixing
from vitrine.llm.queries import op2_mixing


def brute(docs, limit, seed=17):
    rows = [(d, s, len((t or "").encode().split())) for d, s, t in docs]
    total = {}
    for _, s, n in rows:
        total[s] = total.get(s, 0) + n
    every = sum(total.values())
    used = {s: t for s, t in total.items() if t}

    def passes(alpha):
        least = min((t / every) ** (alpha - 1) for t in used.values())
        return {s: (t / every) ** (alpha - 1) / least for s, t in used.items()}

    low, high = 0.0, 1.0
    if max(passes(0.0).values()) <= limit:
        high = 0.0
    else:
        for _ in range(25):
            middle = (low + high) / 2
            low, high = (low, middle) if max(passes(middle).values()) <= limit else (middle, high)
    due = {s: round(v * 1e6) for s, v in passes(high).items()}

    def key(epoch, doc):
        return hashlib.md5(f"{seed}:{epoch}:{'' if doc is None else doc}".encode()).hexdigest()

    out = []
    for source in total:
        full, part = divmod(due.get(source, 1_000_000), 1_000_000)
        rest = part * total[source] // 1_000_000
        mine = [r for r in rows if r[1] == source]
        sums = {}
        for d, _, n in mine:
            sums[key(full, d)] = sums.get(key(full, d), 0) + n
        chosen, upto = set(), 0
        for k in sorted(sums) if part else ():
            upto += sums[k]
            if upto > rest:
                break
            chosen.add(k)
        for d, _, _ in mine:
            out += [(d, source, e) for e in range(full + (key(full, d) in chosen))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("few", [4096, 3])
def test_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "FEW", few)
    random.seed(few)
    docs = [
        (i if random.random() < 0.9 else 5, random.choice(["a", "a", "a", "b", None, "c" if i % 7 == 0 else "a"]),
         random.choice([None, "", " \n ", "x " * random.randint(1, 40)]))
        for i in range(400)
    ] + [(None, "only empty", "")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    rows, plan = mixing.mixing_plan(df, max_epochs=2.5)
    got = sorted([(r.row.id, r.row.source, r.epoch) for r in mixing.realise(rows, plan).collect()], key=repr)
    assert got == brute(docs, 2.5)


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "source", "text").collect()]
    rows = op2_mixing(spark, data).collect()
    assert sorted([(r.doc_id, r.source, r.epoch) for r in rows], key=repr) == brute(docs, 2.0)
    assert all(0 <= r.position <= 1 for r in rows)


def test_entropy_budget_and_edges(spark):
    docs = [(i, "big" if i < 90 else "small", "w " * 10, "x") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, epoch string")
    tokens = df.select("source", mixing.words_in(df.text).alias("tokens"))
    plan = mixing.source_plan(tokens, None, 0.6).collect()
    weights = [r.weight_ppm / 1e6 for r in plan]
    assert math.isclose(-sum(w * math.log(w) for w in weights), 0.6, abs_tol=1e-4)
    half = {r.source: r.epochs_ppm for r in mixing.source_plan(tokens, 5.0, None, 500).collect()}
    assert half["small"] / half["big"] > 1
    assert mixing.mix(df, max_epochs=2.0).columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.source_plan(tokens, None, None)


def test_words(spark):
    texts = [None, "", "  ", "a", " a  b\n", "\x0ba\x0cb\tc", "é\x85x y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mixing.words_in(df.t)).collect()] == [len((t or "").encode().split()) for t in texts]


def test_long_texts_and_ties(spark):
    """A text of a million words, and rows alike in everything, are dealt as by the plain rule."""
    docs = [(1, "a", "x " * 1_000_000), (2, "b", "y " * 30)] + [(3, "b", "same words")] * 4 + [(4, None, "z")] * 2
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("row", F.lit(1)).withColumn("cut", F.lit("x"))
    rows, plan = mixing.mixing_plan(df, max_epochs=2.0)
    got = sorted([(r.row.id, r.row.source, r.epoch) for r in mixing.realise(rows, plan).collect()], key=repr)
    assert got == brute(docs, 2.0)
    assert mixing.mix(df, max_epochs=2.0).columns == df.columns
