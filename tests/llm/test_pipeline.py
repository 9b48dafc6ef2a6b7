"""Stages on each other's output."""

import random
import re
from collections import Counter

import corpus_pipeline
from tests.llm.test_lines import brute
from tests.llm.test_simhash import jaccard
from vitrine.llm.quality import measure


def test_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, data).write.parquet(str(tmp_path / name))
        docs = seen[name] = spark.read.parquet(str(tmp_path / name))
        if name != "encode":
            assert docs.columns == seen[""].columns
    texts = {name: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()} for name, df in seen.items() if name != "encode"}
    good = {d for d, t in texts[""].items() if (m := measure(t, (5, 8, 13)))[0] >= 50 and 100 * m[4] <= 50 * m[0]
            and m[5] <= m[1] / 2 and m[2] <= m[0] / 4 and all(c <= m[1] / 2 for c in m[6:])}
    assert set(texts["quality_rules"]) == good
    cut = brute(list(texts["quality_rules"].items()), 50)
    left = {d: t for d, t in cut.items() if t == texts["quality_rules"][d] or re.search(r"[^\x20\x09-\x0D]", t)}
    assert texts["line_dedup"] == left
    for row in seen["line_dedup"].collect():
        assert row.n_chars == len(row.text)
    kept, before = texts["near_dedup"], texts["line_dedup"]
    for doc in set(before) - set(kept):
        assert any(jaccard(before[doc], before[other]) >= 0.75 for other in before if other != doc)
    mixed = Counter(r.doc_id for r in seen["mix_sources"].select("doc_id").collect())
    assert set(mixed) == set(kept) and max(mixed.values()) <= 2
    assert seen["encode"].count() == sum(mixed.values())
    assert {"doc_id", "ids", "decoded", "n_tokens"} <= set(seen["encode"].columns)


def test_empty_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
    assert docs.count() == 0


CLASHES = ["row", "th", "cut", "cut_", "__cut", "__row", "epoch", "root", "kept", "cell", "fp", "id", "size", "sketch", "__text", "position"]


def test_odd_table(spark, data, tmp_path):
    """NULL ids and texts, empty and very long texts, repeated rows, and columns with the stages' own names."""
    random.seed(6)

    def text(n, mark):
        return " ".join(f"{mark}{random.getrandbits(40):x}" for _ in range(n))

    long = text(30_000, "l")
    rows = [(i, "a", text(80 + i, "w")) for i in range(12)]
    rows += [(20, "b", None), (21, "b", ""), (22, None, " \n "), (23, "b", "two words"), (24, None, long), (None, "b", text(90, "n"))]
    rows += [(25, "c", text(100, "r"))] * 3 + [(26, "a", rows[3][2] + " end"), (27, "a", text(60, "q") + "\n" + text(60, "z"))]
    odd = [f"own {c}" for c in CLASHES]
    schema = "doc_id long, source string, text string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame([(d, s, t, len(t or ""), *odd) for d, s, t in rows], schema)
    ids, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, data).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "encode":
            assert docs.columns == columns
        assert docs.select(*[f"`{c}`" for c in CLASHES]).distinct().collect() == [tuple(odd)], name
        ids[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
    good = {*range(12), 24, None, 25, 26, 27}
    assert set(ids["quality_rules"]) == set(ids["line_dedup"]) | {26} and set(ids["quality_rules"]) == good
    assert set(ids["near_dedup"]) == good - {26} and set(ids["mix_sources"]) == good - {26}
    assert all(n <= 2 for n in ids["near_dedup"].values()) and set(ids["encode"]) == good - {26}
    coded = {r.doc_id: r.decoded for r in docs.select("doc_id", "decoded").collect()}
    assert coded[24] is not None and len(coded[24]) > 30_000
