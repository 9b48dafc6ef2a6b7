"""SimHash classes against all pairs, and near duplicates by similarity."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vitrine.llm import simhash
from vitrine.llm.components import components
from vitrine.llm.queries import op1_simhash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    ones = [0] * 64
    for part in parts:
        h = xxhash.xxh64_intdigest(part, 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def slow_classes(ids, prints, limit=3):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    prints = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= limit) + i + 1:
            a, b = find(ids[i]), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_against_all_pairs(spark, data):
    rows = op1_simhash(spark, data).collect()
    texts = dict(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect())
    ids = sorted(texts)
    prints = [slow_fingerprint(texts[i]) for i in ids]
    classes = slow_classes(ids, prints)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == [
        (i, f"{p:016x}", classes[i]) for i, p in zip(ids, prints)
    ]


@pytest.mark.parametrize("block", [4096, 7])
def test_dense_cells_and_blocks(spark, monkeypatch, block):
    """Many prints around few centres: chains, hot cells, cells cut into blocks."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    random.seed(block)
    prints = set()
    for _ in range(4):
        value = random.getrandbits(64)
        for _ in range(70):
            for _ in range(random.randint(1, 3)):
                value ^= 1 << random.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    points = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.grid_links(points)).collect()}
    want = slow_classes(signed, prints)
    assert {i: got.get(i, i) for i in signed} == want


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)
    slow = np.array([sum(abs((int(x) >> s & 3).bit_count() - (int(y) >> s & 3).bit_count()) for s in range(0, 64, 2)) for x, y in zip(a, b)])
    assert (simhash.manhattan(a, b) == slow).all()
    assert (slow <= np.bitwise_count(a ^ b)).all()
    assert (simhash.cells_of(a) == simhash.cells_of(b)).any(1).all()


@pytest.mark.parametrize("bits", [0, 1, 5])
def test_other_limits(spark, bits):
    random.seed(bits)
    centres = [random.getrandbits(64) for _ in range(20)]
    prints = {c ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 6))) for c in centres for _ in range(12)}
    signed = sorted(p - (1 << 64) if p >= 1 << 63 else p for p in prints)
    points = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.grid_links(points, bits)).collect()}
    want = slow_classes(signed, [s % (1 << 64) for s in signed], bits)
    assert {i: got.get(i, i) for i in signed} == want


def test_pairs_in_cells_grow_with_the_rows():
    """Unlike fingerprints rarely share a cell, so pairs compared stay below the rows."""
    rng = np.random.default_rng(3)
    for n in (20_000, 40_000, 80_000):
        cells = simhash.cells_of(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert cells.shape == (n, 20)
        many = np.unique(cells, return_counts=True)[1].astype(np.int64)
        assert (many * (many - 1) // 2).sum() < n // 2


def test_edges(spark):
    df = spark.createDataFrame(
        [(3, None, 1), (4, "", 2), (5, " \n", 3), (5, " \n", 3), (6, "One Two", 4), (7, "one two", 5), (None, "x " * 90_000, 6)],
        "doc_id long, text string, fp int",
    )
    rows = {(r.doc_id, r.component_id) for r in simhash.simhash_classes(df).collect()}
    assert {(3, 3), (4, 3), (5, 3), (6, 6), (7, 6)} <= rows
    assert simhash.simhash_classes(df).count() == 7
    assert simhash.simhash_classes(df.limit(0)).count() == 0


def jaccard(a, b, n=5):
    x, y = (set(zip(*[t.lower().split()[i:] for i in range(n)])) for t in (a, b))
    return len(x & y) / max(1, len(x | y))


def test_near_duplicates(spark):
    """Edited copies go, one of each group stays, texts without a copy stay."""
    random.seed(5)
    words = [f"w{random.randrange(4000)}" for _ in range(4000)]
    docs, groups = [], {}
    for g in range(60):
        base = random.choices(words, k=random.randint(60, 400))
        docs.append((len(docs), " ".join(base)))
        groups[g] = [docs[-1][0]]
        for _ in range(g % 4):
            copy = list(base)
            for at in random.sample(range(len(copy)), max(1, len(copy) // 100)):
                copy[at] = "edited"
            docs.append((len(docs), " ".join(copy)))
            groups[g].append(docs[-1][0])
    docs += [(len(docs), docs[0][1]), docs[3], (900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit("kept"))
    left = [r.doc_id for r in simhash.drop_near_duplicates(df).collect()]
    assert len(left) == len(set(left)) == len(groups) + 1  # the two empty texts are one
    assert all(sum(d in left for d in ids) == 1 for ids in groups.values())
    assert simhash.drop_near_duplicates(df.limit(0)).columns == df.columns


def test_block_edits_against_brute_force(spark):
    """A passage appended, cut or replaced: the classes are those of all pairs at 0.8."""
    random.seed(8)
    texts = []
    for size in (40, 100, 300, 1000):
        for similarity in (0.79, 0.805, 0.82, 0.85, 0.9):
            base = [f"w{int(random.paretovariate(0.7)) % 5000}" for _ in range(size)]
            other = [f"x{random.randrange(5000)}" for _ in range(size)]
            more = round(size * (1 / similarity - 1))
            swap, at = max(1, round(size * (1 - similarity) / (1 + similarity)) - 4), size // 3
            texts += [base, base + other[:more], [*base[:at], *other[:swap], *base[at + swap :]]]
            cut = [f"y{w}" for w in base]
            texts += [cut, cut[: round(size * similarity)]]
    texts = [" ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(zip(*[t.split()[i:] for i in range(5)])) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root = [root[j] if r == root[i] else r for r in root]
    got = {}
    for row in simhash.near_duplicate_classes(df).collect():
        got.setdefault(row.root, set()).add(row.doc)
    want = {}
    for doc, r in enumerate(root):
        want.setdefault(r, set()).add(doc)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert len(want) < 0.7 * len(texts)


def test_near_copies_are_found_by_fingerprints(spark, monkeypatch):
    """Without a band in common, texts join exactly where the grid join links their fingerprints."""
    random.seed(9)
    base = [[f"w{random.randrange(9000)}" for _ in range(1500)] for _ in range(40)]
    texts = [" ".join(w) for words in base for w in (words, [*words[:700], "edited", *words[701:]])]
    sets = [simhash.shingle_set(t) for t in texts]
    prints = [simhash.fingerprint_of(s) % 2**64 for s in sets]
    near = [(prints[i] ^ prints[i + 1]).bit_count() <= 3 for i in range(0, len(texts), 2)]
    assert 10 < sum(near) < 40
    # bands made of the whole set: no two sets share one
    own = lambda parts: b"".join(xxhash.xxh64_digest(parts.tobytes(), seed) for seed in range(32))
    monkeypatch.setattr(simhash, "bands", own)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {}
    for row in simhash.near_duplicate_classes(df).collect():
        groups.setdefault(row.root, set()).add(row.doc)
    assert [any({2 * i, 2 * i + 1} <= g for g in groups.values()) for i in range(40)] == near
