"""Line dedup against a quadratic search for repeated runs."""

import hashlib
import random

import pytest

from vitrine.llm import linededup
from vitrine.llm.queries import op9_lines


def brute(docs, least):
    """Texts without the lines of repeated runs of ``least`` words that have an earlier copy."""
    rows = [
        (d, t, [(p, line, len(line.encode().split())) for p, line in enumerate((t or "").split("\n")) if line.encode().split()])
        for d, t in sorted(docs, key=lambda x: x[0])
    ]
    where = {}
    for i, (_, _, lines) in enumerate(rows):
        for j, line in enumerate(lines):
            where.setdefault(line[1], []).append((i, j))
    out = {}
    for i, (doc, text, lines) in enumerate(rows):
        cut = set()
        for j in range(len(lines)):
            best = 0
            for a, b in where[lines[j][1]]:
                if (a, b) >= (i, j):
                    break
                n = 0
                while j + n < len(lines) and b + n < len(rows[a][2]) and lines[j + n][1] == rows[a][2][b + n][1]:
                    n += 1
                best = max(best, n)
            if best and sum(x[2] for x in lines[j : j + best]) >= least:
                cut.update(range(lines[j][0], lines[j + best - 1][0] + 1))
        out[doc] = text if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if p not in cut)
    return out


@pytest.mark.parametrize("least", [1, 6, 10, 17])
def test_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(linededup, "AHEAD", 50)
    random.seed(least)
    pool = [" ".join(random.choices("abcdefg", k=random.randint(1, 6))) for _ in range(9)]
    docs = []
    for doc in range(60):
        lines = [random.choice(pool) if random.random() < 0.93 else f"u{random.random()}" for _ in range(random.randint(0, 14))]
        if random.random() < 0.3:
            lines.insert(0, "")
        if docs and random.random() < 0.4:
            lines += random.choice(docs)[1].split("\n")[2:9]
        docs.append((doc, "\n".join(lines)))
    docs += [(100, None), (101, ""), (102, "\n\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.drop_repeated_lines(df, least).collect()}
    assert got == brute(docs, least)


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    want = brute([tuple(d) for d in docs], 50)
    assert any(want[d.doc_id] != d.text for d in docs)
    for row in op9_lines(spark, data).collect():
        assert row.text_sha256 == hashlib.sha256(want[row.doc_id].encode()).hexdigest()


def test_edges(spark):
    line = "word " * 60
    df = spark.createDataFrame(
        [(None, line, 1), (1, line + "\nown", 2), (1, line + "\nown", 2), (2, "x " * 100_000, 3)],
        "doc_id long, text string, doc int",
    )
    out = linededup.drop_repeated_lines(df, mark="cut").collect()
    assert sorted((r.doc_id or 0, r.text[:5], r.doc, r.cut) for r in out) == [
        (0, "word ", 1, 0), (1, "own", 2, 1), (1, "own", 2, 1), (2, "x x x", 3, 0)
    ]
    assert linededup.drop_repeated_lines(df.limit(0)).count() == 0
