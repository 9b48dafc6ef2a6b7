"""Spelling variants against plain loops."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vitrine.llm import spelling
from vitrine.llm.queries import op12_spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counts(docs, min_chars=6, min_count=5):
    found = Counter()
    for doc, text in docs:
        for run in re.findall(f"[A-Za-z{chr(0xC0)}-{chr(0xFF)}]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= min_chars and n >= min_count}


def plain(docs):
    words = counts(docs)
    # deleting one code point from both sides meets every near word
    by_part = {}
    for w in words:
        for key in {w, *[w[:i] + w[i + 1 :] for i in range(len(w))]}:
            by_part.setdefault(key, set()).add(w)
    others = {w: set() for w in words}
    for group in by_part.values():
        for a in group:
            others[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in words:
        if others[w]:
            best = min(others[w], key=lambda o: (-words[o], o))
            if words[best] >= 5 * words[w]:
                form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, n, len(others[w]), form.get(w), words.get(form.get(w)), root))
    return sorted(rows)


def got(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()))


def test_query_equals_plain(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    rows = got(op12_spelling(spark, data))
    assert rows == plain(docs) and any(r[3] for r in rows)


@pytest.mark.parametrize("letters, cells", [("ab", 40), ("abcdefghijkl", 300), ("xyz" + chr(0xE9) + chr(0xC9), 1 << 20)])
def test_random_words(spark, letters, cells):
    random.seed(7)
    words = ["".join(random.choices(letters, k=random.randint(5, 9))) for _ in range(1500)]
    words += ["prefixprefix" + w for w in words[:300]] + [w + "suffixsuffix" for w in words[:300]]
    docs = [(i, " ".join(random.choices(words, weights=[1 + 400 / (k + 1) for k in range(len(words))], k=900))) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(spelling.spelling_forms(df, cells=cells)) == plain(docs)


def test_scan_of_one_list():
    random.seed(2)
    for r in (1, 2, 5):
        mids = sorted({"".join(random.choices("abc", k=random.choice([r, r + 1]))) for _ in range(60)})
        a, b = spelling.scan_lists(mids, r, np.array([0]))
        want = {(i, j) for i, x in enumerate(mids) for j, y in enumerate(mids) if len(x) == r and near(x, y)}
        assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_chains_and_ties(spark):
    # marine (200) <- maine? counts grow fivefold along a chain; of equal counts the smaller word is the form
    text = {"abcdef": 1000, "abcdefg": 150, "abcdefgh": 20, "xbcdef": 30, "mnopqr": 40, "mnopqs": 40, "mnopqt": 8}
    docs = [(None, " ".join([w] * n)) for w, n in text.items()] + [(1, None), (2, ""), (2, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r[0]: r for r in got(spelling.spelling_forms(df))}
    assert sorted(rows.values()) == plain(docs)
    assert rows["abcdefgh"][3] == "abcdefg" and rows["abcdefgh"][5] == "abcdef" and rows["mnopqt"][3] == "mnopqr"


def test_edges(spark):
    schema = "doc_id long, text string, word string, n long"
    assert spelling.spelling_forms(spark.createDataFrame([], schema)).count() == 0
    long = "q" * 4000
    docs = [(i, f"{long} {long}r x{'a' * 2000}", "w", 1) for i in range(6)]
    rows = got(spelling.spelling_forms(spark.createDataFrame(docs, schema)))
    assert rows == plain([d[:2] for d in docs]) and len(rows) == 3
