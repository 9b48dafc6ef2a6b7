"""Host segmentation and naive Bayes against plain loops over whole tables."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrine.llm import urls
from vitrine.llm.queries import URL_RULES, op7_urls

from tests.llm.test_found import parts_of


def viterbi(run, counts, total):
    """Best score and split by plain recursion over prefixes; of equal scores the longer last piece at each place."""
    best = {len(run): (0.0, [])}
    for i in range(len(run) - 1, -1, -1):
        choices = []
        for size in range(1, min(urls.WORD, len(run) - i) + 1):
            piece, (rest, words) = run[i : i + size], best[i + size]
            choices.append((math.log(10 / total) - 2.3 * size + rest, size, False, words))
            if piece in counts:
                choices.append((math.log(counts[piece] / total) + rest, size, True, words))
        score, size, known, words = max(choices, key=lambda c: c[:3])
        best[i] = (score, [(run[i : i + size], known), *words])
    out, before = [], True
    for piece, known in best[0][1]:
        if before or known:
            out.append(piece)
        else:
            out[-1] += piece
        before = known
    return out


def verdicts(rows, counts, seeds=urls.SEED_WORDS):
    """``(host, path) -> score`` for rows of (host, path), one each."""
    counts = Counter(counts) + Counter(urls.HOST_WORDS)
    total = max(10, sum(counts.values()))
    cut = {}

    def words(text):
        return [w for r in re.findall("[a-z]+", text.lower()) for w in cut.setdefault(r, viterbi(r, counts, total))]

    bad = {host for host, _ in rows if set(words(host)) & set(seeds)}
    n_words = {True: Counter(), False: Counter()}
    n_rows = Counter(host in bad for host, _ in rows)
    for host, path in rows:
        n_words[host in bad].update(words(host) + words(path))
    size = len(n_words[True] | n_words[False])
    prior = math.log((n_rows[True] + 1) / (n_rows[False] + 1))
    logs = lambda w, kind: math.log((n_words[kind][w] + 1) / (sum(n_words[kind].values()) + size))
    return {(h, p): prior + sum(logs(w, True) - logs(w, False) for w in words(h) + words(p)) for h, p in rows}


def test_whole_pages(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()
    counts = Counter()
    for page in pages:
        text = re.sub(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ", page.html)
        counts.update(w for w in re.findall("[a-z]+", re.sub("<[^>]*>", " ", text).lower()) if len(w) <= urls.WORD)
    want = verdicts([parts_of(p.url) for p in pages], counts)
    for row in op7_urls(spark, data).collect():
        score = want[row.host, row.path]
        assert row.score == pytest.approx(score, abs=2e-6)
        if row.rule is None and (row.host or row.path):
            assert row.verdict == ("block" if score > 0 else "allow")


def test_repeated_rows_count(spark):
    random.seed(8)
    hosts = ["cheapnews.example", "newsgarden.example", "the-school.example", "betsbets.example", "downloads.school"]
    rows = [(random.choice(hosts), "/" + random.choice(["ads", "maths", "news/then", "", "x" * 100])) for _ in range(400)]
    rows += [("downloads.school", "/ads")] * 200
    counts = Counter({"news": 50, "garden": 20, "school": 30, "downloads": 9, "bets": 2, "then": 7, "ads": 4})
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    df = spark.createDataFrame([(f"http://{h}{p}",) for h, p in rows], "url string")
    want = verdicts(rows, counts)
    for row in urls.judge(df, [], words).collect():
        assert row.score == pytest.approx(want[row.host, row.path], abs=1e-9)


def test_seed_words_of_paths_say_nothing_of_a_host(spark):
    """``ads`` is a word of the path and stands inside ``downloads``: no reason to block the host."""
    words = spark.createDataFrame([("downloads", 500), ("school", 500), ("maths", 500)], "word string, n long")
    df = spark.createDataFrame([("http://downloads.school/ads",), ("http://downloads.school/maths",)] * 5, "url string")
    assert {r.verdict for r in urls.judge(df, URL_RULES, words).collect()} == {"allow"}


def test_long_runs_are_segmented(spark):
    words = spark.createDataFrame([("cheap", 50), ("pills", 40), ("the", 900)], "word string, n long")
    runs = spark.createDataFrame([("cheappills" * 50,), ("the" + "q" * 90 + "the",)], "run string")
    got = {r.run: r.parts for r in urls.segment(runs, words).collect()}
    assert got["cheappills" * 50] == ["cheap", "pills"] * 50
    assert got["the" + "q" * 90 + "the"] == ["the", "q" * 90, "the"]
    shown = spark.createDataFrame([("<p>a</p><script>var cheap = 1 < 2;</script >b<STYLE>x{}</style><i>c",)], "html string")
    assert shown.select(urls.page_text(F.col("html"))).first()[0].split() == ["a", "b", "c"]
