"""URL filter: host words by unigram Viterbi, judged by multinomial naive Bayes.

Explicit rules (host suffix and path prefix) come first, the longest one wins.  Urls
without a rule are judged by the words of host and path.  Runs of letters in a host are
segmented into words by the most probable split under a unigram table counted over the
corpus; the same splits path segments that are words run together.  Naive Bayes then sums
the log ratios of the words; its counts come from labelled urls, every row of them counted.

Counting, joins and sums are Spark jobs over distinct runs and words.  The splits of a run, of
any length, are looked up by an equi-join of its substrings with the word table, so no table is held
in a task or broadcast unless the planner measures it as small; a task sees one run with
the words found in it.  Letters that no known word covers are one word.

Defined cases: a NULL url or one without ``://`` has an empty host and path and gets the
verdict of no words, allow; a tie of the classes is allow; repeated urls are judged alike;
hosts are lower-cased in A-Z only; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import sized, stored

WORD = 24  # longest word looked up; longer words of a text are no pieces of a run


@dataclass(frozen=True)
class Rule:
    """Block or allow a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rule(verdict: str, text: str) -> Rule:
    """``example.com/de/`` as a rule."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", ""))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest fitting rule, or NULL; rules are a short list held in the plan."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(rule.name)).otherwise(out)
    return out


def runs(text: Column) -> Column:
    """Lower-case letter runs of a host or path."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0)), lambda r: r != "")


def page_text(html: Column) -> Column:
    """Page source without tags; what scripts and styles hold goes with them."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*+>.*?</\1\s*+>", " ")
    return F.regexp_replace(bare, "<[^>]*+>", " ")


def word_table(texts: DataFrame, column: str) -> DataFrame:
    """Stored table ``word, n``: lower-case words of a text column with their counts."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return stored(words.filter(F.length("word").between(1, WORD)).groupBy("word").agg(F.count("*").alias("n")), "words")


def _viterbi(run: str, found: list[tuple[int, int, int]], total: int) -> list[str]:
    """Most probable split; ``found`` has (start, size, count).  Ties go to the longer first word."""
    n = len(run)
    at: dict[int, list[tuple[int, float]]] = {}
    for start, size, count in found:
        at.setdefault(start, []).append((size, math.log(count / total)))
    best = [0.0] * (n + 1)
    step = [0] * (n + 1)
    known = [False] * (n + 1)
    for i in range(n - 1, -1, -1):
        # an unknown stretch costs more the longer it is
        best[i], step[i], known[i] = max(
            [(math.log(10 / total) - 2.3 * size + best[i + size], size, False) for size in range(1, min(WORD, n - i) + 1)]
            + [(score + best[i + size], size, True) for size, score in at.get(i, ())]
        )
    out, i, before = [], 0, True
    while i < n:
        piece = run[i : i + step[i]]
        if before or known[i]:
            out.append(piece)
        else:  # unknown letters side by side are one word
            out[-1] += piece
        before, i = known[i], i + step[i]
    return out


def segment(distinct_runs: DataFrame, words: DataFrame) -> DataFrame:
    """Stored table ``run, parts`` for distinct ``run`` values."""
    total = max(10, words.agg(F.sum("n")).first()[0] or 0)
    starts = distinct_runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("start"))
    pieces = starts.select(
        "run", "start",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(WORD), F.length("run") - F.col("start") + 1))).alias("size"),
    ).select("run", "start", "size", F.substring("run", F.col("start"), F.col("size")).alias("word"))
    found = pieces.join(words, "word").groupBy("run").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("start"), "size", "n")).alias("found")
    )
    known = distinct_runs.join(found, "run", "left").select("run", F.coalesce("found", F.array()).alias("found"))

    def split(batches):
        for batch in batches:
            made = []
            for run, found_in in zip(batch.column("run").to_pylist(), batch.column("found").to_pylist()):
                made.append(_viterbi(run, [(x["start"], x["size"], x["n"]) for x in found_in], total))
            parts = pa.array(made, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("run"), parts], names=["run", "parts"])

    return stored(known.mapInArrow(split, "run string, parts array<string>"), "segments")


def bayes_table(labelled: DataFrame, smoothing: float = 1.0) -> tuple[DataFrame, float]:
    """Stored table ``word, ratio`` of ``labelled(words, bad, n)``, and the log ratio of the classes.

    ``n`` is the number of rows that a line stands for.  ``ratio`` is log P(word | bad) -
    log P(word | good), with additive smoothing.
    """
    bad_rows, good_rows = F.when(F.col("bad"), F.col("n")).otherwise(0), F.when(F.col("bad"), 0).otherwise(F.col("n"))
    count = labelled.agg(F.sum(bad_rows), F.sum("n")).first()
    bad, every = count[0] or 0, count[1] or 0
    words = labelled.select("bad", "n", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum(bad_rows).alias("b"), F.sum(good_rows).alias("g")
    )
    words = stored(words, "bayes-counts")
    sums = words.agg(F.sum("b"), F.sum("g"), F.count("*")).first()
    size = (sums[2] or 0) * smoothing
    ratio = F.ln((F.col("b") + smoothing) / F.lit((sums[0] or 0) + size or 1.0)) - F.ln(
        (F.col("g") + smoothing) / F.lit((sums[1] or 0) + size or 1.0)
    )
    prior = math.log((bad + 1) / (every - bad + 1))
    return stored(words.select("word", ratio.alias("ratio")), "bayes"), prior


# Words that make a host bad by themselves: labels for training where no others exist.
SEED_WORDS = (
    "casino", "pills", "cheap", "bets", "poker", "spam", "porn", "xxx", "viagra", "loan", "lottery", "ads", "track",
    "malware", "phishing", "warez",
)
# Common words of host names, counted once each beside the words of the corpus.
HOST_WORDS = (
    *SEED_WORDS, "free", "win", "farm", "blog", "news", "shop", "store", "online", "mail", "web", "site", "world",
    "best", "buy", "example", "com", "net", "org", "www", "my", "the", "top", "pharmacy", "money", "game", "games",
)


def judge(
    urls: DataFrame, rules: list[Rule], words: DataFrame, labels: DataFrame | None = None,
    url_col: str = "url", seeds: tuple[str, ...] = SEED_WORDS,
) -> DataFrame:
    """``urls`` with ``host, path, rule, verdict, score``; columns of these names are replaced.

    ``words(word, n)`` is the unigram table.  ``labels(url, bad boolean)`` trains the
    classes; without it the urls themselves do, labelled bad if a seed word is among the words of the host.
    """
    own = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "score")]
    kept = urls.select(F.struct(*[urls[c] for c in own]).alias("row"), urls[url_col].alias("url"))
    kept = kept.select("row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    def places(df: DataFrame) -> DataFrame:
        return df.groupBy("host", "path").agg(F.count("*").alias("n"))

    every = stored(places(kept), "places")
    train = every if labels is None else stored(
        labels.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "bad")
        .groupBy("host", "path", "bad").agg(F.count("*").alias("n")), "labelled",
    )
    found = every.select("host", "path") if labels is None else every.select("host", "path").union(train.select("host", "path"))
    both = F.concat(runs(F.col("host")), runs(F.col("path")))
    distinct = found.select(F.explode(both).alias("run")).distinct()
    extra = urls.sparkSession.createDataFrame([(w, 1) for w in HOST_WORDS], "word string, n long")
    table = words.select("word", "n").union(extra).groupBy("word").agg(F.sum("n").alias("n"))
    parts = segment(distinct, stored(table, "unigrams"))

    def worded(df: DataFrame) -> DataFrame:
        """One row per word, of the host or not."""
        named = lambda part, of_host: F.transform(
            runs(F.col(part)), lambda r: F.struct(r.alias("run"), F.lit(of_host).alias("of_host"))
        )
        lists = df.withColumn("x", F.explode_outer(F.concat(named("host", True), named("path", False))))
        lists = lists.select(*df.columns, "x.run", "x.of_host")
        return lists.join(sized(parts), "run", "left").withColumn("word", F.explode_outer("parts")).drop("run", "parts")

    split = stored(worded(every), "split")
    learn = split if labels is None else stored(worded(train), "split-labelled")
    by = ["host", "path", "n"] if labels is None else ["host", "path", "bad", "n"]
    bags = learn.groupBy(*by).agg(F.collect_list("word").alias("words"))
    if labels is None:
        # the words of a host alone decide its label
        hosts = split.filter(F.col("word").isin(*seeds) & F.col("of_host")).select("host").distinct()
        bags = bags.join(hosts.withColumn("bad", F.lit(True)), "host", "left").withColumn("bad", F.coalesce("bad", F.lit(False)))
    ratios, prior = bayes_table(bags)
    score = split.join(sized(ratios), "word", "left").groupBy("host", "path").agg(
        (F.sum(F.coalesce("ratio", F.lit(0.0))) + F.lit(prior)).alias("score")
    )
    score = stored(score, "scores")
    judged = kept.join(sized(score), ["host", "path"], "left")
    empty = (F.col("host") == "") & (F.col("path") == "")
    rule = rule_for(F.col("host"), F.col("path"), rules)
    verdicts = {r.name: r.verdict for r in rules}
    by_rule = F.lit(None).cast("string")
    for name, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(by_rule)
    method = F.when(~empty & (F.col("score") > 0), F.lit("block")).otherwise(F.lit("allow"))
    return (
        judged.withColumn("rule", rule).withColumn("verdict", F.coalesce(by_rule, method))
        .select("row.*", "host", "path", "rule", "verdict", "score")
    )
