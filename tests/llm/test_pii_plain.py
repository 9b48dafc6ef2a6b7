"""Contextual extraction held against the same rounds in plain Python, and its odd cases."""

import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from vitrine.llm import pii

LOCAL, LETTERS, BLANKS = "A-Za-z0-9._%+-", "A-Za-z0-9_\x80-\U0010ffff", " \t-\r"
EMAIL, PHONE, IP, CARD = (
    rf"(?<![{LOCAL}])[{LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"\+[0-9][ ().0-9-]+[0-9]",
    r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}", r"[0-9](?:[ -]?[0-9])+",
)
TOKEN = re.compile("|".join((
    EMAIL.replace("+@", "++@").replace("-]+)+", "-]++)++"), PHONE, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"(?<![0-9A-Za-z_-])[0-9](?:[ -]?[0-9])++(?![0-9A-Za-z_/-])",
    rf"(?<![{LETTERS}])[{LETTERS}]++(?:[^{LETTERS}{BLANKS}]++[{LETTERS}]++)++",
    r"(?<![0-9A-Za-z_-])[A-Za-z_-]*+[0-9][A-Za-z0-9_/-]*+",
)))


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(x) <= 255 for x in text.split("."))
    if kind == 2:
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def shape(word):
    return re.sub("[0-9]", "0", word.lower())


def seed_kind(text):
    for kind, rule in ((0, EMAIL), (3, PHONE), (1, IP), (2, CARD)):
        if re.fullmatch(rule, text) and valid(kind, text):
            return kind
    return None


def places(text):
    """(start, stop, instance, seed kind, patterns) of every token with a word before it."""
    words, at, tokens = [], 0, []
    for m in TOKEN.finditer(text):
        words += [shape(w) for w in re.split(rf"[{BLANKS}]+", text[at:m.start()]) if w]
        tokens.append((m, len(words)))
        words.append(shape(m[0]))
        at = m.end()
    words += [shape(w) for w in re.split(rf"[{BLANKS}]+", text[at:]) if w]
    for m, i in tokens:
        if i:
            patterns = [("left", words[i - 1])]
            patterns += [("two", words[i - 2], words[i - 1])] if i > 1 else []
            patterns += [("around", words[i - 1], words[i + 1])] if i + 1 < len(words) else []
            yield m.start(), m.end(), m[0].lower(), seed_kind(m[0]), patterns


def rounds(texts, limits=pii.Bootstrap()):
    found = {d: list(places(t or "")) for d, t in texts}
    edges = defaultdict(dict)
    for tokens in found.values():
        for _, _, instance, kind, patterns in tokens:
            for p in patterns:
                edges[p][instance] = kind
    seeds = {(i, k): 1.0 for members in edges.values() for i, k in members.items() if k is not None}
    new = {}
    for _ in range(limits.rounds):
        known = defaultdict(list)
        for (i, k), score in [*seeds.items(), *new.items()]:
            known[i].append((k, score))
        said = defaultdict(float)
        for members in edges.values():
            hit = defaultdict(float)
            for i in members:
                for k, score in known[i] if i in known else ():
                    hit[k] += score
            for k, total in hit.items():
                worth = total / (len(members) + limits.smoothing)
                if total >= limits.support and worth >= limits.pattern_limit:
                    for i, own in members.items():
                        if own is None:
                            said[i, k] += math.log(1 - min(worth, 0.999))
        best = {}
        for (i, k), total in said.items():
            score = 1 - math.exp(total)
            if score >= limits.instance_limit and (i not in best or (score, -k) > (best[i][1], -best[i][0])):
                best[i] = (k, score)
        new = {(i, k): score for i, (k, score) in best.items()}
    kinds = {i: k for i, k in new}
    return {
        d: sorted((a, f"learned_{pii.KINDS[kinds[i]]}", b) for a, b, i, own, _ in tokens if own is None and i in kinds)
        for d, tokens in found.items()
    }


def learned(df):
    rows = pii.find_personal_data(df).collect()
    return {r.doc_id: sorted((s.start, s.kind, s.stop) for s in r.spans if s.kind.startswith("learned")) for r in rows}


def test_rounds_of_the_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = rounds(texts)
    assert learned(docs) == want


def test_short_and_digitless_identifiers(spark):
    far = " " * 200
    texts = [f"please contact mail user{i}@mail.example.com today" for i in range(60)]
    texts += [f"write to {'x' * 300} account{far}acct{i}@mail.example.com today" for i in range(60)]
    texts += ["contact mail user3", "contact mail jane(at)corp", "contact mail jane.doe@intranet", "contact mail 7",
              "contact mail AB-12345 then", f"write to {'x' * 300} account{far}bob(at)corp", "see well-known user3 of x/y",
              "user7 mail mail user8", None, "", "mail", "mail ü.ñ, " * 3, "contact mail user3"]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("x")).withColumn("row", F.lit(1))
    got = learned(df)
    assert got == rounds(rows)
    at = {t: got[i] for i, t in enumerate(texts) if t}
    assert at["contact mail user3"] == [(13, "learned_email", 18)]
    assert at["contact mail jane(at)corp"] == [(13, "learned_email", 25)]
    assert at["contact mail jane.doe@intranet"] == [(13, "learned_email", 30)]
    assert at["contact mail 7"] == [(13, "learned_email", 14)]
    assert at[texts[125]] == [(len(texts[125]) - 11, "learned_email", len(texts[125]))]
    assert learned(df.limit(0)) == {}
