"""Personal data and url filter."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from vitrine.llm import pii, urls
from vitrine.llm.queries import URL_RULES, op3_pii, op7_urls

RULES = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(x) <= 255 for x in text.split("."))
    if kind == 2:
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def base(text):
    text = text or ""
    # the plain rule for addresses is tried at every place, which long texts without one can't afford
    rules = [r for k, r in enumerate(RULES) if k or re.search(r"@[A-Za-z0-9-]+\.", text)]
    found = sorted((m.start(), RULES.index(r), m.end()) for r in rules for m in r.finditer(text) if valid(RULES.index(r), m[0]))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)


def plain(spans):
    return pii.spans_text(F.filter(spans, lambda s: s["kind"].isin(*pii.KINDS)))


def test_base_of_odd_texts(spark):
    random.seed(1)
    odd = ["a", "b.c", "@", "x@y", "x@y.z", ".", ". ", "1", "12", "255", "256", "0", "00", "-", " ", "+", "+1", "(",
           "1.2.3.4", "999.1.1.1", "4111111111111111", "4111 1111-1111 1111", "+1 (415) 555-0100", "_", "%", "é", "😀", "\n",
           "\x0b", "a@b.c@d.e", "a@b-.c_d@e.f", "5", "123456789012345"]
    docs = [(i, "".join(random.choices(odd, k=random.randint(0, 14)))) for i in range(1200)]
    docs += [(5000, None), (5001, ""), (5001, ""), (5002, "7" * 100_000), (5003, "a" * 100_000 + "@"), (5004, "1-" * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("kind", F.lit(1))
    found = pii.find_personal_data(df)
    assert sorted(map(tuple, found.select("doc_id", plain(F.col("spans"))).collect())) == sorted((d, base(t)) for d, t in docs)
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_contexts_are_learned(spark):
    random.seed(1)
    words = ["the", "of", "reed", "oner", "thand", "inra", "eren", "thre"]
    some = lambda n: " ".join(random.choices(words, k=n))
    docs, wanted = [], {}
    for i in range(300):
        if i % 3 == 1:
            docs.append((i, f"{some(5)} please contact mail user{i}@mail.example.com {some(4)}"))
        elif i % 3 == 2 and i < 40:
            text = f"{some(5)} please contact mail ID-{i}4444 {some(4)}"
            docs.append((i, text))
            wanted[i] = f"learned_email:{text.index('ID-')}:{text.index('ID-') + len(f'ID-{i}4444')}"
        else:
            docs.append((i, f"{some(6)} build 20230{i} {some(3)}"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = pii.find_personal_data(df).select("doc_id", pii.spans_text(F.col("spans")).alias("s"))
    assert {r.doc_id: r.s for r in found.filter("s LIKE '%learned%'").collect()} == wanted


def test_instance_in_many_contexts(spark):
    """Enough good patterns round a score to exactly 1; the instance stays a learned one."""
    docs = [(i, f"w{chr(97 + i % 60 // 26)}{chr(97 + i % 60 % 26)} mail user{i}@mail.example.com now") for i in range(300)]
    docs += [(1000 + i, f"w{chr(97 + i // 26)}{chr(97 + i % 26)} mail ID-77777 now") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = pii.find_personal_data(df).select("doc_id", pii.spans_text(F.col("spans")).alias("s"))
    got = {r.doc_id: r.s for r in found.filter("doc_id >= 1000").collect()}
    assert got == {1000 + i: "learned_email:9:17" for i in range(60)}


def test_pii_query(spark, data):
    texts = dict(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect())
    rows = op3_pii(spark, data).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = base(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(re.findall(rf"\b{k}:", want)) for k in pii.KINDS]


# -- urls --------------------------------------------------------------------------
def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


ODD = [None, "", "x", "http://", "http://NET/", "http://a.net", "http://a.net/", "http://xnet/", "ftp://B.Example.NET/en/x?y#z",
       "http://example.com/de", "http://example.com/de/1", "http://a.org/fr/?q", "://org/fr/#", "a://b://c.net/d", "http://É.net/x",
       "http://a.com\n/x", "http://" + "q" * 5000 + ".com/" + "z" * 5000, "http://www.cheapcasino.com/win", "http://blog.then.com/en"]


def test_url_query(spark, data):
    pages = dict(spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url").collect())
    rows = op7_urls(spark, data).collect()
    assert len(rows) == len(pages)
    for row in rows:
        host, path = parts_of(pages[row.page_id])
        rule = rule_of(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule and rule.name)
        assert row.verdict == rule.verdict if rule else row.verdict in ("allow", "block")
        if not rule and "casino" in host:
            assert row.verdict == "block"


def test_odd_urls(spark):
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(ODD * 2)], "page_id long, url string, word string")
    words = urls.word_table(spark.createDataFrame([("then the cheap news",)] * 3, "t string"), "t")
    rows = urls.judge(df, URL_RULES, words).collect()
    assert len(rows) == 2 * len(ODD)
    for row in rows:
        host, path = parts_of(row.url)
        rule = rule_of(host, path)
        assert (row.host, row.path, row.rule, row.word) == (host, path, rule and rule.name, "own")
        if not host:
            assert row.verdict == "allow"
    assert urls.judge(df.limit(0), URL_RULES, words).count() == 0


def test_segments(spark):
    words = spark.createDataFrame([("cheap", 50), ("pills", 40), ("the", 900), ("then", 90), ("news", 60)], "word string, n long")
    runs = spark.createDataFrame([("cheappills",), ("thenews",), ("zzqzz",), ("thencheap",), ("a" * 70,)], "run string")
    got = {r.run: r.parts for r in urls.segment(runs, words).collect()}
    assert got["cheappills"] == ["cheap", "pills"] and got["thenews"] == ["the", "news"]
    assert got["thencheap"] == ["then", "cheap"] and "".join(got["zzqzz"]) == "zzqzz" and got["a" * 70] == ["a" * 70]


def test_held_out_accuracy(spark):
    """Classes are learned from labelled urls and hold on hosts that were not seen."""
    random.seed(3)
    bad, good = ["casino", "pills", "bets", "cheap", "lottery"], ["garden", "school", "music", "river", "bread"]
    neutral = ["blog", "web", "my", "site"]

    def make(i):
        pool = bad if i % 2 else good
        return f"http://{random.choice(neutral)}{random.choice(pool)}{random.choice(pool)}{i}.example.com/{random.choice(pool)}/{i}", bool(i % 2)

    train, test = [make(i) for i in range(300)], [make(i) for i in range(300, 500)]
    words = spark.createDataFrame([(w, 20) for w in bad + good + neutral], "word string, n long")
    labels = spark.createDataFrame(train, "url string, bad boolean")
    rows = urls.judge(spark.createDataFrame(test, "url string, truth boolean"), [], words, labels).collect()
    assert sum((r.verdict == "block") == r.truth for r in rows) >= 0.95 * len(rows)
