"""Quality rules, secrets, chat formatting and top-k against plain computations."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import chat, quality, secrets, topk
from vitrine.llm.queries import op4_secrets, op6_chat, op8_quality, op10_topk


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, data):
    return dict(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect())


# -- quality ----------------------------------------------------------------------
def slow_quality(text, ngrams=(5, 8, 13)):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    size = [len(w) for w in words]

    def covered(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        return {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}

    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count = Counter(lines)
    chars = lambda x: sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", x)))
    return [
        len(words), sum(size), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(count), len(covered(3)),
        sum(chars(x) * k for x, k in count.items() if k > 1), *[sum(size[j] for j in covered(n)) for n in ngrams],
    ]


def test_quality_measures():
    random.seed(2)
    texts = [None, "", " ", "a", "a b", "a b c", "é é é é é", "x\x85y x\x85y x\x85y"]
    for _ in range(300):
        size = random.randint(0, 60)
        texts.append("".join(random.choice(["a", "bé", "c#", "d"]) + random.choice(" \n\t") for _ in range(size)))
    texts.append(" ".join(f"w{i}" for i in range(3000)) + " w1 w2 w3")
    for text in texts:
        assert quality.measure(text, (5, 8, 13)) == slow_quality(text), text


def test_quality_wide_vocabulary(monkeypatch):
    """Pairs are renumbered where their product would not fit."""
    ids = np.array([0, 1, 2, 0, 1, 2, 5, 0, 1, 2])
    assert (quality._repeated(quality._triples(ids, 1 << 20)) == quality._repeated(quality._triples(ids, 6))).all()


def test_quality_query(spark, data):
    texts = documents(spark, data)
    for row in op8_quality(spark, data).collect():
        want = slow_quality(texts[row.doc_id])
        assert list(row)[1:10] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        kept = not failed and want[5] <= want[1] * 0.5 and want[2] <= want[0] * 0.25
        kept = kept and all(c <= want[1] * 0.5 for c in want[6:])
        assert (row.base_failed, row.kept) == (failed, kept)


def test_quality_keeps_columns(spark):
    good = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(1, good, 7, True), (2, None, 8, False), (2, good, 9, None)], "id long, text string, n_words long, kept boolean")
    assert sorted(map(tuple, quality.keep_good(df).select("id", "n_words").collect())) == [(1, 7), (2, 9)]
    assert quality.keep_good(df.limit(0)).columns == df.columns


# -- secrets ----------------------------------------------------------------------
def test_secrets_base(spark, data):
    texts = documents(spark, data)
    rules = [
        ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I),
         lambda m: len(m[2]) >= 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    ]
    for row in op4_secrets(spark, data).collect():
        text = texts[row.doc_id] or ""
        found = sorted((m.start(), i, k, m.end()) for i, (k, r, ok) in enumerate(rules) for m in r.finditer(text) if ok(m))
        assert row.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in found))
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(x[1] == i for x in found) for i in range(3))


@pytest.mark.parametrize("text, value", [
    ('db_password = "hunTer2-Swordfish!"', "hunTer2-Swordfish!"),
    ("x = 'Zq8#kLm2pQ9w'\nclient_secret = x\n", "Zq8#kLm2pQ9w"),
    ("a = 'Zq8#kLm2pQ9w'; b = a; c = b; authToken: c", "Zq8#kLm2pQ9w"),
    ('{"privateKey": "Zq8#kLm2pQ9w"}', "Zq8#kLm2pQ9w"),
    ("os.environ['DB_PASSWD'] = 'Zq8#kLm2pQ9w'", "Zq8#kLm2pQ9w"),
    ("passphrase: correct-Horse7battery", "correct-Horse7battery"),
    ("password = 'Zq8#kL' + 'm2pQ9w!!'", "Zq8#kL"),
])
def test_secrets_found(text, value):
    assert value in [text[a:b] for a, b in secrets.literals(text)]


@pytest.mark.parametrize("name", ["db_pass", "DB_PASS", "smtp.pass", "api.key", "access.key", "private.key", "secret.key"])
def test_secrets_gate_lets_every_scored_name_through(name):
    text = f"{name} = Zq8#kLm2pQ9w-Xy7\n"
    assert secrets.name_score(name) > 0 and [text[a:b] for a, b in secrets.literals(text)] == ["Zq8#kLm2pQ9w-Xy7"]
    assert all(secrets.literals(f"{n.replace(' ', '.')}: Zq8#kLm2pQ9w-Xy7") for n, w in secrets.NAMES.items() if w >= 0.5)


@pytest.mark.parametrize("text", [
    "password = 'changeme'", "token_count = 123456789", "secret = get_secret('Zq8#kLm2pQ9w')", "title = 'Zq8#kLm2pQ9w'",
    "a = b; b = a; password = a", "password: the word of the day is long", "password = ''", "password =", "= token",
])
def test_secrets_left_alone(text):
    assert not [text[a:b] for a, b in secrets.literals(text) if len(text[a:b]) > 8]


def test_secrets_edges(spark):
    long = "token " * 30_000 + '"' + "a" * 200_000
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (2, "", 3), (3, long, 4)], "doc_id long, text string, spans int")
    rows = secrets.find_secrets(df).collect()
    assert [r.doc_id for r in rows] == [1, 2, 2, 3] and rows[0].spans == []
    assert secrets.find_secrets(df.limit(0)).count() == 0


# -- chat --------------------------------------------------------------------------
def test_chat_query(spark, data):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{data}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    said = "</s>[INST] ok [/INST]"
    turns[-1] = [("user", said), ("assistant", said)]
    got = {r.conv_id: r for r in op6_chat(spark, data).collect()}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        loss = [t for r, t in rows if r == "assistant"]
        assert got[conv].n_turns == len(rows)
        assert got[conv].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in rows))
        assert got[conv].loss_chars == sum(map(len, loss)) and got[conv].loss_sha256 == sha("".join(loss))


def test_chat_examples(spark):
    odd = ["<|im_start|>", "<|im_end|>", "\\", "\\\\<s>", "<\\s>", "[INST", "]", "</s>", "<", "|im_end|>", "é\n", None, ""]
    random.seed(4)
    rows = [(c, t, random.choice(["user", "assistant", None, "<|message|>x"]), "".join(x or "" for x in random.choices(odd, k=4)), "z")
            for c in range(40) for t in range(random.randint(1, 6))]
    rows += [(None, 0, "user", None, "z"), (99, 1, "assistant", "same", "z"), (99, 1, "assistant", "same", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example string")
    examples = chat.prefix_examples(df)
    back = examples.select("*", chat.read_turns(F.col("text")).alias("turns"), chat.masked_text().alias("loss")).collect()
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0] or -5, r[1], r[2] or "", r[3] or "")):
        by[r[0]].append((r[2] or "", r[3] or ""))
    for row in back:
        turns = by[row.conv_id]
        read = [tuple(t) for t in row.turns]
        assert read == turns[: len(read)]
        if row.mask_start is not None:
            assert read[-1][0] == "assistant" and row.loss == read[-1][1]
        for mark in chat.Template().others:
            assert mark not in row.text
    for conv, turns in by.items():
        mine = [r for r in back if r.conv_id == conv]
        assert sum(r.mask_start is not None for r in mine) == sum(r == "assistant" for r, _ in turns)
        assert max(len(r.turns) for r in mine) == len(turns)
    assert chat.prefix_examples(df.limit(0)).count() == 0


def test_chat_long_texts_and_long_conversations(spark):
    long = "</s>[INST] é\\ " * 40_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long)]
    rows += [(2, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.conversation_digest(chat.prefix_examples(df)).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (2, len(long), sha(long))
    said = [f"turn {t}" for t in range(1, 600, 2)]
    assert (got[2].n_turns, got[2].loss_chars, got[2].loss_sha256) == (600, sum(map(len, said)), sha("".join(said)))


# -- top-k -------------------------------------------------------------------------
def slow_topk(rows, k):
    out = []
    for q, x in rows:
        if q % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_topk_query(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(i, np.floor(64 * np.array(v, np.float64)).astype(int).tolist()) for i, v in rows]
    assert sorted(tuple(r) for r in op10_topk(spark, data).collect()) == slow_topk(rows, 20)


@pytest.mark.parametrize("block", [8192, 16])
def test_topk_ties_and_edges(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_BYTES", block * 6 * 8)
    monkeypatch.setattr(topk, "QUERIES", max(2, block // 8))
    random.seed(block)
    rows = [(i, [random.choice([0.0, 0.1, -0.5, 1.0, 3.0]) for _ in range(6)]) for i in range(150)]
    bad = [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")] * 6)]
    df = spark.createDataFrame(rows + bad + [(420, []), (421, [1e4])], "vec_id long, embedding array<float>")
    v = topk.quantised(df)
    got = sorted(tuple(r) for r in topk.top_k(v, v.filter("id % 20 = 0"), 7).collect())
    ints = [(r.id, r.v + [0] * (6 - len(r.v))) for r in v.collect()]
    assert len(ints) == 152 and got == slow_topk(ints, 7)
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0
    assert topk.top_k(v.filter("id < 3"), v.filter("id = 0"), 20).count() == 2


def test_topk_repeated_ids_and_other_columns(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 200)
    random.seed(4)
    rows = [(i % 30, [float(random.randint(-3, 3)) for _ in range(4)]) for i in range(90)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, block int, kind string")
    v = topk.quantised(df, 1.0)
    want = []
    for q, x in sorted({(i, tuple(v)) for i, v in rows if i % 20 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)[:9]
        want += [(q, rank, i, -int(s)) for rank, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in topk.top_k(v, v.filter("id % 20 = 0"), 9).collect()) == sorted(want)


def test_topk_beyond_64_bits(spark):
    """Ranks stay exact where scores do not fit; shown are the ends of the range."""
    big = 2.0**61
    rows = [(0, [big, 1.0]), (1, [big, 0.0]), (2, [big * 2, 0.0]), (3, [-big, 5.0]), (4, [big * 2, 7.0]), (5, [-big, 6.0]), (6, [1.0, 1.0])]
    v = spark.createDataFrame(rows, "id long, v array<double>").selectExpr("id", "transform(v, x -> CAST(x AS BIGINT)) AS v")
    got = sorted(tuple(r)[1:] for r in topk.top_k(v, v.filter("id = 0"), 10).collect())
    assert [i for _, i, _ in got] == [4, 2, 1, 6, 5, 3]
    assert [s for _, _, s in got] == [2**63 - 1] * 3 + [2**61 + 1] + [1 - 2**63] * 2


def test_topk_index_makes_fewer_products():
    """Whole index of wide rows: exact, with fewer products than all pairs, in bounded memory."""
    import tracemalloc

    rng = np.random.default_rng(5)
    width = 768
    n = topk.BLOCK_BYTES // (8 * width)
    values = np.floor(64 * rng.standard_normal((n, width)) * rng.exponential(1, (1, width)) ** 2).astype(np.int64)
    ids, asked = np.arange(n), values[:64]
    tracemalloc.start()
    index = topk.ImpactIndex(values, ids)
    best = index.best(asked, ids[:64], 20)
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert index.products < 0.8 * n * width * 64
    for at, (where, score, _) in enumerate(best):
        full = values @ asked[at]
        full[at] = -(2**62)  # its own row
        order = np.lexsort((ids, -full))[:20]
        assert (order == where).all() and (full[order] == score).all()


def test_quality_of_single_words_and_pairs():
    from vitrine.llm.quality import measure

    def plain(text, n):
        words = text.split()
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(n)}
        return sum(len(words[i]) for i in inside)

    for text in ("a b x y a b z w", "a a", "a", "", "a b c", "one two one", "x y z x y z", "p q r s p t"):
        assert measure(text, (1, 2, 3))[6:] == [plain(text, n) for n in (1, 2, 3)]
    assert measure("a b x y a b z w", (2,))[6] == 4
