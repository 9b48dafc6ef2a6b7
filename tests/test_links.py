import random

import pytest

from vitrine.operators.counting import category_counts
from vitrine.operators.follow import follow_links, follow_links_salted
from vitrine.operators.limits import first_per_group
from vitrine.operators.links import category_links, distinct_links, page_links
from vitrine.plans.catalogue import extract_category, union_runs
from vitrine.plans.rules import default_rules

BASE = "https://shop.example"
RULES = default_rules(BASE, "https://cdn.shop.example", "store.shop.example")
GRID = '<div class="x grid grid-cols-2 md:grid-cols-4">{}</div>'


def anchor(href):
    return f'<a href="{href}">t</a>'


def found(spark, html, category="thuoc/ho"):
    pages = spark.createDataFrame([(1, f"{BASE}/{category}", html)], "page_id long, url string, html string")
    seeds = spark.createDataFrame([(0, category)], "ord int, category string")
    rows = category_links(pages, seeds, RULES).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(len(rows)))
    return [r["url"] for r in rows]


@pytest.mark.parametrize(
    "html,expected",
    [
        (GRID.format("") + anchor("/thuoc/a.html"), []),
        (GRID.format(anchor("/thuoc/a.html")) + anchor("/thuoc/b.html"), ["/thuoc/a.html"]),
        (GRID.format(anchor("/thuoc/a.html")) + GRID.format(anchor("/thuoc/b.html")), ["/thuoc/a.html"]),
        ('<div class="grid grid-cols-2">' + anchor("/thuoc/a.html") + "</div>", ["/thuoc/a.html"]),
        (anchor("/thuoc/a.html") + anchor(f"{BASE}/thuoc/a.html") + anchor("/thuoc/b.html"),
         ["/thuoc/a.html", "/thuoc/b.html"]),
        (anchor("//h/thuoc/x.html"), ["//h/thuoc/x.html"]),
        (anchor("/thuoc/a.html?x=1") + anchor("/thuoc/a.html#t") + anchor("/other/a.html") + anchor("/thuoc/a"), []),
        (anchor("/my/thuoc/sort=a/b.html") + anchor("/my/thuoc/b.html"), ["/my/thuoc/b.html"]),
        ("<a>no href</a><b href='/thuoc/a.html'>b</b>", []),
    ],
)
def test_category_links(spark, html, expected):
    assert found(spark, html) == [BASE + path for path in expected]


def test_page_links_keep_order_and_repeats(page):
    rows = page_links(page(anchor("/b") + anchor("a") + anchor("/b") + '<a href="">e</a>'), BASE, True)
    assert [(r["pos"], r["href"], r["url"]) for r in rows.orderBy("pos").collect()] == [
        (0, "/b", BASE + "/b"), (1, "a", "a"), (2, "/b", BASE + "/b"), (3, "", "")
    ]


def test_distinct_links_first_occurrence(page):
    links = page_links(page(anchor("/x") + anchor("/y"), anchor("/y") + anchor("/z")), BASE)
    rows = {r["url"]: (r["page_id"], r["pos"]) for r in distinct_links(links).collect()}
    assert rows == {BASE + "/x": (0, 0), BASE + "/y": (0, 1), BASE + "/z": (1, 1)}


@pytest.mark.parametrize("n", [0, None, 3, 200, 1001, 1500, 10**7])
@pytest.mark.parametrize("spread_ids", [False, True])
def test_first_per_group_equals_brute_force(spark, n, spread_ids):
    random.seed(5)
    ids = random.sample(range(4000), 1500)
    if spread_ids:  # hash-like ids over the whole 64-bit range, negative ones too
        ids = [random.randrange(-(2**63), 2**63) for _ in ids]
    rows = [("hot" if random.random() < 0.7 else f"g{random.randrange(5)}", i, p) for i in ids for p in range(3)]
    df = spark.createDataFrame(rows, "grp string, page_id long, pos int")
    expected = []
    for group in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == group)
        expected += mine[:n] if n else mine
    got = [tuple(r) for r in first_per_group(df, n, "grp").collect()]
    assert sorted(got) == sorted(expected)


def test_block_levels_follow_the_id_range():
    from vitrine.operators.limits import _levels

    assert _levels(0, 1023) == 1 and _levels(0, 1024) == 2 and _levels(-1, 1023) == 2
    assert _levels(-(2**53), 2**53 - 1) == 6


def test_category_counts_equal_brute_force(spark):
    random.seed(7)
    words = ["ab/cd", "ab/ce", "b/c", "zzz", "ab", "abab"]
    urls = ["".join(random.choice("ab/cde") for _ in range(random.randrange(0, 25))) for _ in range(300)]
    urls += ["ab/cd/ab/cd"] * 100  # a hot value, with the word twice
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    cats = spark.createDataFrame([(w,) for w in words + ["ab"]], "category string")
    got = {r["category"]: r["items"] for r in category_counts(df, cats).collect()}
    assert got == {w: sum(w in u for u in urls) for w in words}


def test_follow_links_with_a_hot_target(spark):
    links = spark.createDataFrame(
        [("hub" if i % 3 else f"u{i}", i, 0) for i in range(600)] + [("gone", 999, 0)],
        "url string, page_id long, pos int",
    )
    records = spark.createDataFrame([("hub", "H")] + [(f"u{i}", f"R{i}") for i in range(600)], "url string, name string")
    plain = sorted(map(tuple, follow_links(links, records).collect()))
    assert len(plain) == 600
    assert sorted(map(tuple, follow_links_salted(links, records).collect())) == plain


def test_extract_category_is_a_bag_with_limit(spark):
    pages = spark.createDataFrame(
        [
            (1, f"{BASE}/thuoc/ho", "".join(anchor(f"/thuoc/{c}.html") for c in "abc")),
            (2, f"{BASE}/thuoc/sot", anchor("/thuoc/a.html") + anchor("/thuoc/missing.html")),
            (3, f"{BASE}/thuoc/a.html", "<h1>A</h1>"),
            (4, f"{BASE}/thuoc/b.html", "<h1>B</h1>"),
            (5, f"{BASE}/thuoc/c.html", "<h1>C</h1>"),
            (6, f"{BASE}/thuoc/d.html", "<h1>not linked</h1>"),
        ],
        "page_id long, url string, html string",
    )
    seeds = spark.createDataFrame([(0, "thuoc/ho"), (1, "thuoc/sot")], "ord int, category string")

    def names(limit):
        rows = extract_category(pages, seeds, RULES, limit, as_of="2025-01-01").collect()
        return sorted((r["listed_in"], r["listed_pos"], r["name"]) for r in rows)

    every = [("thuoc/ho", 0, "A"), ("thuoc/ho", 1, "B"), ("thuoc/ho", 2, "C"), ("thuoc/sot", 0, "A")]
    assert names(0) == every and names(None) == every
    assert names(2) == [r for r in every if r[1] < 2]


def test_extract_category_with_a_long_link_list(spark, monkeypatch):
    from vitrine import session

    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    test_extract_category_is_a_bag_with_limit(spark)


def test_union_runs_keeps_repeats(spark):
    df = spark.range(3)
    assert union_runs(df, df).count() == 6


def test_words_with_a_shared_head_meet_few_texts(spark):
    """Candidates are told apart by their rarest piece, not by the head they share."""
    from vitrine.operators import counting

    words = spark.range(200).selectExpr("concat('thuc-pham-chuc-nang/leaf-', lpad(id * 7919 % 100000, 5, '0')) AS category")
    urls = words.selectExpr(f"concat('{BASE}/', category, '/x.html') AS url").union(
        spark.range(800).selectExpr(f"concat('{BASE}/thuc-pham-chuc-nang/', id, '.html') AS url")
    )
    counts = counting.category_counts(urls, words).collect()
    assert len(counts) == 200 and all(r["items"] == 1 for r in counts)
    pairs = counting.contains_join(urls, words, "url", "category", 8, verify=False).count()
    assert pairs <= 2000
