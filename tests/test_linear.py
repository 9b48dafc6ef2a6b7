"""Pages with thousands of containers, ratings, slides and divs: time grows with the page."""

import time

import pytest

from vitrine.functions.sql import between, lower_bound
from vitrine.operators.products import extract_fields
from vitrine.plans.rendered import CDN, HOST, RULES

MARK = "Thương hiệu:"


def containers(n):
    parts = [f'<div class="inner"><p>é{i} 🎉</p><i class="cursor-pointer">no<b class="lc-wrap-link">x</b></i> t{i}</div>' for i in range(n)]
    return "<body>" + "".join(parts) + "</body>"


def cuts(n):
    return '<div class="inner">' + '<p class="cursor-pointer">no</p><i>k</i>' * n + "</div>"


def reviews(n):
    return "<body>" + "".join(f"<div><b>{9 + i % 3} (x) đánh giá</b></div>" for i in range(n)) + '<i class="stars">4</i></body>'


def slides(n):
    one = f'<div class="swiper-slide"><img src="https://{HOST}/a.png"><img class="gallery-img" src="{CDN}/https://{HOST}/dsc_{{}}.jpg"></div>'
    return '<div class="swiper-wrapper">' + "".join(one.format(i) for i in range(n)) + "</div>"


def divs(n):
    return "<body>" + f"<p>{MARK} x</p><div>plain</div>" * n + f"<div>{MARK} Acme</div></body>"


PAGES = {
    "content": (containers, "content", lambda n: "".join(f'<div class="inner"><p>é{i} 🎉</p> t{i}</div>' for i in range(n))),
    "cuts": (cuts, "content", lambda n: '<div class="inner">' + "<i>k</i>" * n + "</div>"),
    "rating": (reviews, "rating", lambda n: 4.0),
    "images": (slides, "images", lambda n: [f"{CDN}/https://{HOST}/dsc_{i}.jpg" for i in range(n)]),
    "brand": (divs, "brand", lambda n: "Acme"),
}


@pytest.mark.parametrize("name", PAGES)
def test_doubling_a_page_about_doubles_the_time(page, name):
    make, field, want = PAGES[name]
    seconds = {}
    for n in (2000, 4000, 8000, 2000, 4000, 8000):
        df = extract_fields(page(make(n)), RULES, [field])
        start = time.perf_counter()
        got = df.first()[field]
        seconds[n] = time.perf_counter() - start
        assert got == want(n)
    print(name, seconds)
    # fixed costs taken off: the second doubling may cost three times what the first one did
    first, second = seconds[4000] - seconds[2000], seconds[8000] - seconds[4000]
    assert second < 3 * max(first, 0.15), seconds


def test_nested_containers_and_cuts(page):
    """A container inside an unwanted part is still a container; cuts count within each container."""
    html = (
        '<div class="inner">a<p class="cursor-pointer">cut<span class="lc-wrap-link">deep</span>'
        '<div class="inner">b<i class="lc-wrap-link">c</i>d</div></p>e</div>'
        '<div class="inner cursor-pointer">gone</div><div class="inner">&#xFEFF;f</div>'
    )
    got = extract_fields(page(html), RULES, ["content"]).first()["content"]
    assert got == '<div class="inner">ae</div><div class="inner">bd</div><div class="inner">' + chr(0xFEFF) + "f</div>"


@pytest.mark.parametrize("values", [[], [5], [1, 3, 3, 7], list(range(0, 300, 3))])
def test_bounds(spark, values):
    import bisect

    array = f"CAST(array({', '.join(map(str, values))}) AS ARRAY<INT>)"
    df = spark.range(-2, 12).selectExpr("CAST(id AS INT) AS x", f"{array} AS a")
    for row in df.selectExpr("x", "a", f"{lower_bound('a', 'x')} AS at", f"{between('a', 'x', 'x + 4')} AS some").collect():
        assert row.at == bisect.bisect_left(values, row.x)
        assert row.some == [v for v in values if row.x <= v < row.x + 4]
