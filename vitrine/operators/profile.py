"""Corpus profiling: which links, containers, images and selectors a corpus has."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window, functions as F

from vitrine.functions import nodes as nd
from vitrine.functions import text as tx
from vitrine.functions import urls
from vitrine.functions.sql import coalesce, first_of, let, lit
from vitrine.operators.counting import contains_join, shortest
from vitrine.operators.links import ANCHORS, LINK_KEEP, page_links
from vitrine.operators.lookup import pages_of
from vitrine.operators.products import RECORD, first_with_digit
from vitrine.plans.rules import Rules
from vitrine.session import stored
from vitrine.sources.pages import parse_usable, usable_pages

# Default words and selectors of the reports.
LINK_KEYWORDS = ("san-pham", "product", "thuoc", "item")
IMAGE_KEYWORDS = ("product", "thuoc", "item")
CONTAINERS = (
    nd.cls_part("product"), nd.cls_part("item"), nd.cls_part("card"), nd.cls_part("box"),
    nd.tag("div").child(nd.cls("row")), nd.tag("div").child(nd.cls("grid")),
)
# Selector lists of the two page probes.
PROBE_A: dict[str, tuple[nd.Sel, ...]] = {
    "title": (nd.tag("h1"), nd.cls("title"), nd.cls("product-title"), nd.cls("name")),
    "price": (nd.cls("price"), nd.cls("cost"), nd.cls("gia"), nd.cls_part("price")),
    "description": (nd.cls("description"), nd.cls("desc"), nd.cls("mo-ta"), nd.cls("content")),
    "image": (
        nd.attr_part("img", "src", "product"),
        nd.tag("img").under(nd.cls("product-image")), nd.tag("img").under(nd.cls("main-image")),
    ),
}
PROBE_B: dict[str, tuple[nd.Sel, ...]] = {
    "title": (
        nd.tag("h1"), nd.cls("product-title"), nd.cls("title"), nd.cls_part("title"),
        nd.cls("name"), nd.cls("product-name"),
    ),
    "price": (
        nd.cls("price"), nd.cls_part("price"), nd.cls("cost"), nd.cls("gia"), nd.cls_part("gia"),
        nd.cls_part("price", of="span"), nd.cls_part("price", of="div"),
    ),
    "image": (
        nd.tag("img").under(nd.cls("product-image")), nd.tag("img").under(nd.cls("main-image")),
        nd.attr_part("img", "alt", "product"), nd.attr_part("img", "src", "product"),
        nd.tag("img").under(nd.cls("image")), nd.tag("img"),
    ),
}
# What marks a candidate item link, and a search hit.
CANDIDATE_PARTS = ("/san-pham/", "/product/", "/thuoc/")
CANDIDATE_SKIPS = ("/thuoc?", "/thuoc/tra-cuu", "/thuoc/thuoc-")
SEARCH_PART = "san-pham"


def page_titles(pages: DataFrame) -> DataFrame:
    """``page_id, title``: the string of the first title element, or 'No title'."""
    title = f"if(e.sole IS NULL, '', {nd.text_of('e')})"
    found = first_of(nd.find_all(nd.tag("title")), "e", title)
    return parse_usable(pages, nd.keep_for(nd.tag("title")), carry=("page_id",)).selectExpr(
        "page_id", f"coalesce({found}, 'No title') AS title"
    )


def first_headings(pages: DataFrame, rules: Rules) -> DataFrame:
    """``page_id, url, name`` by the name rules."""
    from vitrine.operators.products import extract_fields

    found = extract_fields(pages, rules, ("name",))
    return found.filter(F.col("parse_error").isNull()).select("page_id", "url", "name")


# -- links ---------------------------------------------------------------------
def _cut(text: str, chars: int | None) -> str:
    """First characters of a text; None = whole."""
    return text if chars is None else f"substring({text}, 1, {chars})"


def _first(items: str, n: int | None) -> str:
    """First items of an array; None = all."""
    return items if n is None else f"slice({items}, 1, {n})"


def _keyword_reports(
    pages: DataFrame, base_url: str, keywords: Sequence[str], samples: int | None, text_chars: int | None
) -> DataFrame:
    """One row per page with an array of per-keyword reports; no shuffle."""
    href = nd.attr("n", "href")
    shown = (
        f"named_struct('text', {_cut(tx.strip(nd.text_of('n')), text_chars)},"
        f" 'url', {urls.absolutise(href, base_url)})"
    )
    reports = []
    for order, word in enumerate(keywords):
        hits = f"filter({ANCHORS}, n -> contains(lower({href}), {lit(word)}))"
        reports.append(
            f"named_struct('keyword_ord', {order}, 'keyword', {lit(word)}, 'links', size({hits}),"
            f" 'samples', transform({_first(hits, samples)}, n -> {shown}))"
        )
    return parse_usable(pages, LINK_KEEP).selectExpr(
        "page_id", "url", f"filter(array({', '.join(reports)}), r -> r.links > 0) AS reports"
    )


def keyword_links(
    pages: DataFrame, base_url: str, keywords: Sequence[str] = LINK_KEYWORDS, samples: int | None = None,
    text_chars: int | None = None,
) -> DataFrame:
    """Per page and keyword: number of links, and ``samples`` of them with ``text_chars`` of text.

    Rows: ``page_id, url, keyword_ord, keyword, links, samples
    array<struct<text,url>>``; keywords without a link give no row.  None = all, whole.
    """
    return _keyword_reports(pages, base_url, keywords, samples, text_chars).selectExpr(
        "page_id", "url", "inline(reports)"
    )


def keyword_links_by_table(
    pages: DataFrame, words: DataFrame, base_url: str, samples: int | None = None, text_chars: int | None = None,
) -> DataFrame:
    """As :func:`keyword_links`, for the words of a table ``words(keyword_ord, keyword)`` of any length.

    Links meet words by an equi-join on the rarest short piece of each word, so neither the plan nor the
    work grows with words times links; a word is matched in lower-cased links as it is written.
    """
    links = page_links(usable_pages(pages), base_url, with_text=True).select(
        "page_id", "page_url", "pos", "url", F.lower("href").alias("_low"), F.expr(_cut("link_text", text_chars)).alias("text")
    )
    words = words.select("keyword_ord", "keyword").filter(F.length("keyword") > 0).distinct()
    gram = 1 if words.isEmpty() else shortest(words, "keyword", 6)
    hits = contains_join(links, words, "_low", "keyword", gram).drop("_low")
    # ranking and counting use the same keys, so hits are dealt once
    keys = ["page_id", "keyword_ord", "keyword"]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    shown = F.struct("pos", "text", "url")
    some = shown if samples is None else F.when(nth <= samples, shown)
    report = hits.select(*keys, "page_url", some.alias("shown")).groupBy(*keys).agg(
        F.first("page_url").alias("page_url"), F.count(F.lit(1)).cast("int").alias("links"),
        F.array_sort(F.collect_list("shown")).alias("samples"),
    )
    return report.select(
        "page_id", F.col("page_url").alias("url"), "keyword_ord", "keyword", "links",
        F.transform("samples", lambda s: F.struct(s["text"].alias("text"), s["url"].alias("url"))).alias("samples"),
    )


def first_item_links(
    pages: DataFrame, base_url: str, keywords: Sequence[str] = LINK_KEYWORDS, n: int | None = None,
    samples: int | None = None, text_chars: int | None = None,
) -> DataFrame:
    """First ``n`` of a page's keyword samples, keyword by keyword, repeats kept; None = all, whole."""
    found = _first("flatten(transform(reports, r -> r.samples))", n)
    return (
        _keyword_reports(pages, base_url, keywords, samples, text_chars)
        .selectExpr("page_id", f"posexplode({found}) AS (pos, link)")
        .select("page_id", "pos", "link.url", "link.text")
    )


def candidate_links(
    pages: DataFrame, base_url: str,
    parts: Sequence[str] = CANDIDATE_PARTS, skips: Sequence[str] = CANDIDATE_SKIPS,
    min_text: int | None = 5, max_text: int | None = 100, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Links that look like items: a wanted part, no skipped part, a plausible text.

    The text is longer than ``min_text`` and shorter than ``max_text`` (None = any length).
    """
    links = page_links(pages, base_url, with_text=True, carry=carry)
    return links.filter(
        F.expr(urls.contains_any("href", parts)) & ~F.expr(urls.contains_any("url", skips)) & _text_size(min_text, max_text)
    )


def _text_size(above: int | None, below: int | None = None) -> "F.Column":
    size = F.length("link_text")
    test = F.lit(True) if above is None else size > above
    return test if below is None else test & (size < below)


def search_hits(
    pages: DataFrame, base_url: str, part: str = SEARCH_PART, min_text: int | None = 10, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Links of search-result pages that lead to an item, with a text longer than ``min_text`` (None = any)."""
    links = page_links(pages, base_url, with_text=True, carry=carry)
    return links.filter(F.contains("href", F.lit(part)) & _text_size(min_text))


def seed_pages(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """The pages of ``seeds(ord, url)``, picked before any of them is parsed."""
    return pages_of(pages, seeds.select("url", "ord"))


def first_link(links: DataFrame) -> DataFrame:
    """First link on the first seed page that has any: at most one row.

    ``links`` carries the seed's ``ord``.  The winner is a minimum, so nothing is
    sorted globally and one row per task is shuffled.
    """
    best = F.min(F.struct("ord", "page_id", "pos", "url", "link_text")).alias("best")
    return links.agg(best).filter(F.col("best").isNotNull()).select("best.*")


FIRST_BLOCK, GROWTH = 16, 8  # seeds in the first block of a walk, and how fast blocks grow


def seed_bounds(seeds: DataFrame, first: int = FIRST_BLOCK) -> list[int]:
    """Last ``ord`` of every block of a walk: about ``first`` seeds, then 8 times as many, and so on.

    One aggregate; the bounds are approximate, which moves seeds between blocks and never changes a result.
    """
    total = seeds.agg(F.count("ord").alias("n")).first()["n"]
    shares, size = [], first
    while size < total:
        shares.append(size / total)
        size *= GROWTH
    bounds = seeds.agg(F.percentile_approx("ord", [*shares, 1.0], 100_000).alias("at")).first()["at"] or []
    return sorted(set(bounds))


def walk_seeds(
    pages: DataFrame, seeds: DataFrame, find: Callable[[DataFrame], DataFrame], first: int = FIRST_BLOCK
) -> tuple[DataFrame, int]:
    """First link over the seed pages in their order, and the number of pages parsed for it.

    ``find`` takes seed pages (with ``ord``) to links.  Seeds are taken in blocks of growing size;
    the walk stops at the first block that has a link, so pages behind it are never parsed.  A
    walk without a hit parses every seed page once, in a handful of jobs.  Seeds without an ``ord`` come first.
    """
    seeds, _ = stored(seeds.select("url", F.col("ord").cast("long").alias("ord")), "seeds")
    parsed, low = 0, None
    for high in seed_bounds(seeds, first) or [None]:
        block = F.lit(True) if high is None else F.coalesce(F.col("ord") <= high, F.lit(low is None))
        if low is not None:
            block &= F.col("ord") > low
        seen = Observation()
        asked = seed_pages(pages, seeds.filter(block)).observe(seen, F.count(F.lit(1)).alias("pages"))
        hit, size = stored(first_link(find(asked)), "first-link")
        parsed += seen.get["pages"]
        if size["rows"]:
            break
        low = high
    return hit, parsed


def first_candidate(pages: DataFrame, seeds: DataFrame, base_url: str, **marks) -> DataFrame:
    """First item-like link over the seed pages in their order; pages behind its block are not parsed."""
    return walk_seeds(pages, seeds, lambda some: candidate_links(some, base_url, carry=("ord",), **marks))[0]


def first_search_hit(pages: DataFrame, seeds: DataFrame, base_url: str, **marks) -> DataFrame:
    """First item link over the stored result pages of the search terms, in their order; stops as above."""
    return walk_seeds(pages, seeds, lambda some: search_hits(some, base_url, carry=("ord",), **marks))[0]


# -- elements -----------------------------------------------------------------
def selector_profile(pages: DataFrame, sels: Sequence[nd.Sel] = CONTAINERS) -> DataFrame:
    """Per selector over the corpus: elements, pages with any, first class list.

    Rows: ``selector, elements, pages_hit, example``.  Each page adds one small
    struct per selector; partial aggregation keeps the shuffle at one row per
    selector and task.
    """
    per_sel = []
    for sel in sels:
        hits = nd.find_all(sel)
        example = first_of("hs", "e", "named_struct('page_id', page_id, 'pre', e.pre, 'cls', trim(e.cls))")
        row = f"named_struct('selector', {lit(sel.label)}, 'n', size(hs), 'example', {example})"
        per_sel.append(let("hs", hits, row))
    rows = parse_usable(pages, nd.keep_for(*sels), carry=("page_id",)).selectExpr(
        f"inline(array({', '.join(per_sel)}))"
    )
    return rows.groupBy("selector").agg(
        F.sum("n").alias("elements"),
        F.count_if(F.col("n") > 0).alias("pages_hit"),
        F.min("example").alias("first"),
    ).select("selector", "elements", "pages_hit", F.col("first.cls").alias("example"))


def image_report(
    pages: DataFrame, keywords: Sequence[str] = IMAGE_KEYWORDS, samples: int | None = None,
    alt_chars: int | None = None,
) -> DataFrame:
    """Per page: images whose source holds a keyword, ``samples`` of them with ``alt_chars`` of alt text.

    None = all, whole.
    """
    src = nd.attr("n", "src")
    hits = f"filter({nd.find_all(nd.tag('img'))}, n -> {urls.contains_any(f'lower({src})', keywords)})"
    shown = (
        f"named_struct('alt', {_cut(f"coalesce({nd.attr('n', 'alt')}, 'No alt')", alt_chars)}, 'src', {src})"
    )
    keep = nd.keep_for(nd.tag("img"), attr_names=("src", "alt"))
    return parse_usable(pages, keep, with_text=False).selectExpr(
        "page_id", "url", f"size({hits}) AS images",
        f"transform({_first(hits, samples)}, n -> {shown}) AS samples",
    )


def selector_first_hit(
    pages: DataFrame, probe: Mapping[str, Sequence[nd.Sel]], non_empty: bool, text_chars: int | None = None
) -> DataFrame:
    """Per page and field, the first selector that matches and what it holds.

    ``non_empty=False``: an element without text still wins.  ``non_empty=True``:
    it does not, and images fall back to ``data-src``.  Rows: ``page_id, url,
    field, selector_ord, selector, content``; fields without a hit give no row.
    Texts of the first kind are cut to ``text_chars`` (None = whole), the others are whole.
    """
    fields = []
    for field, sels in probe.items():
        tries = []
        for order, sel in enumerate(sels):
            if field == "image":
                src = nd.attr("e", "src")
                other = f"coalesce({nd.attr('e', 'data-src')}, 'No src')" if non_empty else "'No src'"
                content = f"coalesce({src}, {other})"
            else:
                content = tx.strip(nd.text_of("e"))
                if not non_empty:
                    content = _cut(content, text_chars)
            value = first_of(nd.find_all(sel), "e", content)
            if non_empty:
                value = tx.non_empty(value)
            hit = (
                f"named_struct('field', {lit(field)}, 'selector_ord', {order},"
                f" 'selector', {lit(sel.label)}, 'content', v)"
            )
            tries.append(let("v", value, f"if(v IS NULL, NULL, {hit})"))
        fields.append(coalesce(tries))
    keep = nd.keep_for(*[s for sels in probe.values() for s in sels], attr_names=("src", "data-src"))
    return parse_usable(pages, keep).selectExpr(
        "page_id", "url", f"inline(filter(array({', '.join(fields)}), h -> h IS NOT NULL))"
    )


def selector_coverage(hits: DataFrame) -> DataFrame:
    """Number of pages each selector wins: ``field, selector_ord, selector, pages``."""
    return hits.groupBy("field", "selector_ord", "selector").agg(F.count(F.lit(1)).alias("pages"))


# -- records ------------------------------------------------------------------
def fill_rate(products: DataFrame) -> DataFrame:
    """Per record column: rows, and rows with more than the "missing" value."""
    present = []
    for name, kind, missing in RECORD:
        if name not in products.columns or missing is None:
            continue
        if kind.startswith("array"):
            filled = F.size(name) > 0
        else:
            filled = F.col(name) != F.lit(missing)
        present.append((name, F.count_if(F.coalesce(filled, F.lit(False))).alias(name)))
    totals = products.agg(F.count(F.lit(1)).alias("_rows"), *[c for _, c in present])
    pairs = ", ".join(f"'{name}', {name}" for name, _ in present)
    return totals.selectExpr("_rows AS records", f"stack({len(present)}, {pairs}) AS (field, filled)").select(
        "field", "records", "filled"
    )


# Chains whose winner is the first existing element.
SIMPLE_CHAINS = ("name", "original_price", "unit", "sku", "discount", "description", "usage", "availability")


def rule_wins(pages: DataFrame, rules: Rules) -> DataFrame:
    """Which rule of each chain won how often: ``field, rule_idx, selector, pages``.

    The price chain wins by digit, the other chains by existing element.
    """
    wins = []
    for field in (*SIMPLE_CHAINS, "price"):
        tries = []
        for order, sel in enumerate(getattr(rules, field)):
            value = first_with_digit([sel]) if field == "price" else nd.first_text(sel)
            tries.append(
                f"if({value} IS NULL, NULL, named_struct('field', {lit(field)},"
                f" 'rule_idx', {order}, 'selector', {lit(sel.label)}))"
            )
        wins.append(coalesce(tries))
    sels = [s for field in (*SIMPLE_CHAINS, "price") for s in getattr(rules, field)]
    rows = parse_usable(pages, nd.keep_for(*sels), carry=("page_id",)).selectExpr(
        f"inline(filter(array({', '.join(wins)}), w -> w IS NOT NULL))"
    )
    return rows.groupBy("field", "rule_idx", "selector").agg(F.count(F.lit(1)).alias("pages"))
