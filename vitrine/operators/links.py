"""Link extraction: page -> ordered, filtered, distinct links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.functions import nodes as nd
from vitrine.functions import urls
from vitrine.functions.sql import Sql, lit
from vitrine.functions.text import strip
from vitrine.operators.lookup import pages_of
from vitrine.plans.rules import Rules
from vitrine.sources.htmltree import Keep
from vitrine.sources.parse import parse_pages

# what link extraction needs from the parse step
LINK_KEEP = Keep(attrs=frozenset((("a", "href"),)), attr_names=frozenset(("href",)))
_HREF = nd.attr("n", "href")
ANCHORS = f"filter(nodes, n -> n.tag = 'a' AND {_HREF} IS NOT NULL)"


def page_links(
    pages: DataFrame, base_url: str, with_text: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Every link of every page, in document order.

    One row per ``a[href]``: ``page_id, page_url``, more page columns on request
    (``carry``), ``pos`` (0-based order on the page), ``href`` as written, ``url``
    made absolute and, on request, the stripped ``link_text``.  No shuffle: links
    leave their page by explode.
    """
    parts = f"'href', {_HREF}, 'url', {urls.absolutise(_HREF, base_url)}"
    if with_text:
        parts += f", 'link_text', {strip(nd.text_of('n'))}"
    links = f"transform({ANCHORS}, n -> named_struct({parts}))"
    return (
        parse_pages(pages, LINK_KEEP, carry=("page_id", "url", *carry), with_text=with_text)
        .selectExpr("page_id", "url AS page_url", *carry, f"posexplode({links}) AS (pos, link)")
        .select("page_id", "page_url", *carry, "pos", "link.*")
    )


def distinct_links(links: DataFrame) -> DataFrame:
    """First occurrence of every URL over all pages, by ``(page_id, pos)``.

    A partial aggregate runs before the shuffle, so one URL linked from every
    page costs each map task a single row.
    """
    return (
        links.groupBy("url")
        .agg(F.min(F.struct("page_id", "pos")).alias("at"))
        .select("url", "at.page_id", "at.pos")
    )


def item_links(category: Sql, rules: Rules) -> Sql:
    """Ordered distinct item URLs of one parsed category page (over ``_grid``).

    With a product grid only links inside the first grid count, even if it has
    none; without a grid every link of the page does.
    """
    anchors = (
        f"filter(nodes, n -> n.tag = 'a' AND contains({_HREF}, {lit(rules.item_suffix)})"
        f" AND contains({_HREF}, {urls.category_head(category)})"
        f" AND {urls.count_slashes(_HREF)} >= 2"
        f" AND (_grid IS NULL OR {nd.within('n', '_grid')}))"
    )
    found = f"array_distinct(transform({anchors}, n -> {urls.absolutise(_HREF, rules.base_url)}))"
    return f"filter({found}, u -> {urls.is_item_url('u', rules.base_url)})"


def category_pages(pages: DataFrame, categories: DataFrame, rules: Rules) -> DataFrame:
    """The pages of the listed categories: ``categories(ord, category)`` joined on URL."""
    wanted = categories.select(
        "ord", "category", F.concat(F.lit(rules.base_url + "/"), F.col("category")).alias("url")
    )
    return pages_of(pages, wanted)


def category_links(pages: DataFrame, categories: DataFrame, rules: Rules) -> DataFrame:
    """Item links of the category pages: ``ord, category, page_id, pos, url``.

    The join comes before the parse, so only category pages are parsed.
    """
    parsed = parse_pages(
        category_pages(pages, categories, rules),
        LINK_KEEP | rules.grid.keep(),
        carry=("ord", "category", "page_id"),
        with_text=False,
    )
    return parsed.selectExpr("*", f"{nd.first_node(rules.grid)} AS _grid").selectExpr(
        "ord", "category", "page_id", f"posexplode({item_links('category', rules)}) AS (pos, url)"
    )
