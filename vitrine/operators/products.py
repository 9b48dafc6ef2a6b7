"""The 26-column product record as Spark expressions over parsed pages.

Missing and empty are kept apart until the last projection: a rule yields NULL
only when its *element* is missing (then the next rule is tried), an element
without text yields ``''`` and stops the chain.  Sentinels replace NULL at the
very end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from vitrine.functions import nodes as nd
from vitrine.functions import text as tx
from vitrine.functions.sql import (
    Sql, any_of, coalesce, first_non_empty, first_of, first_value, let, lit, lower_bound,
)
from vitrine.operators import content, images
from vitrine.plans.rules import Rules
from vitrine.sources.htmltree import Keep
from vitrine.sources.pages import page_fault
from vitrine.sources.parse import JSON_TYPE, LINKED_JSON_TYPE, parse_pages

# The record: column order, type and the value that stands for "missing".
RECORD: tuple[tuple[str, str, object], ...] = (
    ("url", "string", ""),
    ("name", "string", ""),
    ("price", "double", 0.0),
    ("unit", "string", ""),
    ("sku", "string", ""),
    ("rating", "double", 0.0),
    ("reviews_count", "bigint", 0),
    ("comments_count", "bigint", 0),
    ("brand", "string", ""),
    ("official_name", "string", ""),
    ("category", "string", ""),
    ("registration_number", "string", ""),
    ("form", "string", ""),
    ("package_size", "string", ""),
    ("origin_brand", "string", ""),
    ("manufacturer", "string", ""),
    ("country_of_manufacture", "string", ""),
    ("ingredients", "string", ""),
    ("images", "array<string>", []),
    ("content", "string", ""),
    ("original_price", "double", 0.0),
    ("discount", "string", ""),
    ("description", "string", ""),
    ("usage", "string", ""),
    ("availability", "string", ""),
    ("crawled_at", "timestamp", None),
)
COLUMNS = tuple(name for name, _, _ in RECORD)
EXTRACTED = tuple(name for name in COLUMNS if name not in ("url", "crawled_at"))


# -- chains ------------------------------------------------------------------
def first_existing(sels: Iterable[nd.Sel]) -> Sql:
    """Cleaned text of the first selector that has an element."""
    return tx.clean_text(coalesce(nd.first_text(sel) for sel in sels))


def first_with_digit(sels: Iterable[nd.Sel]) -> Sql:
    """Text of the first selector whose first element holds a digit."""
    body = let("t", nd.text_of("e"), f"if({tx.has_digit('t')}, t, NULL)")
    return coalesce(first_of(nd.find_all(sel), "e", body) for sel in sels)


def link_trail(sels: Iterable[nd.Sel]) -> Sql:
    """``A > B > C``: texts of all links below the first selector that has any."""
    anchors = [nd.find_all(nd.tag("a").under(sel), "n", "_anchors") for sel in sels]
    texts = f"transform({first_non_empty(anchors)}, e -> {tx.clean_text(nd.text_of('e'))})"
    # a NULL stands for "no link at all": joining an empty list would give ''
    return f"array_join({let('ts', texts, 'if(size(ts) = 0, NULL, ts)')}, ' > ')"


# -- attribute table ---------------------------------------------------------
NEARBY = 64  # nodes looked at for the cells of a row before searching all of them


def info_rows(rules: Rules) -> Sql:
    """``array<array<string>>``: label and value of each row of the first table.

    The cells of a row nearly always follow it closely, so a long table costs
    rows times ``NEARBY``, not rows times cells; only a row whose second cell is
    farther off looks at all cells.
    """
    row = f"{rules.info_row.on('n')} AND {nd.within('n', '_table')}"
    rows = f"filter(transform(nodes, (n, i) -> if({row}, named_struct('r', n, 'at', i), NULL)), x -> x IS NOT NULL)"
    near = f"filter(w, c -> {rules.info_cell.on('c')} AND {nd.within('c', 'x.r')})"
    enough = f"size(cs) >= 2 OR size(w) < {NEARBY} OR try_element_at(w, -1).pre > x.r.last"
    every = f"filter(_cells, c -> {nd.within('c', 'x.r')})"
    cells = let("w", f"slice(nodes, x.at + 2, {NEARBY})", let("cs", near, f"if({enough}, cs, {every})"))
    pairs = f"transform({rows}, x -> transform(slice({cells}, 1, 2), c -> {nd.text_of('c')}))"
    return f"filter({pairs}, p -> size(p) = 2)"


def info_value(label: str) -> Sql:
    """Value of the first row whose label contains ``label``; may be ``''``."""
    return first_of(f"filter(_info, p -> contains(p[0], {lit(label)}))", "p", tx.clean_text("p[1]"))


# -- brand -------------------------------------------------------------------
def json_brands(rules: Rules) -> tuple[Sql, Sql]:
    """Brands in embedded JSON: ``array<struct<value, failed>>`` of the plain scripts, and that of linked data.

    A plain script that could not be used falls back to a text match; a
    linked-data script that could not be used is passed over.
    """
    body = first_of("filter(nodes, n -> n.pre = h.pre)", "n", "n.text")
    matches = coalesce(
        tx.non_empty(f"regexp_extract({body}, {lit(f'(?iu)"{key}[^"]*":{tx.WS}*"([^"]+)"')}, 1)")
        for key in rules.brand_keys
    )
    value = f"named_struct('value', if(h.failed, {matches}, h.value), 'failed', h.failed)"
    plain = f"transform(filter(json_hits, h -> NOT h.linked), h -> {value})"
    linked = "transform(filter(json_hits, h -> h.linked AND NOT h.failed), h -> h.value)"
    return plain, first_value(linked)


def json_brand(rules: Rules) -> Sql:
    """Brand from embedded JSON: plain scripts first, then linked-data scripts."""
    plain, linked = json_brands(rules)
    return tx.clean_text(f"coalesce({first_value(f'transform({plain}, h -> h.value)')}, {linked})")


def inline_brand(rules: Rules) -> Sql:
    """Text behind the inline label in the first ``div`` made of that one string."""
    label = lit(rules.brand_inline)
    marked = f"filter(nodes, n -> n.tag IS NULL AND contains({nd.text_of('n')}, {label}))"
    spot = f"get(spots, {lower_bound('spots', 'n.sole')}) = n.sole"
    alone = f"filter(nodes, n -> n.tag = 'div' AND n.sole IS NOT NULL AND {spot})"
    divs = let("spots", f"transform({marked}, n -> n.pre)", alone)
    behind = f"get(split({nd.text_of('e')}, {label}), 1)"
    return first_of(divs, "e", tx.clean_text(behind))


def brand(rules: Rules) -> Sql:
    return coalesce([
        json_brand(rules),
        tx.non_empty(info_value(rules.brand_label)),
        inline_brand(rules),
        first_existing(rules.brand),
    ])


# -- ratings and counts ------------------------------------------------------
def in_range(value: Sql) -> Sql:
    return let("x", value, "if(x BETWEEN 0 AND 5, x, NULL)")


def rating_marks(rules: Rules) -> list[tuple[str, str]]:
    """What follows a rating near the review word: the mark and its regular expression."""
    return [("(", "\\("), (rules.star_word, rules.star_word), ("/", "/")]


def class_rating(sel: nd.Sel, fixed_decimals: bool = False) -> Sql:
    """Number before a slash in the first match."""
    head = f"substring_index({nd.text_of('e')}, '/', 1)"
    if fixed_decimals:
        number = tx.non_empty(f"regexp_extract({head}, {lit('[0-9]+(?:[.][0-9]+)?')}, 0)")
    else:
        number = tx.digits(head)
    return first_of(nd.find_all(sel), "e", f"try_cast({number} AS DOUBLE)")


def rating(rules: Rules, fixed_decimals: bool = False) -> Sql:
    """Rating near the review word, else in a summary box, else from a class.

    The class rule drops the decimal point (``4.5/5`` gives 45.0), which is the
    recorded behaviour; ``fixed_decimals`` reads the number instead.
    """
    # bodies: text of the parent of every string with the review word
    near = coalesce(in_range(tx.number_before("t", mark)) for _, mark in rating_marks(rules))
    worded = any_of(f"contains(t, {lit(w)})" for w in (rules.review_word, rules.star_word))
    boxes = f"filter(transform(_boxes, e -> {nd.text_of('e')}), t -> {worded})"
    boxed = in_range(tx.number_before("t", "\\("))
    return coalesce([
        first_value(f"transform(_review_texts, t -> {near})"),
        first_value(f"transform({boxes}, t -> {boxed})"),
        *[class_rating(sel, fixed_decimals) for sel in rules.rating],
    ])


def review_texts(rules: Rules) -> Sql:
    """Texts around the review word: the parent's text of each string with it.

    Equal parents count once; a string outside any element stands in the page.
    """
    strings = f"filter(nodes, n -> n.tag IS NULL AND contains({nd.text_of('n')}, {lit(rules.review_word)}))"
    parents = f"array_distinct(transform({strings}, n -> n.parent))"
    # a parent is looked up by its number among the kept nodes
    holder = let("e", f"get(nodes, {lower_bound('nodes', 'up', '.pre')})", f"if(e.pre = up, {nd.text_of('e')}, NULL)")
    return f"transform({parents}, up -> if(up < 0, text, {holder}))"


def box_count(word: str) -> Sql:
    """Whole number before ``word`` in the first summary box only."""
    return first_of("_boxes", "e", tx.count_before(nd.text_of("e"), word))


def reviews_count(rules: Rules) -> Sql:
    classed = [first_of(nd.find_all(s), "e", tx.parse_count(nd.text_of("e"))) for s in rules.reviews_count]
    return coalesce([box_count(rules.review_word), *classed])


# -- registry ----------------------------------------------------------------
@dataclass(frozen=True)
class FieldPlan:
    """How one column is computed and what it needs from the parse step."""

    value: Callable[[Rules], Sql]
    keep: Callable[[Rules], Keep]


def _chain(field: str, value=None) -> FieldPlan:
    return FieldPlan(
        value or (lambda rules: first_existing(getattr(rules, field))),
        lambda rules: nd.keep_for(*getattr(rules, field)),
    )


def _table_keep(rules: Rules) -> Keep:
    table = rules.info_table
    return nd.keep_for(rules.info_row.under(table), rules.info_cell.under(table))


def _label(field: str) -> FieldPlan:
    return FieldPlan(lambda rules: info_value(dict(rules.table_labels)[field]), _table_keep)


def _script_keep(*types: str) -> Keep:
    return Keep(attr_values=frozenset(("type", t) for t in types), attr_names=frozenset(("type",)))


FIELDS: dict[str, FieldPlan] = {
    "name": _chain("name"),
    "price": _chain("price", lambda r: tx.parse_price(first_with_digit(r.price))),
    "unit": _chain("unit"),
    "sku": _chain("sku"),
    "rating": FieldPlan(
        rating,
        lambda r: nd.keep_for(r.summary_box, *r.rating, strings=(r.review_word,)),
    ),
    "reviews_count": FieldPlan(reviews_count, lambda r: nd.keep_for(r.summary_box, *r.reviews_count)),
    "comments_count": FieldPlan(lambda r: box_count(r.comment_word), lambda r: nd.keep_for(r.summary_box)),
    "brand": FieldPlan(
        brand,
        lambda r: nd.keep_for(*r.brand, strings=(r.brand_inline,))
        | _table_keep(r)
        | _script_keep(JSON_TYPE, LINKED_JSON_TYPE),
    ),
    "category": FieldPlan(
        lambda r: link_trail(r.category), lambda r: nd.keep_for(*[nd.tag("a").under(s) for s in r.category])
    ),
    "ingredients": FieldPlan(
        lambda r: coalesce(
            [tx.non_empty(info_value(r.ingredients_label)), first_existing(r.ingredients)]
        ),
        lambda r: nd.keep_for(*r.ingredients) | _table_keep(r),
    ),
    "images": FieldPlan(
        lambda r: images.image_urls(),
        lambda r: images.keep(r) | _script_keep(JSON_TYPE),
    ),
    "content": FieldPlan(content.content, content.keep),
    "original_price": _chain(
        "original_price",
        lambda r: tx.parse_price(coalesce(nd.first_text(s) for s in r.original_price)),
    ),
    "discount": _chain("discount"),
    "description": _chain("description"),
    "usage": _chain("usage"),
    "availability": _chain("availability"),
    **{
        field: _label(field)
        for field in (
            "official_name", "registration_number", "form", "package_size",
            "origin_brand", "manufacturer", "country_of_manufacture",
        )
    },
}

_NEEDS_TABLE = {"brand", "ingredients", "official_name", "registration_number", "form",
                "package_size", "origin_brand", "manufacturer", "country_of_manufacture"}
_WITHOUT_TEXT = {"images", "content"}
_NEEDS_BOX = {"rating", "reviews_count", "comments_count"}


def record_keep(rules: Rules, fields: Iterable[str]) -> Keep:
    """Parse-step filter for the given fields."""
    keep = Keep()
    for field in fields:
        keep = keep | FIELDS[field].keep(rules)
    return keep


def parse_for(pages: DataFrame, rules: Rules, fields: Iterable[str], carry: Iterable[str]) -> DataFrame:
    """Parse ``pages`` for exactly what ``fields`` need, with the shared columns.

    Shared pieces (table cells, boxes, marked strings, images) are columns of
    their own, so that each is computed once per page however many fields use it.
    """
    fields = set(fields)
    rules, selectors = rules.numbered()
    parsed = parse_pages(
        pages,
        record_keep(rules, fields),
        carry=carry,
        markup_attrs=rules.content_attrs if "content" in fields else None,
        markup_skip=rules.content_drop_tags,
        markup_keep=nd.keep_for(rules.content_box, *rules.content_fallbacks),
        json_keys=rules.brand_keys if "brand" in fields else (),
        with_text=bool(fields - _WITHOUT_TEXT),
        selectors=[sel.own() for sel in selectors],
    )
    # each stage may use the columns of the stages before it
    stages: list[dict[str, Sql]] = [{}, {}, {}, {}]
    if fields & _NEEDS_TABLE:
        stages[0]["_table"] = nd.first_node(rules.info_table)
        stages[0]["_cells"] = nd.find_all(rules.info_cell)
        stages[1]["_info"] = info_rows(rules)
    if fields & _NEEDS_BOX:
        stages[0]["_boxes"] = nd.find_all(rules.summary_box)
    if "rating" in fields:
        stages[0]["_review_texts"] = review_texts(rules)
    if "category" in fields:
        stages[0]["_anchors"] = nd.find_all(nd.tag("a"))
    if "content" in fields:
        stages[0]["_boxes_of_content"] = content.containers(rules)
        stages[0]["_cuts"] = content.cuts(rules)
    if "images" in fields:
        stages[0]["_imgs"] = nd.find_all(nd.tag("img"))
        stages[1]["_candidates"] = images.candidates(rules)
        stages[2]["_gallery"] = images.gallery(rules)
        stages[3]["_images"] = images.choose(rules)
    out = parsed
    for stage in stages:
        if stage:
            out = out.selectExpr("*", *[f"{value} AS {name}" for name, value in stage.items()])
    return out


def extract_fields(
    pages: DataFrame, rules: Rules, fields: Iterable[str] = EXTRACTED,
    carry: Iterable[str] = ("page_id", "url"),
) -> DataFrame:
    """``carry`` + ``fields`` with NULL for missing + ``parse_error``."""
    fields = [f for f in fields if f in FIELDS]
    carry = list(carry)
    parsed = parse_for(pages, rules, fields, carry)
    rules, _ = rules.numbered()
    values = [f"{FIELDS[f].value(rules)} AS {f}" for f in fields]
    return parsed.selectExpr(*carry, *values, "parse_error")


def with_sentinels(df: DataFrame) -> DataFrame:
    """Replace NULL by the record's sentinel, column by column."""
    out = {}
    for name, kind, missing in RECORD:
        if name in df.columns and missing is not None:
            empty = F.array().cast(kind) if missing == [] else F.lit(missing).cast(kind)
            out[name] = F.coalesce(F.col(name), empty)
    return df.withColumns(out)


def records_and_failures(
    pages: DataFrame,
    rules: Rules,
    as_of=None,
    extra: dict[str, "F.Column"] | None = None,
) -> DataFrame:
    """One row per page, from one parse: ``page_id``, the record's columns, and ``reason``.

    ``reason`` is NULL for a good page.  Of a failed page (no source, an error status or a
    parser error) only ``page_id``, ``url``, ``crawled_at`` and ``reason`` say something, the other columns
    hold what stands for "missing".  See ``sinks.write.write_outcomes`` for two tables of it.
    """
    fault = page_fault(pages)
    judged = pages.withColumns({"_fault": fault, "html": F.when(fault.isNull(), F.col("html"))})
    found = extract_fields(judged, rules, carry=("page_id", "url", "_fault"))
    when = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    reason = F.when(F.col("parse_error").isNotNull(), F.coalesce("_fault", "parse_error")).alias("reason")
    record = with_sentinels(found.withColumn("crawled_at", when))
    out = record.select("page_id", *COLUMNS, reason)
    return out.withColumns(extra) if extra else out


def extract_products(
    pages: DataFrame,
    rules: Rules,
    as_of=None,
    extra: dict[str, "F.Column"] | None = None,
) -> DataFrame:
    """Product records of all good pages: the 26 columns in record order.

    ``as_of`` stamps ``crawled_at`` (a fixed value makes runs repeatable; default
    is the query's start time).  ``extra`` adds columns computed from the record.
    """
    good = extract_fields(pages, rules, carry=("url",)).filter(F.col("parse_error").isNull())
    when = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    record = with_sentinels(good.withColumn("crawled_at", when)).select(*COLUMNS)
    return record.withColumns(extra) if extra else record
