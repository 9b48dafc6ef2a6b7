"""Which rule gave each field of a record: value and rule number through every fallback.

A chain is an array of *tries* ``struct<rule_idx, rule, value>``, one per rule, with a NULL value
where the rule does not decide; the first that has a value wins.  Values are those of the record, as text,
so that a chain can be held against it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from vitrine.functions import nodes as nd
from vitrine.functions import text as tx
from vitrine.functions.sql import Sql, any_of, coalesce, first, first_of, let, lit
from vitrine.operators import content, images
from vitrine.operators.products import (
    EXTRACTED, box_count, first_with_digit, in_range, info_value, inline_brand, json_brands, link_trail, parse_for,
    rating_marks, class_rating,
)
from vitrine.plans.rules import Rules
from vitrine.sources.pages import usable_pages

Tries = list[tuple[str, Sql]]  # rule label, value


def _texts(sels: Iterable[nd.Sel], clean=tx.clean_text) -> Tries:
    return [(sel.label, clean(nd.first_text(sel))) for sel in sels]


def _row_of(label: str) -> str:
    return f"table: {label}"


# Rules whose number depends on what is found first on the page, not on the rule alone: an
# array of struct<rule_idx, rule, value> in page order, of which the first counts.
def _found(number: Sql, label: Sql, value: Sql) -> Sql:
    return f"named_struct('rule_idx', {number}, 'rule', {label}, 'value', CAST({value} AS STRING))"


def _try(number: int, label: str, value: Sql) -> Sql:
    return let("w", value, f"if(w IS NULL, NULL, {_found(str(number), lit(label), 'w')})")


def _chain(tries: Tries, start: int = 0) -> list[Sql]:
    return [_try(start + i, label, value) for i, (label, value) in enumerate(tries)]


def _brand(rules: Rules) -> list[Sql]:
    """0 JSON, 1 text of JSON that could not be read, 2 linked data, 3 table, 4 inline label, then classes."""
    plain, linked = json_brands(rules)
    value = tx.clean_text("h.value")
    some = first(f"filter({plain}, h -> h.value IS NOT NULL)")
    number, label = "if(h.failed, 1, 0)", "if(h.failed, 'json text', 'json')"
    scripts = let("h", some, f"if(h IS NULL, NULL, {_found(number, label, value)})")
    return [
        scripts,
        _try(2, "linked json", tx.clean_text(linked)),
        _try(3, _row_of(rules.brand_label), tx.non_empty(info_value(rules.brand_label))),
        _try(4, f"inline: {rules.brand_inline}", inline_brand(rules)),
        *_chain(_texts(rules.brand), 5),
    ]


def _rating(rules: Rules) -> list[Sql]:
    """Numbers 0 to 2: mark after the number near the review word; 3: summary box; then classes."""
    marks = rating_marks(rules)
    near = [_try(i, f"near: {word}", in_range(tx.number_before("t", mark))) for i, (word, mark) in enumerate(marks)]
    texts = f"transform(_review_texts, t -> {coalesce(near)})"
    worded = any_of(f"contains(t, {lit(w)})" for w in (rules.review_word, rules.star_word))
    boxes = f"filter(transform(_boxes, e -> {nd.text_of('e')}), t -> {worded})"
    boxed = _try(len(marks), rules.summary_box.label, in_range(tx.number_before("t", marks[0][1])))
    classed = [(sel.label, class_rating(sel)) for sel in rules.rating]
    return [
        first(f"filter({texts}, w -> w IS NOT NULL)"),
        first(f"filter(transform({boxes}, t -> {boxed}), w -> w IS NOT NULL)"),
        *_chain(classed, len(marks) + 1),
    ]


def _images(rules: Rules) -> list[Sql]:
    """The step that gave the first image; the value holds all images, whatever their steps."""
    names = " ".join(f"WHEN {step} THEN {lit(name)}" for step, name in images.STEP_NAMES.items())
    value = f"array_join({images.image_urls()}, '|')"
    found = _found("x.step - 1", f"CASE x.step {names} END", value)
    return [first_of("_images", "x", found)]


def _content(rules: Rules) -> list[Sql]:
    sels = (rules.content_box, *rules.content_fallbacks)
    tries = [f"if(size({nd.find_all(sel)}) > 0, {_found(str(i), lit(sel.label), 'c')}, NULL)" for i, sel in enumerate(sels)]
    # bound to a variable, so the markup is cut once and not per rule
    return [let("c", content.content(rules), f"if(c IS NULL, NULL, {coalesce(tries)})")]


def chains(rules: Rules) -> dict[str, Sql]:
    """Per field ``struct<rule_idx, rule, value>`` of the rule that won, or NULL."""
    simple = {f: _chain(_texts(getattr(rules, f))) for f in (
        "name", "unit", "sku", "discount", "description", "usage", "availability",
    )}
    counts = [(s.label, first_of(nd.find_all(s), "e", tx.parse_count(nd.text_of("e")))) for s in rules.reviews_count]
    ingredients = (_row_of(rules.ingredients_label), tx.non_empty(info_value(rules.ingredients_label)))
    every = {
        **simple,
        "price": _chain([
            (s.label, let("p", first_with_digit([s]), f"if(p IS NULL, NULL, {tx.parse_price('p')})")) for s in rules.price
        ]),
        "original_price": _chain([
            (s.label, let("p", nd.first_text(s), f"if(p IS NULL, NULL, {tx.parse_price('p')})")) for s in rules.original_price
        ]),
        "category": _chain([(s.label, link_trail([s])) for s in rules.category]),
        "ingredients": _chain([ingredients, *_texts(rules.ingredients)]),
        "brand": _brand(rules),
        "rating": _rating(rules),
        "reviews_count": _chain([(rules.summary_box.label, box_count(rules.review_word)), *counts]),
        "comments_count": _chain([(rules.summary_box.label, box_count(rules.comment_word))]),
        "images": _images(rules),
        "content": _content(rules),
        **{field: _chain([(_row_of(label), info_value(label))]) for field, label in rules.table_labels},
    }
    return {field: coalesce(every[field]) for field in EXTRACTED}


def winning_rules(pages: DataFrame, rules: Rules) -> DataFrame:
    """Per good page and field the rule that won: ``page_id, url, field, rule_idx, rule, value``.

    Fields that no rule decided give no row.  One parse, no shuffle.
    """
    parsed = parse_for(usable_pages(pages), rules, EXTRACTED, ("page_id", "url")).filter(F.col("parse_error").isNull())
    won = chains(rules.numbered()[0])
    # the structs are columns of their own, so that each is computed once
    fields = parsed.selectExpr("page_id", "url", *[f"{value} AS {field}" for field, value in won.items()])
    rows = ", ".join(f"struct({lit(f)} AS field, {f}.rule_idx, {f}.rule, {f}.value)" for f in won)
    return fields.selectExpr("page_id", "url", f"inline(filter(array({rows}), w -> w.rule_idx IS NOT NULL))")


def rule_wins_all(pages: DataFrame, rules: Rules) -> DataFrame:
    """How often each rule of each of the 24 extracted fields won: ``field, rule_idx, rule, pages``."""
    return winning_rules(pages, rules).groupBy("field", "rule_idx", "rule").agg(F.count(F.lit(1)).alias("pages"))
