"""Winning rules: their values are those of the record."""

from pyspark.sql import functions as F

from vitrine.operators.products import EXTRACTED, extract_fields
from vitrine.operators.winners import winning_rules
from vitrine.plans.rendered import RULES, product_pages


def test_values_are_those_of_the_record(spark, data):
    pages = product_pages(spark.read.parquet(f"{data}/part.parquet"))
    won = {(r.page_id, r.field): r.value for r in winning_rules(pages, RULES).collect()}
    kept = [F.array_join(F.when(F.size(c) > 0, F.col(c)), "|") if c == "images" else F.col(c).cast("string") for c in EXTRACTED]
    fields = extract_fields(pages, RULES).select("page_id", *[k.alias(c) for c, k in zip(EXTRACTED, kept)])
    n = 0
    for row in fields.collect():
        for field in EXTRACTED:
            got = won.get((row.page_id, field))
            if got is None and field in ("price", "original_price"):
                assert row[field] == "0.0"  # no rule decided
            else:
                assert got == row[field], (row.page_id, field)
                n += got is not None
    assert n == len(won) and {f for _, f in won} == set(EXTRACTED)


def test_rules_of_odd_pages(page, spark):
    """Several scripts, a mark out of range, empty elements, a second container kind."""
    df = page(
        '<script type="application/json">{"x": 1}</script><script type="application/json">{"brand": "A",</script>'
        '<script type="application/ld+json">{"brand": "B"}</script>',
        '<b>7 (x) 3 sao 4/5 đánh giá</b><i class="rating">2/5</i>',
        '<p class="description"></p><p class="product-detail">text</p>',
        '<div class="description">a</div><div id="detail-content-1">b</div>',
        "<p>nothing</p>",
        None,
    )
    found = {(r.page_id, r.field): (r.rule_idx, r.rule, r.value) for r in winning_rules(df, RULES).collect()}
    assert found[0, "brand"] == (1, "json text", "A")
    assert found[1, "rating"] == (1, "near: sao", "3.0")
    assert found[2, "description"] == (1, ".description", "")
    assert found[3, "content"] == (3, "div.description", '<div class="description">a</div>')
    assert {p for p, _ in found} == {0, 1, 2, 3}
