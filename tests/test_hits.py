"""Selectors that the parse step lists by number, and work dealt over the cores."""

import io
from contextlib import redirect_stdout
from dataclasses import replace

from vitrine.functions import nodes as nd
from vitrine.operators.products import extract_products
from vitrine.plans import rendered
from vitrine.plans.rules import default_rules
from vitrine.sources import parse
from vitrine.sources.htmltree import TreeBuilder
from vitrine.sources.parse import parse_pages

RULES = default_rules("https://shop.example", "https://cdn.shop.example", "store.shop.example")
SELS = [
    nd.tag("p"), nd.cls("a"), nd.cls("a", of="div"), nd.cls_part("cl"), nd.attr_is("i", "data-x", "1"),
    nd.attr_part("i", "data-x", "1"), nd.attr_head("i", "data-x", "1"), nd.Sel(tag="div", cls_exact="a b"),
    nd.Sel(classes=("a", "b")), nd.Sel(cls_part=""), nd.attr_is("i", "data-x", ""), nd.attr_part("i", "data-x", ""),
]
HTML = (
    '<div class="a b">1<p>2</p></div><div class="b  a">3</div><p class="cla">4</p><p class>5</p><i data-x="1">6</i>'
    '<i data-x>7</i><i data-x="21">8</i><i data-x="12" data-x="2">9</i><DIV CLASS=" a b ">0</DIV><i class="a" class="b">x</i>'
    '<script class="a">"<p>"</script><p class="a&#32;b">y</p>'
)


def test_listed_matches_are_those_of_the_predicates(page):
    keep = nd.keep_for(*SELS)
    parsed = parse_pages(page(HTML, "", None, "<p>"), keep, selectors=[s.own() for s in SELS])
    for number, sel in enumerate(SELS):
        rows = parsed.selectExpr(
            f"transform(filter(nodes, n -> {sel.on('n')}), n -> n.pre) AS slow",
            f"transform({nd.find_all(replace(sel, number=number))}, n -> n.pre) AS listed",
        ).collect()
        assert all(r.listed == r.slow for r in rows), sel


def test_ancestors_of_numbered_selectors(page):
    """Below and child selectors find the same nodes with numbers as without."""
    html = '<div class="k"><b>1</b><u><b>2</b></u></div><b>3</b><div><i class="k"><b>4</b></i></div>'
    for sel in (nd.tag("b").under(nd.cls("k")), nd.tag("b").child(nd.cls("k"))):
        inner, outer = replace(sel, inside=None, child_of=None), sel.inside or sel.child_of
        known = replace(outer, number=1)
        numbered = replace(sel, number=0, **({"inside": known} if sel.inside else {"child_of": known}))
        row = parse_pages(page(html), selectors=[inner.own(), outer.own()]).selectExpr(
            f"transform({nd.find_all(sel)}, n -> n.pre) AS slow", f"transform({nd.find_all(numbered)}, n -> n.pre) AS listed"
        ).first()
        assert row.listed == row.slow and row.slow


def test_records_do_not_test_every_node_for_every_rule(page):
    out = io.StringIO()
    with redirect_stdout(out):
        extract_products(page("<h1>x</h1>"), RULES, as_of="2025-01-01").explain()
    assert "hits" in out.getvalue()
    numbered, sels = RULES.numbered()
    assert len(sels) == len(set(sels)) and all(s.number is not None for s in (*numbered.price, numbered.info_cell))


def test_pages_of_a_small_table_are_dealt_over_the_cores(spark, data, tmp_path):
    """Five splits on four cores: the pages made of them still come in even tasks."""
    part = spark.read.parquet(f"{data}/part.parquet")
    for n, rows in enumerate(part.randomSplit([20.0, 1.0, 1.0, 1.0, 1.0], 1)):
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "part.parquet"))
    pages = rendered.product_pages(spark.read.parquet(str(tmp_path / "part.parquet")))
    sizes = pages.rdd.glom().map(len).collect()
    assert len(sizes) == 4 * spark.sparkContext.defaultParallelism and max(sizes) < sum(sizes) / 4


def test_parsed_pages_are_sent_back_in_small_batches():
    """The rows of a task held in Python do not grow with its Arrow batches."""
    import pyarrow as pa

    html = "<table>" + "<tr><td>x</td></tr>" * 100 + "</table>"
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(4000)), "_html": [html] * 4000})
    sent = list(parse._parse_batch(TreeBuilder(nd.keep_for(nd.tag("td"))), batch, ["page_id"], (), ("nodes", "parse_error")))
    assert sum(b.num_rows for b in sent) == 4000
    assert max(b.num_rows for b in sent) * len(html) <= 2 << 20
