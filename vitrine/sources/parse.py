"""``pages`` -> parsed pages: one Arrow map over the scan, each page read once."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from vitrine.functions import jsonsearch
from vitrine.functions.jsonsearch import search_script
from vitrine.sources import htmltree
from vitrine.sources.htmltree import (
    ALL_NODES,
    ATTRS,
    NODE_WIDTH,
    PRE,
    TAG,
    TEXT,
    Keep,
    Own,
    TreeBuilder,
)

# Executors need no copy of this package: the parse step travels with its code.
for _module in (htmltree, jsonsearch, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

NODE_FIELDS = (
    "pre int, last int, parent int, kind string, tag string, cls string, "
    "attrs map<string,string>, text string, t0 int, t1 int, h0 int, h1 int, sole int"
)
NODES_DDL = f"array<struct<{NODE_FIELDS.replace(' int', ':int').replace(' string', ':string').replace(' map', ':map')}>>"
JSON_HITS_DDL = "array<struct<pre:int,linked:boolean,value:string,failed:boolean>>"
OUTPUTS = ("text", "markup", "nodes", "json_hits", "hits", "parse_error")
_DDL = {"nodes": NODES_DDL, "json_hits": JSON_HITS_DDL, "hits": "array<array<int>>"}

_INT, _STR = pa.int32(), pa.string()
_NODE_TYPES = [
    ("pre", _INT), ("last", _INT), ("parent", _INT), ("kind", _STR), ("tag", _STR),
    ("cls", _STR), ("attrs", pa.map_(_STR, _STR)), ("text", _STR), ("t0", _INT),
    ("t1", _INT), ("h0", _INT), ("h1", _INT), ("sole", _INT),
]
_NODE_ARROW = [pa.field(name, kind) for name, kind in _NODE_TYPES]
_HIT_ARROW = [
    pa.field("pre", _INT), pa.field("linked", pa.bool_()),
    pa.field("value", _STR), pa.field("failed", pa.bool_()),
]
# Output is flushed after this much HTML, so one batch of huge pages stays small.
_FLUSH_CHARS = 1 << 20

JSON_TYPE = "application/json"
LINKED_JSON_TYPE = "application/ld+json"


def html_text(column) -> "F.Column":
    """Page source as valid UTF-8 text; works for STRING and BINARY columns."""
    return F.make_valid_utf8(column.cast("string"))


def parse_pages(
    pages: DataFrame,
    keep: Keep = ALL_NODES,
    carry: Iterable[str] = ("page_id", "url"),
    html: str = "html",
    markup_attrs: Iterable[str] | None = None,
    markup_skip: Iterable[str] = (),
    markup_keep: Keep = ALL_NODES,
    json_keys: Iterable[str] = (),
    with_text: bool = True,
    selectors: Iterable[Own] = (),
) -> DataFrame:
    """Parse every page once.

    Output: the ``carry`` columns, ``text`` (all visible text, only ``with_text``), ``markup``
    (re-serialised elements let through by ``markup_keep``, only with
    ``markup_attrs``), ``nodes`` (filtered by
    ``keep``), ``json_hits`` (only with ``json_keys``), ``hits`` (per entry of ``selectors`` the places
    of its elements in ``nodes``) and ``parse_error``, which
    is NULL for a good page.  A bad page is a row, never an exception.  What is not asked for is
    neither built nor sent back from Python.

    Only ``carry`` and ``html`` are read from the scan, so filter ``pages``
    before calling: predicates do not pass through a Python map.
    """
    carry = list(carry)
    source = pages.select(*carry, html_text(F.col(html)).alias("_html"))
    keys = tuple(json_keys)
    selectors = tuple(selectors)
    asked = {"hits": bool(selectors), "text": with_text, "markup": markup_attrs is not None, "json_hits": bool(keys)}
    outputs = tuple(name for name in OUTPUTS if asked.get(name, True))
    fields = [source.schema[name] for name in carry]
    fields += [T.StructField(name, T.DataType.fromDDL(_DDL.get(name, "string"))) for name in outputs]
    options = {
        "keep": keep,
        "markup_attrs": None if markup_attrs is None else tuple(markup_attrs),
        "markup_skip": tuple(markup_skip),
        "markup_keep": markup_keep,
        "with_text": with_text,
        "selectors": selectors,
    }

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = TreeBuilder(**options)
        for batch in batches:
            yield from _parse_batch(builder, batch, carry, keys, outputs)

    return source.mapInArrow(parse, T.StructType(fields))


def _parse_batch(builder, batch, carry, keys, outputs=OUTPUTS):
    sources = batch.column(len(carry))
    start, chars, rows = 0, 0, []
    for index in range(batch.num_rows):
        row = _parse_one(builder, sources[index].as_py(), keys)
        rows.append(row)
        chars += row[6]
        if chars >= _FLUSH_CHARS:
            yield _to_arrow(batch.slice(start, len(rows)), carry, rows, outputs)
            start, chars, rows = index + 1, 0, []
    if rows:
        yield _to_arrow(batch.slice(start, len(rows)), carry, rows, outputs)


def _parse_one(builder, html, keys):
    """(text, markup, nodes, json hits, selector hits, error, size) of one page."""
    if html is None:
        return "", "", [], [], builder.no_hits(), "no html", 0
    try:
        tree = builder.build(html)
    except Exception as error:  # noqa: BLE001 - a bad page is data, not a failure
        return "", "", [], [], builder.no_hits(), f"{type(error).__name__}: {error}", len(html)
    hits = []
    if keys:
        for node in tree.nodes:
            if node[TAG] == "script" and node[ATTRS] and node[TEXT]:
                kind = dict(node[ATTRS]).get("type")
                if kind == JSON_TYPE or kind == LINKED_JSON_TYPE:
                    value, failed = search_script(node[TEXT], keys)
                    hits.append((node[PRE], kind == LINKED_JSON_TYPE, value, failed))
    return tree.text, tree.markup, tree.nodes, hits, tree.hits, None, len(html)


def _to_arrow(carried, carry, rows, outputs):
    text, markup, nodes, hits, places, errors, _ = zip(*rows)
    columns = [carried.column(index) for index in range(len(carry))]
    made = {
        "text": lambda: pa.array(text, _STR),
        "markup": lambda: pa.array(markup, _STR),
        "nodes": lambda: _nested(nodes, _NODE_ARROW, NODE_WIDTH),
        "json_hits": lambda: _nested(hits, _HIT_ARROW, len(_HIT_ARROW)),
        "hits": lambda: pa.array(places, pa.list_(pa.list_(_INT))),
        "parse_error": lambda: pa.array(errors, _STR),
    }
    columns += [made[name]() for name in outputs]
    return pa.RecordBatch.from_arrays(columns, [*carry, *outputs])


def _nested(groups, fields, width):
    """list<struct> column from per-page lists of row tuples."""
    offsets = pa.array(itertools.accumulate(map(len, groups), initial=0), _INT)
    flat = [row for group in groups for row in group]
    slots = list(zip(*flat)) if flat else [()] * width
    children = []
    for spec, values in zip(fields, slots):
        if pa.types.is_map(spec.type):
            values = [v or [] for v in values]
        children.append(pa.array(values, spec.type))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(children, fields=fields))
