"""The cleaned long description of a product page."""

from __future__ import annotations

from vitrine.functions import nodes as nd
from vitrine.functions.sql import Sql, any_of, between, first_non_empty, let, lower_bound
from vitrine.functions.text import collapse_markup
from vitrine.plans.rules import Rules
from vitrine.sources.htmltree import Keep


def keep(rules: Rules) -> Keep:
    return nd.keep_for(rules.content_box, *rules.content_fallbacks, *rules.content_drop)


def containers(rules: Rules) -> Sql:
    """The exact container once, else *all* matches of the first selector that has any."""
    boxes = [f"slice({nd.find_all(rules.content_box)}, 1, 1)"]
    boxes += [nd.find_all(sel) for sel in rules.content_fallbacks]
    return first_non_empty(boxes)


def cuts(rules: Rules) -> Sql:
    """All unwanted nodes of the page, in document order."""
    return f"filter(nodes, n -> {any_of(sel.on('n') for sel in rules.content_drop)})"


# Characters of fixed width: a slice is cut out at once, wherever in the page it lies.
WIDE = "encode(markup, 'UTF-32')"


def content(rules: Rules) -> Sql:
    """Markup of the containers without unwanted parts; NULL without a container.

    The cuts of a container are found by binary search in ``_cuts``, so the time grows with the
    page and not with containers times cuts.
    """
    pieces = f"flatten(transform(_boxes_of_content, b -> transform({_kept('b')}, p -> {_slice('p')})))"
    # bound to a variable: a column used once would be computed anew for every piece
    whole = let("wide", WIDE, f"array_join({pieces}, '')")
    return f"if(size(_boxes_of_content) = 0, NULL, {collapse_markup(whole)})"


def _slice(piece: str) -> Sql:
    part = f"substring(wide, 4 * {piece}.start + 1, 4 * ({piece}.stop - {piece}.start))"
    # decoding takes a byte-order mark off the front, and only that one
    return f"decode(concat(X'0000FEFF', {part}), 'UTF-32')"


def _kept(box: str) -> Sql:
    """Ranges of ``box`` that no unwanted node in it covers."""
    inside = between("_cuts", f"{box}.pre", f"{box}.last + 1", ".pre")
    # a cut is not within another one if as many end before it as start before it
    outermost = f"filter(cs, (n, i) -> i = {lower_bound('ends', 'n.pre')})"
    outer = let("cs", inside, let("ends", "sort_array(transform(cs, n -> n.last))", outermost))
    piece = f"named_struct('start', coalesce(get(outer, {{0}} - 1).h1, {box}.h0), 'stop', {{1}})"
    before = f"transform(outer, (n, i) -> {piece.format('i', 'n.h0')})"
    return let("outer", outer, f"concat({before}, array({piece.format('size(outer)', f'{box}.h1')}))")
