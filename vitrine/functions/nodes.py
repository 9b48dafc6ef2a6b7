"""Selectors as Spark predicates over the ``nodes`` array of a parsed page.

A :class:`Sel` is a plain value object.  ``sel.on(n)`` is the SQL predicate for
one node, ``sel.keep()`` the matching filter for the parse step, so the parse
emits only nodes some rule can use.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from vitrine.functions.sql import Sql, first, first_of, let, lit, lower_bound
from vitrine.sources.htmltree import Keep, Own


@dataclass(frozen=True)
class Sel:
    """One element pattern; all given conditions must hold."""

    label: str = ""
    tag: str | None = None
    classes: tuple[str, ...] = ()  # class tokens, all required
    cls_exact: str | None = None  # whole class attribute
    cls_part: str | None = None  # substring of the class attribute
    attr_is: tuple[tuple[str, str], ...] = ()
    attr_part: tuple[tuple[str, str], ...] = ()
    attr_head: tuple[tuple[str, str], ...] = ()
    inside: "Sel | None" = None  # some ancestor matches
    child_of: "Sel | None" = None  # the parent matches
    number: int | None = None  # the parse step lists its matches in ``hits`` at this place

    def on(self, n: str) -> Sql:
        """Predicate for the node bound to lambda variable ``n``, without ancestors."""
        tests = [f"{n}.tag = {lit(self.tag)}" if self.tag else f"{n}.kind = 'element'"]
        cls = f"{n}.cls"
        for token in self.classes:
            tests.append(f"contains({cls}, {lit(f' {token} ')})")
        if self.cls_exact is not None:
            tests.append(f"{cls} = {lit(f' {self.cls_exact} ')}")
        if self.cls_part is not None:
            tests.append(f"contains({cls}, {lit(self.cls_part)})")
        tests += [f"{attr(n, name)} = {lit(value)}" for name, value in self.attr_is]
        tests += [f"contains({attr(n, name)}, {lit(value)})" for name, value in self.attr_part]
        tests += [f"startswith({attr(n, name)}, {lit(value)})" for name, value in self.attr_head]
        return "(" + " AND ".join(tests) + ")"

    def own(self) -> Own:
        """The conditions of :meth:`on`, for the parse step."""
        tokens = tuple(f" {token} " for token in self.classes)
        exact = None if self.cls_exact is None else f" {self.cls_exact} "
        parts = tokens if self.cls_part is None else (*tokens, self.cls_part)
        return Own(self.tag, parts, exact, self.attr_is, self.attr_part, self.attr_head)

    def keep(self) -> Keep:
        """A necessary condition for a match, as a parse-step filter."""
        names = frozenset(n for n, _ in self.attr_is + self.attr_part + self.attr_head)
        spec: dict = {"attr_names": names}
        if self.classes:
            spec["tokens"] = frozenset(self.classes[:1])
        elif self.cls_exact is not None:
            spec["exact_classes"] = frozenset((self.cls_exact,))
        elif self.cls_part is not None:
            spec["class_parts"] = frozenset((self.cls_part,))
        elif self.attr_is:
            spec["attr_values"] = frozenset(self.attr_is[:1])
        elif self.attr_head:
            spec["attr_heads"] = frozenset(self.attr_head[:1])
        elif names:
            spec["attrs"] = frozenset((self.tag, name) for name in list(names)[:1])
        elif self.tag:
            spec["tags"] = frozenset((self.tag,))
        else:
            spec["everything"] = True
        own = Keep(**spec)
        outer = self.inside or self.child_of
        if outer is None:
            return own
        around = outer.keep()
        return around | Keep(attr_names=names, inner=own, outer=around)

    def under(self, outer: "Sel") -> "Sel":
        return replace(self, inside=outer, label=f"{outer.label} {self.label}")

    def child(self, outer: "Sel") -> "Sel":
        return replace(self, child_of=outer, label=f"{outer.label} > {self.label}")


def tag(name: str) -> Sel:
    return Sel(label=name, tag=name)


def cls(token: str, of: str | None = None) -> Sel:
    return Sel(label=f"{of or ''}.{token}", tag=of, classes=(token,))


def cls_part(part: str, of: str | None = None) -> Sel:
    return Sel(label=f'{of or ""}[class*="{part}"]', tag=of, cls_part=part)


def attr_is(of: str, name: str, value: str) -> Sel:
    return Sel(label=f'{of}[{name}="{value}"]', tag=of, attr_is=((name, value),))


def attr_part(of: str, name: str, value: str) -> Sel:
    return Sel(label=f'{of}[{name}*="{value}"]', tag=of, attr_part=((name, value),))


def attr_head(of: str, name: str, value: str) -> Sel:
    return Sel(label=f'{of}[{name}^="{value}"]', tag=of, attr_head=((name, value),))


def keep_for(*sels: Sel, attr_names: tuple[str, ...] = (), strings: tuple[str, ...] = ()) -> Keep:
    """Parse-step filter for a set of selectors."""
    base = Keep(attr_names=frozenset(attr_names), strings=frozenset(strings))
    return reduce(lambda a, b: a | b, (s.keep() for s in sels), base)


# -- node access -------------------------------------------------------------
def attr(n: str, name: str) -> Sql:
    """Attribute value; NULL when missing."""
    return f"try_element_at({n}.attrs, {lit(name)})"


def within(n: str, outer: Sql) -> Sql:
    """``n`` is a descendant of ``outer``."""
    return f"({n}.pre > {outer}.pre AND {n}.pre <= {outer}.last)"


def text_of(n: str) -> Sql:
    """Text of a node's subtree: its own string, else its slice of the page text."""
    return f"coalesce({n}.text, substring(text, {n}.t0 + 1, {n}.t1 - {n}.t0))"


def find_all(sel: Sel, var: str = "n", nodes: Sql = "nodes") -> Sql:
    """All matches in document order; the ancestors are looked up once.

    Of a selector with a number only the nodes that the parse step lists for it are looked at.
    """
    up = var + "_up"
    if sel.number is not None and nodes == "nodes":
        listed = f"transform(get(hits, {sel.number}), at -> get(nodes, at))"
        if sel.inside is None and sel.child_of is None:
            return listed
        nodes = listed
    if sel.inside is not None:
        # inside one of them: more start than end before the node
        inside = f"{lower_bound(up, f'{var}.pre', '.pre')} > {lower_bound(f'{up}_ends', f'{var}.pre')}"
        found = f"filter({nodes}, {var} -> {sel.on(var)} AND size({up}) > 0 AND {inside})"
        return let(up, find_all(sel.inside), let(f"{up}_ends", f"sort_array(transform({up}, a -> a.last))", found))
    if sel.child_of is not None:
        test = f"{sel.on(var)} AND get({up}, {lower_bound(up, f'{var}.parent')}) = {var}.parent"
        parents = f"transform({find_all(sel.child_of)}, a -> a.pre)"
        return let(up, parents, f"filter({nodes}, {var} -> {test})")
    return f"filter({nodes}, {var} -> {sel.on(var)})"


def first_node(sel: Sel) -> Sql:
    return first(find_all(sel))


def first_text(sel: Sel) -> Sql:
    """Text of the first match; NULL only if no element matches."""
    return first_of(find_all(sel), "e", text_of("e"))
