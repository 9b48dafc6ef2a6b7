"""Helpers for building Spark SQL expressions as text.

All functions of this package take and return SQL *fragments* (plain strings):
``clean_text("title")`` is an expression over column ``title``.  Use
``F.expr(...)`` or ``df.selectExpr(...)`` to apply one.  A record has hundreds of
small expressions; one parsed string per column plans far faster than hundreds of
Column objects and stays readable in ``explain``.
"""

from __future__ import annotations

from collections.abc import Iterable

Sql = str


def lit(value: str) -> Sql:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def coalesce(parts: Iterable[Sql]) -> Sql:
    parts = list(parts)
    return parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"


def any_of(tests: Iterable[Sql]) -> Sql:
    return "(" + " OR ".join(tests) + ")"


def let(var: str, value: Sql, body: Sql) -> Sql:
    """``body`` with ``var`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {var} -> {body})[0]"


def first(array: Sql) -> Sql:
    """First array element, NULL for an empty or NULL array."""
    return f"get({array}, 0)"


def first_value(array: Sql) -> Sql:
    """First element that is not NULL."""
    return first(f"filter({array}, v -> v IS NOT NULL)")


def first_of(array: Sql, var: str, value: Sql) -> Sql:
    """``value`` of the first element only; NULL when there is none."""
    return first(f"transform(slice({array}, 1, 1), {var} -> {value})")


def first_non_empty(arrays: Iterable[Sql]) -> Sql:
    """First of the arrays that has elements, else an empty array."""
    arrays = list(arrays)
    return f"coalesce({first(f'filter(array({', '.join(arrays)}), xs -> size(xs) > 0)')}, slice({arrays[-1]}, 1, 0))"


def lower_bound(array: Sql, value: Sql, of: str = "") -> Sql:
    """How many elements of an ascending array (their field ``of``, as ``.pre``) lie below ``value``.

    A binary search; ``array`` is a column or a variable, as it is looked at in every round.
    """
    half = "shiftright(lb.lo + lb.hi, 1)"
    up = f"named_struct('lo', {half} + 1, 'hi', lb.hi)"
    down = f"named_struct('lo', lb.lo, 'hi', {half})"
    step = f"if(lb.lo >= lb.hi, lb, if(get({array}, {half}){of} < {value}, {up}, {down}))"
    rounds = f"sequence(1, CAST(greatest(1, ceil(log2(size({array}) + 1))) AS INT))"
    return f"aggregate({rounds}, named_struct('lo', 0, 'hi', size({array})), (lb, round) -> {step}, lb -> lb.lo)"


def between(array: Sql, low: Sql, high: Sql, of: str = "") -> Sql:
    """The elements of an ascending array from ``low`` on and below ``high``."""
    start, stop = lower_bound(array, low, of), lower_bound(array, high, of)
    return let("low_at", start, f"slice({array}, low_at + 1, {stop} - low_at)")
