"""Scalar text and number functions as SQL fragments of built-in functions."""

from __future__ import annotations

from vitrine.functions.sql import Sql, lit

# Every character the Unicode standard (and Python's ``str.strip``)
# treats as white space.  Plain ``trim`` and ``\s`` know only part of them.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex character class.
WS = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip(text: Sql) -> Sql:
    """Remove Unicode white space at both ends (linear time, no regex)."""
    return f"trim(BOTH {lit(WHITESPACE)} FROM {text})"


def clean_text(text: Sql) -> Sql:
    """Strip, then turn each line feed, carriage return and tab into one space.

    Inner runs are not collapsed.  NULL stays NULL; sentinels come last.
    """
    return f"translate({strip(text)}, '\\n\\r\\t', '   ')"


def non_empty(text: Sql) -> Sql:
    return f"nullif({text}, '')"


def has_digit(text: Sql) -> Sql:
    return f"rlike({text}, '[0-9]')"


def digits(text: Sql) -> Sql:
    """All ASCII digits of the text, joined; NULL when there are none."""
    return non_empty(f"regexp_replace({text}, '[^0-9]+', '')")


def parse_price(text: Sql) -> Sql:
    """Every digit of the text read as one number; 0.0 when there is none.

    Separators and decimals carry no meaning: ``12,5`` is 125.
    """
    return f"coalesce(try_cast({digits(text)} AS DOUBLE), 0D)"


def parse_count(text: Sql) -> Sql:
    """As :func:`parse_price` to a BIGINT, NULL when there is no digit."""
    return f"try_cast({digits(text)} AS BIGINT)"


def number_before(text: Sql, marker_regex: str) -> Sql:
    """Decimal number right before a marker, first regex hit; NULL without a hit."""
    return _before(text, "[0-9]+(?:\\.[0-9]+)?", marker_regex, "DOUBLE")


def count_before(text: Sql, marker_regex: str) -> Sql:
    """Whole number right before a marker, first regex hit; NULL without a hit."""
    return _before(text, "[0-9]+", marker_regex, "BIGINT")


def _before(text, number, marker, kind):
    pattern = lit(f"({number}){WS}*{marker}")
    return f"try_cast({non_empty(f'regexp_extract({text}, {pattern}, 1)')} AS {kind})"


def collapse_markup(markup: Sql) -> Sql:
    """White-space runs to one space, none between tags, none at the ends."""
    return strip(f"replace(regexp_replace({markup}, {lit(WS + '+')}, ' '), '> <', '><')")


def stamp(moment: Sql) -> Sql:
    """Time stamp as used in output names."""
    return f"date_format({moment}, 'yyyyMMdd_HHmmss')"
