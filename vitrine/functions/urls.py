"""URL functions as SQL fragments of built-in functions."""

from __future__ import annotations

from vitrine.functions.sql import Sql, any_of, lit

# A URL holding one of these is a listing, not a single item.
LISTING_MARKS = ("?", "#", "page=", "sort=")

# Image-proxy sizes and what they are rewritten to.
THUMB_SIZES = ("/unsafe/150x0/", "/unsafe/375x0/")
FULL_SIZE = "/unsafe/768x0/"
UNSIZED = "/unsafe/https://"
UNSIZED_FULL = "/unsafe/768x0/filters:quality(90)/https://"


def contains_any(text: Sql, words) -> Sql:
    return any_of(f"contains({text}, {lit(word)})" for word in words)


def absolutise(href: Sql, base_url: str) -> Sql:
    """Prefix the base when the link starts with ``/``; leave any other form."""
    return f"if(startswith({href}, '/'), concat({lit(base_url)}, {href}), {href})"


def count_slashes(text: Sql) -> Sql:
    return f"(length({text}) - length(replace({text}, '/', '')))"


def is_item_url(url: Sql, base_url: str) -> Sql:
    """True for the URL of a single item page."""
    path = f"replace({url}, {lit(base_url)}, '')"
    return (
        f"(endswith({url}, '.html') AND {count_slashes(path)} >= 2"
        f" AND NOT {contains_any(url, LISTING_MARKS)})"
    )


def category_head(category: Sql) -> Sql:
    """``a/b/c`` -> ``/a/``."""
    return f"concat('/', substring_index({category}, '/', 1), '/')"


def last_segment(url: Sql) -> Sql:
    return f"substring_index({url}, '/', -1)"


def full_size_image(url: Sql) -> Sql:
    """Rewrite a thumbnail URL of the image proxy to its full-size form."""
    swaps = [(size, FULL_SIZE) for size in THUMB_SIZES] + [(UNSIZED, UNSIZED_FULL)]
    cases = " ".join(
        f"WHEN contains({url}, {lit(old)}) THEN replace({url}, {lit(old)}, {lit(new)})"
        for old, new in swaps
    )
    return f"CASE {cases} ELSE {url} END"
