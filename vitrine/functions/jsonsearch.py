"""Document-order search in embedded JSON (needs key order, so not a Spark type).

Spark's VARIANT sorts object keys and a MAP would merge types; both lose the
document order that decides which hit is first.  The helper runs inside the parse
step on the bodies of JSON script elements only.
"""

from __future__ import annotations

import json


def first_hit(data, key_parts):
    """First value found under a key containing one of ``key_parts``.

    Objects and lists are walked depth first, in document order.  A string under
    a matching key, or the ``name`` of an object under one, is a hit.  An empty
    hit ends its own object only; the search goes on behind that object.
    """
    trail = [_children(data)]
    while trail:
        for key, value in trail[-1]:
            if key is not None and _matches(key, key_parts):
                hit = None
                if isinstance(value, str):
                    hit = (value,)
                elif isinstance(value, dict) and "name" in value:
                    hit = (value["name"],)
                if hit is not None:
                    if hit[0]:
                        return hit[0]
                    trail.pop()
                    break
            if isinstance(value, (dict, list)):
                trail.append(_children(value))
                break
        else:
            trail.pop()
    return None


def _children(value):
    if isinstance(value, dict):
        return iter(value.items())
    if isinstance(value, list):
        return ((None, item) for item in value)
    return iter(())


def _matches(key, key_parts):
    low = key.lower()
    return any(part in low for part in key_parts)


def search_script(body: str, key_parts):
    """``(value, failed)`` for one script body.

    ``failed`` is set for unparsable JSON and for a hit that is not a string.
    """
    try:
        hit = first_hit(json.loads(body), key_parts)
    except (ValueError, RecursionError):
        return None, True
    if not hit:
        return None, False
    if not isinstance(hit, str):
        return None, True
    return hit.encode("utf-8", "replace").decode("utf-8"), False
