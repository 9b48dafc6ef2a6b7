"""Product images: an ordered union of page sources, as array expressions.

Every source turns into candidates ``struct<step, raw, script>``; the product-image
test and the size rewrite run once over all of them, then the steps are combined
under the fallback rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitrine.functions import nodes as nd
from vitrine.functions.sql import Sql, between, first, first_non_empty, let, lit
from vitrine.functions.text import non_empty, strip
from vitrine.functions.urls import contains_any, full_size_image
from vitrine.plans.rules import Rules
from vitrine.sources.htmltree import Keep
from vitrine.sources.pages import parse_usable
from vitrine.sources.parse import JSON_TYPE

# Candidate steps, in the order in which they are looked at.
CAROUSEL, OLD_GALLERY, MODAL, JSON, CLASS_1, LAST = 1, 2, 3, 4, 5, 9
STEP_NAMES = {
    1: "carousel", 2: "gallery", 3: "modal", 4: "json",
    5: "class_1", 6: "class_2", 7: "class_3", 9: "any_img",
}


def keep(rules: Rules) -> Keep:
    return nd.keep_for(
        nd.tag("img"), rules.carousel, rules.slide, rules.old_gallery, rules.modal_thumb,
        *rules.image_fallbacks, attr_names=("src", "srcset", "data-src"),
    )


def is_product_image(url: Sql, rules: Rules) -> Sql:
    """Deny words first, then the storage host and a product mark on it."""
    test = (
        f"contains(low, {lit(rules.image_host)})"
        f" AND ({contains_any('low', rules.image_marks)} OR rlike({url}, {lit(rules.image_code)}))"
        f" AND NOT {contains_any('low', rules.image_deny)}"
    )
    # bound to a variable, so the URL is lowered once and not per word
    return let("low", f"lower({url})", test)


# -- choosing a URL from one img element --------------------------------------
def _dense(parts: Sql) -> Sql:
    """First srcset candidate for 2x screens."""
    return first(f"filter({parts}, p -> contains(p, '2x'))")


def _leading(part: Sql) -> Sql:
    return f"substring_index({part}, ' ', 1)"


def _slide_url(img: str) -> Sql:
    """srcset (parts trimmed), else src; blank falls back to data-src."""
    srcset = strip(nd.attr(img, "srcset"))
    parts = f"transform(split({srcset}, ','), p -> {strip('p')})"
    best = _leading(f"coalesce({_dense(parts)}, {first(parts)})")
    chosen = f"if(coalesce({srcset}, '') <> '', {best}, {strip(nd.attr(img, 'src'))})"
    return f"coalesce({non_empty(chosen)}, {strip(nd.attr(img, 'data-src'))})"


def _gallery_url(img: str, first_part: bool) -> Sql:
    """srcset with its parts *not* trimmed, else src.

    Without a 2x part: the first part (``first_part``) or else the src.
    """
    srcset, src = nd.attr(img, "srcset"), nd.attr(img, "src")
    parts = f"split({srcset}, ',')"
    dense = strip(_leading(_dense(parts)))
    other = strip(_leading(first(parts))) if first_part else src
    return f"if(coalesce({srcset}, '') <> '', coalesce({dense}, {other}), {src})"


def _any_url(img: str) -> Sql:
    return f"coalesce({non_empty(nd.attr(img, 'src'))}, {nd.attr(img, 'data-src')})"


# -- candidates ---------------------------------------------------------------
def _candidate(step: int, raw: Sql, script: Sql = "CAST(NULL AS INT)") -> Sql:
    return f"named_struct('step', {step}, 'raw', {raw}, 'script', {script})"


def _in_first(sel: nd.Sel, inner: nd.Sel) -> Sql:
    """Nodes matching ``inner`` below the first match of ``sel``."""
    below = f"filter(nodes, i -> {inner.on('i')} AND {nd.within('i', 'b')})"
    return f"flatten(transform(slice({nd.find_all(sel)}, 1, 1), b -> {below}))"


def candidates(rules: Rules) -> Sql:
    """Accepted candidates of all steps, in step then document order (over ``_imgs``)."""
    inner = between("_imgs", "s.pre + 1", "s.last + 1", ".pre")
    marked = first(f"filter(ins, g -> {rules.gallery_image.on('g')})")
    best = let("ins", inner, f"coalesce({marked}, {first('ins')})")
    picked = f"filter(transform({_in_first(rules.carousel, rules.slide)}, s -> {best}), m -> m IS NOT NULL)"
    pattern = (
        "(?iu)" + rules.image_cdn.replace(".", r"\.")
        + f'/[^"]*(?:DSC_|{rules.image_code})[^"]*\\.(?:jpg|jpeg|png|webp)'
    )
    scripts = f"filter(nodes, s -> s.tag = 'script' AND {nd.attr('s', 'type')} = {lit(JSON_TYPE)})"
    found = f"regexp_extract_all(s.text, {lit(pattern)}, 0)"
    parts = [
        f"transform({picked}, m -> {_candidate(CAROUSEL, _slide_url('m'))})",
        f"transform({_in_first(rules.old_gallery, rules.gallery_image)},"
        f" m -> {_candidate(OLD_GALLERY, _gallery_url('m', True))})",
        f"transform({nd.find_all(rules.modal_thumb)}, s -> {_candidate(MODAL, nd.attr(first(inner), 'src'))})",
        f"flatten(transform({scripts}, s -> transform({found}, u -> {_candidate(JSON, 'u', 's.pre')})))",
    ]
    for k, sel in enumerate(rules.image_fallbacks):
        parts.append(
            f"transform({nd.find_all(sel, 'n', '_imgs')}, m -> {_candidate(CLASS_1 + k, _gallery_url('m', False))})"
        )
    parts.append(f"transform(_imgs, m -> {_candidate(LAST, _any_url('m'))})")
    return f"filter(concat({', '.join(parts)}), c -> {is_product_image('c.raw', rules)})"


def _shown(c: str) -> Sql:
    return f"named_struct('url', {full_size_image(c + '.raw')}, 'step', {c}.step)"


def _step(number: int) -> Sql:
    return f"transform(filter(_candidates, c -> c.step = {number}), c -> {_shown('c')})"


def gallery(rules: Rules) -> Sql:
    """Carousel, else the old gallery; modal thumbs are always added."""
    return f"concat({first_non_empty([_step(CAROUSEL), _step(OLD_GALLERY)])}, {_step(MODAL)})"


def choose(rules: Rules) -> Sql:
    """``array<struct<url, step>>``: the fallback rules over ``_candidates`` and ``_gallery``."""
    fallbacks = [_step(CLASS_1 + k) for k in range(len(rules.image_fallbacks))]
    return first_non_empty([_with_embedded(rules), *fallbacks, _step(LAST)])


def _with_embedded(rules: Rules) -> Sql:
    """Append JSON images to a short gallery; each script stops once the list is long."""
    short = "true" if rules.json_image_min is None else f"size(_gallery) < {rules.json_image_min}"
    embedded = f"filter(_candidates, c -> c.step = {JSON} AND {short})"
    known = "exists(s.found, x -> x.url = c.raw)"
    full = "false" if rules.json_image_stop is None else f"size(s.found) + 1 >= {rules.json_image_stop}"
    add = (
        f"if(c.script = s.done OR {known}, s, named_struct('found', concat(s.found, array({_shown('c')})),"
        f" 'done', if({full}, c.script, s.done)))"
    )
    start = "named_struct('found', _gallery, 'done', -1)"
    return f"aggregate({embedded}, {start}, (s, c) -> {add}, s -> s.found)"


def image_urls(chosen: Sql = "_images") -> Sql:
    """Distinct URLs, first occurrence kept."""
    return f"array_distinct(transform({chosen}, x -> x.url))"


def product_images(pages: DataFrame, rules: Rules) -> DataFrame:
    """Long form: ``url, pos, image_url, source_step``, one row per distinct image."""
    from vitrine.operators.products import parse_for

    parsed = parse_for(pages, rules, ("images",), ("url",))
    names = " ".join(f"WHEN {number} THEN {lit(name)}" for number, name in STEP_NAMES.items())
    return (
        parsed.selectExpr("url", "_images", "transform(_images, x -> x.url) AS _urls")
        .selectExpr(
            "url",
            "posexplode(filter(_images, (x, i) -> array_position(_urls, x.url) = i + 1)) AS (pos, image)",
        )
        .selectExpr("url", "pos", "image.url AS image_url", f"CASE image.step {names} END AS source_step")
    )


def gallery_counts(pages: DataFrame, rules: Rules) -> DataFrame:
    """Slides, gallery images and thumbs found per page."""
    return parse_usable(pages, keep(rules), with_text=False).selectExpr(
        "page_id",
        "url",
        f"size({_in_first(rules.carousel, rules.slide)}) AS slides",
        f"size({_in_first(rules.old_gallery, rules.gallery_image)}) AS gallery_images",
        f"size({nd.find_all(rules.modal_thumb)}) AS thumbs",
    )
