"""Expected results as plain SQL for DuckDB, keyed like ``queries.QUERIES``.

The SQL never parses a rendered page: it states, from the same table columns, what
extraction must give.  For the given ``pages`` it uses regular expressions.
"""

from __future__ import annotations

from vitrine.plans.queries import CORE, KEYWORDS, RATED, TABLED
from vitrine.plans.rendered import BASE, CDN, HOST, RULES


def _decoded(text: str) -> str:
    """HTML references that occur in the given pages, decoded."""
    for name, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return text


def _cleaned(text: str) -> str:
    spaces = "' ' || chr(9) || chr(10) || chr(13)"
    return f"translate(trim({text}, {spaces}), chr(10) || chr(13) || chr(9), '   ')"


# -- given pages --------------------------------------------------------------
_LINK_LISTS = """
  SELECT page_id, url AS page_url,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)', 1) AS hrefs,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)', 2) AS texts
  FROM pages"""
_LINKS = f"""
  SELECT page_id, page_url, pos, href, link_text,
         CASE WHEN href LIKE '/%' THEN '{BASE}' || href ELSE href END AS url
  FROM (SELECT page_id, page_url, CAST(pos AS INTEGER) AS pos,
               {_decoded('href')} AS href, trim({_decoded('link_text')}) AS link_text
        FROM (SELECT page_id, page_url, generate_subscripts(hrefs, 1) - 1 AS pos,
                     unnest(hrefs) AS href, unnest(texts) AS link_text
              FROM ({_LINK_LISTS})))"""
_SECTION = "regexp_extract(page_url, '^https?://[^/]+/([^/?#]+)', 1)"
_SITE = "regexp_extract(url, '^https?://([^/]+/[^/?#]+)', 1)"
_H1 = _cleaned(_decoded("regexp_extract(html, '<h1>([^<]*)', 1)"))

_KEYED = " UNION ALL ".join(
    f"SELECT {i} AS keyword_ord, '{word}' AS keyword" for i, word in enumerate(KEYWORDS)
)
_KEYWORD_HITS = f"""
  SELECT page_id, keyword_ord, keyword, pos, url, substr(link_text, 1, 50) AS text,
         row_number() OVER (PARTITION BY page_id, keyword ORDER BY pos) AS nth
  FROM ({_LINKS}), ({_KEYED}) WHERE contains(lower(href), keyword)"""


def _top(part: str, text_test: str) -> str:
    return f"""
  SELECT 1000000000 - page_id AS ord, page_id, pos, url, link_text
  FROM ({_LINKS}) WHERE {part} AND {text_test} ORDER BY ord, page_id, pos LIMIT 1"""


_PAGE_SQL = {
    "page_titles": f"""
  SELECT page_id, {_decoded("regexp_extract(html, '<title>([^<]*)', 1)")} AS title FROM pages""",
    "h1_names": f"SELECT page_id, {_H1} AS name FROM pages",
    "stream_ingest": f"SELECT page_id, {_H1} AS name FROM pages",
    "links_all": f"SELECT page_id, pos, href FROM ({_LINKS})",
    "links_absolute": f"SELECT page_id, pos, url FROM ({_LINKS})",
    "links_distinct": f"""
  SELECT url, page_id, pos FROM ({_LINKS})
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, pos) = 1""",
    "item_urls": """
  SELECT page_id, url FROM pages
  WHERE url LIKE '%.html' AND NOT contains(url, '?') AND NOT contains(url, '#')
    AND NOT contains(url, 'page=') AND NOT contains(url, 'sort=')
    AND len(string_split(replace(url, 'https://', ''), '/')) >= 3""",
    "links_top_n": f"""
  SELECT {_SECTION} AS section, page_id, pos, href FROM ({_LINKS})
  QUALIFY row_number() OVER (PARTITION BY {_SECTION} ORDER BY page_id, pos) <= 3""",
    "links_top_many": f"""
  SELECT 'all' AS scope, page_id, pos, href FROM ({_LINKS}) ORDER BY page_id, pos LIMIT 1200""",
    "category_counts": f"""
  SELECT category, CAST(count(*) AS BIGINT) AS items
  FROM pages JOIN (SELECT DISTINCT {_SITE} AS category FROM pages) ON contains(url, category)
  GROUP BY category""",
    "parse_quarantine": """
  SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'no html' ELSE 'status 404' END AS reason
  FROM pages WHERE page_id % 7 = 0 OR page_id % 11 = 3""",
    "keyword_links": f"""
  SELECT page_id, CAST(keyword_ord AS INTEGER) AS keyword_ord, keyword,
         CAST(count(*) AS INTEGER) AS links,
         string_agg(text || '->' || url, '|' ORDER BY pos) FILTER (WHERE nth <= 5) AS samples
  FROM ({_KEYWORD_HITS}) GROUP BY page_id, keyword_ord, keyword""",
    "first_item_links": f"""
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY keyword_ord, nth) - 1 AS INTEGER) AS pos,
         url, text
  FROM ({_KEYWORD_HITS}) WHERE nth <= 5
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY keyword_ord, nth) <= 5""",
    "selector_profile": """
  SELECT selector, CAST(sum(n) AS BIGINT) AS elements, CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS pages_hit,
         CASE WHEN selector IN ('div.ad', '[class*="a"]') THEN 'ad' END AS example
  FROM (SELECT 'p' AS selector, len(regexp_extract_all(html, '<p>')) AS n FROM pages
        UNION ALL SELECT 'div.ad', len(regexp_extract_all(html, '<div class="ad">')) FROM pages
        UNION ALL SELECT 'ul > li', len(regexp_extract_all(html, '<li>')) FROM pages
        UNION ALL SELECT '[class*="a"]', len(regexp_extract_all(html, ' class="[^"]*a[^"]*"')) FROM pages)
  GROUP BY selector""",
    "first_candidate": _top(
        "(contains(href, '/th') OR contains(href, '/st')) AND NOT contains(url, '/the?') AND NOT contains(url, '/that')",
        "length(link_text) > 5 AND length(link_text) < 100",
    ),
    "first_search_hit": _top("contains(href, 'th')", "length(link_text) > 10"),
    "clean_text": f"SELECT doc_id, {_cleaned('text')} AS cleaned FROM documents",
    "price_parse": """
  SELECT o_orderkey, CAST(regexp_replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '[^0-9]', '', 'g') AS DOUBLE) AS price
  FROM orders""",
}

# -- taxonomy and labels ------------------------------------------------------
_TAXONOMY = """
  SELECT lower(p_type) AS main, lower(replace(p_brand, '#', '-')) AS mid,
         CASE WHEN p_size = 50 THEN ' ' ELSE replace(p_name, ' ', '-') END AS leaf,
         min(p_partkey) AS ord
  FROM part GROUP BY 1, 2, 3"""
_TAXONOMY_SQL = {
    "taxonomy_paths": f"""
  SELECT ord, CASE WHEN main = 'small' THEN main || '/' || mid || '/' || leaf ELSE main || '/' || leaf END AS category,
         '/' || main || '/' AS head
  FROM ({_TAXONOMY}) WHERE leaf <> ' '""",
    "taxonomy_preset": f"""
  SELECT ord, main || '/' || leaf AS category FROM ({_TAXONOMY})
  WHERE main = 'economy' AND mid = 'brand-7' AND leaf <> ' '""",
    "taxonomy_mains": f"SELECT main AS category, min(ord) AS ord FROM ({_TAXONOMY}) GROUP BY main",
    "run_label_mixed": """
  SELECT 'multiple_' || count(DISTINCT lower(p_type) || '/' || p_brand) || '_categories' AS label FROM part""",
    "run_label_one_main": "SELECT 'all_items_multiple' AS label",
}

# -- records on rendered pages ------------------------------------------------
_SHELF = "'shelf-' || (p_partkey // 1024)"
_URL = f"'{BASE}/' || {_SHELF} || '/' || lower(p_type) || '/' || p_partkey || '.html'"
_CATEGORY = f"{_SHELF} || '/' || lower(replace(p_brand, '#', '-'))"
_CODE = "'00' || lpad(CAST(p_partkey AS VARCHAR), greatest(6, length(CAST(p_partkey AS VARCHAR)))::INT, '0')"
_FULL = f"'{CDN}/unsafe/768x0/https://{HOST}/' || {_CODE}"
_EVEN, _TABLE = "p_partkey % 2 = 0", "p_partkey % 7 > 1"


def _given(value: str, test: str = _EVEN, missing: str = "''") -> str:
    return f"CASE WHEN {test} THEN {value} ELSE {missing} END"


_RECORD = {
    "url": _URL,
    "name": "p_name || ' #' || p_partkey",
    "price": _given("CAST(floor(p_retailprice) AS DOUBLE) * 1000", "p_partkey % 4 < 3", "0.0::DOUBLE"),
    "unit": _given("'Hộp'"),
    "sku": "lpad(CAST(p_partkey AS VARCHAR), greatest(8, length(CAST(p_partkey AS VARCHAR)))::INT, '0')",
    "rating": """CAST(CASE p_partkey % 5 WHEN 2 THEN (p_size % 6) * 10 + 5 WHEN 4 THEN 0 ELSE p_size % 6 END AS DOUBLE)""",
    "reviews_count": "CAST(CASE WHEN p_partkey % 5 < 3 THEN p_size ELSE 0 END AS BIGINT)",
    "comments_count": "CAST(CASE WHEN p_partkey % 5 < 2 THEN p_size * 2 ELSE 0 END AS BIGINT)",
    "brand": f"CASE WHEN p_partkey % 6 <> 4 OR {_TABLE} THEN p_brand ELSE '' END",
    "official_name": _given("p_name", _TABLE),
    "category": _given("p_type || ' > ' || p_brand", "p_partkey % 5 <> 0"),
    "registration_number": _given("'VD-' || p_partkey", _TABLE),
    "form": _given("p_type", _TABLE),
    "package_size": _given("'Hộp ' || p_size || ' viên'", _TABLE),
    "origin_brand": _given("'from ' || p_brand", _TABLE),
    "manufacturer": _given("'made by ' || p_brand", _TABLE),
    "country_of_manufacture": _given("'land ' || p_size", _TABLE),
    "ingredients": _given("p_name || ' ' || p_size", _TABLE, _given("'alt ' || p_partkey")),
    "images": f"array_to_string(list_transform(image_list, lambda x: x.image_url), '|')",
    "content": """CASE p_partkey % 3
      WHEN 0 THEN '<div class="lc-wrap-content lc-view-full-cont abc"><p id="i' || p_partkey || '">' || p_name
        || ' &amp; more</p><a href="/x">L</a><br/></div>'
      WHEN 1 THEN '<div class="inner">' || p_type || '</div><div class="inner">' || p_size || ' <i>x</i></div>'
      ELSE '' END""",
    "original_price": _given("CAST(p_size AS DOUBLE) * 1000", missing="0.0::DOUBLE"),
    "discount": _given("'-' || p_size || '%'"),
    "description": _given("p_type || ' item'", "p_partkey % 2 = 0 AND p_partkey % 10 <> 0"),
    "usage": _given("'use ' || p_size"),
    "availability": _given("'in stock'"),
}
_IMAGE = "{{'image_url': {url}, 'source_step': '{step}'}}"


def _images(step: str, *names: str) -> str:
    return "[" + ", ".join(_IMAGE.format(url=name, step=step) for name in names) + "]"


_IMAGE_LIST = f"""CASE p_partkey % 6
    WHEN 0 THEN {_images('carousel', f"{_FULL} || '_1.jpg'", f"{_FULL} || '_3.jpg'")}
    WHEN 1 THEN {_images('gallery', f"{_FULL} || '_1.jpg'")}
    WHEN 2 THEN {_images('modal', f"{_FULL} || '_1.jpg'", f"{_FULL} || '_2.jpg'")}
    WHEN 3 THEN list_transform(range(1, least(p_size % 13 + 1, 10) + 1), lambda i:
      {{'image_url': '{CDN}/unsafe/768x0/filters:quality(90)/https://{HOST}/' || {_CODE} || '_' || i || '.jpg',
        'source_step': 'json'}})
    WHEN 4 THEN {_images('any_img', f"{_FULL} || '_1.jpg'", f"'{CDN}/https://{HOST}/' || {_CODE} || '_2.jpg'")}
    ELSE [] END"""
_PART = f"(SELECT *, {_IMAGE_LIST} AS image_list FROM part)"


def _record(*fields: str) -> str:
    return f"SELECT {', '.join(f'{_RECORD[f]} AS {f}' for f in ('url', *fields))} FROM {_PART}"


_PRODUCTS = _record(*[f for f in _RECORD if f != "url"])
_FILLED = {name: "<> 0" if name in ("price", "rating", "reviews_count", "comments_count", "original_price")
           else "<> ''" for name in _RECORD}
_RECORD_SQL = {
    "products_core": _record(*CORE),
    "products_rating": _record(*RATED),
    "products_table": _record(*TABLED),
    "products_brand": _record("brand"),
    "product_images": _record("images"),
    "product_content": _record("content"),
    "products_full": _PRODUCTS,
    "product_images_long": f"""
  SELECT url, CAST(pos AS INTEGER) AS pos, image.image_url AS image_url, image.source_step AS source_step
  FROM (SELECT {_URL} AS url, generate_subscripts(image_list, 1) - 1 AS pos, unnest(image_list) AS image FROM {_PART})""",
    "runs_appended": f"{_record('name', 'sku')} UNION ALL {_record('name', 'sku')}",
    "sink_roundtrip": " UNION ALL ".join(
        f"SELECT '{fmt}' AS format, * FROM ({_record('name', 'price', 'reviews_count', 'images', 'content')})"
        for fmt in ("parquet", "json", "csv")
    ),
    "fill_rate": " UNION ALL ".join(
        f"SELECT '{name}' AS field, CAST(count(*) AS BIGINT) AS records,"
        f" CAST(count(*) FILTER (WHERE {name} {test}) AS BIGINT) AS filled FROM ({_PRODUCTS})"
        for name, test in _FILLED.items()
    ),
    "rule_wins": """
  SELECT field, CAST(rule_idx AS INTEGER) AS rule_idx, selector, CAST(count(*) AS BIGINT) AS pages FROM (
    SELECT 'name' AS field, p_partkey % 3 AS rule_idx,
           ['h1[data-test="product_name"]', 'h1', '.product-title'][p_partkey % 3 + 1] AS selector FROM part
    UNION ALL SELECT 'price', [0, 1, 3][p_partkey % 4 + 1],
           ['span[data-test="price"]', '.price', '.cost'][p_partkey % 4 + 1] FROM part WHERE p_partkey % 4 < 3
    UNION ALL SELECT 'original_price', 0, '.price-original' FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT 'unit', 0, 'span[data-test="unit"]' FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT 'sku', 0, 'span[data-test-id="sku"]' FROM part
    UNION ALL SELECT 'discount', 1, '.sale-badge' FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT 'description', 0, '.product-description' FROM part WHERE p_partkey % 10 = 0
    UNION ALL SELECT 'description', 2, '.product-detail' FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 10 <> 0
    UNION ALL SELECT 'usage', 1, '.cach-dung' FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT 'availability', 1, '.stock-status' FROM part WHERE p_partkey % 2 = 0)
  GROUP BY field, rule_idx, selector""",
    "gallery_counts": """
  SELECT p_partkey AS page_id,
         CAST(CASE p_partkey % 6 WHEN 0 THEN 3 ELSE 0 END AS INTEGER) AS slides,
         CAST(CASE p_partkey % 6 WHEN 1 THEN 2 ELSE 0 END AS INTEGER) AS gallery_images,
         CAST(CASE p_partkey % 6 WHEN 2 THEN 3 ELSE 0 END AS INTEGER) AS thumbs
  FROM part""",
    "image_report": f"""
  SELECT p_partkey AS page_id,
         CAST(CASE WHEN p_partkey % 6 IN (0, 2, 4, 5) THEN 1 ELSE 0 END AS INTEGER) AS images,
         CASE p_partkey % 6
           WHEN 0 THEN 'No alt->https://{HOST}/logo/dsc_1.png'
           WHEN 2 THEN 'No alt->{CDN}/unsafe/150x0/https://{HOST}/' || {_CODE} || '_2.jpg'
           WHEN 4 THEN 'No alt->{CDN}/https://{HOST}/' || {_CODE} || '_2.jpg'
           WHEN 5 THEN 'an item->https://{HOST}/icon/dsc_1.png'
           ELSE '' END AS samples
  FROM part""",
    "embedded_scripts": f"""
  SELECT p_partkey AS page_id, CAST(0 AS INTEGER) AS pos, CASE p_partkey % 6
    WHEN 0 THEN '{{"p":[1,{{"q":{{"brand":"' || p_brand || '"}}}}],"manufacturer":"other"}}'
    WHEN 1 THEN '{{"Brand":{{"name":"' || p_brand || '"}}}}'
    WHEN 2 THEN '{{"brandName": "' || p_brand || '",'
    ELSE '[' || array_to_string(list_transform(range(1, p_size % 13 + 2), lambda i:
      '"{CDN}/unsafe/https://{HOST}/' || {_CODE} || '_' || i || '.jpg"'), ',') || ']' END AS body
  FROM part WHERE p_partkey % 6 < 4""",
}
_PROBE_TITLE = """
    SELECT p_partkey AS page_id, 'title' AS field, CASE WHEN p_partkey % 3 < 2 THEN 0 ELSE {fallback} END AS selector_ord,
           CASE WHEN p_partkey % 3 < 2 THEN 'h1' ELSE '.product-title' END AS selector,
           CASE WHEN p_partkey % 3 = 0 THEN 'decoy' ELSE p_name || chr(9) || '#' || p_partkey END AS content FROM part"""
_PROBE_PRICE = """
    SELECT p_partkey, 'price', 0, '.price', CASE p_partkey % 4 WHEN 0 THEN '7' WHEN 2 THEN 'Hết'
           ELSE CAST(floor(p_retailprice) AS BIGINT) || '.000 đ' END FROM part WHERE p_partkey % 4 < 3"""
_THUMB = f"'{CDN}/unsafe/150x0/https://{HOST}/' || {_CODE} || '_1.jpg'"
_PROBE_B_ROWS = f"""
  {_PROBE_TITLE.format(fallback=1)} UNION ALL {_PROBE_PRICE}
  UNION ALL SELECT p_partkey, 'price', 4, '[class*="gia"]', '(' || p_size || ')'
  FROM part WHERE p_partkey % 4 = 3 AND p_partkey % 5 = 2
  UNION ALL SELECT p_partkey, 'image', 5, 'img', CASE p_partkey % 6
    WHEN 2 THEN {_THUMB} WHEN 4 THEN {_THUMB} WHEN 5 THEN 'https://{HOST}/icon/dsc_1.png' ELSE 'No src' END
  FROM part WHERE p_partkey % 6 <> 3"""
_PROBE_COLUMNS = "page_id, field, CAST(selector_ord AS INTEGER) AS selector_ord, selector, content"
_PROBE_SQL = {
    "selector_first_hit": f"""
  SELECT {_PROBE_COLUMNS} FROM ({_PROBE_TITLE.format(fallback=2)} UNION ALL {_PROBE_PRICE})""",
    "selector_first_text": f"SELECT {_PROBE_COLUMNS} FROM ({_PROBE_B_ROWS})",
    "selector_coverage": f"""
  SELECT field, CAST(selector_ord AS INTEGER) AS selector_ord, selector, CAST(count(*) AS BIGINT) AS pages
  FROM ({_PROBE_B_ROWS}) GROUP BY ALL""",
}

# Which rule wins where: field, rule number, label, test over ``part``.
_WINS = [
    ("name", 0, 'h1[data-test="product_name"]', "p_partkey % 3 = 0"),
    ("name", 1, "h1", "p_partkey % 3 = 1"),
    ("name", 2, ".product-title", "p_partkey % 3 = 2"),
    ("price", 0, 'span[data-test="price"]', "p_partkey % 4 = 0"),
    ("price", 1, ".price", "p_partkey % 4 = 1"),
    ("price", 3, ".cost", "p_partkey % 4 = 2"),
    ("original_price", 0, ".price-original", _EVEN),
    ("unit", 0, 'span[data-test="unit"]', _EVEN),
    ("sku", 0, 'span[data-test-id="sku"]', "true"),
    ("discount", 1, ".sale-badge", _EVEN),
    ("description", 0, ".product-description", "p_partkey % 10 = 0"),
    ("description", 2, ".product-detail", f"{_EVEN} AND p_partkey % 10 <> 0"),
    ("usage", 1, ".cach-dung", _EVEN),
    ("availability", 1, ".stock-status", _EVEN),
    ("category", 0, ".breadcrumb", "p_partkey % 5 <> 0"),
    ("ingredients", 0, "table: Thành phần", _TABLE),
    ("ingredients", 3, ".thanh-phan", f"{_EVEN} AND NOT {_TABLE}"),
    ("brand", 0, "json", "p_partkey % 6 < 2"),
    ("brand", 1, "json text", "p_partkey % 6 = 2"),
    ("brand", 2, "linked json", "p_partkey % 6 = 3"),
    ("brand", 3, "table: Thương hiệu", f"p_partkey % 6 = 4 AND {_TABLE}"),
    ("brand", 4, "inline: Thương hiệu:", "p_partkey % 12 = 5"),
    ("brand", 7, ".thuong-hieu", "p_partkey % 12 = 11"),
    ("rating", 0, "near: (", "p_partkey % 5 = 0"),
    ("rating", 1, "near: sao", "p_partkey % 5 = 3"),
    ("rating", 3, 'div[class="flex items-center"]', "p_partkey % 5 = 1"),
    ("rating", 4, ".rating", "p_partkey % 5 = 2"),
    ("reviews_count", 0, 'div[class="flex items-center"]', "p_partkey % 5 = 0"),
    ("reviews_count", 2, ".review-count", "p_partkey % 5 = 1"),
    ("reviews_count", 3, ".so-danh-gia", "p_partkey % 5 = 2"),
    ("comments_count", 0, 'div[class="flex items-center"]', "p_partkey % 5 < 2"),
    ("images", 0, "carousel", "p_partkey % 6 = 0"),
    ("images", 1, "gallery", "p_partkey % 6 = 1"),
    ("images", 2, "modal", "p_partkey % 6 = 2"),
    ("images", 3, "json", "p_partkey % 6 = 3"),
    ("images", 8, "any_img", "p_partkey % 6 = 4"),
    ("content", 0, "content", "p_partkey % 3 = 0"),
    ("content", 2, "div.inner", "p_partkey % 3 = 1"),
    *[(field, 0, f"table: {label}", "p_partkey % 7 <> 0") for field, label in RULES.table_labels],
]
_RECORD_SQL["rule_wins_all"] = " UNION ALL ".join(
    f"SELECT '{field}' AS field, CAST({number} AS INTEGER) AS rule_idx, '{rule}' AS rule, count(*) AS pages"
    f" FROM part WHERE {test} HAVING count(*) > 0"
    for field, number, rule, test in _WINS
)

# -- records together with failures --------------------------------------------
_NO_PAGE, _BAD_STATUS = "p_partkey % 13 = 5", "p_partkey % 17 = 3"
_OUTCOMES = f"""
  SELECT 'record' AS kind, {', '.join(f'{_RECORD[f]} AS {f}' for f in ('url', 'name', 'price', 'brand', 'images', 'content'))},
         '2025-01-01 00:00:00' AS crawled_at, NULL::VARCHAR AS reason
  FROM {_PART} WHERE NOT ({_NO_PAGE} OR {_BAD_STATUS})
  UNION ALL
  SELECT 'failure', {_URL}, NULL, NULL, NULL, NULL, NULL, NULL,
         CASE WHEN {_NO_PAGE} THEN 'no html' ELSE 'status 404' END
  FROM part WHERE {_NO_PAGE} OR {_BAD_STATUS}"""
_OUTCOME_SQL = {"records_and_failures": _OUTCOMES, "stream_records": _OUTCOMES}

# -- category pages -----------------------------------------------------------
_LISTED = f"""
  SELECT *, {_CATEGORY} AS category, {_URL} AS url,
         row_number() OVER (PARTITION BY {_CATEGORY} ORDER BY p_partkey) AS nth
  FROM part
  WHERE CAST(split_part(p_brand, '#', 2) AS INTEGER) % 2 = 1 OR p_partkey % 2 = 0"""
_CATEGORY_SQL = {
    "category_links": f"SELECT category, CAST(nth - 1 AS INTEGER) AS pos, url FROM ({_LISTED})",
    "links_followed": f"""
  SELECT category, CAST(nth - 1 AS INTEGER) AS pos, url, {_RECORD['name']} AS name FROM ({_LISTED})""",
    "links_followed_salted": f"""
  SELECT p_partkey AS page_id,
         CASE WHEN p_partkey % 3 = 0 THEN '{BASE}/shelf-0/hub/0.html' ELSE {_URL} END AS url,
         CASE WHEN p_partkey % 3 = 0 THEN 'hub of ' || (SELECT count(*) FROM part) ELSE {_RECORD['name']} END AS name
  FROM part""",
    "category_catalogue": f"""
  SELECT category AS listed_in, CAST(nth - 1 AS INTEGER) AS listed_pos, url, {_RECORD['name']} AS name, {_RECORD['price']} AS price,
         {_RECORD['brand']} AS brand, {_RECORD['official_name']} AS official_name
  FROM ({_LISTED}) WHERE nth <= 3""",
    "catalogue_run": f"""
  WITH seeds AS (SELECT DISTINCT {_CATEGORY} AS category FROM part),
       listed AS (SELECT category, count(*) AS items FROM ({_LISTED}) WHERE nth <= 5 GROUP BY category),
       total AS (SELECT CAST(sum(items) AS BIGINT) AS n FROM listed),
       label AS (SELECT CASE WHEN count(DISTINCT split_part(category, '/', 1)) = 1
                   THEN replace(min(split_part(category, '/', 1)) || '_multiple', '-', '_')
                   ELSE 'multiple_' || count(*) || '_categories' END AS label FROM seeds)
  SELECT 'products_' || label || '_20250101_000000' AS run, n AS n_parquet, n AS n_json, n AS n_csv,
         category, coalesce(items, 0) AS items
  FROM seeds LEFT JOIN listed USING (category), total, label""",
    "category_catalogue_all": f"""
  SELECT category AS listed_in, CAST(nth - 1 AS INTEGER) AS listed_pos, url, {_RECORD['name']} AS name, {_RECORD['price']} AS price,
         {_RECORD['brand']} AS brand, {_RECORD['official_name']} AS official_name
  FROM ({_LISTED})""",
}

_OTHER_SQL = {
    "keyword_links_table": f"""
  WITH words AS (SELECT keyword, min(page_id) AS keyword_ord FROM (
         SELECT page_id, unnest(regexp_extract_all(lower(regexp_extract(html, '<title>([^<]*)', 1)), '[a-z]{{3,}}')) AS keyword FROM pages)
         GROUP BY keyword),
       hits AS (SELECT page_id, keyword_ord, keyword, pos, url, substr(link_text, 1, 50) AS text,
                  row_number() OVER (PARTITION BY page_id, keyword ORDER BY pos) AS nth
                FROM ({_LINKS}), words WHERE contains(lower(href), keyword))
  SELECT page_id, keyword_ord, keyword, CAST(count(*) AS INTEGER) AS links,
         string_agg(text || '->' || url, '|' ORDER BY pos) FILTER (WHERE nth <= 5) AS samples
  FROM hits GROUP BY page_id, keyword_ord, keyword""",
    "products_custom": f"""
  SELECT {_URL} AS url, p_name AS name,
         CASE WHEN {_EVEN} THEN '-' || p_size || '%' ELSE {_RECORD['sku']} END AS sku,
         {_RECORD['package_size']} AS country_of_manufacture,
         {_RECORD['price']} >= 1500000 AS dear, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words, '2025-01-01' AS day
  FROM part""",
    "product_images_by_class": f"""
  SELECT {_URL} AS url, CAST(pos AS INTEGER) AS pos, {_CODE} || '_' || file || '.jpg' AS file, source_step
  FROM part JOIN (VALUES (0, 0, '2', 'class_1'), (0, 1, '3', 'class_1'), (1, 0, '4', 'class_2'), (2, 0, '5', 'class_3'))
    AS w(way, pos, file, source_step) ON p_partkey % 4 = way""",
    "empty_run": f"""
  SELECT DISTINCT {_CATEGORY} AS category, CAST(0 AS BIGINT) AS items, CAST(0 AS INTEGER) AS formats, false AS folder_left
  FROM part""",
}
_CATEGORY_SQL["catalogue_resumed"] = _CATEGORY_SQL["category_catalogue_bucketed"] = _CATEGORY_SQL["category_catalogue"]

ORACLES: dict[str, str] = {**_PAGE_SQL, **_TAXONOMY_SQL, **_RECORD_SQL, **_PROBE_SQL, **_CATEGORY_SQL, **_OUTCOME_SQL, **_OTHER_SQL}
