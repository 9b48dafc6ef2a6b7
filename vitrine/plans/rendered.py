"""Product and category pages rendered from the ``part`` table.

The given ``pages`` hold no prices, tables, images or JSON, so the record rules
are exercised on pages whose every value comes from ``part``; the expected records
are then plain SQL over ``part``.  Rendering is a projection (product pages) and
one bounded grouping (category pages, at most 1024 parts per group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.plans.rules import Rules, default_rules
from vitrine.session import even, spread

BASE = "https://shop.example"
CDN = "https://cdn.shop.example"
HOST = "store.shop.example"
RULES: Rules = default_rules(BASE, CDN, HOST)

SHELF = "concat('shelf-', p_partkey div 1024)"
ITEM_URL = f"concat('{BASE}/', {SHELF}, '/', lower(p_type), '/', p_partkey, '.html')"
CATEGORY = f"concat({SHELF}, '/', lower(replace(p_brand, '#', '-')))"
_CODE = "concat('00', lpad(p_partkey, greatest(6, length(p_partkey)), '0'))"


def _image(number: str, size: str = "/unsafe/150x0/") -> str:
    return f"concat('{CDN}{size}https://{HOST}/', {_CODE}, '_', {number}, '.jpg')"


def _case(modulus: int, *branches: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(branches) if b)
    return f"CASE p_partkey % {modulus} {whens} ELSE '' END"


def _row(label: str, value: str) -> str:
    value = f"if(p_partkey % 7 = 1, ' ', {value})"
    return f"concat('<tr class=\"content-container\"><td>{label}</td><td>\n ', {value}, '</td></tr>')"


_NAME = "concat('\n\t', p_name, '\t#', p_partkey, ' \n')"
_R = "p_size % 6"

_PARTS = {
    "name": _case(
        3,
        f"concat('<h1>decoy</h1><h1 data-test=\"product_name\">', {_NAME}, '</h1>')",
        f"concat('<h1 class=\"big\">', {_NAME}, '</h1>')",
        f"concat('<div class=\"x product-title\">', {_NAME}, '</div>')",
    ),
    "price": _case(
        4,
        "concat('<b class=\"price\">7</b><span data-test=\"price\">', CAST(floor(p_retailprice) AS BIGINT), '.000đ</span>')",
        "concat('<span class=\"now price\">', CAST(floor(p_retailprice) AS BIGINT), '.000 đ</span>')",
        "concat('<span class=\"price\">Hết</span><p class=\"cost\">', CAST(floor(p_retailprice) AS BIGINT), '.000đ</p>')",
    ),
    "facts": _case(
        2,
        "concat('<span class=\"price-original\">', p_size, '.000đ</span>',"
        " '<b class=\"sale-badge\"> -', p_size, '% </b>',"
        " if(p_partkey % 10 = 0, '<p class=\"product-description\"></p>', ''),"
        " '<p class=\"product-detail\"> ', p_type, '\nitem</p>',"
        " '<p class=\"cach-dung\">use ', p_size, '</p>',"
        " '<i class=\"stock-status\">in <b>stock</b></i>',"
        " '<span data-test=\"unit\">Hộp</span>',"
        " '<p class=\"thanh-phan\">alt ', p_partkey, '</p>')",
    ),
    "sku": "concat('<span data-test-id=\"sku\">', lpad(p_partkey, greatest(8, length(p_partkey)), '0'), '</span>')",
    "trail": (
        "if(p_partkey % 5 = 0, '', concat('<ol class=\"breadcrumb\"><li><a href=\"/t\">', p_type,"
        " '</a></li><li><a href=\"/b\"> ', p_brand, ' </a></li></ol>'))"
    ),
    "table": "if(p_partkey % 7 = 0, '', concat('<table class=\"content-list\">', "
    + ", ".join(
        [
            _row("Tên chính hãng", "p_name"),
            _row("Số đăng ký", "concat('VD-', p_partkey)"),
            _row("Dạng bào chế", "p_type"),
            _row("Quy cách", "concat('Hộp ', p_size, ' viên')"),
            _row("Xuất xứ thương hiệu", "concat('from ', p_brand)"),
            _row("Nhà sản xuất", "concat('made by ', p_brand)"),
            _row("Nước sản xuất", "concat('land ', p_size)"),
            _row("Thành phần", "concat(p_name, ' ', p_size)"),
            f"if(p_partkey % 6 = 4, {_row('Thương hiệu', 'p_brand')}, '')",
        ]
    )
    + ", '</table>'))",
    "brand": _case(
        6,
        "concat('<script type=\"application/json\">{\"p\":[1,{\"q\":{\"brand\":\"', p_brand, '\"}}],\"manufacturer\":\"other\"}</script>')",
        "concat('<script type=\"application/json\">{\"Brand\":{\"name\":\"', p_brand, '\"}}</script>')",
        "concat('<script type=\"application/json\">{\"brandName\": \"', p_brand, '\",</script>')",
        "concat('<script type=\"application/ld+json\">{\"@type\":\"Product\",\"brand\":{\"name\":\" ', p_brand, '\"}}</script>')",
        "",
        "if(p_partkey % 12 = 5, concat('<div><b>Thương hiệu: ', p_brand, '</b></div>'),"
        " concat('<i class=\"thuong-hieu\">', p_brand, '</i>'))",
    ),
    "rating": _case(
        5,
        f"concat('<span>', {_R}, ' (x) ', p_size, ' đánh giá</span><div class=\"flex items-center\">',"
        " p_size, ' đánh giá, ', p_size * 2, ' bình luận</div>')",
        f"concat('<div class=\"flex items-center\">', {_R}, ' (', p_size, ' sao) ', p_size * 2,"
        " ' bình luận</div><i class=\"review-count\">', p_size, ' lượt</i>')",
        f"concat('<i class=\"rating\">', {_R}, '.5/5</i><i class=\"so-danh-gia\">(', p_size, ')</i>')",
        f"concat('<span>12 (x) ', {_R}, ' sao đánh giá</span>')",
    ),
    "images": _case(
        6,
        "concat('<div class=\"swiper-wrapper\"><div class=\"swiper-slide\"><img class=\"gallery-img\" srcset=\" ',"
        f" {_image('1')}, ' 1x, ', {_image('1', '/unsafe/375x0/')}, ' 2x\"></div>',"
        f" '<div class=\"swiper-slide\"><img src=\"https://{HOST}/logo/dsc_1.png\"></div>',"
        f" '<div class=\"a swiper-slide\"><img src=\" ', {_image('3')}, ' \"></div></div>')",
        "concat('<div class=\"carousel-gallery-list\"><img class=\"gallery-img\" srcset=\"',"
        f" {_image('1')}, ' 2x\"><img class=\"gallery-img\" srcset=\" ', {_image('2')}, ' 2x\"></div>')",
        "concat('<div class=\"lg-thumb-item\"><img src=\"', "
        f"{_image('1')}, '\"></div><div class=\"lg-thumb-item\"><img src=\"', {_image('1')},"
        f" '\"></div><div class=\"lg-thumb-item\"><img src=\"', {_image('2')}, '\"></div>')",
        "concat('<script type=\"application/json\">[', array_join(transform(sequence(1, p_size % 13 + 1),"
        f" i -> concat('\"', {_image('i', '/unsafe/')}, '\"')), ','), ']</script>')",
        f"concat('<img data-src=\"', {_image('1')}, '\"><img src=\"', {_image('2', '/')}, '\">')",
        f"'<img src=\"https://{HOST}/icon/dsc_1.png\" alt=\"an item\">'",
    ),
    "content": _case(
        3,
        "concat('<div data-x=\"1\" class=\"lc-wrap-content  lc-view-full-cont abc\"><script>var a=\"</p>\";</script>',"
        " '<style>p{}</style><p style=\"c\" id=\"i', p_partkey, '\">', p_name, '   &amp;\n more</p>  ',"
        " '<a href=\"/x\" onclick=\"y\">L</a><div class=\"btn cursor-pointer\">cut<b class=\"lc-overlay-detail\">z</b></div><br></div>')",
        "concat('<div class=\"inner\">', p_type, '</div><p>no</p><div class=\"inner\" title=\"t\">', p_size, ' <i>x</i></div>')",
    ),
}


def product_pages(part: DataFrame) -> DataFrame:
    """One page per part: ``page_id, url, html``."""
    body = ", ".join(_PARTS.values())
    html = (
        "concat('<!DOCTYPE html><html><head><title>', p_name, '</title></head><body>', "
        f"{body}, '</body></html>')"
    )
    return even(part, "p_partkey").selectExpr(
        "p_partkey AS page_id", f"{ITEM_URL} AS url", f"{html} AS html"
    )


def class_gallery_pages(part: DataFrame) -> DataFrame:
    """Pages whose images only a class gives away, one of three ways by ``p_partkey % 4``; the last has none.

    A srcset counts for its 2x part alone and is not trimmed; images of other hosts stand between.
    """
    away = "'<img class=\"gallery-img\" src=\"https://other.example/dsc_1.png\">'"
    ways = _case(
        4,
        f"concat('<div class=\"swiper-wrapper\"><p>', {away}, '<img class=\"gallery-img\" srcset=\"',"
        f" {_image('1')}, ' 1x,', {_image('2', '/unsafe/375x0/')}, ' 2x\" src=\"x\">"
        f"<img class=\"gallery-img\" src=\"', {_image('3', '/')}, '\"></p></div>')",
        f"concat('<div class=\"my-swiper-slide-box\"><b><img class=\"big\" src=\"', {_image('4')}, '\"></b></div>"
        f"<img class=\"my-gallery-img\" src=\"', {_image('5')}, '\">')",
        f"concat('<p><img class=\"my-gallery-img x\" src=\"', {_image('5')}, '\"><img class=\"a gallery-img\" srcset=\" ',"
        f" {_image('6')}, ' 2x\" src=\"', {_image('7')}, '\"></p>')",
        away,
    )
    return spread(part, "p_partkey").selectExpr(
        "p_partkey AS page_id", f"{ITEM_URL} AS url", f"concat('<html><body>', {ways}, '</body></html>') AS html"
    )


def category_pages(part: DataFrame) -> DataFrame:
    """One page per shelf (1024 part keys) and brand, listing its parts in key order.

    Even brands show a product grid holding the even parts, the odd ones stand
    outside; odd brands have no grid.  Every fifth link is repeated; foreign and
    listing links are mixed in.
    """
    link = (
        f"concat('<a href=\"/', {SHELF}, '/', lower(p_type), '/', p_partkey, '.html\">', p_name, '</a>')"
    )
    rows = part.selectExpr(
        f"{CATEGORY} AS category",
        "p_partkey div 1024 AS shelf",
        "CAST(substring_index(p_brand, '#', -1) AS INT) AS brand_no",
        f"named_struct('k', p_partkey, 'a', concat({link}, if(p_partkey % 5 = 0, {link}, ''),"
        f" '<a href=\"/other/x/', p_partkey, '.html\">o</a>',"
        f" '<a href=\"/', {SHELF}, '/', p_partkey, '.html?page=2\">q</a>')) AS item",
    )
    grouped = rows.groupBy("category", "shelf", "brand_no").agg(
        F.array_sort(F.collect_list("item")).alias("items")
    )
    every = "array_join(transform(items, i -> i.a), '')"
    even = "array_join(transform(filter(items, i -> i.k % 2 = 0), i -> i.a), '')"
    odd = "array_join(transform(filter(items, i -> i.k % 2 = 1), i -> i.a), '')"
    html = (
        f"if(brand_no % 2 = 0, concat('<div class=\"grid gap-2 grid-cols-2 md:grid-cols-4\">', {even},"
        f" '</div>', {odd}), concat('<nav>', {every}, '</nav>'))"
    )
    return grouped.selectExpr(
        "shelf * 100 + brand_no + 1000000000000 AS page_id",
        f"concat('{BASE}/', category) AS url",
        f"concat('<html><body>', {html}, '</body></html>') AS html",
    )


def categories(part: DataFrame) -> DataFrame:
    """``ord, category`` of all category pages."""
    return part.selectExpr("p_partkey", f"{CATEGORY} AS category").groupBy("category").agg(
        F.min("p_partkey").alias("ord")
    ).select("ord", "category")
