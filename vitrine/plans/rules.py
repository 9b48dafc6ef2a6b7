"""Extraction rules: what to look for on a page, as data.

``default_rules(base_url, image_cdn, image_host)`` holds the values of one known shop layout;
every entry is a constructor argument of :class:`Rules`, so another site needs
other values, not other code.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from vitrine.functions.nodes import Sel, attr_head, attr_is, cls, cls_part, tag


@dataclass(frozen=True)
class Rules:
    """All rules of one site.  Chains are tried in order."""

    base_url: str
    image_cdn: str
    image_host: str  # storage host of product images

    # Selector chains of the record's simple text fields.
    name: tuple[Sel, ...] = (
        attr_is("h1", "data-test", "product_name"),
        tag("h1"), cls("product-title"), cls("product-name"), cls("title"),
    )
    price: tuple[Sel, ...] = (
        attr_is("span", "data-test", "price"),
        cls("price"), cls_part("price"), cls("cost"), cls("gia"),
        cls_part("price", of="span"), cls_part("price", of="div"),
    )
    original_price: tuple[Sel, ...] = (cls("price-original"), cls("price-old"), cls("original-price"))
    unit: tuple[Sel, ...] = (attr_is("span", "data-test", "unit"),)
    sku: tuple[Sel, ...] = (attr_is("span", "data-test-id", "sku"),)
    discount: tuple[Sel, ...] = (cls("discount-percent"), cls("sale-badge"), cls("discount"))
    description: tuple[Sel, ...] = (cls("product-description"), cls("description"), cls("product-detail"))
    ingredients: tuple[Sel, ...] = (cls("ingredients"), cls("composition"), cls("thanh-phan"))
    usage: tuple[Sel, ...] = (cls("usage"), cls("cach-dung"), cls("instructions"))
    availability: tuple[Sel, ...] = (cls("availability"), cls("stock-status"), cls("tinh-trang"))
    category: tuple[Sel, ...] = (cls("breadcrumb"), cls("category"), cls("danh-muc"))
    brand: tuple[Sel, ...] = (cls("brand"), cls("manufacturer"), cls("thuong-hieu"))
    rating: tuple[Sel, ...] = (cls("rating"), cls("stars"), cls("danh-gia"))
    reviews_count: tuple[Sel, ...] = (cls("reviews-count"), cls("review-count"), cls("so-danh-gia"))

    # The attribute table and the labels of its rows.
    info_table: Sel = cls("content-list", of="table")
    info_row: Sel = cls("content-container", of="tr")
    info_cell: Sel = tag("td")
    brand_label: str = "Thương hiệu"
    ingredients_label: str = "Thành phần"
    table_labels: tuple[tuple[str, str], ...] = (
        ("official_name", "Tên chính hãng"),
        ("registration_number", "Số đăng ký"),
        ("form", "Dạng bào chế"),
        ("package_size", "Quy cách"),
        ("origin_brand", "Xuất xứ thương hiệu"),
        ("manufacturer", "Nhà sản xuất"),
        ("country_of_manufacture", "Nước sản xuất"),
    )

    # Words around ratings, counts and the inline brand.
    brand_inline: str = "Thương hiệu:"
    review_word: str = "đánh giá"
    star_word: str = "sao"
    comment_word: str = "bình luận"
    summary_box: Sel = Sel(label='div[class="flex items-center"]', tag="div", cls_exact="flex items-center")

    # Key parts that mark a brand in embedded JSON, in this order.
    brand_keys: tuple[str, ...] = ("brand", "manufacturer")

    # Image galleries.
    carousel: Sel = cls("swiper-wrapper", of="div")
    slide: Sel = cls("swiper-slide", of="div")
    gallery_image: Sel = cls("gallery-img", of="img")
    old_gallery: Sel = cls("carousel-gallery-list", of="div")
    modal_thumb: Sel = cls("lg-thumb-item", of="div")
    image_fallbacks: tuple[Sel, ...] = (
        Sel(label="carousel img", tag="img", cls_exact="gallery-img",
            inside=Sel(tag="div", cls_exact="swiper-wrapper")),
        Sel(label="slide img", tag="img", inside=Sel(tag="div", cls_part="swiper-slide")),
        Sel(label="gallery img", tag="img", cls_part="gallery-img"),
    )
    # An image URL with one of these is no product image.
    image_deny: tuple[str, ...] = (
        "logo", "banner", "icon", "badge", "smalls/", "facebook", "zalo", "download",
        "payment", "visa", "master", "momo", "napas", "vnpay", "apple_pay", "amex", "jcb",
        "bo_cong_thuong", "legit_", "dmca_", "search_", "menu_", "truyen_thong",
        "tin_khuyen_mai", "chuyen_trang", "deep_link", "goc_suc_khoe", "short_video",
        "cup_", "benh_", "thuong_hieu", "danh_muc", "kiem_tra_suc_khoe", "header_", "footer_",
    )
    # What marks a product image on the storage host.
    image_marks: tuple[str, ...] = (
        "dsc_",
        "lineabon", "omexxel", "calci", "vitamin", "nutrimed", "nutrigrow", "osteocare",
        "vitabiotics", "anica", "pharma", "ergopharm", "nordic", "excelife",
    )
    image_code: str = "00[0-9]{6}"
    json_image_min: int | None = 3  # look into JSON below this many images (None = always)
    json_image_stop: int | None = 10  # a script stops adding at this many (None = never)

    # The long description and what is cut from it.
    content_box: Sel = Sel(
        label="content", tag="div", cls_exact="lc-wrap-content lc-view-full-cont abc"
    )
    content_fallbacks: tuple[Sel, ...] = (
        cls("lc-wrap-content", of="div"), cls("inner", of="div"),
        cls("description", of="div"), attr_head("div", "id", "detail-content"),
    )
    content_drop_tags: tuple[str, ...] = ("script", "style")
    content_drop: tuple[Sel, ...] = (
        cls("lc-wrap-link"), cls("lc-overlay-detail"), cls_part("cursor-pointer"),
    )
    content_attrs: tuple[str, ...] = ("class", "id", "href", "src", "alt", "width", "height")

    # The product grid of a category page, and an item link.
    grid: Sel = Sel(label="grid", tag="div", classes=("grid", "grid-cols-2", "md:grid-cols-4"))
    item_suffix: str = ".html"

    def numbered(self) -> tuple["Rules", list[Sel]]:
        """These rules with a number in each selector, and the selectors by number."""
        sels: dict[Sel, int] = {}

        def number(sel: Sel) -> Sel:
            around = {n: number(s) for n in ("inside", "child_of") if (s := getattr(sel, n))}
            bare = replace(sel, label="", inside=None, child_of=None, number=None)
            return replace(sel, **around, number=sels.setdefault(bare, len(sels)))

        changed = {}
        for spec in fields(self):
            value = getattr(self, spec.name)
            if isinstance(value, Sel):
                changed[spec.name] = number(value)
            elif isinstance(value, tuple) and value and all(isinstance(v, Sel) for v in value):
                changed[spec.name] = tuple(map(number, value))
        return replace(self, **changed), list(sels)


def default_rules(base_url: str, image_cdn: str, image_host: str) -> Rules:
    """Default rules for a site at ``base_url`` whose JSON names images on ``image_cdn``.

    Both are full prefixes such as ``https://shop.example`` (no trailing slash);
    ``image_host`` is the host name of the storage that holds product images.
    """
    return Rules(base_url=base_url.rstrip("/"), image_cdn=image_cdn.rstrip("/"), image_host=image_host)
