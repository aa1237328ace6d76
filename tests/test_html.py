import datetime as dt
from decimal import Decimal

from shelfwatch.sources import html as H

LISTING_1 = """<html><body><ol>
<li><article class="product_pod"><h3><a href="catalogue/a-light_1000/index.html"
 title="A Light in the Attic">A Light...</a></h3>
<p class="star-rating Three"></p><div class="product_price">
<p class="price_color">Â£51.77</p></div></article></li>
<li><article class="product_pod"><h3><a href="b-book_999/index.html" title="B &amp; C">B</a></h3>
<p class="star-rating Seven"></p><p class="price_color">£13.99</p></article></li>
</ol><ul class="pager"><li class="next"><a href="catalogue/page-2.html">next</a></li></ul>
</body></html>"""

LISTING_2 = """<html><body><article class="product_pod"><h3>
<a href="c-book_998/index.html" title="Last">Last</a></h3><p class="star-rating One"></p>
<p class="price_color">£1.99</p></article></body></html>"""


def _detail(crumbs, rows):
    lis = "".join(f"<li><a href='#'>{c}</a></li>" for c in crumbs)
    trs = "".join(f"<tr><th>{k}</th><td>{v}</td></tr>" for k, v in rows or [])
    table = f"<table class='table table-striped'>{trs}</table>" if rows is not None else ""
    return f"<html><body><ul class='breadcrumb'>{lis}</ul>{table}</body></html>"


BASE = "https://books.toscrape.com/catalogue/"
DETAILS = [
    (10, BASE + "a-light_1000/index.html",
     _detail(["Home", "Books", "Poetry", "A Light in the Attic"],
             [("UPC", "a897fe39b1053632"), ("Availability", "In stock (22 available)")])),
    (11, BASE + "b-book_999/index.html", _detail(["Home", "Books"], None)),
    (12, BASE + "c-book_998/index.html",
     _detail(["Home", "Books", "Travel"], [("UPC", "x1"), ("Availability", "In stock")])),
]


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_listing_cards_and_next(spark):
    pages = _pages(spark, [(1, "https://books.toscrape.com/", LISTING_1),
                           (2, BASE + "page-2.html", LISTING_2)])
    got = H.parse_listing(H.parse_pages(pages)).orderBy("page_id", "title").collect()
    assert [(r.title, r.price, r.rating, r.product_url, r.next_url) for r in got] == [
        ("A Light in the Attic", Decimal("51.77"), 3,
         "https://books.toscrape.com/catalogue/a-light_1000/index.html",
         "https://books.toscrape.com/catalogue/page-2.html"),
        ("B & C", Decimal("13.99"), 0, BASE + "b-book_999/index.html",
         "https://books.toscrape.com/catalogue/page-2.html"),
        ("Last", Decimal("1.99"), 1, BASE + "c-book_998/index.html", None),
    ]


def test_detail_defaults(spark):
    got = {r.url: (r.category, r.upc, r.stock_quantity)  # noqa: E501
           for r in H.parse_detail(H.parse_pages(_pages(spark, DETAILS))).collect()}
    assert got == {BASE + "a-light_1000/index.html": ("Poetry", "a897fe39b1053632", 22),
                   BASE + "b-book_999/index.html": ("Unknown", "Unknown", 0),
                   BASE + "c-book_998/index.html": ("Travel", "x1", 0)}


def test_enrich_joins_and_rejects(spark):
    listing = H.parse_listing(H.parse_pages(_pages(spark, [
        (1, "https://books.toscrape.com/", LISTING_1), (2, BASE + "page-2.html", LISTING_2)])))
    recrawl = (20, DETAILS[0][1], DETAILS[0][2].replace("22 available", "21 available"))
    detail = H.parse_detail(H.parse_pages(_pages(spark, DETAILS[:2] + [recrawl])))
    records, rejected = H.enrich(listing, detail, "2026-06-06")
    recs = sorted((r.title, r.upc, r.category, r.stock_quantity, r.rating, r.date_collected)
                  for r in records.collect())
    assert recs == [("A Light in the Attic", "a897fe39b1053632", "Poetry", 21, "3",
                     dt.date(2026, 6, 6)),
                    ("B & C", "Unknown", "Unknown", 0, "0", dt.date(2026, 6, 6))]
    assert [r.title for r in rejected.collect()] == ["Last"]


def test_generic_profile(spark):
    html = ("<html><head><title>T &amp; U</title><script>var t=\"</p>\";</script></head>"
            "<body><nav><ul><li><a href=\"/a\">A</a></li><li><a href=\"/b\">B &amp; C</a></li>"
            "</ul></nav><article><h1>Head &quot;x&quot;</h1><p><b>x<br><p>y</p></article>"
            "</body></html>")
    parsed = H.parse_pages(_pages(spark, [(5, "u", html), (6, "v", None)]))
    heads = {r.page_id: (r.title, r.h1) for r in H.page_headings(parsed).collect()}
    assert heads == {5: ("T & U", 'Head "x"'), 6: (None, None)}
    links = [(r.pos, r.href, r.text) for r in H.page_links(parsed).orderBy("pos").collect()]
    assert links == [(0, "/a", "A"), (1, "/b", "B & C")]


def test_malformed_page_does_not_fail(spark):
    bad = "<html><body><nav><ul><li><a href='/x'>X</a></li></ul></nav><h1>T</h1><![if"
    parsed = H.parse_pages(_pages(spark, [(1, "u", bad), (2, "v", "<h1>ok</h1>")]))
    got = {r.page_id: r.h1 for r in H.page_headings(parsed).collect()}
    assert got == {1: "T", 2: "ok"}


def test_a_broken_page_is_rejected_not_read_in_part(spark):
    broken = LISTING_2.replace("</body>", "<![broken[</body>")
    parsed = H.parse_pages(_pages(spark, [(1, "l1", LISTING_1), (2, "l2", broken)]), partitions=2)
    assert {r.page_id for r in H.parse_listing(parsed).collect()} == {1}
    assert [(r.page_id, r.parse_error.split(":")[0]) for r in H.page_rejects(parsed).collect()] == [(2, "AssertionError")]


def test_the_last_of_repeated_rows_counts(spark):
    page = _detail(["Home", "Books", "Poetry"], [("UPC", "old"), ("Availability", "In stock (4 available)"),
                                                 ("UPC", "new"), ("Availability", "soon")])
    got = H.parse_detail(H.parse_pages(_pages(spark, [(1, "u", page)]))).first()
    assert (got.upc, got.stock_quantity) == ("new", 4)
