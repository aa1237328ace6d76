"""HTML extraction as a Spark job.

Pages are a table ``(page_id, url, html)``. One ``mapInPandas`` pass parses each page
with the standard-library ``html.parser`` (the only per-row Python in the library) and
returns raw fields: listing cards, next link, breadcrumb items, info-table rows, and a
generic profile (title, h1, navigation links). Everything after that — exploding cards,
rating / price / stock / URL cleaning, defaults, the listing-detail join — is Spark
column work.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions import clean as X
from shelfwatch.operators.dedup import dedup_keep_last
from shelfwatch.session import ship_package

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "source", "track", "wbr"}

CARD = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("href", T.StringType()),
    T.StructField("price_text", T.StringType()), T.StructField("rating_word", T.StringType())])
ROW = T.StructType([T.StructField("th", T.StringType()), T.StructField("td", T.StringType())])
LINK = T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])

PARSED = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("h1", T.StringType()),
    T.StructField("nav_links", T.ArrayType(LINK)),
    T.StructField("cards", T.ArrayType(CARD)),
    T.StructField("next_href", T.StringType()),
    T.StructField("breadcrumb", T.ArrayType(T.StringType())),
    T.StructField("info_rows", T.ArrayType(ROW)),
    T.StructField("parse_error", T.StringType()),
])


class _PageParser(HTMLParser):
    """Single pass over one page; keeps an element stack and the few texts we need."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, set]] = []
        self.title = None
        self.h1 = None
        self.nav_links: list[dict] = []
        self.cards: list[dict] = []
        self.next_href = None
        self.breadcrumb = None
        self.info_rows = None
        self._buf: dict[str, list[str]] = {}     # open text captures by name
        self._card = None
        self._in_h3 = False
        self._next_li = False
        self._crumb_open = False
        self._table_open = False
        self._row = None
        self._nav_a = None

    # helpers ---------------------------------------------------------------------------
    def _inside(self, tag: str, cls: str | None = None) -> bool:
        return any(t == tag and (cls is None or cls in c) for t, c in self.stack)

    def _start(self, name: str):
        self._buf[name] = []

    def _stop(self, name: str) -> str | None:
        parts = self._buf.pop(name, None)
        return None if parts is None else "".join(parts)

    # events ----------------------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = set((a.get("class") or "").split())
        if tag == "title" and self.title is None:
            self._start("title")
        elif tag == "h1" and self.h1 is None and "h1" not in self._buf:
            self._start("h1")
        elif tag == "article" and "product_pod" in classes:
            self._card = {"title": None, "href": None, "price_text": None, "rating_word": None,
                          "_a": False}
        elif tag == "h3" and self._card is not None:
            self._in_h3 = True
        elif tag == "a" and self._card is not None and self._in_h3 and not self._card["_a"]:
            self._card.update(title=a.get("title"), href=a.get("href"), _a=True)
        elif tag == "p" and self._card is not None and "price_color" in classes \
                and self._card["price_text"] is None:
            self._start("price")
        elif tag == "p" and self._card is not None and "star-rating" in classes \
                and self._card["rating_word"] is None:
            words = (a.get("class") or "").split()
            self._card["rating_word"] = words[1] if len(words) > 1 else None
        elif tag == "li" and "next" in classes and self.next_href is None:
            self._next_li = True
        elif tag == "a" and self._next_li and self.next_href is None:
            self.next_href = a.get("href")
        elif tag == "ul" and "breadcrumb" in classes and self.breadcrumb is None:
            self._crumb_open, self.breadcrumb = True, []
        elif tag == "li" and self._crumb_open:
            self._start("crumb")
        elif tag == "table" and "table-striped" in classes and self.info_rows is None:
            self._table_open, self.info_rows = True, []
        elif tag == "tr" and self._table_open:
            self._row = {"th": None, "td": None}
        elif tag in ("th", "td") and self._row is not None and self._row[tag] is None:
            self._start(tag)
        if tag == "a" and self._inside("nav") and self._inside("li"):
            self._nav_a = {"href": a.get("href"), "text": None}
            self._start("nav_a")
        if tag not in VOID:
            self.stack.append((tag, classes))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "title" and "title" in self._buf:
            self.title = self._stop("title")
        elif tag == "h1" and "h1" in self._buf:
            self.h1 = self._stop("h1")
        elif tag == "p" and "price" in self._buf and self._card is not None:
            self._card["price_text"] = self._stop("price")
        elif tag == "h3":
            self._in_h3 = False
        elif tag == "article" and self._card is not None:
            if "price" in self._buf:
                self._card["price_text"] = self._stop("price")
            self._card.pop("_a")
            self.cards.append(self._card)
            self._card = None
        elif tag == "li" and self._next_li:
            self._next_li = False
        elif tag == "li" and "crumb" in self._buf:
            self.breadcrumb.append(self._stop("crumb").strip())
        elif tag == "ul" and self._crumb_open:
            self._crumb_open = False
        elif tag in ("th", "td") and tag in self._buf and self._row is not None:
            self._row[tag] = self._stop(tag).strip()
        elif tag == "tr" and self._row is not None:
            if self._row["th"] is not None and self._row["td"] is not None:
                self.info_rows.append(self._row)
            self._row = None
        elif tag == "table" and self._table_open:
            self._table_open = False
        if tag == "a" and self._nav_a is not None:
            self._nav_a["text"] = self._stop("nav_a")
            self.nav_links.append(self._nav_a)
            self._nav_a = None
        # close up to the matching open element (tolerates unclosed <p>, <b>, ...)
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        for parts in self._buf.values():
            parts.append(data)


def parse_page(html: str | None) -> dict:
    """Raw fields of one page. Where the parser cannot finish, ``parse_error`` says why and
    the fields hold what came before; one malformed page never fails the task."""
    p, error = _PageParser(), None
    if html:
        try:
            p.feed(html)
            p.close()
        except (AssertionError, ValueError, IndexError) as e:
            error = f"{type(e).__name__}: {e}"
    return {"title": p.title, "h1": p.h1, "nav_links": p.nav_links, "cards": p.cards,
            "next_href": p.next_href, "breadcrumb": p.breadcrumb, "info_rows": p.info_rows,
            "parse_error": error}


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        parsed = [parse_page(h) for h in pdf["html"]]
        out = pd.DataFrame(parsed, columns=[f.name for f in PARSED.fields[2:]])
        out.insert(0, "url", pdf["url"].values)
        out.insert(0, "page_id", pdf["page_id"].values)
        yield out


def parse_pages(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per page with the raw extracted fields (schema ``PARSED``).

    Only ``page_id``, ``url`` and ``html`` cross into Python, in Arrow batches; pages are
    independent, so the work spreads over all partitions of the page table. Parsing is
    CPU-bound: for a table of few large files set ``partitions`` (the rows are then dealt
    round-robin), or a smaller ``spark.sql.files.maxPartitionBytes``.
    """
    ship_package(pages.sparkSession)
    src = pages.select(F.col("page_id").cast("long"), "url", "html")
    if partitions:
        src = src.repartition(partitions)
    return src.mapInPandas(_parse_batches, PARSED)


def page_rejects(parsed: DataFrame) -> DataFrame:
    """Pages that the parser could not finish, with the reason."""
    return parsed.where(F.col("parse_error").isNotNull()).select("page_id", "url", "parse_error")


# ---------------------------------------------------------------- generic profile
def page_headings(parsed: DataFrame) -> DataFrame:
    """Title and first h1 text of every page (entities decoded)."""
    return parsed.select("page_id", "url", "title", "h1")


def page_links(parsed: DataFrame) -> DataFrame:
    """Navigation links (``nav li a``), one row per link with its position on the page."""
    return parsed.select("page_id", F.posexplode("nav_links").alias("pos", "link")) \
        .select("page_id", "pos", F.col("link.href").alias("href"),
                F.col("link.text").alias("text"))


# ---------------------------------------------------------------- product profile
def parse_listing(parsed: DataFrame) -> DataFrame:
    """H1 + U1 + H3: one row per product card of every whole listing page, cleaned.

    Columns: page_id, title, price, rating (star count), product_url, next_url. Pages with
    a parse error are left to ``page_rejects``.
    """
    cards = parsed.where(F.col("parse_error").isNull()).select(
        "page_id", "next_href", F.explode("cards").alias("c"))
    return cards.select(
        "page_id",
        F.col("c.title").alias("title"),
        X.clean_price(F.trim(F.col("c.price_text"))).alias("price"),
        F.coalesce(F.try_element_at(X.rating_word_map(), F.col("c.rating_word")),
                   F.lit(0)).alias("rating"),
        X.resolve_product_url(F.col("c.href")).alias("product_url"),
        X.resolve_next_url(F.col("next_href")).alias("next_url"),
    )


def parse_detail(parsed: DataFrame) -> DataFrame:
    """H2: category (third breadcrumb item when there are more than two), UPC and stock
    from the info table. A missing row leaves 'Unknown' / 0; of repeated rows the last
    counts (for the stock the last with digits)."""
    rows = F.col("info_rows")

    def last(keep) -> F.Column:
        return F.try_element_at(F.filter(rows, keep), F.lit(-1))["td"]

    upc = last(lambda r: r["th"] == "UPC")
    avail = last(lambda r: (r["th"] == "Availability") & r["td"].rlike("[0-9]"))
    crumbs = F.col("breadcrumb")
    category = F.when(F.size(crumbs) > 2, F.try_element_at(crumbs, F.lit(3)))
    return parsed.select(
        "page_id", "url",
        X.or_unknown(category).alias("category"),
        X.or_unknown(upc).alias("upc"),
        F.when(avail.isNull(), F.lit(0)).otherwise(X.clean_stock(avail)).alias("stock_quantity"),
        "parse_error")


def enrich_flagged(listing: DataFrame, detail: DataFrame, run_date: str | None = None
                   ) -> DataFrame:
    """Every listing row with its detail attributes and ``reject_reason`` (NULL: good).

    A listing without a detail page, or with a broken one, is rejected (the source logged
    and dropped it). A detail page present more than once (re-crawled) counts once: the one
    with the highest ``page_id`` is kept, so the join never multiplies rows. Both sides
    scale with the catalog, so the planner picks the join strategy.
    """
    if "page_id" in detail.columns:
        detail = dedup_keep_last(detail, ["url"], ["page_id"]).drop("page_id")
    if "parse_error" not in detail.columns:
        detail = detail.withColumn("parse_error", F.lit(None).cast("string"))
    d = detail.withColumnRenamed("url", "product_url").withColumn("_found", F.lit(True))
    date = F.lit(run_date).cast("date") if run_date else F.current_date()
    reason = (F.when(F.col("_found").isNull(), F.lit("no detail page"))
               .when(F.col("parse_error").isNotNull(),
                     F.concat(F.lit("broken detail page: "), F.col("parse_error"))))
    return listing.join(d, "product_url", "left").select(
        "page_id", "title", "price", F.col("rating").cast("string").alias("rating"),
        "product_url", date.alias("date_collected"), "upc", "category", "stock_quantity",
        reason.alias("reject_reason"))


def enrich(listing: DataFrame, detail: DataFrame, run_date: str | None = None
           ) -> tuple[DataFrame, DataFrame]:
    """``enrich_flagged`` split into (records, rejected listings with their reason)."""
    flagged = enrich_flagged(listing, detail, run_date)
    bad = F.col("reject_reason").isNotNull()
    return (flagged.where(~bad).drop("page_id", "reject_reason"),
            flagged.where(bad).select("page_id", "title", "price", "rating", "product_url",
                                      "reject_reason"))
