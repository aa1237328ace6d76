"""Registered queries of the extraction and load paths, each with its DuckDB oracle.

Pages are built by column expressions from ``part``, so that every case of the markup
occurs in proportion to the table; the load queries write real tables into the shared
checkpoint folder and read them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions.clean import SITE_BASE_URL, SITE_CATALOGUE_URL
from shelfwatch.operators import evolution as EV
from shelfwatch.operators import quality as Q
from shelfwatch.operators import snapshots as S
from shelfwatch.plans import oracle as O
from shelfwatch.plans.registry import register
from shelfwatch.schemas import PRICE, WIDE_COLUMNS
from shelfwatch.session import scratch_folder
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.sources import binding as B
from shelfwatch.sources import html as H
from shelfwatch.sources.tables import read_snapshot_csv

_WORDS = ("Zero", "One", "Two", "Three", "Four", "Five", "Six")


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        k.alias("k"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.col("p_size").cast("int").alias("size"),
        (F.floor(F.col("p_retailprice") * 100).cast("decimal(12,0)") / 100).cast(PRICE).alias("price"))


#: Pages that one task parses; a few seconds of work.
PAGES_PER_TASK = 20_000


def _dealt_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_part`` dealt over as many tasks as its pages take: the table is small in bytes, so a
    scan has few splits. The narrow rows are dealt, before pages are made of them."""
    part = _part(spark, sf_dir)
    return part.repartition(part.count() // PAGES_PER_TASK + 1)      # the count reads footers only


# Where the n-th listing stands; every other link names the catalogue folder itself.
_HREF_SQL = "CASE WHEN k % 2 = 0 THEN 'catalogue/' ELSE '' END || 'p_' || CAST(k AS VARCHAR) || '/index.html'"
_URL_SQL = (f"CASE WHEN k % 2 = 0 THEN '{SITE_BASE_URL}' ELSE '{SITE_CATALOGUE_URL}' END || {_HREF_SQL}")
_PART_SQL = ("p AS (SELECT p_partkey AS k, p_name AS name, p_brand AS brand, CAST(p_size AS INTEGER) AS size, "
             "CAST(CAST(floor(p_retailprice * 100) AS DECIMAL(12,0)) / 100 AS DECIMAL(10,2)) AS price FROM part)")


def _href() -> F.Column:
    k = F.col("k")
    return F.concat(F.when(k % 2 == 0, F.lit("catalogue/")).otherwise(F.lit("")), F.lit("p_"),
                    k.cast("string"), F.lit("/index.html"))


def _listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page per part: every 17th breaks off, some have a next link."""
    k = F.col("k")
    words = F.array(*map(F.lit, _WORDS))
    card = F.concat(
        F.lit('<article class="product_pod"><h3><a href="'), _href(), F.lit('" title="'), "name",
        F.lit(' &amp; co">short</a></h3><p class="star-rating '), F.get(words, (k % 7).cast("int")),
        F.lit('"></p><p class="price_color"> Â£'), F.col("price").cast("string"), F.lit("</p></article>"))
    nxt = (F.when(k % 3 == 0, F.lit('<ul><li class="next"><a href="catalogue/page-2.html">next</a></li></ul>'))
            .when(k % 3 == 1, F.lit('<ul><li class="next"><a href="page-3.html">next</a></li></ul>'))
            .otherwise(F.lit("")))
    broken = F.when(k % 17 == 0, F.lit("<![broken[")).otherwise(F.lit(""))
    return _dealt_part(spark, sf_dir).select(
        k.alias("page_id"), F.concat(F.lit("list-"), k.cast("string")).alias("url"),
        F.concat(F.lit("<html><body>"), card, nxt, broken, F.lit("</body></html>")).alias("html"))


def _detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page per part (every 11th is missing), with all shapes of the info table."""
    k = F.col("k")

    def row(th: str, td) -> F.Column:
        return F.concat(F.lit(f"<tr><th>{th}</th><td>"), td, F.lit("</td></tr>"))

    upc = row("UPC", F.concat(F.lit("u"), k.cast("string")))
    stock = row("Availability", F.concat(F.lit("In stock ("), F.col("size").cast("string"), F.lit(" available)")))
    rows = (F.when(k % 8 == 1, stock).when(k % 8 == 2, upc)
             .when(k % 8 == 3, F.concat(row("UPC", F.lit("first")), upc, stock, row("Availability", F.lit("soon"))))
             .when(k % 8 == 4, F.concat(upc, row("Availability", F.lit("In stock"))))
             .otherwise(F.concat(upc, row("Tax", F.lit("0")), stock)))
    table = F.when(k % 8 == 0, F.lit("")).otherwise(
        F.concat(F.lit('<table class="table table-striped">'), rows, F.lit("</table>")))
    crumb = F.concat(F.lit('<ul class="breadcrumb"><li>Home</li><li>All</li>'),
                     F.when(k % 5 != 0, F.concat(F.lit("<li><a>"), "brand", F.lit("</a></li><li>this</li>")))
                     .otherwise(F.lit("")), F.lit("</ul>"))
    broken = F.when(k % 13 == 0, F.lit("<![broken[")).otherwise(F.lit(""))
    page = F.concat(F.lit("<html><body>"), crumb, broken, table, F.lit("</body></html>"))
    base = F.when(k % 2 == 0, F.lit(SITE_BASE_URL)).otherwise(F.lit(SITE_CATALOGUE_URL))
    return _dealt_part(spark, sf_dir).where(k % 11 != 0).select(
        (k + 10_000_000).alias("page_id"), F.concat(base, _href()).alias("url"), page.alias("html"))


_CARDS_SQL = f"""
cards AS (SELECT k AS page_id, name || ' & co' AS title, price,
  CASE WHEN k % 7 BETWEEN 1 AND 5 THEN CAST(k % 7 AS INTEGER) ELSE 0 END AS rating, {_URL_SQL} AS product_url,
  CASE k % 3 WHEN 0 THEN '{SITE_BASE_URL}catalogue/page-2.html' WHEN 1 THEN '{SITE_CATALOGUE_URL}page-3.html' END
    AS next_url, k FROM p WHERE k % 17 <> 0),
details AS (SELECT k + 10000000 AS page_id, {_URL_SQL} AS url,
  CASE WHEN k % 5 = 0 THEN 'Unknown' ELSE brand END AS category,
  CASE WHEN k % 13 = 0 OR k % 8 IN (0, 1) THEN 'Unknown' ELSE 'u' || CAST(k AS VARCHAR) END AS upc,
  CASE WHEN k % 13 = 0 OR k % 8 IN (0, 2, 4) THEN 0 ELSE size END AS stock_quantity, k % 13 = 0 AS broken
  FROM p WHERE k % 11 <> 0)
"""


def _pages_sql(body: str) -> str:
    return f"WITH {_PART_SQL}, {_CARDS_SQL} {body}"


def _cards(spark, sf_dir):
    return H.parse_listing(H.parse_pages(_listing_pages(spark, sf_dir)))


def _details(spark, sf_dir):
    return H.parse_detail(H.parse_pages(_detail_pages(spark, sf_dir)))


@register("listing_cards", _pages_sql(
    "SELECT page_id, title, CAST(price AS DOUBLE) AS price, rating, product_url, next_url FROM cards"))
def listing_cards(spark, sf_dir):
    return _cards(spark, sf_dir).withColumn("price", F.col("price").cast("double"))


@register("detail_attributes", _pages_sql(
    "SELECT page_id, url, category, upc, stock_quantity, broken FROM details"))
def detail_attributes(spark, sf_dir):
    return _details(spark, sf_dir).withColumn("broken", F.col("parse_error").isNotNull()).drop("parse_error")


_RUN_DATE = "2026-06-06"


@register("page_enrich", _pages_sql(
    f"SELECT c.title, CAST(c.price AS DOUBLE) AS price, CAST(c.rating AS VARCHAR) AS rating, c.product_url, "
    f"DATE '{_RUN_DATE}' AS date_collected, d.upc, d.category, d.stock_quantity "
    "FROM cards c JOIN details d ON d.url = c.product_url WHERE NOT d.broken"))
def page_enrich(spark, sf_dir):
    records, _ = H.enrich(_cards(spark, sf_dir), _details(spark, sf_dir), _RUN_DATE)
    return records.withColumn("price", F.col("price").cast("double"))


@register("page_rejects", _pages_sql(
    "SELECT c.page_id, CASE WHEN d.url IS NULL THEN 'no detail page' ELSE 'broken detail page' END AS reason "
    "FROM cards c LEFT JOIN details d ON d.url = c.product_url WHERE d.url IS NULL OR d.broken "
    "UNION ALL SELECT k, 'broken page' FROM p WHERE k % 17 = 0 "
    "UNION ALL SELECT k + 10000000, 'broken page' FROM p WHERE k % 13 = 0 AND k % 11 <> 0"))
def page_rejects(spark, sf_dir):
    # each page is parsed once, for its records and for its faults
    listing = _staged(H.parse_pages(_listing_pages(spark, sf_dir)))
    detail = _staged(H.parse_pages(_detail_pages(spark, sf_dir)))
    _, bad = H.enrich(H.parse_listing(listing), H.parse_detail(detail), _RUN_DATE)
    reason = F.regexp_extract("reject_reason", "^[^:]*", 0)
    pages = H.page_rejects(listing).unionByName(H.page_rejects(detail))
    return bad.select("page_id", reason.alias("reason")).unionByName(
        pages.select("page_id", F.lit("broken page").alias("reason")))


# ---------------------------------------------------------------- CSV files
def _scratch(spark: SparkSession) -> str:
    return f"{scratch_folder(spark, 'shelfwatch-run')}/data"


def _staged(df: DataFrame) -> DataFrame:
    path = _scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hard_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as wide rows whose titles need every rule of the CSV dialect."""
    k = F.col("k")
    title = (F.when(k % 8 == 0, F.concat(F.lit('He said "hi", twice '), "name")).when(k % 8 == 1, F.lit(""))
              .when(k % 8 == 2, F.lit(None)).when(k % 8 == 3, F.concat(F.lit("  "), "name", F.lit("  ")))
              .when(k % 8 == 4, F.concat("name", F.lit("\nline, two"))).when(k % 8 == 5, F.lit('"'))
              .when(k % 8 == 6, F.concat("name", F.lit("\\"))).otherwise(F.col("name")))
    day = F.when(k % 2 == 0, F.lit("2026-06-05")).otherwise(F.lit("2026-06-06")).cast("date")
    return _part(spark, sf_dir).select(
        title.alias("title"), "price", F.get(F.array(*map(F.lit, _WORDS)), (k % 7).cast("int")).alias("rating"),
        F.concat(F.lit(B.URL_PREFIX), k.cast("string")).alias("product_url"), day.alias("date_collected"),
        k.cast("string").alias("upc"), F.col("brand").alias("category"), F.col("size").alias("stock_quantity"))


_HARD_SQL = f"""hard AS (SELECT CASE k % 8 WHEN 0 THEN 'He said "hi", twice ' || name WHEN 1 THEN '' WHEN 2 THEN NULL
  WHEN 3 THEN '  ' || name || '  ' WHEN 4 THEN name || ' line, two' WHEN 5 THEN '"'
  WHEN 6 THEN name || chr(92) ELSE name END AS title, CAST(price AS DOUBLE) AS price,
  ['Zero', 'One', 'Two', 'Three', 'Four', 'Five', 'Six'][CAST(k % 7 AS INTEGER) + 1] AS rating,
  '{B.URL_PREFIX}' || CAST(k AS VARCHAR) AS product_url,
  CASE WHEN k % 2 = 0 THEN DATE '2026-06-05' ELSE DATE '2026-06-06' END AS date_collected,
  CAST(k AS VARCHAR) AS upc, brand AS category, size AS stock_quantity FROM p)"""


def _wide(df: DataFrame) -> DataFrame:
    return df.select(*WIDE_COLUMNS).withColumn("price", F.col("price").cast("double"))


@register("csv_snapshot", f"WITH {_PART_SQL}, {_HARD_SQL} SELECT * FROM hard")
def csv_snapshot(spark, sf_dir):
    """Written as the snapshot CSV (K1) and read back."""
    wh = Warehouse(spark, _scratch(spark))
    wh.write_snapshot(_hard_texts(spark, sf_dir))
    return _wide(read_snapshot_csv(spark, wh.snapshot_path))


@register("csv_archive_day", f"WITH {_PART_SQL}, {_HARD_SQL} SELECT * FROM hard WHERE date_collected = DATE '2026-06-05'")
def csv_archive_day(spark, sf_dir):
    """Archived per day (K2), one day read back with all eight columns."""
    wh = Warehouse(spark, _scratch(spark))
    wh.archive(_hard_texts(spark, sf_dir))
    return _wide(read_snapshot_csv(spark, f"{wh.archive_path}/run_date=2026-06-05"))


@register("csv_log_keep_last", f"""WITH {_PART_SQL}, {_HARD_SQL}
SELECT title, CASE WHEN CAST(upc AS BIGINT) % 3 = 0 THEN price + 1 ELSE price END AS price, rating, product_url,
  date_collected, upc, category, stock_quantity FROM hard""")
def csv_log_keep_last(spark, sf_dir):
    """Two runs appended to the log (K3), the later one wins where both name a product."""
    from shelfwatch.sources.tables import read_history_csv
    wh = Warehouse(spark, _scratch(spark))
    rows = _hard_texts(spark, sf_dir)
    wh.append_log(rows, 1)
    wh.append_log(rows.where("CAST(upc AS BIGINT) % 3 = 0").withColumn("price", (F.col("price") + 1).cast(PRICE)), 2)
    return _wide(read_history_csv(spark, wh.log_path))


# ---------------------------------------------------------------- loads
def _days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The observations of the two latest dates, as wide rows."""
    books, fact = B.books(spark, sf_dir), B.fact(spark, sf_dir)
    keep = [*WIDE_COLUMNS, B.LOG_ORDER]
    return (S.snapshot_at(books, S.previous_date(fact)).select(*keep),
            S.snapshot_at(books, S.latest_date(fact)).select(*keep))


def _loaded(wh: Warehouse) -> DataFrame:
    return wh.books().select("upc", "title", F.col("price").cast("double").alias("price"), "rating",
                             "stock_quantity", "date_collected")


_LOADED_SQL = "upc, title, CAST(price AS DOUBLE) AS price, rating, stock_quantity, date_collected"
_TWO_DAYS = "date_collected IN ((SELECT latest_date FROM dates), (SELECT previous_date FROM dates))"


@register("ingest_day", O.q(
    f"SELECT upc, title, CAST(price AS DOUBLE) AS price, rating, stock_quantity, DATE '{_RUN_DATE}' AS date_collected "
    "FROM snapshot"))
def ingest_day(spark, sf_dir):
    """K10 + P5: one run stamped with its date, loaded twice (the second replaces the first)."""
    wh = Warehouse(spark, _scratch(spark))
    _, latest = _days(spark, sf_dir)
    for n in (1, 2):
        wh.ingest(latest, run_date=_RUN_DATE, batch_id=n, write_csv=False)
    return _loaded(wh)


@register("replace_day", O.q(
    f"SELECT {_LOADED_SQL} FROM books WHERE date_collected = (SELECT previous_date FROM dates) "
    f"UNION ALL SELECT {_LOADED_SQL} FROM snapshot WHERE CAST(upc AS BIGINT) % 2 = 0"))
def replace_day(spark, sf_dir):
    """K5: a day loaded again with half its rows; the other day stays."""
    wh = Warehouse(spark, _scratch(spark))
    before, latest = _days(spark, sf_dir)
    wh.ingest(before, batch_id=1, write_csv=False)
    wh.ingest(latest, batch_id=2, write_csv=False)
    wh.ingest(latest.where("CAST(upc AS BIGINT) % 2 = 0"), batch_id=3, write_csv=False)
    return _loaded(wh)


@register("cascade_delete", O.q(
    f"SELECT {_LOADED_SQL} FROM books WHERE CAST(upc AS BIGINT) % 3 <> 0"))
def cascade_delete(spark, sf_dir):
    """Every third product deleted, with its facts on all dates."""
    wh = Warehouse(spark, _scratch(spark))
    rows = B.books(spark, sf_dir).select(*WIDE_COLUMNS).withColumn("ingest_seq", F.lit(0).cast("long"))
    wh.upsert_catalog(rows)
    wh.replace_day(rows)
    wh.delete_products(B.catalog(spark, sf_dir).where("CAST(upc AS BIGINT) % 3 = 0").select("upc"))
    return _loaded(wh)


@register("micro_batch_upsert", O.q(
    f"SELECT upc, title, CAST(CASE WHEN date_collected = (SELECT latest_date FROM dates) AND CAST(upc AS BIGINT) % 4 = 0 "
    "THEN price + 1 ELSE price END AS DOUBLE) AS price, rating, stock_quantity, date_collected "
    f"FROM books WHERE {_TWO_DAYS}"))
def micro_batch_upsert(spark, sf_dir):
    """E2 + E6: a day in three parts, one of them twice, then a later correction of some rows;
    the tables equal those of the whole day, and the other day stays."""
    wh = Warehouse(spark, _scratch(spark))
    before, latest = _days(spark, sf_dir)
    wh.ingest(before, batch_id=0, write_csv=False)
    part = F.pmod(F.xxhash64("upc"), F.lit(3))
    for n in (0, 1, 1, 2):
        wh.ingest_part(latest.where(part == n), [B.LOG_ORDER], n + 1, write_log=False)
    later = latest.where("CAST(upc AS BIGINT) % 4 = 0").withColumn("price", (F.col("price") + 1).cast(PRICE))
    wh.ingest_part(later, [B.LOG_ORDER], 9, write_log=False)
    return _loaded(wh)


# ---------------------------------------------------------------- rules that fire (D1-D3, D5, D7), E5
_BREAKS = [  # (remainder of the part key by 12, column, Spark value, SQL value)
    (0, "title", "NULL", "NULL"), (1, "product_url", "NULL", "NULL"), (2, "price", "NULL", "NULL"),
    (3, "date_collected", "NULL", "NULL"), (4, "upc", "NULL", "NULL"), (5, "price", "-price", "-price"),
    (6, "stock_quantity", "-1", "-1"), (7, "upc", "repeat('u', 51)", "repeat('u', 51)"),
    (8, "category", "repeat('c', 101)", "repeat('c', 101)"), (9, "rating", "repeat('r', 21)", "repeat('r', 21)")]
_RULES = ["title_not_null", "product_url_not_null", "price_not_null", "date_not_null", "upc_not_null",
          "price_non_negative", "stock_non_negative", "upc_length", "category_length", "rating_length"]


@register("rule_violations", O.q(
    "SELECT r.rule, CASE r.m WHEN 4 THEN NULL WHEN 7 THEN repeat('u', 51) ELSE upc END AS upc, "
    "CASE WHEN r.m = 3 THEN NULL ELSE date_collected END AS date_collected FROM snapshot s JOIN (VALUES "
    + ", ".join(f"({m}, '{rule}')" for (m, *_), rule in zip(_BREAKS, _RULES))
    + ") r(m, rule) ON CAST(s.upc AS BIGINT) % 12 = r.m "
    "UNION ALL SELECT 'primary_key_upc', upc, NULL FROM catalog WHERE CAST(upc AS BIGINT) % 12 = 11 "
    "UNION ALL SELECT 'upc_not_null', NULL, NULL FROM catalog WHERE CAST(upc AS BIGINT) % 12 = 4"))
def rule_violations(spark, sf_dir):
    """D1-D3, D5, D7 on the latest snapshot with one broken column in most rows, and on a
    dimension with repeated and missing keys."""
    rows = S.latest_snapshot(B.books(spark, sf_dir), B.fact(spark, sf_dir)).select(*WIDE_COLUMNS)
    m = F.col("upc").cast("long") % 12
    types = dict(rows.dtypes)
    broken = rows.select(*[F.coalesce(*[F.when(m == k, F.struct(F.expr(v).cast(types[c]).alias("v")))
                                        for k, col, v, _ in _BREAKS if col == c],
                                      F.struct(F.col(c).alias("v")))["v"].alias(c) for c in rows.columns])
    catalog = B.catalog(spark, sf_dir)
    k = F.col("upc").cast("long") % 12
    bad = (catalog.unionByName(catalog.where(k == 11))
           .withColumn("upc", F.when(k == 4, F.lit(None)).otherwise(F.col("upc"))))
    return Q._row_violations(broken).unionByName(Q.catalog_violations(bad))


@register("union_evolving", O.q(
    "SELECT upc, CAST(price AS DOUBLE) AS price, NULL AS stock_quantity, date_collected FROM books "
    "WHERE date_collected = (SELECT previous_date FROM dates) UNION ALL "
    "SELECT upc, CAST(price AS DOUBLE), stock_quantity, date_collected FROM snapshot"))
def union_evolving(spark, sf_dir):
    """E5: a day in an older layout without the stock column, and one with it."""
    before, latest = _days(spark, sf_dir)
    old = before.select("upc", F.col("price").cast("double").alias("price"), "date_collected")
    new = latest.select("upc", F.col("price").cast("double").alias("price"), "stock_quantity", "date_collected")
    return EV.align_schema(EV.union_evolving(old, new), new.schema)
