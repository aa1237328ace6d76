"""Registered queries: one callable per operator group, each with its DuckDB oracle.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame built from the driver
tables through the binding in ``shelfwatch.sources.binding``; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators import analytics as A
from shelfwatch.operators import snapshots as S
from shelfwatch.operators.dedup import dedup_keep_last
from shelfwatch.plans import oracle as O
from shelfwatch.sources import binding as B

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _books(spark, sf_dir):
    return B.books(spark, sf_dir)


def _snapshot(spark, sf_dir):
    return S.latest_snapshot(B.books(spark, sf_dir), B.fact(spark, sf_dir))


def _totals(spark, sf_dir):
    return A.product_totals(B.fact(spark, sf_dir), B.catalog(spark, sf_dir))


WIDE_OUT = ("title, CAST(price AS DOUBLE) AS price, rating, product_url, date_collected, "
            "upc, category, stock_quantity")


def _wide_out(df: DataFrame) -> DataFrame:
    return df.select("title", F.col("price").cast("double").alias("price"), "rating",
                     "product_url", "date_collected", "upc", "category", "stock_quantity")


# ---------------------------------------------------------------- reads
@register("star_join", O.q(f"SELECT {WIDE_OUT} FROM books"))
def star_join(spark, sf_dir):
    return _wide_out(_books(spark, sf_dir))


@register("full_history", O.q(f"SELECT {WIDE_OUT} FROM books"))
def full_history(spark, sf_dir):
    return _wide_out(S.full_history(_books(spark, sf_dir)))


@register("latest_snapshot", O.q(f"SELECT {WIDE_OUT} FROM snapshot"))
def latest_snapshot(spark, sf_dir):
    return _wide_out(_snapshot(spark, sf_dir))


SNAPSHOT_DATE = "2001-07-01"


@register("snapshot_at", O.q(
    f"SELECT {WIDE_OUT} FROM books WHERE date_collected = DATE '{SNAPSHOT_DATE}'"))
def snapshot_at(spark, sf_dir):
    return _wide_out(S.snapshot_at(_books(spark, sf_dir), SNAPSHOT_DATE))


@register("dedup_history", O.q(
    "SELECT title, CAST(price AS DOUBLE) AS price, rating, product_url, date_collected, upc, "
    "category, stock_quantity FROM history"))
def dedup_history(spark, sf_dir):
    keys = ["title", "product_url", "date_collected"]
    # few rows a key: dealt before they are sorted by key, no task sorts a whole split of the log
    log = B.raw_log(spark, sf_dir).repartition(*keys)
    return _wide_out(dedup_keep_last(log, keys, [B.LOG_ORDER]))


@register("collection_dates", O.q(
    "SELECT DISTINCT date_collected FROM fact WHERE date_collected IS NOT NULL"))
def collection_dates(spark, sf_dir):
    return S.collection_dates(B.fact(spark, sf_dir))


@register("last_two_dates", O.q(
    "SELECT previous_date, latest_date FROM dates WHERE previous_date IS NOT NULL"))
def last_two_dates(spark, sf_dir):
    return S.last_two_dates(B.fact(spark, sf_dir))


# ---------------------------------------------------------------- analytics
@register("total_records", O.q("SELECT COUNT(*) AS total_scraped_records FROM books"))
def total_records(spark, sf_dir):
    return A.star_total_records(_totals(spark, sf_dir))


@register("average_price", O.q(f"SELECT {O.avg2('price')} AS average_price FROM books"))
def average_price(spark, sf_dir):
    return A.star_average_price(_totals(spark, sf_dir))


@register("price_bounds", O.q(
    "SELECT CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price "
    "FROM snapshot"))
def price_bounds(spark, sf_dir):
    return A.price_bounds(_snapshot(spark, sf_dir))


@register("kpi_row", O.q(
    f"SELECT COUNT(*) AS total_books, {O.avg2('price')} AS avg_price, "
    "CAST(SUM(stock_quantity) AS BIGINT) AS total_stock, "
    "COUNT(DISTINCT category) AS unique_categories FROM snapshot"))
def kpi_row(spark, sf_dir):
    return A.kpis(_snapshot(spark, sf_dir))


@register("category_counts", O.q(
    "SELECT category, COUNT(*) AS book_count FROM books GROUP BY category"))
def category_counts(spark, sf_dir):
    return A.star_category_counts(_totals(spark, sf_dir))


@register("category_counts_top15", O.q(
    "SELECT category, COUNT(*) AS book_count FROM snapshot WHERE category IS NOT NULL "
    "GROUP BY category ORDER BY book_count DESC, category ASC LIMIT 15"))
def category_counts_top15(spark, sf_dir):
    return A.category_counts(_snapshot(spark, sf_dir), top=15, dropna=True)


@register("category_avg_price", O.q(
    f"SELECT category, {O.avg2('price')} AS average_price, COUNT(*) AS book_count "
    "FROM books GROUP BY category"))
def category_avg_price(spark, sf_dir):
    return A.star_category_avg_price(_totals(spark, sf_dir))


@register("category_avg_price_latest", O.q(
    f"SELECT category, {O.avg2('price')} AS average_price, COUNT(*) AS book_count "
    "FROM snapshot GROUP BY category"))
def category_avg_price_latest(spark, sf_dir):
    return A.category_avg_price(_snapshot(spark, sf_dir))


@register("category_avg_price_top25", O.q(
    f"SELECT title AS category, {O.avg2('price')} AS average_price, COUNT(*) AS book_count "
    "FROM snapshot WHERE title IS NOT NULL GROUP BY title "
    "ORDER BY CAST(SUM(CAST(price * 100 AS BIGINT)) AS HUGEINT) * 1000000000000 // COUNT(price) DESC, title LIMIT 25"))
def category_avg_price_top25(spark, sf_dir):
    """Over titles, of which there are more than 25, so that the cut by exact mean matters."""
    by_title = _snapshot(spark, sf_dir).withColumn("category", F.col("title"))
    return A.category_avg_price(by_title, top=25, dropna=True)


@register("category_stock", O.q(
    "SELECT category, CAST(SUM(stock_quantity) AS BIGINT) AS total_items_in_stock "
    "FROM books GROUP BY category"))
def category_stock(spark, sf_dir):
    return A.star_category_stock(_totals(spark, sf_dir))


@register("top_expensive", O.q(
    "SELECT title, CAST(price AS DOUBLE) AS price, category, product_url FROM books "
    "ORDER BY price DESC, product_url, title, category LIMIT 10"))
def top_expensive(spark, sf_dir):
    return A.top_expensive(_books(spark, sf_dir), 10)


@register("scarce_stock", O.q(
    "SELECT title, category, stock_quantity, product_url FROM books "
    "WHERE stock_quantity <= 2 ORDER BY stock_quantity, product_url, title, category LIMIT 15"))
def scarce_stock(spark, sf_dir):
    return A.scarce_stock(_books(spark, sf_dir), 2, 15)


@register("observation_counts", O.q(
    "SELECT title, upc, COUNT(*) AS scrape_runs_logged FROM books GROUP BY title, upc "
    "ORDER BY scrape_runs_logged DESC, title, upc LIMIT 10"))
def observation_counts(spark, sf_dir):
    return A.star_observation_counts(_totals(spark, sf_dir), 10)


@register("rating_distribution", O.q(
    "SELECT rating_numeric, book_count, "
    "CAST((book_count * 20000 + total) // (2 * total) AS DOUBLE) / 100 AS share_pct, "
    "printf('%3d', rating_numeric) AS stars, repeat('*', CAST(book_count // 10 AS INTEGER)) AS bar "
    "FROM (SELECT rating_numeric, book_count, SUM(book_count) OVER () AS total FROM ("
    f"SELECT {O.rating_int('rating')} AS rating_numeric, COUNT(*) AS book_count "
    "FROM snapshot GROUP BY 1) a) b"))
def rating_distribution(spark, sf_dir):
    return A.rating_distribution(_snapshot(spark, sf_dir))


@register("pick_lists", O.q(
    "SELECT DISTINCT 'category' AS kind, category AS value FROM snapshot "
    "UNION SELECT DISTINCT 'title' AS kind, title AS value FROM snapshot"))
def pick_lists(spark, sf_dir):
    return A.pick_lists(_snapshot(spark, sf_dir))


# ---------------------------------------------------------------- change detection
from shelfwatch.operators import changes as C  # noqa: E402
from shelfwatch.operators import search as SR  # noqa: E402


def _changes(spark, sf_dir, keys=C.UPC_KEYS, carry=C.UPC_CARRY):
    return C.latest_changes(B.books(spark, sf_dir), B.fact(spark, sf_dir), keys, carry)


def _change_out(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in ("price_old", "price_new", "change")],
                     *[F.col(c).cast("double").alias(c)
                       for c in ("price_old", "price_new", "change")])


@register("price_changes_upc", O.changes(
    f"SELECT title, upc, product_url, category, {O.change_cols()} FROM ch_upc"))
def price_changes_upc(spark, sf_dir):
    return _change_out(_changes(spark, sf_dir))


@register("price_changes_url", O.changes(
    f"SELECT title, product_url, {O.change_cols()} FROM ch_url"))
def price_changes_url(spark, sf_dir):
    return _change_out(_changes(spark, sf_dir, C.URL_KEYS, ()))


@register("price_drops", O.changes(
    f"SELECT title, upc, product_url, category, {O.change_cols()} FROM ch_upc "
    "WHERE change < 0"))
def price_drops(spark, sf_dir):
    return _change_out(C.drops(_changes(spark, sf_dir)))


@register("price_hikes", O.changes(
    f"SELECT title, upc, product_url, category, {O.change_cols()} FROM ch_upc "
    "WHERE change > 0"))
def price_hikes(spark, sf_dir):
    return _change_out(C.hikes(_changes(spark, sf_dir)))


DEAL_MIN_PCT = 5.0


@register("deals_min_pct", O.changes(
    f"SELECT * FROM (SELECT title, upc, product_url, category, {O.change_cols()} FROM ch_upc "
    f"WHERE change < 0) t WHERE abs(pct) >= {DEAL_MIN_PCT}"))
def deals_min_pct(spark, sf_dir):
    return _change_out(C.drops(_changes(spark, sf_dir), DEAL_MIN_PCT))


@register("changed_rows", O.changes(
    f"SELECT title, product_url, {O.change_cols()} FROM ch_url "
    "WHERE change <> 0 OR change IS NULL"))
def changed_rows(spark, sf_dir):
    return _change_out(C.changed(_changes(spark, sf_dir, C.URL_KEYS, ())))


@register("change_summary", O.changes(
    "SELECT COUNT(*) AS compared, COUNT(*) FILTER (WHERE change < 0) AS drops, "
    "COUNT(*) FILTER (WHERE change > 0) AS hikes, "
    "COUNT(*) FILTER (WHERE change <> 0 OR change IS NULL) AS total_changed FROM ch_upc"))
def change_summary(spark, sf_dir):
    return C.change_summary(_changes(spark, sf_dir))


# ---------------------------------------------------------------- catalog search
SEARCH_OUT = (f"upc, title, category, CAST(price AS DOUBLE) AS price, "
              f"{O.rating_int('rating')} AS rating_numeric, stock_quantity, product_url")
# Thresholds for the binding's price span (810.00-999.70) instead of the site's 20 / 50.
BARGAIN_MAX, PREMIUM_MIN = 850.0, 950.0
BOUND_PRESETS = SR.presets(BARGAIN_MAX, PREMIUM_MIN)


def _search(spark, sf_dir, spec):
    out = SR.search_catalog(_snapshot(spark, sf_dir), spec)
    return out.withColumn("price", F.col("price").cast("double"))


def _search_sql(where: str) -> str:
    return O.q(f"SELECT * FROM (SELECT {SEARCH_OUT} FROM snapshot) s WHERE {where}")


_STARS = "rating_numeric IN (1, 2, 3, 4, 5) AND price IS NOT NULL"
KEYWORD = "RED|^1"


@register("search_keyword", _search_sql(
    f"(coalesce(regexp_matches(title, '(?i){KEYWORD}'), false) OR "
    f"coalesce(regexp_matches(upc, '(?i){KEYWORD}'), false)) AND {_STARS}"))
def search_keyword(spark, sf_dir):
    return _search(spark, sf_dir, SR.SearchSpec(keyword=KEYWORD))


@register("search_literal", _search_sql(
    f"(contains(lower(title), 'hot') OR contains(lower(upc), 'hot')) AND {_STARS}"))
def search_literal(spark, sf_dir):
    return _search(spark, sf_dir, SR.SearchSpec(keyword="HOT", keyword_regex=False))


@register("search_filters", _search_sql(
    "category = 'Brand#12' AND rating_numeric IN (3, 4, 5) AND price IS NOT NULL "
    "AND price >= 880 AND price <= 990 AND stock_quantity > 0"))
def search_filters(spark, sf_dir):
    return _search(spark, sf_dir, SR.SearchSpec(category="Brand#12", ratings=(3, 4, 5),
                                                price_min=880.0, price_max=990.0,
                                                in_stock_only=True))


@register("search_title", _search_sql("title = 'red plate'"))
def search_title(spark, sf_dir):
    return _search(spark, sf_dir, SR.SearchSpec(title="red plate", category="Brand#1",
                                                ratings=()))


@register("search_no_ratings", _search_sql("false"))
def search_no_ratings(spark, sf_dir):
    return _search(spark, sf_dir, SR.SearchSpec(ratings=()))


@register("preset_all", _search_sql(_STARS))
def preset_all(spark, sf_dir):
    return _search(spark, sf_dir, BOUND_PRESETS["all"])


@register("preset_five_star", _search_sql("rating_numeric = 5 AND price IS NOT NULL"))
def preset_five_star(spark, sf_dir):
    return _search(spark, sf_dir, BOUND_PRESETS["five_star"])


@register("preset_bargain", _search_sql(f"{_STARS} AND price <= {BARGAIN_MAX}"))
def preset_bargain(spark, sf_dir):
    return _search(spark, sf_dir, BOUND_PRESETS["bargain"])


@register("preset_low_stock", _search_sql(
    f"stock_quantity BETWEEN 1 AND 3 AND {_STARS} AND stock_quantity > 0"))
def preset_low_stock(spark, sf_dir):
    return _search(spark, sf_dir, BOUND_PRESETS["low_stock"])


@register("preset_premium", _search_sql(f"{_STARS} AND price >= {PREMIUM_MIN}"))
def preset_premium(spark, sf_dir):
    return _search(spark, sf_dir, BOUND_PRESETS["premium"])


# ---------------------------------------------------------------- statistics and reports
from shelfwatch.functions import clean as X  # noqa: E402
from shelfwatch.functions import fmt as FM  # noqa: E402
from shelfwatch.operators import stats as ST  # noqa: E402
from shelfwatch.plans import reports as R  # noqa: E402

_LOG_ORDER_SQL = ("l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, "
                  "l_quantity")


@register("extreme_titles", O.q(
    "SELECT (SELECT title FROM snapshot WHERE price IS NOT NULL "
    f"ORDER BY price DESC, {_LOG_ORDER_SQL} LIMIT 1) AS most_expensive_title, "
    "(SELECT CAST(max(price) AS DOUBLE) FROM snapshot) AS highest_price, "
    "(SELECT title FROM snapshot WHERE price IS NOT NULL "
    f"ORDER BY price ASC, {_LOG_ORDER_SQL} LIMIT 1) AS cheapest_title, "
    "(SELECT CAST(min(price) AS DOUBLE) FROM snapshot) AS lowest_price"))
def extreme_titles(spark, sf_dir):
    return ST.extremes(_snapshot(spark, sf_dir), [B.LOG_ORDER])


def _describe_sql(src: str) -> str:
    cents = "CAST(price * 100 AS BIGINT)"
    quart = ", ".join(f"round(quantile_cont(CAST(price AS DOUBLE), {q}), 4) AS {n}"
                      for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return O.q(
        "SELECT COUNT(price) AS count, "
        f"CAST((2 * SUM({cents}) * 1000 + COUNT(price)) // (2 * COUNT(price)) AS DOUBLE) "
        "/ 100000 AS mean, round(stddev_samp(CAST(price AS DOUBLE)), 5) AS std, "
        f"CAST(min(price) AS DOUBLE) AS min, {quart}, CAST(max(price) AS DOUBLE) AS max "
        f"FROM {src}")


@register("describe_price", _describe_sql("snapshot"))
def describe_price(spark, sf_dir):
    return ST.describe_price(_snapshot(spark, sf_dir))


@register("describe_price_all", _describe_sql("books"))
def describe_price_all(spark, sf_dir):
    return ST.describe_price(_books(spark, sf_dir))


# Fixed values in the next two oracles: headings, rules and labels of the report layouts.
def _statistics_report_sql() -> str:
    rule = "'" + "=" * 50 + "'"
    cents = "CAST(price * 100 AS BIGINT)"
    # half-even average to cents, in integers
    avg = (f"(SELECT CAST((q + CASE WHEN 2 * r > n OR (2 * r = n AND q % 2 = 1) THEN 1 ELSE 0 "
           f"END) AS DOUBLE) / 100 FROM (SELECT SUM({cents}) // COUNT(price) AS q, "
           f"SUM({cents}) % COUNT(price) AS r, COUNT(price) AS n FROM snapshot) a)")
    hi = "CAST(CAST((SELECT max(price) FROM snapshot) AS DOUBLE) AS VARCHAR)"
    lo = "CAST(CAST((SELECT min(price) FROM snapshot) AS DOUBLE) AS VARCHAR)"
    dear = (f"(SELECT title FROM snapshot WHERE price IS NOT NULL ORDER BY price DESC, "
            f"{_LOG_ORDER_SQL} LIMIT 1)")
    cheap = (f"(SELECT title FROM snapshot WHERE price IS NOT NULL ORDER BY price ASC, "
             f"{_LOG_ORDER_SQL} LIMIT 1)")
    head = [rule, "'       BOOKS.TOSCRAPE.COM - DATA ANALYSIS'", rule,
            "'Data Source : Parquet tables'",
            "'Total books in dataset: ' || CAST((SELECT COUNT(*) FROM snapshot) AS VARCHAR)",
            "''", "'--- Price Statistics ---'", f"'Average price: ' || CAST({avg} AS VARCHAR)",
            f"'Highest price: ' || {hi}", f"'Lowest price:  ' || {lo}", "''",
            f"'Most expensive: ' || {dear} || ' (' || {hi} || ')'",
            f"'Cheapest:       ' || {cheap} || ' (' || {lo} || ')'", "''",
            "'--- Rating Distribution ---'", "'Stars | Count'", "'" + "-" * 20 + "'"]
    labels = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    stats = ("SELECT printf('%.6f', CAST(COUNT(price) AS DOUBLE)) AS v0, "
             "printf('%.6f', CAST(SUM(price) AS DOUBLE) / COUNT(price)) AS v1, "
             "printf('%.6f', stddev_samp(CAST(price AS DOUBLE))) AS v2, "
             "printf('%.6f', CAST(min(price) AS DOUBLE)) AS v3, "
             "printf('%.6f', quantile_cont(CAST(price AS DOUBLE), 0.25)) AS v4, "
             "printf('%.6f', quantile_cont(CAST(price AS DOUBLE), 0.5)) AS v5, "
             "printf('%.6f', quantile_cont(CAST(price AS DOUBLE), 0.75)) AS v6, "
             "printf('%.6f', CAST(max(price) AS DOUBLE)) AS v7 FROM snapshot")
    tz = ", ".join(f"length(v{i}) - length(rtrim(v{i}, '0'))" for i in range(8))
    cuts = [f"substr(v{i}, 1, length(v{i}) - k)" for i in range(8)]
    width = "greatest(" + ", ".join(f"length({c})" for c in cuts) + ")"
    desc = ["''", "'--- Full Price Summary (.describe()) ---'"]
    desc += [f"rpad('{lab}', 5, ' ') || lpad({c}, CAST({width} + 4 AS INTEGER), ' ')"
             for lab, c in zip(labels, cuts)]
    desc += ["'Name: Price, dtype: float64'", "''", rule, "'Analysis complete.'"]

    def fixed(block, lines, src):
        return " UNION ALL ".join(
            f"SELECT {block} AS block, CAST(NULL AS VARCHAR) AS k1, CAST(NULL AS VARCHAR) AS k2, "
            f"CAST(NULL AS VARCHAR) AS k3, {i} AS sub, {x} AS line FROM {src}"
            for i, x in enumerate(lines))

    hist = ("SELECT 1 AS block, lpad(CAST(rn AS VARCHAR), 12, '0') AS k1, "
            "CAST(NULL AS VARCHAR) AS k2, CAST(NULL AS VARCHAR) AS k3, 0 AS sub, "
            "'  ' || CAST(rn AS VARCHAR) || '   |  ' || printf('%3d', c) || '  ' || "
            "repeat('*', CAST(c // 10 AS INTEGER)) AS line FROM ("
            f"SELECT {O.rating_int('rating')} AS rn, COUNT(*) AS c FROM snapshot GROUP BY 1) h")
    body = " UNION ALL ".join([fixed(0, head, "(SELECT 1) one"), hist,
                               fixed(2, desc, "dtext")])
    return O.more(f"dvals AS ({stats}), dtext AS (SELECT *, least({tz}, 5) AS k FROM dvals)",
                  f"SELECT * FROM ({body}) t WHERE line IS NOT NULL")


@register("statistics_report_lines", _statistics_report_sql())
def statistics_report_lines(spark, sf_dir):
    return R.ordered(R.statistics_report(_snapshot(spark, sf_dir), "Parquet tables",
                                         [B.LOG_ORDER]))


def _change_report_sql() -> str:
    rule, sub = "'" + "=" * 65 + "'", "'" + "-" * 65 + "'"
    pct = f"COALESCE(CAST({O.pct_half_even('price_new', 'price_old')} AS VARCHAR), 'inf')"
    money = "printf('£%.2f', CAST({c} AS DOUBLE))"
    old_new = (f"'  Old Price: ' || {money.format(c='price_old')} || '  |  New Price: ' || "
               f"{money.format(c='price_new')}")
    head = [rule, "'         PRICE CHANGE DETECTOR REPORT'", rule,
            "'Comparing date: ' || p || '  -->  ' || l", "'Data Source:    Parquet tables'",
            "'Total books checked: ' || CAST(compared AS VARCHAR)",
            "'Total price changes found: ' || CAST(total_changed AS VARCHAR)", rule, "''",
            "'[DECREASE] Price Drops (Good Deals):'", sub,
            "CASE WHEN drops = 0 THEN '  No price drops found.' END"]
    mid = ["'[INCREASE] Price Hikes (More Expensive):'", sub,
           "CASE WHEN hikes = 0 THEN '  No price increases found.' END"]
    tail = [rule, "'                       SUMMARY'", rule,
            "'  Checked Books   : ' || CAST(compared AS VARCHAR)",
            "'  Price Drops     : ' || CAST(drops AS VARCHAR)",
            "'  Price Hikes     : ' || CAST(hikes AS VARCHAR)",
            "'  Total Changes   : ' || CAST(total_changed AS VARCHAR)", rule]

    def fixed(block, lines):
        return " UNION ALL ".join(
            f"SELECT {block} AS block, CAST(NULL AS VARCHAR) AS k1, CAST(NULL AS VARCHAR) AS k2, "
            f"CAST(NULL AS VARCHAR) AS k3, {i} AS sub, {x} AS line FROM summ"
            for i, x in enumerate(lines))

    def per_row(block, cond, sign, paren):
        lines = ["'* ' || title",
                 f"{old_new} || '  |  Change: ' || {sign} || ' {paren}' || {pct} || '%)'",
                 "'  Link: ' || product_url", "''"]
        return " UNION ALL ".join(
            f"SELECT {block} AS block, title AS k1, product_url AS k2, "
            f"CAST(NULL AS VARCHAR) AS k3, {i} AS sub, {x} AS line FROM ch_url WHERE {cond}"
            for i, x in enumerate(lines))

    drop_sign = money.format(c="change")
    hike_sign = "printf('+£%.2f', CAST(change AS DOUBLE))"
    body = " UNION ALL ".join([fixed(0, head), per_row(1, "change < 0", drop_sign, "("),
                               fixed(2, mid), per_row(3, "change > 0", hike_sign, "(+"),
                               fixed(4, tail)])
    return O.changes(
        ", summ AS (SELECT COUNT(*) AS compared, COUNT(*) FILTER (WHERE change < 0) AS drops, "
        "COUNT(*) FILTER (WHERE change > 0) AS hikes, "
        "COUNT(*) FILTER (WHERE change <> 0 OR change IS NULL) AS total_changed, "
        "(SELECT strftime(previous_date, '%Y-%m-%d') FROM dates) AS p, "
        "(SELECT strftime(latest_date, '%Y-%m-%d') FROM dates) AS l FROM ch_url) "
        f"SELECT * FROM ({body}) t WHERE line IS NOT NULL")


@register("change_report_lines", _change_report_sql())
def change_report_lines(spark, sf_dir):
    fact = B.fact(spark, sf_dir)
    ch = _changes(spark, sf_dir, C.URL_KEYS, ())
    return R.ordered(R.change_report(ch, S.previous_date(fact), S.latest_date(fact),
                                     "Parquet tables"))


# ---------------------------------------------------------------- cleaning and display scalars
@register("rating_parse", O.q(
    f"SELECT rating, {O.rating_int('rating')} AS rating_numeric, COUNT(*) AS n "
    "FROM books GROUP BY rating"))
def rating_parse(spark, sf_dir):
    return (_books(spark, sf_dir).groupBy("rating")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("rating", X.parse_rating("rating").alias("rating_numeric"), "n"))


def _raw_texts(df: DataFrame) -> DataFrame:
    """Text as the extraction job sees it, derived from the stored values (X2-X5 inputs)."""
    odd = (F.col("stock_quantity") % 2) == 1
    return df.select(
        "upc", "date_collected",
        F.when(odd, F.concat(F.lit("Â£"), F.col("price").cast("string")))
         .otherwise(F.concat(F.lit("£"), F.col("price").cast("string"))).alias("price_text"),
        F.when(F.col("stock_quantity") > 0,
               F.concat(F.lit("In stock ("), F.col("stock_quantity").cast("string"),
                        F.lit(" available)")))
         .otherwise(F.lit("In stock")).alias("availability"),
        F.when(odd, F.concat(F.lit("catalogue/item_"), F.col("upc"), F.lit("/index.html")))
         .otherwise(F.concat(F.lit("../../item_"), F.col("upc"), F.lit("/index.html")))
         .alias("href"),
        F.when(F.col("stock_quantity") < 10, F.lit(None).cast("string"))
         .when(odd, F.concat(F.lit("catalogue/page-"), F.col("stock_quantity").cast("string"),
                             F.lit(".html")))
         .otherwise(F.concat(F.lit("page-"), F.col("stock_quantity").cast("string"),
                             F.lit(".html"))).alias("next_href"),
        F.concat(F.lit("  "), F.col("title"), F.lit(" ")).alias("title_text"))


@register("text_clean", O.q("""
, raw AS (
  SELECT upc, date_collected,
    CASE WHEN stock_quantity % 2 = 1 THEN 'Â£' ELSE '£' END || CAST(price AS VARCHAR) AS price_text,
    CASE WHEN stock_quantity > 0 THEN 'In stock (' || CAST(stock_quantity AS VARCHAR) || ' available)'
         ELSE 'In stock' END AS availability,
    CASE WHEN stock_quantity % 2 = 1 THEN 'catalogue/item_' || upc || '/index.html'
         ELSE '../../item_' || upc || '/index.html' END AS href,
    CASE WHEN stock_quantity < 10 THEN NULL
         WHEN stock_quantity % 2 = 1 THEN 'catalogue/page-' || CAST(stock_quantity AS VARCHAR) || '.html'
         ELSE 'page-' || CAST(stock_quantity AS VARCHAR) || '.html' END AS next_href,
    '  ' || title || ' ' AS title_text
  FROM books)
SELECT upc, date_collected,
  CAST(TRY_CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS DECIMAL(10,2)) AS DOUBLE) AS price,
  COALESCE(TRY_CAST(regexp_replace(availability, '[^0-9]', '', 'g') AS INTEGER), 0) AS stock_quantity,
  CASE WHEN contains(href, 'catalogue/') THEN 'https://books.toscrape.com/' || href
       ELSE 'https://books.toscrape.com/catalogue/' || href END AS product_url,
  CASE WHEN next_href IS NULL THEN NULL
       WHEN contains(next_href, 'catalogue') THEN 'https://books.toscrape.com/' || next_href
       ELSE 'https://books.toscrape.com/catalogue/' || next_href END AS next_url,
  trim(title_text) AS title,
  COALESCE(CASE WHEN stock_quantity = 0 THEN NULL ELSE title END, 'Unknown') AS category
FROM raw r JOIN (SELECT upc AS u2, date_collected AS d2, title, stock_quantity FROM books) b
  ON r.upc = b.u2 AND r.date_collected = b.d2
""".replace("\n, raw AS", ", raw AS", 1)))
def text_clean(spark, sf_dir):
    books = _books(spark, sf_dir)
    raw = _raw_texts(books.select("upc", "date_collected", "price", "stock_quantity", "title"))
    cleaned = raw.select(
        "upc", "date_collected",
        X.clean_price("price_text").cast("double").alias("price"),
        X.clean_stock("availability").alias("stock_quantity"),
        X.resolve_product_url("href").alias("product_url"),
        X.resolve_next_url("next_href").alias("next_url"),
        X.trimmed("title_text").alias("title"),
        X.or_unknown(F.when(F.col("availability") != "In stock",
                            F.regexp_extract("title_text", r"^\s*(.*?)\s*$", 1)))
         .alias("category"))
    return cleaned


@register("display_format", O.changes(
    "SELECT title, upc, printf('£%.2f', CAST(price_old AS DOUBLE)) AS old_price, "
    "printf('£%.2f', CAST(price_new AS DOUBLE)) AS new_price, "
    "CASE WHEN change < 0 THEN printf('-£%.2f', abs(CAST(change AS DOUBLE))) "
    "     ELSE printf('+£%.2f', CAST(change AS DOUBLE)) END AS change_text, "
    f"CASE WHEN change < 0 THEN printf('%.2f%%', {O.pct_half_even('price_new', 'price_old')}) "
    f"     ELSE printf('+%.2f%%', {O.pct_half_even('price_new', 'price_old')}) END AS pct_text "
    "FROM ch_upc WHERE change <> 0"))
def display_format(spark, sf_dir):
    ch = C.changed(_changes(spark, sf_dir)).where(F.col("change").isNotNull())
    return ch.select(
        "title", "upc", FM.money("price_old").alias("old_price"),
        FM.money("price_new").alias("new_price"),
        F.when(F.col("change") < 0, FM.money_drop("change"))
         .otherwise(FM.money_gain("change")).alias("change_text"),
        F.when(F.col("change") < 0, FM.percent("pct"))
         .otherwise(FM.percent_gain("pct")).alias("pct_text"))


@register("kpi_display", O.q(
    "SELECT format('{:,}', COUNT(*)) AS catalog_size, "
    f"printf('£%.2f', {O.avg2('price')}) AS average_price, "
    "format('{:,}', CAST(SUM(stock_quantity) AS BIGINT)) AS total_inventory, "
    "CAST(COUNT(DISTINCT category) AS VARCHAR) AS total_categories FROM books"))
def kpi_display(spark, sf_dir):
    k = A.kpis(_books(spark, sf_dir))
    return k.select(FM.thousands("total_books").alias("catalog_size"),
                    FM.money("avg_price").alias("average_price"),
                    FM.thousands("total_stock").alias("total_inventory"),
                    F.col("unique_categories").cast("string").alias("total_categories"))


# ---------------------------------------------------------------- data quality and loads
from shelfwatch.operators import quality as Q  # noqa: E402
from shelfwatch.sinks.warehouse import merge_catalog  # noqa: E402


def _rule_sql(src: str) -> str:
    conds = [("title_not_null", "title IS NULL"), ("product_url_not_null", "product_url IS NULL"),
             ("price_not_null", "price IS NULL"), ("date_not_null", "date_collected IS NULL"),
             ("upc_not_null", "upc IS NULL"), ("price_non_negative", "price < 0"),
             ("stock_non_negative", "stock_quantity < 0"),
             ("price_precision", "abs(price) >= 100000000"),
             ("upc_length", "length(upc) > 50"), ("category_length", "length(category) > 100"),
             ("rating_length", "length(rating) > 20")]
    parts = [f"SELECT '{n}' AS rule, upc, date_collected FROM {src} WHERE {c}"
             for n, c in conds]
    parts.append(f"SELECT 'unique_upc_date' AS rule, upc, date_collected FROM {src} "
                 "GROUP BY upc, date_collected HAVING COUNT(*) > 1")
    parts.append("SELECT 'one_date_per_batch' AS rule, CAST(NULL AS VARCHAR) AS upc, d "
                 f"FROM (SELECT DISTINCT date_collected AS d FROM {src} "
                 "WHERE date_collected IS NOT NULL) t "
                 f"WHERE (SELECT COUNT(DISTINCT date_collected) FROM {src}) > 1")
    return " UNION ALL ".join(parts)


@register("constraint_violations", O.q(_rule_sql("raw_log")))
def constraint_violations(spark, sf_dir):
    return Q.violations(B.raw_log(spark, sf_dir))


@register("snapshot_violations", O.q(_rule_sql("snapshot")))
def snapshot_violations(spark, sf_dir):
    return Q.violations(_snapshot(spark, sf_dir))


@register("orphans", O.q(
    "SELECT upc, date_collected, CAST(price AS DOUBLE) AS price FROM fact f "
    "WHERE upc IS NOT NULL AND NOT EXISTS (SELECT 1 FROM snapshot s WHERE s.upc = f.upc)"))
def orphans(spark, sf_dir):
    current = _snapshot(spark, sf_dir).select("upc", "title", "category", "product_url")
    return (Q.orphans(B.fact(spark, sf_dir), current)
            .select("upc", "date_collected", F.col("price").cast("double").alias("price")))


@register("upsert_catalog", O.more("""
existing AS (
  SELECT upc, title, category, product_url FROM (
    SELECT *, row_number() OVER (PARTITION BY upc ORDER BY date_collected DESC, l_shipdate DESC,
      l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC,
      l_quantity DESC) AS rn
    FROM history WHERE date_collected < (SELECT latest_date FROM dates)) t WHERE rn = 1),
incoming AS (
  SELECT upc, title, category || ' @' || CAST(date_collected AS VARCHAR) AS category,
         product_url FROM snapshot)
""", "SELECT * FROM existing e WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.upc = e.upc) "
     "UNION ALL SELECT * FROM incoming"))
def upsert_catalog(spark, sf_dir):
    hist = B.history(spark, sf_dir)
    fact = B.fact(spark, sf_dir)
    before = hist.where(F.col("date_collected") < S.latest_date(fact))
    existing = merge_catalog(spark.createDataFrame([], "upc string, title string, "
                                                   "category string, product_url string"),
                             before, ["date_collected", B.LOG_ORDER])
    incoming = _snapshot(spark, sf_dir).withColumn(
        "category", F.concat("category", F.lit(" @"), F.col("date_collected").cast("string")))
    return merge_catalog(existing, incoming, ["date_collected", B.LOG_ORDER])


# ---------------------------------------------------------------- HTML pages (generic profile)
from shelfwatch.sources import html as H  # noqa: E402


def _decode(x: str) -> str:
    """HTML text decoding of the entities present in the pages; the semicolon is optional
    (legacy references such as a truncated '&amp' decode too). '&amp' goes last so its
    output is never decoded twice."""
    out = x
    for ent, ch in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        out = f"regexp_replace({out}, '&{ent};?', '{ch}', 'g')"
    return out


def _pages(spark, sf_dir):
    return H.parse_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _extract(pattern: str) -> str:
    return _decode(f"regexp_extract(html, '(?s){pattern}', 1)")


_NAV_RE = '<li><a href="([^"]*)">(.*?)</a></li>'


@register("page_headings",
          f"SELECT page_id, url, {_extract('<title>(.*?)</title>')} AS title, "
          f"{_extract('<h1>(.*?)</h1>')} AS h1 FROM pages")
def page_headings(spark, sf_dir):
    return H.page_headings(_pages(spark, sf_dir))


@register("page_links",
          "SELECT page_id, CAST(pos AS INTEGER) AS pos, "
          f"{_decode('href')} AS href, {_decode('text')} AS text FROM ("
          "SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS href, unnest(t) AS text "
          "FROM (SELECT page_id, "
          f"regexp_extract_all(nav, '{_NAV_RE}', 1) AS h, "
          f"regexp_extract_all(nav, '{_NAV_RE}', 2) AS t FROM ("
          "SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages) a"
          ") b) c")
def page_links(spark, sf_dir):
    return H.page_links(_pages(spark, sf_dir))


# ---------------------------------------------------------------- extensions
from shelfwatch.operators import evolution as EV  # noqa: E402


@register("scd2_rating", O.more("""
daily AS (SELECT upc, date_collected, max(rating) AS rating FROM fact
          GROUP BY upc, date_collected),
marked AS (SELECT upc, rating, date_collected AS valid_from,
                  lag(rating) OVER (PARTITION BY upc ORDER BY date_collected) AS prev_r,
                  row_number() OVER (PARTITION BY upc ORDER BY date_collected) AS rn
           FROM daily),
versions AS (SELECT upc, rating, valid_from FROM marked
             WHERE rn = 1 OR prev_r IS DISTINCT FROM rating)
""", "SELECT upc, rating, valid_from, "
     "lead(valid_from) OVER (PARTITION BY upc ORDER BY valid_from) AS valid_to, "
     "lead(valid_from) OVER (PARTITION BY upc ORDER BY valid_from) IS NULL AS is_current "
     "FROM versions"))
def scd2_rating(spark, sf_dir):
    return EV.scd2(B.fact(spark, sf_dir), "upc", ["rating"], unique_per_date=True)


@register("scd2_dimension", O.more("""
daily AS (SELECT * FROM (SELECT upc, title, category || '-' || CAST(stock_quantity % 2 AS VARCHAR) AS category,
            product_url, date_collected, row_number() OVER (PARTITION BY upc, date_collected ORDER BY l_shipdate DESC,
              l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS last
          FROM raw_log) t WHERE last = 1),
marked AS (SELECT upc, title, category, product_url, date_collected AS valid_from,
                  row_number() OVER (PARTITION BY upc ORDER BY date_collected) AS rn,
                  lag(title) OVER w AS pt, lag(category) OVER w AS pc,
                  lag(product_url) OVER w AS pu
           FROM daily WINDOW w AS (PARTITION BY upc ORDER BY date_collected)),
versions AS (SELECT upc, title, category, product_url, valid_from FROM marked
             WHERE rn = 1 OR pt IS DISTINCT FROM title OR pc IS DISTINCT FROM category
                OR pu IS DISTINCT FROM product_url)
""", "SELECT upc, title, category, product_url, valid_from, "
     "lead(valid_from) OVER (PARTITION BY upc ORDER BY valid_from) AS valid_to, "
     "lead(valid_from) OVER (PARTITION BY upc ORDER BY valid_from) IS NULL AS is_current "
     "FROM versions"))
def scd2_dimension(spark, sf_dir):
    """Over the raw log, with a category that changes from run to run and within a date."""
    log = B.raw_log(spark, sf_dir).withColumn("category", F.concat(
        "category", F.lit("-"), (F.col("stock_quantity") % 2).cast("string")))
    return EV.scd2(log.repartition("upc", "date_collected"), order=[B.LOG_ORDER])      # dealt as in dedup_history


@register("fact_upsert", O.more("""
ex AS (SELECT upc, price, rating, stock_quantity, date_collected FROM fact
       WHERE date_collected = (SELECT latest_date FROM dates)),
bt AS (SELECT upc, price, rating, stock_quantity,
              (SELECT latest_date FROM dates) AS date_collected
       FROM fact WHERE date_collected = (SELECT previous_date FROM dates))
""", "SELECT COALESCE(e.upc, b.upc) AS upc, "
     "CAST(CASE WHEN b.upc IS NOT NULL THEN b.price ELSE e.price END AS DOUBLE) AS price, "
     "CASE WHEN e.upc IS NOT NULL THEN e.rating ELSE b.rating END AS rating, "
     "CASE WHEN b.upc IS NOT NULL THEN b.stock_quantity ELSE e.stock_quantity END "
     "AS stock_quantity, COALESCE(e.date_collected, b.date_collected) AS date_collected "
     "FROM ex e FULL OUTER JOIN bt b ON e.upc = b.upc AND e.date_collected = b.date_collected"))
def fact_upsert(spark, sf_dir):
    fact = B.fact(spark, sf_dir).select("upc", "price", "rating", "stock_quantity",
                                        "date_collected")
    existing = S.snapshot_at(fact, S.latest_date(fact))
    late = (S.snapshot_at(fact, S.previous_date(fact))
            .withColumn("date_collected", S.latest_date(fact)))
    out = EV.merge_facts(existing, late)
    return out.withColumn("price", F.col("price").cast("double"))


ALERT_PCT = 10.0


@register("price_alerts", O.changes(
    f"SELECT * FROM (SELECT title, upc, product_url, category, {O.change_cols()} FROM ch_upc "
    f"WHERE change < 0) t WHERE abs(pct) >= {ALERT_PCT}"))
def price_alerts(spark, sf_dir):
    return _change_out(C.price_alerts(_changes(spark, sf_dir), ALERT_PCT))


@register("rating_by_category", O.q(
    "SELECT category, CASE WHEN COUNT(r) = 0 THEN NULL ELSE "
    "CAST((2 * SUM(r) * 100 + COUNT(r)) // (2 * COUNT(r)) AS DOUBLE) / 100 END AS avg_rating, "
    "COUNT(r) AS rated, COUNT(*) - COUNT(r) AS unrated FROM ("
    f"SELECT category, CASE WHEN {O.rating_int('rating')} BETWEEN 1 AND 5 "
    f"THEN {O.rating_int('rating')} END AS r FROM snapshot) t GROUP BY category"))
def rating_by_category(spark, sf_dir):
    return EV.rating_by_category(_snapshot(spark, sf_dir))


SERIES_FROM, SERIES_TO = "1998-01-01", "1999-12-31"


@register("price_series_range", O.q(
    f"SELECT {WIDE_OUT} FROM books "
    f"WHERE date_collected BETWEEN DATE '{SERIES_FROM}' AND DATE '{SERIES_TO}'"))
def price_series_range(spark, sf_dir):
    return _wide_out(EV.price_series(_books(spark, sf_dir), SERIES_FROM, SERIES_TO))


# ---------------------------------------------------------------- the SQL statements
from shelfwatch.plans import sql as SQ  # noqa: E402


def _sql_query(name: str) -> Query:
    def fn(spark, sf_dir):
        return SQ.run(spark, name, _books(spark, sf_dir))
    fn.__name__ = f"sql_{name}"
    return fn


for _n in SQ.STATEMENTS:
    register(f"sql_{_n}", _ORACLE[_n])(_sql_query(_n))


@register("scd2_rating_incremental", _ORACLE["scd2_rating"])
def scd2_rating_incremental(spark, sf_dir):
    """E1 incremental: the SCD2 table of all dates before the latest one, with the latest
    date's batch applied, must equal the SCD2 table built over all dates."""
    fact = B.fact(spark, sf_dir).select("upc", "rating", "date_collected")
    latest = S.latest_date(fact)
    before = EV.scd2(fact.where(F.col("date_collected") < latest), "upc", ["rating"],
                     unique_per_date=True)
    batch = S.snapshot_at(fact, latest)
    return EV.scd2_apply(before, batch, "upc", ["rating"])


@register("scd2_late_batches", _ORACLE["scd2_rating"].replace(
    "FROM versions", ", (SELECT CAST(count(*) AS INTEGER) FROM fact f WHERE f.upc = versions.upc "
    "AND f.date_collected >= versions.valid_from AND f.date_collected < coalesce((SELECT min(v.valid_from) FROM versions v "
    "WHERE v.upc = versions.upc AND v.valid_from > versions.valid_from), DATE '9999-12-31')) AS n_observed FROM versions"))
def scd2_late_batches(spark, sf_dir):
    """E1, late batches: all observations in four batches whose dates interleave, the newest
    first; the table equals SCD2 over all of them."""
    fact = B.fact(spark, sf_dir).select("upc", "rating", "date_collected")
    part = F.pmod(F.col("upc").cast("long") * 7 + F.year("date_collected") * 4 + F.quarter("date_collected"), F.lit(4))
    partitions = fact.count() // 250_000 + 1                         # footers are read, no rows
    table = None
    for n in (3, 0, 2, 1):
        table = EV.scd2_merge(table, fact.where(part == n), "upc", ["rating"], partitions=partitions)
    return table.withColumn("n_observed", F.size("observed")).drop("observed")


from shelfwatch.plans import registry_ledger, registry_loads  # noqa: E402, F401  (register their queries)
