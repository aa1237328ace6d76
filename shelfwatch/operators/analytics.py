"""Catalog analytics: counts, averages, roll-ups and top-k lists.

A1-A5, A7-A11, A14, A17, A18, O1-O5, O7, F7, P2, P6.

Conventions
* SQL-flavoured operators (over the flat ``books`` rows) keep a NULL group; the
  dashboard-flavoured ones (``dropna=True``) drop it, as pandas ``value_counts`` does.
* Averages are rounded exactly: decimal sum / count, then ``round`` (half up), so no
  intermediate 6-digit average is rounded twice.
* Every top-k gets a unique tie-break so that the k rows are well defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.functions.clean import parse_rating
from shelfwatch.functions.fmt import right_align, star_bar


def exact_avg(col: str | Column, scale: int = 2) -> Column:
    """Average of a DECIMAL column rounded half-up to ``scale`` places, exactly.

    ``sum`` is exact for decimals; dividing by the count as DECIMAL(20,0) keeps 20
    fractional digits, far more than a tie could need, then one rounding step.
    """
    c = F.col(col) if isinstance(col, str) else col
    total = F.sum(c).cast("decimal(20,2)")
    n = F.count(c).cast("decimal(20,0)")
    return F.round(total / n, scale)


def total_records(books: DataFrame) -> DataFrame:
    """A1: row count."""
    return books.agg(F.count(F.lit(1)).alias("total_scraped_records"))


def average_price(books: DataFrame) -> DataFrame:
    """A2: ROUND(AVG(price), 2) (SQL flavour: half away from zero)."""
    return books.agg(exact_avg("price").cast("double").alias("average_price"))


def price_bounds(snapshot: DataFrame) -> DataFrame:
    """A3: lowest and highest price (search slider bounds)."""
    return snapshot.agg(F.min("price").cast("double").alias("min_price"),
                        F.max("price").cast("double").alias("max_price"))


def kpis(snapshot: DataFrame) -> DataFrame:
    """A17 = A1 + A2 + A4 + A5 in one pass (pandas flavour: NULLs skipped)."""
    return snapshot.agg(
        F.count(F.lit(1)).alias("total_books"),
        exact_avg("price").cast("double").alias("avg_price"),
        F.sum("stock_quantity").cast("bigint").alias("total_stock"),
        F.count_distinct("category").alias("unique_categories"),
    )


def _top(df: DataFrame, top: int | None, *order: Column) -> DataFrame:
    out = df.orderBy(*order)
    return out.limit(top) if top is not None else out


def category_counts(df: DataFrame, top: int | None = None, dropna: bool = False) -> DataFrame:
    """Products per category, most first (ties by category)."""
    src = df.where(F.col("category").isNotNull()) if dropna else df
    agg = src.groupBy("category").agg(F.count(F.lit(1)).alias("book_count"))
    return _top(agg, top, F.col("book_count").desc(), F.col("category").asc_nulls_first())


def category_avg_price(df: DataFrame, top: int | None = None,
                       dropna: bool = False) -> DataFrame:
    """Rounded average price and count per category, dearest first.

    The SQL flavour orders by the rounded average; the dashboard flavour (``dropna``) ranks
    and cuts by the exact one, so of two that round alike the dearer comes first.
    """
    src = df.where(F.col("category").isNotNull()) if dropna else df
    exact = F.sum("price").cast("decimal(20,2)") / F.count("price").cast("decimal(20,0)")
    agg = src.groupBy("category").agg(
        exact_avg("price").cast("double").alias("average_price"),
        F.count(F.lit(1)).alias("book_count"), exact.alias("_exact"))
    rank = F.col("_exact" if dropna else "average_price").desc_nulls_first()
    return _top(agg, top, rank, F.col("category").asc_nulls_first()).drop("_exact")


def category_stock(df: DataFrame, top: int | None = None, dropna: bool = False) -> DataFrame:
    """A10: total stock per category, largest first."""
    src = df.where(F.col("category").isNotNull()) if dropna else df
    agg = src.groupBy("category").agg(
        F.sum("stock_quantity").cast("bigint").alias("total_items_in_stock"))
    return _top(agg, top, F.col("total_items_in_stock").desc_nulls_first(),
                F.col("category").asc_nulls_first())


# ---------------------------------------------------------------- roll-ups of the star
# Over the full history the fact is first summed per product, then joined: the shuffle and
# the join carry one row per product instead of one per observation.
def product_totals(history: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per product of the dimension with facts: n, price_sum, price_n, stock (sums and counts)."""
    sums = history.groupBy("upc").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(20,2)").alias("price_sum"),
        F.count("price").alias("price_n"), F.sum("stock_quantity").alias("stock"))
    return sums.join(catalog.select("upc", "title", "category"), "upc")


def _star_average(scale: int = 2) -> Column:
    total = F.sum("price_sum").cast("decimal(20,2)")
    return F.round(total / F.nullif(F.sum("price_n"), F.lit(0)).cast("decimal(20,0)"), scale).cast("double")


def star_total_records(totals: DataFrame) -> DataFrame:
    """A1 over the star."""
    return totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_scraped_records"))


def star_average_price(totals: DataFrame) -> DataFrame:
    """A2 over the star."""
    return totals.agg(_star_average().alias("average_price"))


def star_category_counts(totals: DataFrame) -> DataFrame:
    """A8 over the star."""
    agg = totals.groupBy("category").agg(F.sum("n").alias("book_count"))
    return agg.orderBy(F.col("book_count").desc(), F.col("category").asc_nulls_first())


def star_category_avg_price(totals: DataFrame) -> DataFrame:
    """A9 over the star."""
    agg = totals.groupBy("category").agg(_star_average().alias("average_price"), F.sum("n").alias("book_count"))
    return agg.orderBy(F.col("average_price").desc_nulls_first(), F.col("category").asc_nulls_first())


def star_category_stock(totals: DataFrame) -> DataFrame:
    """A10 over the star."""
    agg = totals.groupBy("category").agg(F.sum("stock").cast("bigint").alias("total_items_in_stock"))
    return agg.orderBy(F.col("total_items_in_stock").desc_nulls_first(), F.col("category").asc_nulls_first())


def star_observation_counts(totals: DataFrame, n: int = 10) -> DataFrame:
    """A11 + O5 over the star."""
    agg = totals.groupBy("title", "upc").agg(F.sum("n").alias("scrape_runs_logged"))
    return agg.orderBy(F.col("scrape_runs_logged").desc(), F.col("title").asc_nulls_first(),
                       F.col("upc").asc_nulls_first()).limit(n)


def top_expensive(books: DataFrame, n: int = 10) -> DataFrame:
    """O1 + P2: the ``n`` dearest rows (TakeOrderedAndProject: per-task top-n, then merge)."""
    return (books.select("title", F.col("price").cast("double").alias("price"),
                         "category", "product_url")
                 .orderBy(F.col("price").desc_nulls_first(), F.col("product_url").asc(),
                          F.col("title").asc(), F.col("category").asc())
                 .limit(n))


def scarce_stock(books: DataFrame, max_qty: int = 2, n: int = 15) -> DataFrame:
    """F7 + O4: rows with ``stock_quantity <= max_qty``, scarcest first, first ``n``."""
    return (books.where(F.col("stock_quantity") <= max_qty)
                 .select("title", "category", "stock_quantity", "product_url")
                 .orderBy(F.col("stock_quantity").asc(), F.col("product_url").asc(),
                          F.col("title").asc(), F.col("category").asc())
                 .limit(n))


def observation_counts(books: DataFrame, n: int = 10) -> DataFrame:
    """A11 + O5: observations per (title, upc), most observed first."""
    agg = books.groupBy("title", "upc").agg(F.count(F.lit(1)).alias("scrape_runs_logged"))
    return agg.orderBy(F.col("scrape_runs_logged").desc(), F.col("title").asc_nulls_first(),
                       F.col("upc").asc_nulls_first()).limit(n)


def with_rating_numeric(df: DataFrame) -> DataFrame:
    """Derived ``rating_numeric`` (X1) next to the stored rating text."""
    return df.withColumn("rating_numeric", parse_rating("rating"))


def rating_distribution(snapshot: DataFrame, per_star: int = 10) -> DataFrame:
    """A7 + A18 + O7 + X10 + X11: rows per star count with percent share and text bar.

    The share needs the grand total; it is taken with an unpartitioned window *after*
    the aggregation, so the single window task sees one row per distinct rating only.
    ``share_pct`` is rounded half-up in integer arithmetic (exact). The bar has one mark per
    ``per_star`` rows; raise it with the size of the snapshot.
    """
    agg = (with_rating_numeric(snapshot).groupBy("rating_numeric")
           .agg(F.count(F.lit(1)).alias("book_count")))
    total = F.sum("book_count").over(Window.partitionBy())
    basis_points = F.expr("(book_count * 20000 + _total) div (2 * _total)")
    return (agg.withColumn("_total", total)
               .withColumn("share_pct", basis_points.cast("double") / 100)
               .withColumn("stars", right_align("rating_numeric"))
               .withColumn("bar", star_bar("book_count", per_star))
               .drop("_total")
               .orderBy("rating_numeric"))


def pick_lists(snapshot: DataFrame) -> DataFrame:
    """Sorted distinct categories and titles for the search pick-lists, one table.

    ``kind`` is 'category' or 'title'; pandas ``unique`` keeps NULL, so does this.
    """
    cats = snapshot.select(F.lit("category").alias("kind"), F.col("category").alias("value"))
    titles = snapshot.select(F.lit("title").alias("kind"), F.col("title").alias("value"))
    return (cats.unionByName(titles).distinct()
                .orderBy("kind", F.col("value").asc_nulls_last()))
