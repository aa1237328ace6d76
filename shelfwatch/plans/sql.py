"""The hand-run analysis statements over the flat ``books`` rows, in Spark SQL.

``run(spark, name, books)`` binds the DataFrame to ``{books}`` (no global temp view, so
concurrent callers never see each other's tables); ``register_views`` is there for
interactive use with plain ``spark.sql``. Every ORDER BY carries a unique tie-break so a
LIMIT picks well-defined rows; NULLs sort as in the source database (last ascending,
first descending).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The eight statements and the column names of their contract.
STATEMENTS = {
    "total_records":
        "SELECT COUNT(*) AS total_scraped_records FROM {books}",
    "average_price":
        "SELECT CAST(ROUND(CAST(SUM(price) AS DECIMAL(20,2)) / "
        "CAST(COUNT(price) AS DECIMAL(20,0)), 2) AS DOUBLE) AS average_price FROM {books}",
    "top_expensive":
        "SELECT title, CAST(price AS DOUBLE) AS price, category, product_url FROM {books} "
        "ORDER BY price DESC NULLS FIRST, product_url, title, category LIMIT 10",
    "category_counts":
        "SELECT category, COUNT(*) AS book_count FROM {books} GROUP BY category "
        "ORDER BY book_count DESC, category",
    "category_avg_price":
        "SELECT category, CAST(ROUND(CAST(SUM(price) AS DECIMAL(20,2)) / "
        "CAST(COUNT(price) AS DECIMAL(20,0)), 2) AS DOUBLE) AS average_price, "
        "COUNT(*) AS book_count FROM {books} GROUP BY category "
        "ORDER BY average_price DESC NULLS FIRST, category",
    "category_stock":
        "SELECT category, CAST(SUM(stock_quantity) AS BIGINT) AS total_items_in_stock "
        "FROM {books} GROUP BY category ORDER BY total_items_in_stock DESC NULLS FIRST, category",
    "scarce_stock":
        "SELECT title, category, stock_quantity, product_url FROM {books} "
        "WHERE stock_quantity <= 2 ORDER BY stock_quantity, product_url, title, category "
        "LIMIT 15",
    "observation_counts":
        "SELECT title, upc, COUNT(*) AS scrape_runs_logged FROM {books} GROUP BY title, upc "
        "ORDER BY scrape_runs_logged DESC, title, upc LIMIT 10",
}


def run(spark: SparkSession, name: str, books: DataFrame) -> DataFrame:
    return spark.sql(STATEMENTS[name], books=books)


def register_views(catalog: DataFrame, history: DataFrame, books: DataFrame) -> None:
    """Session views ``books_catalog``, ``price_history`` and ``books`` for ad-hoc SQL."""
    catalog.createOrReplaceTempView("books_catalog")
    history.createOrReplaceTempView("price_history")
    books.createOrReplaceTempView("books")
