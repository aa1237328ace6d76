"""Star-schema reads: the books view, snapshots and collection dates.

J1, P1, S1-S3, F1, F2, A13, A15, W2, O8.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.schemas import WIDE_COLUMNS


def books_view(catalog: DataFrame, history: DataFrame) -> DataFrame:
    """J1 + P1: the flat ``books`` rows = fact JOIN dimension on upc.

    No broadcast hint: the dimension grows with the number of products, so the planner
    (``autoBroadcastJoinThreshold`` + AQE) decides from its measured size. A hot upc on the
    fact side is split by AQE's skew-join handling because the dimension side has one row
    per key.
    """
    dim = catalog.select("upc", "title", "category", "product_url")
    fact_cols = [c for c in history.columns if c not in ("title", "category", "product_url")]
    joined = history.select(*fact_cols).join(dim, "upc", "inner")
    extra = [c for c in joined.columns if c not in WIDE_COLUMNS]
    return joined.select(*WIDE_COLUMNS, *extra)


def full_history(books: DataFrame) -> DataFrame:
    """S2 + O8: every observation, oldest collection date first.

    The further keys (the whole row in the end) make the order unique, so the range sort can
    deal the rows of one large date over many tasks.
    """
    rest = [c for c in WIDE_COLUMNS if c not in ("date_collected", "upc") and c in books.columns]
    return books.orderBy(F.col("date_collected").asc_nulls_last(), "upc", *rest)


def latest_date(history: DataFrame) -> Column:
    """``(SELECT max(date_collected) FROM history)`` as a scalar-subquery column."""
    return history.select(F.max("date_collected")).scalar()


def latest_snapshot(books: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """rows of the most recent collection date of ``history`` (default: ``books``).

    The date is a scalar subquery, so nothing goes through the driver; on a table
    partitioned by ``date_collected`` the subquery prunes partitions at run time.
    """
    source = books if history is None else history
    return books.filter(F.col("date_collected") == latest_date(source))


def snapshot_at(books: DataFrame, date: str | _dt.date | Column) -> DataFrame:
    """F2 / S3: rows collected on one bound date (partition-pruned on a stored table)."""
    if isinstance(date, Column):
        d = date
    else:
        d = F.lit(str(date)).cast("date")
    return books.filter(F.col("date_collected") == d)


def collection_dates(history: DataFrame) -> DataFrame:
    """Distinct collection dates, ascending (NULL dates are not dates: dropped)."""
    return (history.select("date_collected").where(F.col("date_collected").isNotNull())
                   .distinct().orderBy("date_collected"))


def previous_date(history: DataFrame) -> Column:
    """Second most recent collection date, as a scalar subquery (NULL if only one)."""
    latest = latest_date(history)
    return (history.where(F.col("date_collected") < latest)
                   .select(F.max("date_collected")).scalar())


def last_two_dates(history: DataFrame) -> DataFrame:
    """One row (previous_date, latest_date); empty when fewer than two dates exist.

    Two scalar aggregates over the date column (partition metadata on a stored table)
    instead of a global window: no single task ever sees more than one value per
    partial aggregate.
    """
    one = history.sparkSession.range(1)
    return (one.select(previous_date(history).alias("previous_date"),
                       latest_date(history).alias("latest_date"))
               .where(F.col("previous_date").isNotNull()))
