"""Date-over-date price change detection.

J2, J3, P3, P4, X6, X7, F3-F6, O6, A16, W2 (through ``snapshots``).

The two dates compared are the two most recent *global* collection dates: a product
missing on either date is not compared, even when it has older prices. Keys are matched
null-safely (NULL equals NULL, like a pandas merge), which keeps the join an equi-join
(sort-merge or broadcast, never a nested loop).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.operators.snapshots import latest_date, previous_date, snapshot_at

URL_KEYS = ("title", "product_url")          # report flavour
UPC_KEYS = ("title", "upc")                  # dashboard flavour
UPC_CARRY = ("product_url", "category")      # taken from the older snapshot


def change_amount(old: Column, new: Column) -> Column:
    """New - old, exact on DECIMAL(10,2) (DECIMAL(11,2) result)."""
    return (new - old).cast("decimal(11,2)")


def change_percent(change: Column, old: Column) -> Column:
    """Percent of the (already rounded) change, half-even to 2 places, exact decimal.

    A zero old price has no percentage: NULL (pandas would print inf or NaN).
    """
    return F.bround(F.try_divide(change * 100, old), 2).cast("double")


def price_changes(prev: DataFrame, latest: DataFrame, keys: Sequence[str] = UPC_KEYS,
                  carry: Sequence[str] = UPC_CARRY) -> DataFrame:
    """Inner join of two snapshots on ``keys``; adds price_old, price_new, change, pct.

    Only the key, carried and price columns are read (P3); ``carry`` columns come from
    the older snapshot (P4).
    """
    keys, carry = list(keys), list(carry)
    old = prev.select(*[F.col(k).alias(f"_ok{i}") for i, k in enumerate(keys)],
                      *[F.col(c) for c in carry], F.col("price").alias("price_old"))
    new = latest.select(*[F.col(k).alias(f"_nk{i}") for i, k in enumerate(keys)],
                        F.col("price").alias("price_new"))
    cond = [old[f"_ok{i}"].eqNullSafe(new[f"_nk{i}"]) for i in range(len(keys))]
    joined = old.join(new, cond, "inner")
    change = change_amount(F.col("price_old"), F.col("price_new"))
    return (joined.select(*[F.col(f"_ok{i}").alias(k) for i, k in enumerate(keys)],
                          *carry, "price_old", "price_new")
                  .withColumn("change", change)
                  .withColumn("pct", change_percent(F.col("change"), F.col("price_old"))))


def latest_changes(books: DataFrame, history: DataFrame | None = None,
                   keys: Sequence[str] = UPC_KEYS,
                   carry: Sequence[str] = UPC_CARRY) -> DataFrame:
    """Changes between the two most recent collection dates of ``history``.

    With fewer than two dates the previous date is NULL, so the result is empty
    (no simulated changes are made up).
    """
    h = books if history is None else history
    prev = snapshot_at(books, previous_date(h))
    latest = snapshot_at(books, latest_date(h))
    return price_changes(prev, latest, keys, carry)


def changed(ch: DataFrame) -> DataFrame:
    """every row whose change is not zero; an unknown (NULL) change counts as changed."""
    return ch.where((F.col("change") != 0) | F.col("change").isNull())


def drops(ch: DataFrame, min_pct: float = 0.0) -> DataFrame:
    """F4 + F6 + O6: price drops with |pct| >= min_pct, steepest first."""
    out = ch.where(F.col("change") < 0)
    if min_pct:
        out = out.where(F.abs(F.col("pct")) >= F.lit(float(min_pct)))
    return out.orderBy(F.col("pct").asc_nulls_last(), *_tie(ch))


def hikes(ch: DataFrame) -> DataFrame:
    """F5 + O6: price hikes, largest percentage first."""
    return ch.where(F.col("change") > 0).orderBy(F.col("pct").desc_nulls_last(), *_tie(ch))


def _tie(ch: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("title", "upc", "product_url")
            if c in ch.columns]


def change_summary(ch: DataFrame) -> DataFrame:
    """Compared, drops, hikes and changed rows in one aggregation pass."""
    c = F.col("change")
    return ch.agg(F.count(F.lit(1)).alias("compared"),
                  F.count_if(c < 0).alias("drops"),
                  F.count_if(c > 0).alias("hikes"),
                  F.count_if((c != 0) | c.isNull()).alias("total_changed"))


def consecutive_changes(history: DataFrame) -> DataFrame:
    """E3 over a whole history: each observation beside the one before it of the same product.

    (upc, date_collected) must be unique. Rows: upc, date_collected, previous_date, price_old,
    price_new, change, pct (all but the date and new price NULL for a product's first date).
    """
    w = Window.partitionBy("upc").orderBy("date_collected")
    rows = history.select("upc", "date_collected", F.lag("date_collected").over(w).alias("previous_date"),
                          F.lag("price").over(w).alias("price_old"), F.col("price").alias("price_new"))
    return with_change(rows)


def with_change(rows: DataFrame) -> DataFrame:
    """X6, X7 as columns ``change`` and ``pct`` of ``price_old`` and ``price_new``."""
    return rows.withColumn("change", change_amount(F.col("price_old"), F.col("price_new"))).withColumn(
        "pct", change_percent(F.col("change"), F.col("price_old")))


def price_alerts(ch: DataFrame, threshold_pct: float) -> DataFrame:
    """Drops at least ``threshold_pct`` percent deep, ready for a notification sink."""
    return drops(ch, threshold_pct).select(
        *[c for c in ("title", "upc", "product_url", "category") if c in ch.columns],
        "price_old", "price_new", "change", "pct")
