"""Data-quality rules of the star schema (D1-D7, J5, J6 as a check).

``violations`` returns one row ``(rule, upc, date_collected)`` per offence. Row rules are
evaluated in one pass (an array of failed rule names per row, exploded), the key rules
with one aggregation each, the foreign-key rule with one anti-join. Like SQL CHECK
constraints, range rules pass on NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: column limits of the stored tables ----------------------------------
MAX_UPC_LEN = 50
MAX_CATEGORY_LEN = 100
MAX_RATING_LEN = 20
MAX_PRICE_ABS = 10 ** 8  # NUMERIC(10,2): eight integer digits
# ------------------------------------------------------------------------------------------


def row_rules() -> list[tuple[str, Column]]:
    """(rule name, condition that flags an offending row)."""
    c = F.col
    return [
        ("title_not_null", c("title").isNull()),                     # D1
        ("product_url_not_null", c("product_url").isNull()),         # D1
        ("price_not_null", c("price").isNull()),                     # D1
        ("date_not_null", c("date_collected").isNull()),             # D1
        ("upc_not_null", c("upc").isNull()),                         # D5 (primary key)
        ("price_non_negative", c("price") < 0),                      # D2
        ("stock_non_negative", c("stock_quantity") < 0),             # D3
        ("price_precision", F.abs(c("price")) >= MAX_PRICE_ABS),     # D7
        ("upc_length", F.length(c("upc")) > MAX_UPC_LEN),            # D7
        ("category_length", F.length(c("category")) > MAX_CATEGORY_LEN),   # D7
        ("rating_length", F.length(c("rating")) > MAX_RATING_LEN),   # D7
    ]


def _row_violations(df: DataFrame) -> DataFrame:
    flags = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
                      for name, cond in row_rules()])
    return (df.select(F.explode(F.array_compact(flags)).alias("rule"), "upc",
                      "date_collected"))


def key_counts(df: DataFrame, keys=("upc", "date_collected")) -> DataFrame:
    """Rows per key (map-side pre-aggregated)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_keys(df: DataFrame, keys=("upc", "date_collected"),
                   rule: str = "unique_upc_date", counts: DataFrame | None = None
                   ) -> DataFrame:
    """One violation per key that occurs more than once."""
    counts = counts if counts is not None else key_counts(df, keys)
    dup = counts.where(F.col("_n") > 1)
    cols = [F.col(k) if k in keys else F.lit(None).cast(t)
            for k, t in (("upc", "string"), ("date_collected", "date"))]
    return dup.select(F.lit(rule).alias("rule"), *[c.alias(n) for c, n in
                                                   zip(cols, ("upc", "date_collected"))])


def orphans(history: DataFrame, catalog: DataFrame) -> DataFrame:
    """Fact rows whose non-NULL upc is missing from the dimension."""
    return (history.where(F.col("upc").isNotNull())
                   .join(catalog.select("upc"), "upc", "left_anti"))


def _orphan_violations(history: DataFrame, catalog: DataFrame) -> DataFrame:
    return orphans(history, catalog).select(F.lit("foreign_key_upc").alias("rule"), "upc",
                                            "date_collected")


def _multi_date(df: DataFrame, keyed: DataFrame | None = None) -> DataFrame:
    """A load batch must carry exactly one collection date (replace-by-date is per day).

    ``keyed`` (the per-(upc, date) counts, if already computed) is reused so the batch is
    not scanned again; the window runs over the distinct dates only, a handful of rows.
    """
    src = keyed if keyed is not None else df
    dates = src.select("date_collected").where(F.col("date_collected").isNotNull()).distinct()
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return (dates.withColumn("_n", n).where(F.col("_n") > 1)
                 .select(F.lit("one_date_per_batch").alias("rule"),
                         F.lit(None).cast("string").alias("upc"), "date_collected"))


def catalog_violations(catalog: DataFrame) -> DataFrame:
    """The dimension's primary key, upc neither NULL nor repeated."""
    null = catalog.where(F.col("upc").isNull()).select(
        F.lit("upc_not_null").alias("rule"), "upc", F.lit(None).cast("date").alias("date_collected"))
    known = catalog.where(F.col("upc").isNotNull())
    return null.unionByName(duplicate_keys(known, ("upc",), "primary_key_upc"))


def violations(batch: DataFrame, catalog: DataFrame | None = None,
               single_date: bool = True) -> DataFrame:
    """All rule violations of a wide load batch (columns as in ``schemas.WIDE``)."""
    keyed = key_counts(batch)
    out = _row_violations(batch).unionByName(duplicate_keys(batch, counts=keyed))
    if catalog is not None:
        out = out.unionByName(_orphan_violations(batch, catalog))
    if single_date:
        out = out.unionByName(_multi_date(batch, keyed))
    return out


def validate(batch: DataFrame, catalog: DataFrame | None = None
             ) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every row rule, all violations of the batch).

    Loads use the violations to accept or reject a whole batch; the valid rows serve
    callers that prefer to quarantine offending rows instead.
    """
    good, _ = split_valid(batch)
    return good, violations(batch, catalog)


def split_valid(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row-rule quarantine: (rows passing every row rule, rows failing one, with reasons)."""
    flags = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
                                      for name, cond in row_rules()]))
    tagged = batch.withColumn("_rules", flags)
    good = tagged.where(F.size("_rules") == 0).drop("_rules")
    bad = tagged.where(F.size("_rules") > 0).withColumnRenamed("_rules", "violated_rules")
    return good, bad


class ValidationError(Exception):
    """Raised by loads when a batch breaks a rule; ``sample`` holds some of its offences."""

    def __init__(self, sample: list):
        self.sample = sample
        super().__init__(f"batch rejected, e.g. {sample}")
