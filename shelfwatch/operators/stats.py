"""Price statistics of a snapshot: arg-max / arg-min titles (A6) and describe()."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILES = (0.25, 0.5, 0.75)


def _order_struct(order: Sequence[Column | str]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(cols)])


def extremes(snapshot: DataFrame, order: Sequence[Column | str] = ("ingest_seq",)) -> DataFrame:
    """Title of the dearest and of the cheapest row; on a price tie the row that
    comes first in ``order`` wins (as ``idxmax`` / ``idxmin`` pick the first row).

    One aggregation with map-side combine: ``min_by`` over (−price, order) and
    (price, order); ``max_by`` alone would leave ties to chance.
    """
    return snapshot.agg(*extreme_columns(order))


def extreme_columns(order: Sequence[Column | str] = ("ingest_seq",)) -> list[Column]:
    """The four aggregate columns of :func:`extremes`, for use inside a larger ``agg``."""
    o = _order_struct(order)
    price = F.col("price")
    dear_key = F.when(price.isNotNull(), F.struct((-price).alias("p"), o.alias("o")))
    cheap_key = F.when(price.isNotNull(), F.struct(price.alias("p"), o.alias("o")))
    return [F.min_by("title", dear_key).alias("most_expensive_title"),
            F.max(price).cast("double").alias("highest_price"),
            F.min_by("title", cheap_key).alias("cheapest_title"),
            F.min(price).cast("double").alias("lowest_price")]


def describe_columns(approx: bool = False, accuracy: int = 100000,
                     rounded: bool = True) -> tuple[list[Column], list[Column]]:
    """Aggregate columns for :func:`describe_price` and the projection applied after the
    aggregate (so callers can fold describe() into a larger single ``agg``)."""
    p = F.col("price")
    d = p.cast("double")
    if approx:
        qs = F.percentile_approx(d, list(QUANTILES), accuracy)
    else:
        qs = F.percentile(d, F.array(*[F.lit(x) for x in QUANTILES]))
    mean = F.try_divide(F.sum(p).cast("decimal(20,2)"), F.count(p).cast("decimal(20,0)"))
    std = F.stddev_samp(d)
    if rounded:
        mean, std = F.round(mean, 5), F.round(std, 5)
    aggs = [F.count(p).alias("count"), mean.cast("double").alias("mean"), std.alias("std"),
            F.min(p).cast("double").alias("min"), qs.alias("_q"),
            F.max(p).cast("double").alias("max")]
    quart = [F.col("_q")[i] for i in range(len(QUANTILES))]
    if rounded:
        quart = [F.round(q, 4) for q in quart]
    post = [F.col("count"), F.col("mean"), F.col("std"), F.col("min"),
            *[q.alias(n) for q, n in zip(quart, ("p25", "p50", "p75"))], F.col("max")]
    return aggs, post


def describe_price(snapshot: DataFrame, approx: bool = False,
                   accuracy: int = 100000, rounded: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation) and max.

    ``percentile`` is exact; its aggregation buffer is a map price -> count, so memory is
    bounded by the number of distinct prices (cents), not by rows. ``approx=True`` uses
    ``percentile_approx`` (bounded by ``accuracy``) for unbounded value domains.
    The mean is exact (decimal sum / count) rounded half-up to 5 places; quartiles are
    rounded to 4 places (exact for cent prices); std to 5 places. ``rounded=False``
    returns the unrounded doubles (for display formatting).
    """
    aggs, post = describe_columns(approx, accuracy, rounded)
    return snapshot.agg(*aggs).select(*post)
