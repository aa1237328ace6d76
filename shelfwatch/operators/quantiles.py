"""Exact quantiles of any column of numbers in bounded memory (A12 beyond cent prices).

``percentile`` keeps one entry for each distinct value in a single task. Here the order
statistics are selected in passes over the data instead, each an aggregate with map-side
combine whose buffers have a fixed size:

* a pass draws an equal-depth histogram (``percentile_approx`` of ``accuracy`` entries) of the
  values still in question around the wanted rank, and counts exactly what lies below, at and
  between its bounds;
* if the rank falls on a bound, its value is known, however often it occurs; else the next pass
  looks strictly between the two bounds that hold the rank.

A pass leaves some 4 / ``accuracy`` of the values, so two or three passes do for any number of
rows; the last few (``at_hand`` for each rank) are sorted on the driver. The exact counts decide,
so the result doesn't depend on the histogram's quality.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY, AT_HAND = 10_000, 20_000


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int], n: int, *, accuracy: int = ACCURACY,
                     at_hand: int = AT_HAND) -> dict[int, float]:
    """The values at ``ranks`` (from 0) among the ``n`` values of ``column`` that aren't NULL."""
    x = F.col("_x")
    rows = df.select(F.col(column).cast("double").alias("_x")).where(x.isNotNull())
    found: dict[int, float] = {}
    # rank -> (bounds, exclusive, None where open; values up to the lower one; values between them)
    open_ = {r: (None, None, 0, n) for r in ranks if 0 <= r < n}

    def between(low: float | None, high: float | None) -> Column:
        c = F.lit(True) if low is None else x > F.lit(low)
        return c if high is None else c & (x < F.lit(high))

    while wide := {r: b for r, b in open_.items() if b[3] > at_hand}:
        fractions = {r: [min(max((r - b[2] + d * b[3] / accuracy) / b[3], 0.0), 1.0) for d in (-2, 2)]
                     for r, b in wide.items()}
        guess = rows.agg(*[F.percentile_approx(F.when(between(*b[:2]), x), F.array(*map(F.lit, fractions[r])), accuracy)
                           .alias(f"g{r}") for r, b in wide.items()]).first()
        bounds = {r: guess[f"g{r}"] for r in wide}
        counts = rows.agg(*[F.count_if(test).alias(f"{k}{r}") for r, (low, high) in bounds.items() for k, test in (
            ("a", x < F.lit(low)), ("b", x <= F.lit(low)), ("c", x < F.lit(high)), ("d", x <= F.lit(high)))]).first()
        for r, (low, high) in bounds.items():
            below, to_low, to_high, all_ = (counts[f"{k}{r}"] for k in "abcd")
            had = open_[r]
            if below <= r < to_low or to_high <= r < all_:
                found[r] = low if r < to_low else high
                del open_[r]
            elif r < below:                                         # the histogram was off
                open_[r] = had[0], low, had[2], below - had[2]
            elif r >= all_:
                open_[r] = high, had[1], all_, had[2] + had[3] - all_
            else:
                open_[r] = low, high, to_low, to_high - to_low
    if open_:
        keep = F.lit(False)
        for low, high, _, _ in open_.values():
            keep = keep | between(low, high)
        values = sorted((row[0] for row in rows.where(keep).collect()), key=lambda v: (v != v, v))   # at_hand a rank
        for r, (low, _, below, _) in open_.items():
            first = 0 if low is None else next(i for i, v in enumerate(values) if not v <= low)
            found[r] = values[first + r - below]
    return found


def quantiles(df: DataFrame, column: str, fractions: Sequence[float], **options) -> list[float | None]:
    """Quantiles with linear interpolation between neighbours; NULLs don't count. None without values."""
    n = df.where(F.col(column).isNotNull()).count()
    places = [f * (n - 1) for f in fractions]
    at = order_statistics(df, column, sorted({k for p in places for k in (math.floor(p), math.ceil(p))}), n, **options)
    return [None if not n else at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p))
            if math.floor(p) != math.ceil(p) else at[math.floor(p)] for p in places]


def describe(df: DataFrame, column: str, fractions: Sequence[float] = (0.25, 0.5, 0.75), **options) -> DataFrame:
    """A12 for any numbers: count, mean, std, min, the quantiles as p<percent>, max; one row."""
    found = quantiles(df, column, fractions, **options)
    x = F.col(column).cast("double")
    return df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                  *[F.lit(q).cast("double").alias(f"p{100 * f:g}") for q, f in zip(found, fractions)], F.max(x).alias("max"))
