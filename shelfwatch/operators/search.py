"""Catalog search: composed filters and presets.

``search_catalog`` is one ``where`` per active criterion, so Catalyst folds them into
a single filter next to the scan (pushed to parquet where the predicate allows it).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.clean import parse_rating

ALL = "All"
ALL_STARS = (1, 2, 3, 4, 5)


@dataclass(frozen=True)
class SearchSpec:
    """What the user asked for. Defaults select the whole snapshot (ratings 1-5)."""

    keyword: str = ""                     # F9, empty = no filter
    keyword_regex: bool = True            # F9 is a case-insensitive regex; False = literal
    title: str | None = None              # F14: exact title, overrides every other filter
    category: str = ALL                   # F10, "All" = no filter
    ratings: tuple[int, ...] = ALL_STARS  # F11, empty = no rows
    price_min: float | None = None        # F12 inclusive; None = snapshot minimum
    price_max: float | None = None        # F12 inclusive; None = snapshot maximum
    in_stock_only: bool = False           # F13
    low_stock: bool = False               # F8: 1 <= stock <= 3 (set by the preset)
    low_stock_max: int = 3


def presets(bargain_max: float = 20.0, premium_min: float = 50.0) -> dict[str, SearchSpec]:
    """the five one-click views. Choosing one resets keyword, title and category."""
    base = SearchSpec()
    return {
        "all": base,
        "five_star": replace(base, ratings=(5,)),
        "bargain": replace(base, price_max=bargain_max),
        "low_stock": replace(base, in_stock_only=True, low_stock=True),
        "premium": replace(base, price_min=premium_min),
    }


PRESETS = presets()


def keyword_match(keyword: str, regex: bool = True, cols=("title", "upc")) -> Column:
    """case-insensitive match on any of ``cols``; NULL text never matches.

    The regex dialect is Java's (the source used Python's); ``regex=False`` matches the
    keyword literally.
    """
    conds = []
    for c in cols:
        if regex:
            m = F.col(c).rlike("(?i)" + keyword)
        else:
            m = F.lower(F.col(c)).contains(keyword.lower())
        conds.append(F.coalesce(m, F.lit(False)))
    out = conds[0]
    for m in conds[1:]:
        out = out | m
    return out


def _price(bound: float | str | Decimal) -> Column:
    """A price bound as a decimal literal; a double would keep the range from the scan."""
    return F.lit(Decimal(str(bound)))


def search_catalog(snapshot: DataFrame, spec: SearchSpec) -> DataFrame:
    """apply ``spec`` to a snapshot; returns the display columns."""
    df = snapshot
    if "rating_numeric" not in df.columns:
        df = df.withColumn("rating_numeric", parse_rating("rating"))
    if spec.title is not None:
        df = df.where(F.col("title") == F.lit(spec.title))
    else:
        if spec.low_stock:
            df = df.where(F.col("stock_quantity").between(1, spec.low_stock_max))
        if spec.keyword:
            df = df.where(keyword_match(spec.keyword, spec.keyword_regex))
        if spec.category != ALL:
            df = df.where(F.col("category") == F.lit(spec.category))
        if spec.ratings:
            df = df.where(F.col("rating_numeric").isin(list(spec.ratings)))
        else:
            df = df.where(F.lit(False))
        # An open end of the slider is the snapshot's own min/max, which every non-NULL
        # price satisfies: only a NULL price is excluded.
        price = F.col("price")
        df = df.where(price.isNotNull())
        if spec.price_min is not None:
            df = df.where(price >= _price(spec.price_min))
        if spec.price_max is not None:
            df = df.where(price <= _price(spec.price_max))
        if spec.in_stock_only:
            df = df.where(F.col("stock_quantity") > 0)
    return df.select("upc", "title", "category", "price", "rating_numeric",
                     "stock_quantity", "product_url")
