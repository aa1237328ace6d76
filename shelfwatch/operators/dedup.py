"""Keep-last de-duplication.

Expressed as an aggregate, ``max_by(row, order)``, rather than a window: the aggregate
combines map-side, so a key holding a third of all rows shrinks to one row per map task
before the shuffle and no single task ever sorts the hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dedup_keep_last(df: DataFrame, keys: Sequence[str],
                    order: Sequence[Column | str] = ("ingest_seq",)) -> DataFrame:
    """One row per ``keys``: the row that is last in the lexicographic ``order``.

    ``order`` must be unique within a key (e.g. ``ingest_seq``); NULL keys form their own
    group, as in pandas ``drop_duplicates``. Output keeps ``df``'s column order.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    order_struct = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order))])
    picked = (df.groupBy(*keys)
                .agg(F.max_by(F.struct(*payload), order_struct).alias("_last")))
    return picked.select(*[F.col(k) if k in keys else F.col(f"_last.{k}").alias(k)
                           for k in df.columns])


def dedup_keep_first(df: DataFrame, keys: Sequence[str],
                     order: Sequence[Column | str] = ("ingest_seq",)) -> DataFrame:
    """Mirror of :func:`dedup_keep_last` (first row in ``order`` wins)."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    order_struct = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order))])
    picked = (df.groupBy(*keys)
                .agg(F.min_by(F.struct(*payload), order_struct).alias("_first")))
    return picked.select(*[F.col(k) if k in keys else F.col(f"_first.{k}").alias(k)
                           for k in df.columns])
