"""History-keeping extensions the source describes but never built.

* ``scd2``: slowly changing dimension, type 2, from dated observations.
* ``merge_facts``: upsert on (upc, date_collected) that updates price and stock only.
* ``rating_by_category``: ratings normalised to 1..5 and averaged.
* ``align_schema`` / ``union_evolving``: additive schema change without data loss.
* ``price_series``: one product's (or all) prices in a date range, partition-pruned.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.clean import parse_rating


def scd2(observations: DataFrame, key: str = "upc",
         attrs: Sequence[str] = ("title", "category", "product_url"),
         date: str = "date_collected", unique_per_date: bool = False,
         order: Sequence[str] | None = None, keep_dates: bool = False) -> DataFrame:
    """One row per version of ``attrs`` per ``key`` with ``valid_from`` /
    ``valid_to`` (exclusive, NULL while current) and ``is_current``.

    Observations are first reduced to one row per (key, date) — an aggregate with
    map-side combine, so a key with a huge number of raw rows shrinks before any window —
    and the window then sees at most one row per collection date of each key.
    If a key carries several attribute values on one date, the last by ``order`` wins
    (default: ``ingest_seq`` if there is such a column, else the largest values).
    ``unique_per_date=True`` (input already one row per key and date, e.g. the stored
    fact) skips that reduction and its shuffle. ``keep_dates=True`` adds ``observed``, the
    dates a version was seen on, which ``scd2_merge`` needs to split a version.
    """
    attrs = list(attrs)
    if keep_dates:
        return scd2_merge(None, observations, key, attrs, date, order)
    if unique_per_date:
        daily = observations.select(key, date, *attrs)
    else:
        if order is None:
            order = ["ingest_seq"] if "ingest_seq" in observations.columns else []
        daily = (observations.groupBy(key, date)
                 .agg(F.max_by(F.struct(*attrs), F.struct(*order, *attrs)).alias("_a"))
                 .select(key, date, *[F.col(f"_a.{a}").alias(a) for a in attrs]))
    w = Window.partitionBy(key).orderBy(date)
    prev = F.lag(F.struct(*attrs)).over(w)
    changed = daily.withColumn("_prev", prev).where(
        F.col("_prev").isNull() | ~F.struct(*attrs).eqNullSafe(F.col("_prev")))
    versions = changed.select(key, *attrs, F.col(date).alias("valid_from"))
    nxt = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return (versions.withColumn("valid_to", nxt)
                    .withColumn("is_current", F.col("valid_to").isNull()))


def scd2_apply(current: DataFrame, batch: DataFrame, key: str = "upc",
               attrs: Sequence[str] = ("title", "category", "product_url"),
               date: str = "date_collected") -> DataFrame:
    """E1 incremental: apply one dated batch (one row per key) to an SCD2 table.

    One full outer join of ``current`` with the batch on (key, is the version open): an
    unchanged key keeps its open row, a changed key emits its closed old row and a new open
    row, keys only on one side pass through, and closed (historic) versions meet nothing and
    pass through as well, so ``current`` is read once.

    For batches in the order of their dates only: a changed key whose open version starts on
    the batch's date or later ends the job with an error (see ``scd2_merge``).
    """
    attrs = list(attrs)
    o = current.select(
        key, F.col("is_current").alias("_open"), *[F.col(a).alias(f"_o_{a}") for a in attrs],
        F.col("valid_from").alias("_o_from"), F.col("valid_to").alias("_o_to"), F.lit(True).alias("_in_o"))
    b = batch.select(key, F.lit(True).alias("_open"), *[F.col(a).alias(f"_b_{a}") for a in attrs],
                     F.col(date).alias("_b_from"), F.lit(True).alias("_in_b"))
    j = o.join(b, [key, "_open"], "full_outer")
    same = F.struct(*[F.col(f"_o_{a}") for a in attrs]).eqNullSafe(
        F.struct(*[F.col(f"_b_{a}") for a in attrs]))
    in_o, in_b = F.col("_in_o").isNotNull(), F.col("_in_b").isNotNull()

    def version(prefix: str, start: str, end, current_flag) -> F.Column:
        return F.struct(*[F.col(f"{prefix}{a}").alias(a) for a in attrs],
                        F.col(start).alias("valid_from"), end.alias("valid_to"),
                        F.lit(current_flag).alias("is_current"))

    no_date = F.lit(None).cast("date")
    as_it_was = F.struct(*[F.col(f"_o_{a}").alias(a) for a in attrs], F.col("_o_from").alias("valid_from"),
                         F.col("_o_to").alias("valid_to"), F.col("_open").alias("is_current"))
    in_order = F.when(F.col("_b_from") > F.col("_o_from"), F.col("_b_from")).otherwise(F.raise_error(F.lit(
        "late batch: a version starts on its date or later; use scd2_merge")).cast("date"))
    old_closed = version("_o_", "_o_from", in_order, False)
    new_open = version("_b_", "_b_from", no_date, True)
    rows = (F.when(in_o & ~in_b, F.array(as_it_was))
             .when(~in_o & in_b, F.array(new_open))
             .when(same, F.array(as_it_was))
             .otherwise(F.array(old_closed, new_open)))
    return j.select(key, F.explode(rows).alias("_v")).select(key, "_v.*")


def scd2_merge(current: DataFrame | None, batch: DataFrame, key: str = "upc",
               attrs: Sequence[str] = ("title", "category", "product_url"),
               date: str = "date_collected", order: Sequence[str] | None = None,
               partitions: int | None = None) -> DataFrame:
    """E1 for batches of any dates in any order: ``current`` (with ``observed``, as
    ``scd2(keep_dates=True)`` builds it) after ``batch``.

    An observation inside a version of other attributes splits it at the dates the version
    was really seen on; neighbours that come to be equal are joined. So the table after any
    number of batches in any order is that of ``scd2`` over all their rows. An observation of
    a date that is known replaces what was seen on it; within a batch the last by ``order``
    counts (default as in ``scd2``).

    Batch rows are folded to one list of dates per key (map-side first) and meet the versions
    by one equi-join. Only versions that a new date falls into are opened to single dates, and
    only keys of the batch go through the window that joins neighbours.

    ``partitions``: into how many the keys are dealt for the windows, so that a task's memory
    follows from it (some hundred thousand observations each). By default Spark decides from the
    bytes shuffled, which compress to a small part of the rows' size in memory.
    """
    attrs = list(attrs)
    if order is None:
        order = ["ingest_seq"] if "ingest_seq" in batch.columns else []
    daily = (batch.groupBy(F.col(key).alias("_key"), F.col(date).alias("_date"))
             .agg(F.max_by(F.struct(*attrs), F.struct(*order, *attrs)).alias("_attrs")))
    seen = daily.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_date", "_attrs"))).alias("_new"))
    columns = [key, *attrs, "valid_from", "valid_to", "is_current", "observed"]
    if current is None:
        untouched = None
        pieces = seen.select("_key", F.explode("_new").alias("_e")).select(
            "_key", F.col("_e._attrs").alias("_attrs"), F.array("_e._date").alias("_dates"))
    else:
        old = current.select(F.col(key).alias("_key"), F.struct(*attrs).alias("_attrs"), "valid_from", "valid_to",
                             F.col("observed").alias("_dates"), F.lit(True).alias("_old"))
        new = seen.select(F.col("_key").alias("_batch_key"), "_new")
        met = (old.join(new, F.col("_key").eqNullSafe(F.col("_batch_key")), "full_outer")
               .withColumn("_key", F.when(F.col("_old"), F.col("_key")).otherwise(F.col("_batch_key"))))
        untouched = met.where(F.col("_new").isNull()).select(
            F.col("_key").alias(key), "_attrs.*", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"),
            F.col("_dates").alias("observed"))
        met = met.where(F.col("_new").isNotNull())
        pieces = _split(met.repartition(partitions, "_key") if partitions else met)
    if partitions and current is None:
        pieces = pieces.repartition(partitions, "_key")
    w = Window.partitionBy("_key").orderBy("_start")
    islands = (pieces.withColumn("_start", F.element_at("_dates", 1))
               .withColumn("_prev", F.lag(F.struct("_attrs")).over(w))
               .withColumn("_turn", F.when(F.col("_prev").isNotNull() & F.col("_attrs").eqNullSafe(
                   F.col("_prev._attrs")), 0).otherwise(1))
               .withColumn("_island", F.sum("_turn").over(w)))
    versions = islands.groupBy("_key", "_island").agg(
        F.first("_attrs").alias("_attrs"), F.array_sort(F.flatten(F.collect_list("_dates"))).alias("observed"))
    first = F.element_at("observed", 1)
    merged = (versions.withColumn("valid_from", first)
              .withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy("_key").orderBy("valid_from")))
              .select(F.col("_key").alias(key), "_attrs.*", "valid_from", "valid_to",
                      F.col("valid_to").isNull().alias("is_current"), "observed"))
    return (merged if untouched is None else untouched.unionByName(merged)).select(*columns)


def _split(met: DataFrame) -> DataFrame:
    """Versions beside the batch's observations of their key (``_new``) to (_key, _attrs, _dates):
    a version without a new date as it is, any other as single dates."""
    first = F.min("valid_from").over(Window.partitionBy("_key"))      # dates before it belong to the first version
    rows = met.withColumn("_first", F.col("valid_from") == first)
    mine = F.filter("_new", lambda e: F.col("_old").isNull() | (
        (F.col("_first") | (e["_date"] >= F.col("valid_from")))
        & (F.col("valid_to").isNull() | (e["_date"] < F.col("valid_to")))))
    rows = rows.withColumn("_mine", mine)
    taken = F.transform("_mine", lambda e: e["_date"])
    kept = F.filter("_dates", lambda d: ~F.array_contains(taken, d))

    def piece(attrs, dates):
        return F.struct(attrs.alias("_attrs"), dates.alias("_dates"))

    whole = F.array(piece(F.col("_attrs"), F.col("_dates")))
    single = F.concat(F.when(F.col("_old"), F.transform(kept, lambda d: piece(F.col("_attrs"), F.array(d))))
                       .otherwise(F.slice(whole, 1, 0)),
                      F.transform("_mine", lambda e: piece(e["_attrs"], F.array(e["_date"]))))
    return rows.select("_key", F.explode(F.when(F.size("_mine") == 0, whole).otherwise(single)).alias("_p")).select(
        "_key", "_p.*")


def merge_facts(existing: DataFrame, batch: DataFrame,
                keys: Sequence[str] = ("upc", "date_collected"),
                updated: Sequence[str] = ("price", "stock_quantity")) -> DataFrame:
    """Upsert on ``keys``: matching rows take ``updated`` columns from the batch and
    keep every other column; new keys are inserted as they come.

    A full outer equi-join on the keys (both sides scale with one day of products).
    """
    keys, updated = list(keys), list(updated)
    other = [c for c in existing.columns if c not in keys and c not in updated]
    o = existing.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in updated + other],
                        F.lit(True).alias("_in_o"))
    n = batch.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in updated + other
                              if c in batch.columns], F.lit(True).alias("_in_n"))
    j = o.join(n, keys, "full_outer")
    cols = []
    for c in existing.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in updated:
            cols.append(F.when(F.col("_in_n"), F.col(f"_n_{c}"))
                        .otherwise(F.col(f"_o_{c}")).alias(c))
        else:
            newer = F.col(f"_n_{c}") if c in batch.columns else F.lit(None)
            cols.append(F.when(F.col("_in_o"), F.col(f"_o_{c}")).otherwise(newer).alias(c))
    return j.select(*cols)


def rating_by_category(snapshot: DataFrame) -> DataFrame:
    """Ratings as INT 1..5 (0 = unrated, outside the range), averaged per category.

    The average is exact: integer sum / count rounded half-up to 2 places.
    """
    r = parse_rating("rating")
    rated = F.when(r.between(1, 5), r)
    return snapshot.groupBy("category").agg(
        F.round(F.try_divide(F.sum(rated).cast("decimal(20,0)"),
                             F.count(rated).cast("decimal(20,0)")), 2)
         .cast("double").alias("avg_rating"),
        F.count(rated).alias("rated"),
        F.count_if(rated.isNull()).alias("unrated"))


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """E5: add the target's missing columns as typed NULLs and order columns like it;
    columns unknown to the target are kept at the end (additive change, nothing lost)."""
    have = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
    extra = [c for c in df.columns if c not in {f.name for f in target.fields}]
    return df.select(*cols, *extra)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """E5: union of an older and a newer layout by column name, missing columns NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def price_series(books: DataFrame, start: str | _dt.date, end: str | _dt.date,
                 upc: str | None = None) -> DataFrame:
    """Observations with ``start <= date_collected <= end`` (partition-pruned on a
    stored table), optionally for one product, oldest first."""
    d = F.col("date_collected")
    out = books.where(d.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))
    if upc is not None:
        out = out.where(F.col("upc") == F.lit(upc))
    return out.orderBy(d, F.col("upc"))
