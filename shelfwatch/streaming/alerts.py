"""Price alerts on a stream (E3): state per product, observations in any order.

Every observation is compared with the one before it *by date*, whenever either arrives. The
state of a product holds the dates seen with their prices, so a late row finds its neighbours,
and both pairs that it changes are given out again: rows (upc, date_collected) with the date and
price before, and a version that grows with each change of that product. ``current`` keeps the
last version, which is what ``operators.changes.consecutive_changes`` gives for all rows at once,
for any order of files and any division into micro-batches.

Products are dealt into a fixed number of groups by a hash of the upc. The states of a group lie
in one row and one call works on all of them with numpy, so that a micro-batch costs in proportion
to its observations (and the state of the groups it touches), not a Python call for each product.
``merged`` and ``pairs`` say for one product what ``_last`` and ``_before`` do for a group.

Of repeated rows of a (upc, date) the one that is last by ``ingest_seq`` counts (of equal ones
the larger price), whatever order they come in. Rows with a NULL in upc, date or price say
nothing and are left out.

``forget_after`` bounds the state: a product for which event time (the dates, by a watermark of
so many days) has passed its last date by as many days keeps that observation only. Rows older
than the watermark are dropped by Spark then; without it nothing is dropped or forgotten.

Each micro-batch writes its own folder, which a replay writes again, so results do not change
when a batch is repeated after a failure.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwatch.operators.changes import with_change
from shelfwatch.schemas import PRICE
from shelfwatch.session import ship_package

_PAIR = ("upc string, date_collected date, previous_date date, price_old decimal(10,2), price_new decimal(10,2), "
         "version long")
_FOUND = "upc string, day int, first boolean, day_before int, cents_before long, cents long, version long"
#: Of a group of products: its observations by product and day, as compressed Arrow rows.
_STATE = "observations binary"
_ROWS = pa.schema([("upc", pa.string()), ("day", pa.int32()), ("seq", pa.int64()), ("cents", pa.int64()), ("version", pa.int64())])
#: Groups that products are dealt into; must stay the same for a checkpoint.
GROUPS = 4096


def merged(known: dict[int, tuple[int, int]], rows: Iterator[tuple[int, int, int]]) -> dict[int, tuple[int, int]]:
    """Observations by day, (seq, cents) each, after further (day, seq, cents)."""
    out = dict(known)
    for day, seq, cents in rows:
        if day not in out or (seq, cents) >= out[day]:
            out[day] = seq, cents
    return out


def pairs(known: dict[int, tuple[int, int]]) -> dict[int, tuple]:
    """Of each day: (day before, cents before, cents)."""
    out, before = {}, (None, None)
    for day in sorted(known):
        out[day] = (*before, known[day][1])
        before = day, known[day][1]
    return out


def _key(codes: np.ndarray, days: np.ndarray) -> np.ndarray:
    """One number for (product, day), in that order."""
    return (codes.astype("int64") << 32) + days + 2**31


def _last(codes: np.ndarray, days: np.ndarray, seqs: np.ndarray, cents: np.ndarray) -> np.ndarray:
    """``merged`` for many products: places of the rows that count, by product and day."""
    order = np.lexsort((cents, seqs, days, codes))
    at = _key(codes[order], days[order])
    return order[np.append(at[1:] != at[:-1], True)]


def _before(codes: np.ndarray, days: np.ndarray, cents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pairs`` for many products, by product and day: whether a day is its product's first, day and cents before."""
    first = np.append(True, codes[1:] != codes[:-1])[:len(codes)]
    return first, np.where(first, 0, np.roll(days, 1)), np.where(first, 0, np.roll(cents, 1))


def _packed(rows: pd.DataFrame) -> bytes:
    out = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, schema=_ROWS, preserve_index=False)
    with pa.ipc.new_stream(out, _ROWS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_all().to_pandas()


def _task(forget_after: int | None):
    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = _unpacked(state.get[0]) if state.exists else _ROWS.empty_table().to_pandas()
        now, n, given = known[["upc", "day", "seq", "cents"]], len(known), []
        for rows in batches if not state.hasTimedOut else ():
            if len(rows):
                given.append(rows["upc"].unique())
                now = pd.concat([now, rows[["upc", "day", "seq", "cents"]]], ignore_index=True)
                codes = pd.factorize(now["upc"])[0]                    # known products come first, as they are sorted
                now = now.iloc[_last(codes, now["day"].to_numpy(), now["seq"].to_numpy(), now["cents"].to_numpy())]
        codes, names = pd.factorize(now["upc"])
        days, seqs, cents = (now[c].to_numpy() for c in ("day", "seq", "cents"))
        first, day_before, cents_before = _before(codes, days, cents)
        versions = np.zeros(len(names), "int64")
        changed = np.ones(len(now), bool)
        if n:                                                          # what is known stays: find it in what is now
            was = pd.Index(names).get_indexer(known["upc"])
            versions[was] = known["version"]
            at = np.searchsorted(_key(codes, days), _key(was, known["day"].to_numpy()))
            old = _before(was, known["day"].to_numpy(), known["cents"].to_numpy())
            changed[at] = ((first[at] != old[0]) | (day_before[at] != old[1]) | (cents_before[at] != old[2])
                           | (cents[at] != known["cents"].to_numpy()))
        versions[np.unique(codes[changed])] += 1
        keep = np.ones(len(now), bool)
        if forget_after is not None:
            ends = np.append(first[1:], True)[:len(first)]             # the last observation of each product
            passed = (days[ends].astype("int64") + forget_after) * 86_400_000
            mark = state.getCurrentWatermarkMs()
            quiet = ~np.isin(names, np.concatenate(given)) if given else np.ones(len(names), bool)
            keep = ends | ~((passed < mark) & quiet)[codes]
            open_ = np.bincount(codes[keep], minlength=len(names)) > 1
            if open_.any():
                state.setTimeoutTimestamp(max(int(passed[open_].min()), mark + 1))
        state.update((_packed(pd.DataFrame({"upc": names[codes[keep]], "day": days[keep], "seq": seqs[keep],
                                            "cents": cents[keep], "version": versions[codes[keep]]})),))
        if changed.any():
            c = changed
            yield pd.DataFrame({"upc": names[codes[c]], "day": days[c], "first": first[c], "day_before": day_before[c],
                                "cents_before": cents_before[c], "cents": cents[c], "version": versions[codes[c]]})
    return run


def changed_pairs(observations: DataFrame, forget_after: int | None = None, groups: int = GROUPS) -> DataFrame:
    """The stream of pairs that come to be or change; ``observations``: upc, date_collected, price, ingest_seq."""
    ship_package(observations.sparkSession)
    rows = observations.where("upc IS NOT NULL AND date_collected IS NOT NULL AND price IS NOT NULL").select(
        F.pmod(F.xxhash64("upc"), F.lit(groups)).cast("int").alias("group"),
        "upc", F.unix_date("date_collected").alias("day"), F.col("ingest_seq").cast("long").alias("seq"),
        (F.col("price") * 100).cast("long").alias("cents"), F.col("date_collected").cast("timestamp").alias("at"))
    if forget_after is not None:
        rows = rows.withWatermark("at", f"{forget_after} days")
    found = rows.groupBy("group").applyInPandasWithState(
        _task(forget_after), _FOUND, _STATE, "update",
        GroupStateTimeout.NoTimeout if forget_after is None else GroupStateTimeout.EventTimeTimeout)

    def money(cents: str) -> Column:
        return (F.col(cents).cast("decimal(12,0)") / 100).cast(PRICE)

    later = ~F.col("first")
    return found.select(
        "upc", F.date_from_unix_date("day").alias("date_collected"),
        F.when(later, F.date_from_unix_date("day_before")).alias("previous_date"),
        F.when(later, money("cents_before")).alias("price_old"), money("cents").alias("price_new"), "version")


def start_alerts(observations: DataFrame, target: str, checkpoint_location: str, *, forget_after: int | None = None,
                 available_now: bool = False, processing_time: str = "1 minute", groups: int = GROUPS) -> StreamingQuery:
    """Keep the pairs of a stream of observations under ``target`` (one folder a micro-batch).

    ``groups``: as many as make some ten thousand observations in each; fixed with the first run."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    writer = (changed_pairs(observations, forget_after, groups).writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The pairs as they stand, with change and percentage, as ``consecutive_changes`` gives them."""
    rows = spark.read.schema(_PAIR).parquet(target).drop("epoch")
    last = rows.groupBy("upc", "date_collected").agg(
        F.max_by(F.struct("previous_date", "price_old", "price_new"), "version").alias("_p"))
    return with_change(last.select("upc", "date_collected", "_p.*"))


def alerts(changes: DataFrame, min_pct: float) -> DataFrame:
    """Drops of ``min_pct`` percent at least, of ``current`` or ``consecutive_changes``."""
    return changes.where((F.col("change") < 0) & (F.abs("pct") >= F.lit(float(min_pct))))
