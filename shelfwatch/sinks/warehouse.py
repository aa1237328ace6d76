"""Warehouse loads: dimension upsert, idempotent day replace, CSV sinks.

Layout under ``root``::

    catalog/version=<n>/part-*.parquet        product dimension, one full copy per version
    history/date_collected=<d>/part-*.parquet price fact, one partition per collection date
    snapshot/                                 latest run as CSV (overwritten)       K1
    archive/run_date=<d>/                     every run as CSV, one folder per day  K2
    log/                                      append-only CSV log of every run      K3

Plain parquet has no MERGE, so the dimension upsert writes a complete new version next
to the old ones and readers take the highest version; the fact load overwrites exactly
the partition of the batch date (``partitionOverwriteMode=dynamic``), so re-running a day
replaces it and leaves every other day untouched.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.operators.dedup import dedup_keep_last
from shelfwatch.operators.evolution import merge_facts
from shelfwatch.operators.quality import ValidationError, split_valid, violations
from shelfwatch.operators.snapshots import books_view
from shelfwatch.schemas import CATALOG, CSV_HEADER, CSV_WRITE, HISTORY, WIDE_COLUMNS
from shelfwatch.session import checkpointed

CATALOG_COLS = [f.name for f in CATALOG.fields]
HISTORY_COLS = [f.name for f in HISTORY.fields]


def merge_catalog(existing: DataFrame, batch: DataFrame, order: list) -> DataFrame:
    """K4 as a pure DataFrame: batch rows de-duplicated last-wins per upc (W3) replace the
    existing rows with the same upc; all other existing rows stay.

    The anti-join ships only the batch's upc column; no broadcast is forced because the
    batch can be as large as the catalog.
    """
    names = [c for c in order if isinstance(c, str)]
    new = batch.select(*dict.fromkeys(CATALOG_COLS + names))
    new = dedup_keep_last(new, ["upc"], order).select(*CATALOG_COLS)
    return existing.select(*CATALOG_COLS).join(new.select("upc"), "upc", "left_anti") \
        .unionByName(new)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog_path = f"{self.root}/catalog"
        self.history_path = f"{self.root}/history"
        self.snapshot_path = f"{self.root}/snapshot"
        self.archive_path = f"{self.root}/archive"
        self.log_path = f"{self.root}/log"

    # ------------------------------------------------------------------ K6
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def table_name(self, table: str, database: str | None = None) -> str:
        """Name of a table of this warehouse in the session's catalog: bound to the root, so
        that any number of warehouses lie side by side."""
        fs, p = self._fs(self.root)
        mark = hashlib.sha256(str(fs.makeQualified(p)).encode()).hexdigest()[:12]
        return ".".join(f"`{x}`" for x in (database, f"{table}_{mark}") if x)

    def ensure_tables(self, database: str | None = None) -> str:
        """CREATE TABLE IF NOT EXISTS: make the folders, and register the data.

        The price fact becomes a table of the session's catalog over its folder; where that
        catalog is persistent (a metastore) so is the table. Its name holds a mark of the
        root and is returned. The dimension changes its folder with each version, so it is a
        view over the current one. The temporary views ``price_history``, ``catalog``,
        ``history`` and ``books`` show the warehouse that was registered last.
        """
        for path in (self.catalog_path, self.history_path):
            if not self._exists(path):
                fs, p = self._fs(path)
                fs.mkdirs(p)
        name = self.table_name("price_history", database)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HISTORY.fields)
        location = self.history_path.replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                       f"PARTITIONED BY (date_collected) LOCATION '{location}'")
        self.spark.catalog.recoverPartitions(name)
        self.spark.table(name).createOrReplaceTempView("price_history")
        self.catalog().createOrReplaceTempView("catalog")
        self.history().createOrReplaceTempView("history")
        self.books().createOrReplaceTempView("books")
        return name

    # ------------------------------------------------------------------ reads
    def versions(self) -> list[int]:
        """Published dimension versions, from the folder names (one entry per version)."""
        fs, p = self._fs(self.catalog_path)
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("version="))

    def catalog(self, version: int | None = None) -> DataFrame:
        """One dimension version (default: the current, i.e. highest, one)."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], CATALOG)
        path = f"{self.catalog_path}/version={found[-1] if version is None else version}"
        return self.spark.read.schema(CATALOG).parquet(path)

    def history(self) -> DataFrame:
        if not self._exists(self.history_path):
            return self.spark.createDataFrame([], HISTORY)
        return (self.spark.read.schema(HISTORY).option("basePath", self.history_path)
                .parquet(self.history_path).select(*HISTORY_COLS))

    def books(self) -> DataFrame:
        return books_view(self.catalog(), self.history())

    # ------------------------------------------------------------------ K4
    def upsert_catalog(self, batch: DataFrame, order: list[str] | None = None) -> int:
        """ON CONFLICT (upc) DO UPDATE: last row per upc of the batch wins (W3), every
        existing product not in the batch is kept. Returns the new version number."""
        return self._next_version(lambda now: merge_catalog(now, batch, order or ["ingest_seq"]))

    def _next_version(self, change: Callable[[DataFrame], DataFrame], tries: int = 5) -> int:
        """Publish ``change(current dimension)`` as the version after the current one.

        Version numbers count up from the folder names, whatever the clocks say. If another
        load publishes that number first, the change is made again on what it published, so
        no load is lost.
        """
        for _ in range(tries):
            found = self.versions()
            base = found[-1] if found else 0
            now = self.catalog(base) if found else self.spark.createDataFrame([], CATALOG)
            if self._publish_catalog(change(now), base + 1):
                return base + 1
        raise OSError(f"could not publish a catalog version in {tries} tries: other loads came first")

    def _publish_catalog(self, rows: DataFrame, version: int) -> bool:
        """Write a complete dimension version to a staging folder (names starting with '_'
        are invisible to readers), then rename it to ``version=<v>`` in one step, so a
        reader never sees a half-written version even if the job dies mid-commit. False if
        that version exists by then."""
        staging = f"_staging-{uuid.uuid4().hex}"
        rows.select(*CATALOG_COLS).write.mode("overwrite").parquet(f"{self.catalog_path}/{staging}")
        fs, src = self._fs(f"{self.catalog_path}/{staging}")
        target = f"{self.catalog_path}/version={version}"
        _, dst = self._fs(target)
        if fs.exists(dst) or not fs.rename(src, dst):
            fs.delete(src, True)
            return False
        # where the target appeared just before, the rename put our folder inside it
        _, inside = self._fs(f"{target}/{staging}")
        if fs.exists(inside):
            fs.delete(inside, True)
            return False
        return True

    def vacuum_catalog(self, keep: int = 2) -> list[int]:
        """Delete all but the ``keep`` newest dimension versions; returns the removed ones.

        Only folder names are listed (one entry per version), no data is read.
        """
        versions = self.versions()
        old = versions[:-keep] if keep > 0 else versions
        for v in old:
            fs, p = self._fs(f"{self.catalog_path}/version={v}")
            fs.delete(p, True)
        return old

    # ------------------------------------------------------------------ K5
    def _overwrite_days(self, rows: DataFrame) -> None:
        """Replace the partitions of the dates in ``rows``. The rebalance hint gathers each
        date in few files and still splits a large one over several tasks."""
        (rows.select(*HISTORY_COLS).hint("rebalance", "date_collected")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("date_collected").parquet(self.history_path))

    def replace_day(self, batch: DataFrame) -> None:
        """DELETE the batch's date(s) then INSERT, as one dynamic partition overwrite."""
        self._overwrite_days(batch)

    # ------------------------------------------------------------------ E2
    def upsert_facts(self, batch: DataFrame, order: list[str] | None = None,
                     updated: Sequence[str] = ("price", "stock_quantity")) -> None:
        """ON CONFLICT (upc, date_collected) DO UPDATE of ``updated``, else INSERT.

        Of repeated keys in the batch the last by ``order`` counts. Only the partitions of
        the batch's dates are read and rewritten (the merged rows go to the checkpoint
        folder first, since the write replaces what they are read from). Applying a batch
        twice changes nothing, so it can be replayed.
        """
        order = order or ["ingest_seq"]
        batch = dedup_keep_last(batch.select(*dict.fromkeys([*HISTORY_COLS, *order])),
                                ["upc", "date_collected"], order).select(*HISTORY_COLS)
        with checkpointed(batch) as new:
            dates = [r[0] for r in new.select("date_collected").distinct().collect()]  # one per day
            if not dates:
                return
            old = self.history().where(F.col("date_collected").isin(dates))
            with checkpointed(merge_facts(old, new, updated=updated)) as merged:
                self._overwrite_days(merged)

    # ------------------------------------------------------------------ J6
    def delete_products(self, upcs: DataFrame) -> None:
        """ON DELETE CASCADE: drop products and their facts.

        Facts go first, so a run that breaks off leaves products without some facts, never
        facts without product; running it again completes it. Only the partitions that hold
        a deleted product are rewritten; those left empty are removed.
        """
        with checkpointed(upcs.select("upc").distinct()) as keys:
            hist = self.history()
            touched = hist.join(keys, "upc", "left_semi").select("date_collected").distinct()
            dates = [r[0] for r in touched.collect()]      # one row per touched day
            if dates:
                rest = hist.where(F.col("date_collected").isin(dates)).join(keys, "upc", "left_anti")
                with checkpointed(rest) as rest:
                    self._overwrite_days(rest)
                    remaining = {r[0] for r in rest.select("date_collected").distinct().collect()}
                for d in dates:
                    if d not in remaining:
                        fs, p = self._fs(f"{self.history_path}/date_collected={d.isoformat()}")
                        fs.delete(p, True)
            self._next_version(lambda now: now.join(keys, "upc", "left_anti"))

    # ------------------------------------------------------------------ K1, K2, K3, K9
    @staticmethod
    def _csv_columns(df: DataFrame) -> list:
        """The CSV columns; line breaks inside a text become blanks, so that every record is
        one line and the files can be split."""
        texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        return [(F.regexp_replace(c, r"[\r\n]+", " ") if c in texts else F.col(c).cast("string")).alias(h)
                for c, h in zip(WIDE_COLUMNS, CSV_HEADER)]

    def _to_csv_columns(self, df: DataFrame) -> DataFrame:
        return df.select(*self._csv_columns(df))

    def write_snapshot(self, batch: DataFrame) -> None:
        """K1: overwrite the latest-run CSV."""
        self._to_csv_columns(batch).write.mode("overwrite").options(**CSV_WRITE) \
            .csv(self.snapshot_path)

    def archive(self, batch: DataFrame) -> None:
        """K2: one CSV folder per run date; re-running a day replaces only that folder. The
        files keep all eight columns, the folder's date is a copy."""
        out = batch.select(*self._csv_columns(batch), F.col("date_collected").alias("run_date"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .options(**CSV_WRITE).partitionBy("run_date").csv(self.archive_path)

    def append_log(self, batch: DataFrame, batch_id: int) -> None:
        """K3: append to the CSV log with (Batch_Id, Row_Id) so "last" survives re-reads.

        Not idempotent by itself (a re-run appends again); readers repair with W1.
        """
        if "ingest_seq" not in batch.columns:
            batch = batch.withColumn("ingest_seq", F.monotonically_increasing_id())
        rows = batch.select(*self._csv_columns(batch), F.lit(str(batch_id)).alias("Batch_Id"),
                            F.col("ingest_seq").cast("string").alias("Row_Id"))
        rows.write.mode("append").options(**CSV_WRITE).csv(self.log_path)

    def export(self, df: DataFrame, path: str) -> None:
        """K9: any wide frame (snapshot, history) as CSV with the original header."""
        self._to_csv_columns(df).write.mode("overwrite").options(**CSV_WRITE).csv(path)

    # ------------------------------------------------------------------ K10
    def ingest(self, batch: DataFrame, run_date: str | None = None,
               batch_id: int | None = None, write_csv: bool = True) -> dict:
        """Validate, then load one whole run: dimension upsert, day replace, CSV sinks.

        Every rule is checked before the first write, so a rejected batch writes nothing.
        The writes themselves follow one another (dimension, then fact, so a run that breaks
        off leaves no fact without product); running the load again completes it. The batch
        is held in the checkpoint folder meanwhile, so that ``ingest_seq`` (input order) and
        the upstream parse are computed once, even if executors are lost.
        """
        if run_date is not None:                                        # P5
            batch = batch.withColumn("date_collected", F.lit(run_date).cast("date"))
        batch = batch.select(*WIDE_COLUMNS).withColumn(
            "ingest_seq", F.monotonically_increasing_id())
        with checkpointed(batch) as batch:
            sample = violations(batch).limit(20).collect()
            if sample:
                raise ValidationError([r.asDict() for r in sample])
            batch_id = batch_id if batch_id is not None else int(time.time() * 1000)
            version = self.upsert_catalog(batch)
            self.replace_day(batch)
            if write_csv:
                self.write_snapshot(batch)
                self.archive(batch)
                self.append_log(batch, batch_id)
        return {"catalog_version": version, "batch_id": batch_id}

    # ------------------------------------------------------------------ E6
    def ingest_part(self, batch: DataFrame, order: list[str], batch_id: int,
                    write_log: bool = True) -> DataFrame:
        """Load a part of one or several runs by upsert; returns the rows that break a rule.

        ``order`` names the columns that say which of repeated rows came last. Parts applied
        in that order give the same tables as all of them at once, and a part may be applied
        again. On a repeated (upc, date) the whole later row counts.
        """
        rows = batch.withColumn("ingest_seq", F.monotonically_increasing_id())
        good, bad = split_valid(rows)
        with checkpointed(good) as good:
            if good.limit(1).count():
                self._next_version(lambda now: merge_catalog(now, good, order))
                self.upsert_facts(good, order, updated=[c for c in HISTORY_COLS if c not in ("upc", "date_collected")])
                if write_log:
                    self.append_log(good, batch_id)
        return bad
