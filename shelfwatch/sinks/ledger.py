"""A warehouse whose loads are all-or-nothing over both tables.

Data files are never changed. Each load writes its own folders::

    catalog/load=<id>/                        rows of the dimension, bucketed by upc
    history/load=<id>/date_collected=<d>/     rows of the fact, bucketed by upc
    _ledger/<n>.json                          the n-th commit

and becomes visible by one small file that is created if it is absent: it names the folder of
every collection date, the dimension's base and its deltas, the columns of both tables, and the
loads so far. Readers resolve both tables through one commit, so they see a load whole or not at
all. A load that loses the race for a number makes its change again on the winner's state; a
load whose id is known changes nothing.

* Dimension: an upsert writes a delta of the batch's products. Readers merge base and deltas
  (the last value of each column wins); ``compact`` folds deltas into a new base.
* ``books`` joins the bucketed fact with the bucketed base without an exchange of either, and
  then with the deltas, which compaction keeps few.
* Dates are known from the commit: listing them, or taking the latest, reads no data.
* Columns may be added by any load. The commit keeps the columns of both tables; older files
  show NULL, later loads without the column leave it NULL.

A commit holds one line for each collection date and load; nothing in it grows with rows.
"""

from __future__ import annotations

import copy
import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.operators.dedup import dedup_keep_last
from shelfwatch.operators.evolution import align_schema, merge_facts
from shelfwatch.operators.quality import ValidationError, split_valid, violations
from shelfwatch.schemas import CATALOG, HISTORY, WIDE_COLUMNS
from shelfwatch.session import checkpointed
from shelfwatch.sinks.commits import CommitLog
from shelfwatch.sinks.warehouse import Warehouse

State = dict

#: Keys up to this number are looked up by value, so that Spark reads their buckets only.
KEYS_BY_VALUE = 1000


class Conflict(Exception):
    """Another load changed what this one was worked out from; it is worked out again."""


class Ledger:
    """``buckets`` counts when the root is new: as many as make files of some 128 MB of the base
    and of a day of the fact (thousands for a catalog of billions). ``max_deltas``: deltas that
    readers merge at most, before a load folds them into the base."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, max_deltas: int = 8):
        self.spark, self.root, self.buckets, self.max_deltas = spark, root.rstrip("/"), buckets, max_deltas
        self.files = Warehouse(spark, root)                 # CSV sinks and file system helpers
        self._log = CommitLog(spark, f"{self.root}/_ledger")

    # ------------------------------------------------------------------ commits
    def _empty(self) -> State:
        return {"version": 0, "id": "new", "operation": "new", "loads": [], "buckets": self.buckets, "base": None, "deltas": [],
                "days": {}, "catalog": json.loads(CATALOG.json()), "history": json.loads(HISTORY.json())}

    def commits(self) -> list[int]:
        """Numbers of the commits at hand, ascending."""
        return self._log.numbers()

    def state(self, version: int | None = None) -> State:
        """What commit ``version`` (default: the last) says."""
        if version is None:
            found = self.commits()
            if not found:
                return self._empty()
            version = found[-1]
        return self._log.read(version)

    def _publish(self, state: State) -> bool:
        return self._log.publish(state["version"], state)

    def _commit(self, operation: str, change: Callable[[State], None], load: str | None = None, tries: int = 10) -> State:
        for _ in range(tries):
            state = self.state()
            if load is not None and load in state["loads"]:
                return state
            new = copy.deepcopy(state)
            change(new)
            new |= {"version": state["version"] + 1, "id": uuid.uuid4().hex[:12], "operation": operation}
            if load is not None:
                new["loads"].append(load)
            if self._publish(new):
                return new
        raise OSError(f"{operation}: other loads came first {tries} times")

    # ------------------------------------------------------------------ files
    def _write(self, rows: DataFrame, table: str, schema: T.StructType, state: State, lookup: bool = True) -> str:
        """Write bucketed files to a new folder; returns its name below the root. ``lookup``:
        with Bloom filters of the upcs, which a delta is too small for."""
        folder = f"{table}/load={uuid.uuid4().hex}"
        name = f"`shelfwatch_write_{uuid.uuid4().hex}`"
        n = state["buckets"]
        rows = align_schema(rows, schema).select(*schema.names).repartition(n, "upc")
        out = (rows.write.format("parquet").bucketBy(n, "upc").sortBy("upc")
               .option("parquet.bloom.filter.enabled#upc", str(lookup).lower())
               .option("parquet.bloom.filter.adaptive.enabled", "true").option("path", f"{self.root}/{folder}"))
        if table == "history":
            out = out.partitionBy("date_collected")
        out.saveAsTable(name)                               # a table over the folder: buckets need one
        self.spark.sql(f"DROP TABLE {name}")                # the files stay
        return folder

    def _days(self, folder: str) -> dict[str, str]:
        """Folder of each collection date of a load, from the names alone."""
        fs, p = self.files._fs(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
        return {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith("date_collected=")}

    def _register(self, name: str, schema: T.StructType, location: str, buckets: int, days: dict | None) -> str:
        """A table of the session's catalog over folders of a commit (metadata only)."""
        name = self.files.table_name(name)
        if not self.spark.catalog.tableExists(name):
            def quoted(path: str) -> str:
                return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            parts = "PARTITIONED BY (date_collected) " if days is not None else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts}"
                           f"CLUSTERED BY (upc) SORTED BY (upc) INTO {buckets} BUCKETS LOCATION {quoted(location)}")
            items = sorted((days or {}).items())
            for lo in range(0, len(items), 500):
                adds = " ".join(f"PARTITION (date_collected = DATE '{d}') LOCATION {quoted(f'{self.root}/{path}')}"
                                for d, path in items[lo:lo + 500])
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {adds}")
        return name

    # ------------------------------------------------------------------ reads
    @staticmethod
    def _schema(state: State, table: str) -> T.StructType:
        return T.StructType.fromJson(state[table])

    def history(self, state: State | None = None) -> DataFrame:
        """The fact as of a commit (default: the last), partitioned by date, bucketed by upc."""
        state = state or self.state()
        schema = self._schema(state, "history")
        if not state["days"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.table(self._register(f"facts_{state['id']}", schema, f"{self.root}/history",
                                               state["buckets"], state["days"])).select(*schema.names)

    def _base(self, state: State) -> DataFrame:
        schema = self._schema(state, "catalog")
        if not state["base"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.table(self._register(f"base_{state['id']}", schema, f"{self.root}/{state['base']}",
                                               state["buckets"], None))

    def _latest(self, state: State) -> DataFrame | None:
        """One row per product of the deltas: ``_v_<column>`` and whether a load gave it, ``_h_<column>``."""
        names = [c for c in self._schema(state, "catalog").names if c != "upc"]
        parts = []
        for k, delta in enumerate(state["deltas"]):
            rows = self.spark.read.schema(self._schema(state, "catalog")).parquet(f"{self.root}/{delta['path']}")
            parts.append(rows.select("upc", *names, *[F.lit(k if c in delta["columns"] else None).cast("int").alias(f"_at_{c}")
                                                      for c in names]))
        if not parts:
            return None
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        # dealt like the buckets, so that grouping and the join behind it share one exchange
        rows = rows.repartition(state["buckets"], "upc")
        return rows.groupBy("upc").agg(*[F.max_by(c, f"_at_{c}").alias(f"_v_{c}") for c in names],
                                       *[F.max(f"_at_{c}").isNotNull().alias(f"_h_{c}") for c in names])

    def _merged(self, state: State) -> list:
        return [F.when(F.col(f"_h_{c}"), F.col(f"_v_{c}")).otherwise(F.col(f"_b_{c}")).alias(c)
                for c in self._schema(state, "catalog").names if c != "upc"]

    def _prefixed_base(self, state: State) -> DataFrame:
        names = [c for c in self._schema(state, "catalog").names if c != "upc"]
        return self._base(state).select("upc", *[F.col(c).alias(f"_b_{c}") for c in names], F.lit(True).alias("_in_base"))

    def catalog(self, state: State | None = None) -> DataFrame:
        """The dimension as of a commit: base and deltas merged."""
        state = state or self.state()
        latest = self._latest(state)
        if latest is None:
            return self._base(state)
        merged = self._prefixed_base(state).join(latest, "upc", "full_outer")
        return merged.select("upc", *self._merged(state))

    def books(self, state: State | None = None) -> DataFrame:
        """Fact and dimension as of one commit. Both sides are bucketed by upc, so neither
        the fact nor the base is exchanged; the deltas meet what is joined already."""
        state = state or self.state()
        fact, latest = self.history(state), self._latest(state)
        rows = fact.join(self._prefixed_base(state), "upc", "left")
        if latest is None:
            names = [c for c in self._schema(state, "catalog").names if c != "upc"]
            rows = rows.where("_in_base").select(*fact.columns, *[F.col(f"_b_{c}").alias(c) for c in names])
        else:
            rows = rows.join(latest.withColumn("_in_delta", F.lit(True)), "upc", "left").where(
                F.col("_in_base") | F.col("_in_delta")).select(*fact.columns, *self._merged(state))
        return rows.select(*WIDE_COLUMNS, *[c for c in rows.columns if c not in WIDE_COLUMNS])

    def dates(self, state: State | None = None) -> list[dt.date]:
        """Collection dates, ascending, from the commit."""
        return sorted(dt.date.fromisoformat(d) for d in (state or self.state())["days"])

    def collection_dates(self, state: State | None = None) -> DataFrame:
        """A13 as rows (one a date, no data is read)."""
        return self.spark.createDataFrame([(d,) for d in self.dates(state)], "date_collected date")

    def last_two_dates(self, state: State | None = None) -> DataFrame:
        """(previous_date, latest_date); empty when fewer than two dates exist. No data is read."""
        two = self.dates(state)[-2:]
        return self.spark.createDataFrame([tuple(two)] if len(two) == 2 else [], "previous_date date, latest_date date")

    def latest_snapshot(self, state: State | None = None) -> DataFrame:
        """the rows of the latest date; a date literal, so only its folder is read."""
        state = state or self.state()
        dates = self.dates(state)
        books = self.books(state)
        return books.where(F.col("date_collected") == F.lit(dates[-1])) if dates else books

    # ------------------------------------------------------------------ loads
    @staticmethod
    def _evolved(known: T.StructType, given: Iterable[T.StructField]) -> T.StructType:
        """``known`` with the further columns of ``given`` (nullable, at the end)."""
        out = list(known.fields)
        types = {f.name: f.dataType for f in out}
        for f in given:
            if f.name not in types:
                out.append(T.StructField(f.name, f.dataType, True))
            elif types[f.name] != f.dataType:
                raise ValueError(f"column {f.name} is {types[f.name].simpleString()}, the load has {f.dataType.simpleString()}")
        return T.StructType(out)

    def _split_columns(self, state: State, rows: DataFrame, dimension: Sequence[str]) -> tuple[T.StructType, T.StructType]:
        """Columns of both tables after a load of ``rows``; new ones go to the fact unless named in ``dimension``."""
        catalog, history = self._schema(state, "catalog"), self._schema(state, "history")
        new = [f for f in rows.schema.fields if f.name not in (*WIDE_COLUMNS, "ingest_seq")]
        of_dimension = {*catalog.names, *dimension}
        return (self._evolved(catalog, [f for f in new if f.name in of_dimension]),
                self._evolved(history, [f for f in new if f.name not in of_dimension]))

    def load(self, rows: DataFrame, order: Sequence[str], load: str | None, operation: str, *,
             dimension: Sequence[str] = (), facts: Callable[[State, T.StructType], str] | None = None) -> State:
        """Write a delta and fact folders of ``rows`` (wide), and commit them as one change."""
        def schemas(state: State) -> tuple[T.StructType, T.StructType]:
            return self._split_columns(state, rows, dimension)

        start = self.state()
        if load is not None and load in start["loads"]:
            return start
        catalog, history = schemas(start)
        given = [c for c in catalog.names if c in rows.columns]
        keep = [c for c in dict.fromkeys([*given, *order]) if c in rows.columns]
        delta = self._write(dedup_keep_last(rows.select(*keep), ["upc"], list(order)).select(*given), "catalog", catalog, start, lookup=False)
        written = facts(start, history) if facts else self._write(rows, "history", history, start)
        days = self._days(written)

        def change(state: State) -> None:
            if state["buckets"] != start["buckets"] or (
                    facts and any(state["days"].get(d) != start["days"].get(d) for d in days)):
                raise Conflict
            now_catalog, now_history = schemas(state)
            state["catalog"], state["history"] = json.loads(now_catalog.json()), json.loads(now_history.json())
            state["deltas"].append({"path": delta, "columns": given})
            state["days"] |= days

        try:
            done = self._commit(operation, change, load)
        except Conflict:
            return self.load(rows, order, load, operation, dimension=dimension, facts=facts)
        return self.compact() if len(done["deltas"]) > self.max_deltas else done

    def ingest(self, batch: DataFrame, run_date: str | None = None, batch_id: int | str | None = None,
               write_csv: bool = True, dimension: Sequence[str] = (), single_date: bool = True) -> dict:
        """Validate, then load one run: dimension and day(s) become visible together, or not at all.

        A batch that breaks a rule writes nothing. ``batch_id`` makes the load repeatable: the
        second time changes nothing. ``single_date=False`` admits several dates, each of which
        is replaced. The CSV sinks follow the commit.
        """
        if run_date is not None:
            batch = batch.withColumn("date_collected", F.lit(run_date).cast("date"))
        extra = [c for c in batch.columns if c not in (*WIDE_COLUMNS, "ingest_seq")]
        batch = batch.select(*WIDE_COLUMNS, *extra).withColumn("ingest_seq", F.monotonically_increasing_id())
        with checkpointed(batch) as rows:
            sample = violations(rows, single_date=single_date).limit(20).collect()
            if sample:
                raise ValidationError([r.asDict() for r in sample])
            known = batch_id is not None and str(batch_id) in self.state()["loads"]
            state = self.load(rows, ["ingest_seq"], None if batch_id is None else str(batch_id), "ingest",
                              dimension=dimension)
            if write_csv and not known:
                self.files.write_snapshot(rows)
                self.files.archive(rows)
                self.files.append_log(rows, state["version"])
        return {"version": state["version"], "loaded": not known}

    def ingest_part(self, batch: DataFrame, order: list[str], batch_id: int | str | None = None,
                    write_log: bool = True) -> DataFrame:
        """Load a part of runs by upsert on (upc, date); returns the rows that break a rule."""
        good, bad = split_valid(batch.withColumn("ingest_seq", F.monotonically_increasing_id()))
        with checkpointed(good) as rows:
            if rows.limit(1).count():
                def facts(state: State, schema: T.StructType) -> str:
                    last = dedup_keep_last(rows.select(*dict.fromkeys([*[c for c in schema.names if c in rows.columns], *order])),
                                           ["upc", "date_collected"], order)
                    new = align_schema(last, schema).select(*schema.names)
                    dates = [r[0] for r in rows.select("date_collected").distinct().collect()]      # one per day
                    old = align_schema(self.history(state), schema).select(*schema.names).where(
                        F.col("date_collected").isin(dates))
                    merged = merge_facts(old, new, updated=[c for c in schema.names if c not in ("upc", "date_collected")])
                    return self._write(merged, "history", schema, state)

                self.load(rows, order, None if batch_id is None else str(batch_id), "upsert", facts=facts)
                if write_log:
                    self.files.append_log(rows, self.state()["version"])
        return bad

    def delete_products(self, upcs: DataFrame) -> State:
        """Drop products and their facts in one commit.

        Up to ``KEYS_BY_VALUE`` products are looked up by value, which prunes the scan to their
        buckets (and row groups by Bloom filters); more by a join on the bucketed table. Only
        dates that hold one of them are written again; a date left empty ends.
        """
        with checkpointed(upcs.select("upc").distinct()) as keys:
            few = [r[0] for r in keys.limit(KEYS_BY_VALUE + 1).collect()]
            while True:
                start = self.state()
                fact = self.history(start)
                hit = fact.where(F.col("upc").isin(few)) if len(few) <= KEYS_BY_VALUE else fact.join(keys, "upc", "left_semi")
                touched = [r[0] for r in hit.select("date_collected").distinct().collect()]         # one per day
                days = {}
                if touched:
                    rest = fact.where(F.col("date_collected").isin(touched)).join(keys, "upc", "left_anti")
                    days = self._days(self._write(rest, "history", self._schema(start, "history"), start))
                base = self._write(self.catalog(start).join(keys, "upc", "left_anti"), "catalog",
                                   self._schema(start, "catalog"), start)

                def change(state: State) -> None:
                    if state["version"] != start["version"]:
                        raise Conflict
                    for d in touched:
                        state["days"].pop(d.isoformat(), None)
                    state["days"] |= days
                    state["base"], state["deltas"] = base, []

                try:
                    return self._commit("delete", change)
                except Conflict:
                    continue

    def compact(self) -> State:
        """Fold the deltas into a new base; deltas that other loads add meanwhile stay."""
        while True:
            start = self.state()
            if not start["deltas"]:
                return start
            base = self._write(self.catalog(start), "catalog", self._schema(start, "catalog"), start)
            paths = [d["path"] for d in start["deltas"]]

            def change(state: State) -> None:
                if state["base"] != start["base"] or [d["path"] for d in state["deltas"][:len(paths)]] != paths:
                    raise Conflict
                state["base"], state["deltas"] = base, state["deltas"][len(paths):]

            try:
                return self._commit("compact", change)
            except Conflict:
                continue

    def vacuum(self, keep: int = 2, older_than_seconds: float = 86400.0) -> list[str]:
        """Delete folders that none of the ``keep`` last commits names, and older commits.

        Folders younger than ``older_than_seconds`` stay, as a running load may be writing them.
        Returns the removed folders. Only names are listed.
        """
        commits = self.commits()
        last = [self.state(v) for v in commits[-keep:]]
        used = {p.split("/date_collected=")[0] for s in last
                for p in (*s["days"].values(), *[d["path"] for d in s["deltas"]], *([s["base"]] if s["base"] else []))}
        limit = dt.datetime.now().timestamp() - older_than_seconds
        removed = []
        for table in ("catalog", "history"):
            fs, p = self.files._fs(f"{self.root}/{table}")
            for s in fs.listStatus(p) if fs.exists(p) else []:
                name = f"{table}/{s.getPath().getName()}"
                if name.split("/")[1].startswith("load=") and name not in used and s.getModificationTime() / 1000 <= limit:
                    fs.delete(s.getPath(), True)
                    removed.append(name)
        for v in commits[:-keep]:
            self._log.drop(v)
        return sorted(removed)

    def export(self, df: DataFrame, path: str) -> None:
        """K9: any wide frame as CSV with the original header."""
        self.files.export(df, path)

    def ensure_tables(self) -> None:
        """K6: temporary views ``catalog``, ``price_history``, ``history`` and ``books`` of the last commit."""
        state = self.state()
        fact = self.history(state)
        fact.createOrReplaceTempView("price_history")
        fact.createOrReplaceTempView("history")
        self.catalog(state).createOrReplaceTempView("catalog")
        self.books(state).createOrReplaceTempView("books")


def open_store(spark: SparkSession, root: str, ledger: bool = False) -> Ledger | Warehouse:
    """The store at ``root``: a ledger where it has commits or ``ledger`` asks for one."""
    found = Ledger(spark, root)
    return found if ledger or found.commits() else Warehouse(spark, root)
