"""Incremental compaction of the append-only CSV log.

``read_history_csv`` repairs the log on every read by an aggregate over all of it. ``LogRuns``
keeps the repaired rows beside it, as runs::

    runs/load=<id>/date_collected=<d>/     keep-last rows of one date, sorted by title and url
    runs/_commits/<n>.json                 the folder of each date, and the log files taken in

The log files that a commit names are the watermark: reading takes the runs as they are, and
aggregates only rows of files above it together with the runs of the dates that they touch.
``compact`` writes those dates anew and moves the watermark in one commit, so a compaction that
breaks off changes nothing. Log files are never changed; those below the watermark may be archived.
"""

from __future__ import annotations

import copy
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators.dedup import dedup_keep_last
from shelfwatch.schemas import WIDE, WIDE_COLUMNS
from shelfwatch.session import checkpointed
from shelfwatch.sinks.commits import CommitLog
from shelfwatch.sources.tables import read_history_csv

KEYS = ["title", "product_url", "date_collected"]
ORDER = ["log_time", "log_file", "log_batch", "log_row"]
_COLUMNS = [*WIDE_COLUMNS, *ORDER]
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


class LogRuns:
    def __init__(self, spark: SparkSession, log_path: str, runs_path: str):
        self.spark, self.log_path, self.runs_path = spark, log_path.rstrip("/"), runs_path.rstrip("/")
        self.log = CommitLog(spark, f"{self.runs_path}/_commits")

    def state(self) -> dict:
        found = self.log.numbers()
        return self.log.read(found[-1]) if found else {"version": 0, "days": {}, "files": []}

    def pending(self, state: dict | None = None) -> list[str]:
        """Names of the log files above the watermark."""
        fs, p = self.log.fs(self.log_path)
        if not fs.exists(p):
            return []
        taken = set((state or self.state())["files"])
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
        return sorted(n for n in names if n[0] not in "._" and n not in taken)

    def _runs(self, state: dict, days: list[str]) -> DataFrame:
        """Rows of the runs of some dates; only their folders are listed."""
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in WIDE.fields)}, log_time timestamp, " \
                 "log_file string, log_batch long, log_row long"
        if not days:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.runs_path}/{state['days'][d]}" for d in days]
        return self.spark.read.schema(schema).option("basePath", self.runs_path).parquet(*paths).select(*_COLUMNS)

    def _new(self, names: list[str]) -> DataFrame:
        return read_history_csv(self.spark, [f"{self.log_path}/{n}" for n in names]).select(*_COLUMNS)

    def _touched(self, new: DataFrame) -> list[str]:
        dates = new.select(F.coalesce(F.col("date_collected").cast("string"), F.lit(_NO_DATE))).distinct()
        return [r[0] for r in dates.collect()]                          # one per date

    def read(self, with_order: bool = False) -> DataFrame:
        """The repaired log: the rows of ``read_history_csv``."""
        state = self.state()
        names = self.pending(state)
        if not names:
            out = self._runs(state, list(state["days"]))
        else:
            new = self._new(names)
            touched = set(self._touched(new))
            out = self._runs(state, [d for d in state["days"] if d not in touched]).unionByName(
                dedup_keep_last(self._runs(state, [d for d in state["days"] if d in touched]).unionByName(new), KEYS, ORDER))
        return out if with_order else out.select(*WIDE_COLUMNS)

    def compact(self, tries: int = 5) -> dict:
        """Take the files above the watermark into the runs."""
        for _ in range(tries):
            state = self.state()
            names = self.pending(state)
            if not names:
                return state
            folder = f"load={uuid.uuid4().hex}"
            with checkpointed(self._new(names)) as new:
                touched = self._touched(new)
                old = self._runs(state, [d for d in touched if d in state["days"]])
                merged = dedup_keep_last(old.unionByName(new), KEYS, ORDER)
                (merged.hint("rebalance", "date_collected").sortWithinPartitions("date_collected", "title", "product_url")
                 .write.partitionBy("date_collected").parquet(f"{self.runs_path}/{folder}"))
            done = copy.deepcopy(state)
            done["version"] += 1
            done["files"] += names
            done["days"] |= {d: f"{folder}/date_collected={d}" for d in touched}
            if self.log.publish(done["version"], done):
                return done
        raise OSError(f"could not commit a compaction in {tries} tries: others came first")
