"""Incremental ingestion with Structured Streaming.

New run files (the CSV layout written by the extraction job) land in a folder; a file
stream picks them up, oldest first, and ``foreachBatch`` upserts every micro-batch on
(upc, date_collected). A day may arrive as any number of files: nothing is replaced that a
later file does not name, so the tables do not depend on how files fall into micro-batches.
A micro-batch replayed after a failure applies the same rows again and changes nothing (the
CSV log gets them twice and is repaired on reading). The stream's own progress lives in
``checkpoint_location``, which must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwatch.schemas import CSV_READ, CSV_SCHEMA, WIDE_COLUMNS
from shelfwatch.session import checkpointed
from shelfwatch.sinks.ledger import Ledger, open_store
from shelfwatch.sources.tables import _CORRUPT, _wide_from_csv

#: Which of repeated rows came last: files by time and name, rows by their place.
ORDER = ["file_time", "file_name", "block_start", "line"]


def run_files(spark: SparkSession, source_dir: str, files_per_batch: int = 100) -> DataFrame:
    """Streaming rows of CSV run files, with their order and any corrupt line.

    ``files_per_batch`` bounds the work of a micro-batch; it does not change results.
    """
    raw = (spark.readStream.schema(T.StructType([*CSV_SCHEMA.fields, _CORRUPT]))
           .options(**CSV_READ).option("maxFilesPerTrigger", files_per_batch).csv(source_dir))
    m = F.col("_metadata")
    return raw.select("*", m["file_modification_time"].alias("file_time"), m["file_path"].alias("file_name"),
                      m["file_block_start"].alias("block_start"))


def start_ingest(spark: SparkSession, source_dir: str, warehouse_root: str,
                 checkpoint_location: str, available_now: bool = False,
                 processing_time: str = "1 minute", rejected_path: str | None = None,
                 write_csv: bool = True, files_per_batch: int = 100, ledger: bool = False) -> StreamingQuery:
    """Start the incremental load. Rows that break a rule, and lines that are no record, go
    to ``rejected_path`` (one folder per micro-batch); without it such a row ends the load.

    Into a ledger (``ledger``, or where the root is one) each micro-batch is one commit under
    the name of this stream's checkpoint and the batch, so a replay finds it done."""
    wh = open_store(spark, warehouse_root, ledger)

    def load(batch: DataFrame, epoch_id: int) -> None:
        with checkpointed(batch.withColumn("line", F.monotonically_increasing_id())) as rows:
            lines = rows.where(F.col("corrupt_record").isNotNull())
            wide = _wide_from_csv(rows.where(F.col("corrupt_record").isNull()).drop("corrupt_record"))
            load = f"{checkpoint_location}#{epoch_id}" if isinstance(wh, Ledger) else epoch_id
            bad = wh.ingest_part(wide.select(*WIDE_COLUMNS, *ORDER), ORDER, load, write_log=write_csv)
            rejects = bad.select(*WIDE_COLUMNS, "file_name", "violated_rules", F.lit(None).cast("string")
                                 .alias("corrupt_record")).unionByName(
                _wide_from_csv(lines).select(*WIDE_COLUMNS, "file_name", F.array(F.lit("not_a_record"))
                                             .alias("violated_rules"), "corrupt_record"))
            if rejected_path is not None:
                rejects.write.mode("overwrite").parquet(f"{rejected_path}/epoch={epoch_id}")
            elif sample := rejects.limit(20).collect():
                raise ValueError(f"rejected rows, e.g. {[r.asDict() for r in sample]}")

    writer = (run_files(spark, source_dir, files_per_batch).writeStream.foreachBatch(load)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=processing_time)
    return writer.start()
