"""Readers: CSV snapshot / log files, the warehouse tables, and source fallback."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.clean import from_date_text
from shelfwatch.operators.dedup import dedup_keep_last
from shelfwatch.schemas import CSV_DIALECT, CSV_EMPTY, CSV_HEADER, CSV_READ, CSV_SCHEMA, PRICE, WIDE_COLUMNS

_CORRUPT = T.StructField("corrupt_record", T.StringType(), True)
CSV_LOG_SCHEMA = T.StructType(CSV_SCHEMA.fields + [
    T.StructField("Batch_Id", T.StringType(), True),
    T.StructField("Row_Id", T.StringType(), True)])


def _wide_from_csv(df: DataFrame) -> DataFrame:
    df = df.withColumns({c: F.when(F.col(c) == CSV_EMPTY, F.lit("")).otherwise(F.col(c)) for c in CSV_HEADER})
    return df.select(
        F.col("Title").alias("title"),
        F.col("Price").try_cast(PRICE).alias("price"),
        F.col("Rating").alias("rating"),
        F.col("URL").alias("product_url"),
        from_date_text("Date_Collected").alias("date_collected"),
        F.col("UPC").alias("upc"),
        F.col("Category").alias("category"),
        F.col("Stock_Quantity").try_cast("int").alias("stock_quantity"),
        *[c for c in df.columns if c not in CSV_HEADER])


def _scan_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Raw rows with ``corrupt_record``: the line, where it has not the schema's columns.

    ``multi_line`` reads foreign files whose quoted fields hold line breaks; such files
    cannot be split, so each is read by one task. Our own files have no raw line breaks.
    """
    return (spark.read.schema(T.StructType([*schema.fields, _CORRUPT])).options(**CSV_READ)
            .option("multiLine", multi_line).csv(path))


def record_flag(df: DataFrame) -> Column:
    """True for a whole record, false for a corrupt line.

    Names every column, as the reader only finds a line corrupt in columns that it parses.
    """
    texts = F.concat_ws("", *[c for c in df.columns if c in CSV_LOG_SCHEMA.names])
    return F.col("corrupt_record").isNull() & (F.length(texts) >= 0)


def read_snapshot_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The overwrite-mode snapshot CSV (header row, explicit schema, no inference).

    Lines with missing or surplus fields are left out; ``csv_rejects`` returns them.
    """
    raw = _scan_csv(spark, path, CSV_SCHEMA, multi_line)
    return _wide_from_csv(raw.where(record_flag(raw)).drop("corrupt_record"))


def csv_rejects(spark: SparkSession, path: str, log: bool = False,
                multi_line: bool = False) -> DataFrame:
    """Lines of a snapshot (or log) CSV that do not have its columns, with their file."""
    raw = _scan_csv(spark, path, _log_schema(spark, path) if log else CSV_SCHEMA, multi_line)
    return (raw.select("*", F.col("_metadata.file_path").alias("file")).where(~record_flag(raw))
            .select("file", "corrupt_record"))


def _log_schema(spark: SparkSession, path: str) -> T.StructType:
    """Log schema with or without the id columns, by the header of the files."""
    header = spark.read.options(**CSV_DIALECT).csv(path).columns
    return CSV_LOG_SCHEMA if "Row_Id" in header else CSV_SCHEMA


def read_history_csv(spark: SparkSession, path: str | list[str], dedup: bool = True,
                     with_order: bool = True, multi_line: bool = False) -> DataFrame:
    """The append-mode history log, keep-last per (title, url, date).

    Logs written by :mod:`shelfwatch.sinks.warehouse` carry ``Batch_Id`` / ``Row_Id``, which
    define "last". Without them (8 columns) the order is that of writing: the files by
    modification time, then name, the rows by their place in the file.
    """
    schema = _log_schema(spark, path)
    raw = _scan_csv(spark, path, schema, multi_line)
    m = F.col("_metadata")
    if schema is CSV_LOG_SCHEMA:
        ids = [F.lit(None).cast("timestamp"), F.lit(None).cast("string"),
               F.col("Batch_Id").try_cast("long"), F.col("Row_Id").try_cast("long")]
    else:
        ids = [m["file_modification_time"], m["file_path"], m["file_block_start"],
               F.monotonically_increasing_id()]
    names = ["log_time", "log_file", "log_batch", "log_row"]
    raw = raw.select("*", *[c.alias(n) for c, n in zip(ids, names)])
    raw = raw.where(record_flag(raw))
    wide = _wide_from_csv(raw).select(*WIDE_COLUMNS, *names)
    if dedup:
        wide = dedup_keep_last(wide, ["title", "product_url", "date_collected"], names)
    return wide if with_order else wide.select(*WIDE_COLUMNS)


def read_first_available(readers: Sequence[tuple[str, Callable[[], DataFrame]]],
                         skip_empty: bool = True) -> tuple[DataFrame, str]:
    """The first source that resolves (and, by default, is not empty) plus its label.

    Each reader is ``(label, thunk)``; a thunk that raises (missing path, unreachable
    database) falls through to the next. Emptiness is probed with ``limit(1)``, which
    reads at most one row.
    """
    errors = []
    for label, thunk in readers:
        try:
            df = thunk()
            if skip_empty and not df.limit(1).take(1):
                errors.append(f"{label}: empty")
                continue
            return df, label
        except Exception as e:  # noqa: BLE001 - any failure means "try the next source"
            errors.append(f"{label}: {type(e).__name__}: {str(e)[:200]}")
    raise FileNotFoundError("no data source available: " + "; ".join(errors))


# Table names of the relational store.
JDBC_CATALOG, JDBC_HISTORY = "books_catalog", "price_history"


def read_jdbc_snapshot(spark: SparkSession, url: str, properties: dict,
                       catalog_table: str = JDBC_CATALOG, history_table: str = JDBC_HISTORY,
                       dates: Sequence[dt.date] | None = None, upc_bounds: Sequence[str] = ()
                       ) -> tuple[DataFrame, DataFrame]:
    """S1-S3 against an existing relational store: (catalog, history) via the JDBC source.

    ``dates`` (ascending) reads the history in one partition per date, each with its own
    date predicate, so only those dates are read and each by a task of its own. The catalog
    is cut at ``upc_bounds`` in the same way. Further filters and projections are pushed
    into the database queries. Needs the database's JDBC driver on the classpath.
    """
    def cut(column: str, bounds: Sequence[str]) -> list[str]:
        quoted = ["'" + b.replace("'", "''") + "'" for b in bounds]
        low = [None, *quoted]
        return [" AND ".join(x for x in (a and f"{column} >= {a}", b and f"{column} < {b}") if x)
                + (f" OR {column} IS NULL" if a is None else "")
                for a, b in zip(low, [*quoted, None])]

    if upc_bounds:
        cat = spark.read.jdbc(url, catalog_table, predicates=cut("upc", upc_bounds), properties=properties)
    else:
        cat = spark.read.jdbc(url, catalog_table, properties=properties)
    if dates is None:
        return cat, spark.read.jdbc(url, history_table, properties=properties)
    days = [f"date_collected = DATE '{d.isoformat()}'" for d in dates]
    return cat, spark.read.jdbc(url, history_table, predicates=days, properties=properties)
