"""Helpers shared by the operators: staged tables and bounded text batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder, ship_package

#: Text bytes that one step inside a task works on at a time.
STEP_BYTES = 2_000_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared checkpoint folder, removed when the application ends."""
    return f"{scratch_folder(spark, 'llm')}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) for a Python stage; other columns, whatever their names, stay behind."""
    ship_package(docs.sparkSession)
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def n_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def each_text(column: pa.Array, rows: int = 256) -> Iterator[bytes]:
    """``raw_texts`` one after the other; only ``rows`` of a batch are Python objects at a time."""
    for lo in range(0, len(column), rows):
        yield from raw_texts(column.slice(lo, rows))


def slices(texts: list, step: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``step`` bytes of text each (one row at least)."""
    start, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= step:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
