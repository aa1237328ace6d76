"""Token-id files: documents in id order, coded in independent, checksummed blocks.

A file set is a Parquet table of blocks, written by Spark's own committer, so it works on
any store that Spark writes to and a retried task leaves nothing behind. One row per block:

* ``part``, ``block``: the range partition (ascending ``doc_id``) and the place in it;
* ``first_id``, ``n_ids``: ids of the part before the block, and in it;
* ``payload``: the block as ``rangecoder.encode_blocks`` makes it. Its document table holds
  (doc_id, null flag, ordinal in the part, start in the document, ids of the document) for
  each piece, so ids and lengths come from the payload alone.

A block holds whole documents while they fit into ``BLOCK_IDS`` ids; a longer document is
cut into blocks of that size. Any block can be read without the others.

Defined results: null text is empty (the end id alone); a null ``doc_id`` sorts first;
repeated rows stay, next to each other; an empty table gives an empty file set. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import n_parts, staged, text_rows
from .rangecoder import decode_blocks, encode_blocks
from .wordids import encode_texts

BLOCK_IDS = 4096
#: Blocks that one task holds at a time (bounds its memory).
LANES = 1536

_PIECE = np.dtype([("doc", "<i8"), ("null", "u1"), ("ordinal", "<i8"), ("start", "<i8"), ("n", "<i4"), ("total", "<i8")])
_BLOCK_SCHEMA = "part int, block long, first_id long, n_ids int, payload binary"
_PIECE_SCHEMA = ("part int, ordinal long, doc_id long, start_in_doc long, start_in_part long, "
                 "length int, doc_ids long")


def _write_task(path: str, spaced: bool, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        done: list[tuple] = []                 # (first_id, ids, pieces) of closed blocks
        ids: list[bytes] = []
        pieces: list[tuple] = []
        size = first = number = ordinal = 0

        def close() -> None:
            nonlocal size, first
            if pieces:
                done.append((first, np.frombuffer(b"".join(ids), "<u4"), np.array(pieces, _PIECE)))
                first += size
            ids.clear()
            pieces.clear()
            size = 0

        def coded() -> pa.RecordBatch:
            nonlocal number
            payloads = encode_blocks([b for _, b, _ in done], [t.tobytes() for _, _, t in done])
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(done), pa.int32()),
                "block": pa.array(range(number, number + len(done)), pa.int64()),
                "first_id": pa.array([f for f, _, _ in done], pa.int64()),
                "n_ids": pa.array([len(b) for _, b, _ in done], pa.int32()),
                "payload": pa.array(payloads, pa.binary())})
            number += len(done)
            done.clear()
            return out

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), encode_texts(path, batch.column(1), spaced)):
                raw += end
                total, at = len(raw) // 4, 0
                if size and size + total > BLOCK_IDS:
                    close()
                while at < total:
                    n = min(BLOCK_IDS - size, total - at)
                    ids.append(raw[4 * at:4 * (at + n)])
                    pieces.append((doc or 0, doc is None, ordinal, at, n, total))
                    at, size = at + n, size + n
                    if size == BLOCK_IDS:
                        close()
                ordinal += 1
                if len(done) >= LANES:
                    yield coded()
        close()
        if done:
            yield coded()

    return run


def write_ids(docs: DataFrame, target: str, vocab_path: str, *, spaced: bool = False,
              end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending ``doc_id`` order."""
    rows = text_rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    # The text's hash breaks ties, so that a repeated id can be dealt to several parts.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (rows.repartitionByRange(n_parts(docs.sparkSession), *order).sortWithinPartitions(*order)
     .mapInArrow(_write_task(vocab_path, spaced, end_id), _BLOCK_SCHEMA)
     .write.option("compression", "none").parquet(target))


def _read_task(batches: Iterator[pa.RecordBatch], keep_ids: bool = True) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, LANES):
            now = batch.slice(lo, LANES)
            blocks, tables = decode_blocks(now.column("payload").to_pylist())
            found: list = []                    # ids of each piece, or their checksum
            pieces = np.frombuffer(b"".join(tables), _PIECE)
            counts = [len(t) // _PIECE.itemsize for t in tables]
            lo = 0
            for block, k in zip(blocks, counts):
                raw, at = memoryview(block.astype("<u4").tobytes()), 0
                for n in pieces["n"][lo:lo + k].tolist():
                    piece = raw[at:at + 4 * n]
                    found.append(bytes(piece) if keep_ids else zlib.crc32(piece))
                    at += 4 * n
                lo += k
            # ids before each piece: of the part before its block, and of the block before it
            before = np.cumsum(pieces["n"], dtype=np.int64) - pieces["n"]
            head = np.cumsum([0, *counts])[:-1]
            first = now.column("first_id").to_numpy() - before[head]
            at = before + first.repeat(counts)
            doc = pa.array(pieces["doc"], pa.int64(), mask=pieces["null"].astype(bool))
            yield pa.RecordBatch.from_arrays(
                [pa.array(now.column("part").to_numpy().repeat(counts), pa.int32()),
                 pa.array(pieces["ordinal"], pa.int64()), doc, pa.array(pieces["start"], pa.int64()),
                 pa.array(at - pieces["start"], pa.int64()), pa.array(pieces["n"], pa.int32()),
                 pa.array(pieces["total"], pa.int64()), pa.array(found, pa.binary() if keep_ids else pa.int64())],
                ["part", "ordinal", "doc_id", "start_in_doc", "start_in_part", "length", "doc_ids",
                 "ids" if keep_ids else "crc"])


def read_pieces(spark: SparkSession, source: str, *, keep_ids: bool = True) -> DataFrame:
    """Decoded pieces of documents; one row per document, more for those cut over blocks.

    ``start_in_part`` counts the ids of the part before the document. With ``keep_ids`` false
    the column ``crc`` stands for ``ids``: the CRC-32 of the ids just decoded.
    """
    return spark.read.schema(_BLOCK_SCHEMA).parquet(source).mapInArrow(
        functools.partial(_read_task, keep_ids=keep_ids),
        f"{_PIECE_SCHEMA}, {'ids binary' if keep_ids else 'crc long'}")


def part_starts(spark: SparkSession, source: str) -> DataFrame:
    """Ids before each part: one row per range partition, read without the payloads."""
    sums = (spark.read.schema(_BLOCK_SCHEMA).parquet(source).groupBy("part")
            .agg(F.sum("n_ids").alias("part_ids")))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))


def _crc_matrix_times(matrix: Sequence[int], vector: int) -> int:
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector >>= 1
        k += 1
    return out


@functools.lru_cache(8192)
def _crc_shift(n: int) -> tuple[int, ...]:
    """The matrix that moves a CRC-32 over ``n`` zero bytes; pieces have few different lengths."""
    # over one zero bit, then squared: 2, 4, 8 (a byte), 16 ... bits
    op = [0xEDB88320] + [1 << k for k in range(31)]
    for _ in range(3):
        op = [_crc_matrix_times(op, v) for v in op]
    out = [1 << k for k in range(32)]
    while n:
        if n & 1:
            out = [_crc_matrix_times(op, v) for v in out]
        op = [_crc_matrix_times(op, v) for v in op]
        n >>= 1
    return tuple(out)


def crc32_join(crc1: int, crc2: int, len2: int) -> int:
    """CRC-32 of a + b from those of a and b: crc1 moved over ``len2`` zero bytes, xor crc2."""
    return _crc_matrix_times(_crc_shift(len2), crc1) ^ crc2


@functools.lru_cache(64)
def _crc_power(k: int) -> np.ndarray:
    """What moving a CRC-32 over ``2 ** k`` zero bytes makes of each of its bits."""
    return np.array(_crc_shift(1 << k), np.uint32)


def crc32_moved(crcs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each CRC-32 moved over ``n`` zero bytes; those of all parts of a text, moved over what
    follows them, give the CRC-32 of the text by xor."""
    out = crcs.astype(np.uint32)
    for k in range(int(n.max(initial=0)).bit_length()):
        some = np.flatnonzero(n >> k & 1)
        crc, moved = out[some], np.zeros(len(some), np.uint32)
        for bit, value in enumerate(_crc_power(k)):
            moved ^= (crc >> np.uint32(bit) & np.uint32(1)) * value
        out[some] = moved
    return out


def _moved(crc: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(crc32_moved(crc.to_numpy(), n.to_numpy()).astype(np.int64))


def document_digests(spark: SparkSession, source: str) -> DataFrame:
    """Per document of a file set: doc_id, start, n_tokens, ids_crc32, in no fixed order.

    The files are decoded once: places and checksums of the pieces are staged (some 60 bytes
    each). Only documents cut over several blocks are gathered (checksums, not ids).
    """
    pieces = staged(read_pieces(spark, source, keep_ids=False), "pieces")
    moved = F.pandas_udf(_moved, T.LongType())
    behind = 4 * (F.col("doc_ids") - F.col("start_in_doc") - F.col("length"))
    one = pieces.filter(F.col("length") == F.col("doc_ids")).select(
        "part", "doc_id", "start_in_part", F.col("doc_ids").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    cut = (pieces.filter(F.col("length") != F.col("doc_ids"))
           .withColumn("crc", moved("crc", behind)).groupBy("part", "ordinal")
           .agg(F.first("doc_id").alias("doc_id"), F.first("start_in_part").alias("start_in_part"),
                F.first("doc_ids").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
           .select("part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"))
    starts = F.broadcast(part_starts(spark, source))     # one row per range partition
    return one.unionByName(cut).join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")
