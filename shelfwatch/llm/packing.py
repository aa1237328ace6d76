"""Packing documents into fixed-length token sequences (bounded-space online best fit).

Each map task tokenises its documents and keeps at most ``open_windows`` open windows. A
document's ids are cut every ``window`` ids; full cuts are sequences of their own, the rest
goes into the open window that it fills best. If none fits and no more may be opened, the
fullest window is emitted. Windows still open at the end of the tasks are merged: those of
``MERGE_PARTS`` tasks meet in one group (at most MERGE_PARTS * open_windows * window ids),
where they are laid end to end and cut every ``window`` ids, so one sequence a group at
most is left partly filled.

Defined results: null text packs as empty text (its end id alone); a null ``doc_id`` stays
null; repeated rows are packed as documents of their own; an empty table gives no pieces;
other columns are ignored, whatever their names. A text of any length is read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import each_text, staged, text_rows
from .vocab import vocabulary

WINDOW = 1024
OPEN_WINDOWS = 64
#: Tasks whose left-over windows are merged together.
MERGE_PARTS = 64
#: Sequence ids: task (or merge group) above, number within it below.
_SHIFT = 33
_MERGED = 1 << 62


class OpenWindows:
    """A bounded set of partly filled windows with best-fit placement.

    ``free`` is a bit mask of the free sizes present, so the best fit is its lowest set bit
    at or above the size asked for.
    """

    def __init__(self, window: int, limit: int):
        self.window, self.limit = window, limit
        self.by_free: dict[int, list[list]] = {}
        self.free, self.count = 0, 0

    def _take(self, size: int) -> list:
        stack = self.by_free[size]
        got = stack.pop()
        if not stack:
            del self.by_free[size]
            self.free &= ~(1 << size)
        self.count -= 1
        return got

    def place(self, length: int, piece) -> list[list]:
        """Put a piece (shorter than a window) away; returns the windows that close."""
        closed = []
        fits = self.free >> length
        if fits:
            size = length + (fits & -fits).bit_length() - 1
            pieces = self._take(size)
        else:
            if self.count >= self.limit:
                fullest = (self.free & -self.free).bit_length() - 1
                closed.append(self._take(fullest))
            size, pieces = self.window, []
        pieces.append(piece)
        if size == length:
            closed.append(pieces)
        else:
            self.by_free.setdefault(size - length, []).append(pieces)
            self.free |= 1 << (size - length)
            self.count += 1
        return closed

    def rest(self) -> list[list]:
        return [w for size in sorted(self.by_free) for w in self.by_free[size]]


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("open", T.BooleanType()), T.StructField("ids", T.BinaryType())])


def _pack_task(path: str, spaced: bool, end_id: int, window: int, limit: int, keep_ids: bool):
    """mapInArrow function: rows (doc_id, text) to placed pieces of closed and open windows."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, part = vocabulary(path), TaskContext.get().partitionId()
        windows, number, rows, kept, schema = OpenWindows(window, limit), 0, [], 0, None

        def emit(pieces: list, is_open: bool) -> None:
            nonlocal number, kept
            seq, offset = (part << _SHIFT) + number, 0
            number += 1
            for doc, start, total, ids in pieces:
                n = len(ids) // 4
                keep = ids if keep_ids or is_open else None
                kept += len(keep or b"")
                rows.append((doc, start, n, total, zlib.crc32(ids), seq, offset, part, is_open, keep))
                offset += n

        def flush() -> pa.RecordBatch:
            nonlocal kept
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                             schema=schema)
            rows.clear()
            kept = 0
            return out

        for batch in batches:
            if schema is None:
                schema = pa.schema([("doc_id", batch.column(0).type), *[(n, pa.int64()) for n in (
                    "start", "length", "doc_tokens", "ids_crc32", "sequence_id", "offset")],
                    ("part", pa.int32()), ("open", pa.bool_()), ("ids", pa.binary())])
            for doc, text in zip(batch.column(0).to_pylist(), each_text(batch.column(1))):
                ids = vocab.encode(text, spaced) + end
                total = len(ids) // 4
                whole = total - total % window
                for at in range(0, whole, window):
                    emit([(doc, at, total, ids[4 * at:4 * (at + window)])], False)
                if whole < total:
                    for pieces in windows.place(total - whole, (doc, whole, total, ids[4 * whole:])):
                        emit(pieces, False)
                if len(rows) >= 20_000 or kept >= 8_000_000:
                    yield flush()
        for pieces in windows.rest():
            emit(pieces, True)
        if rows:
            yield flush()

    return run


def _merge_group(window: int, keep_ids: bool):
    """Lay the open windows of a group end to end and cut them every ``window`` ids."""

    def run(key, pdf):
        pdf = pdf.sort_values(["sequence_id", "offset"], kind="stable")
        seq, at, out = _MERGED + (int(key[0]) << _SHIFT), 0, []
        for row in pdf.itertuples(index=False):
            ids, start = row.ids, row.start
            while ids:
                n = min(window - at, len(ids) // 4)
                head, ids = ids[:4 * n], ids[4 * n:]
                out.append((row.doc_id, start, n, row.doc_tokens, zlib.crc32(head), seq, at,
                            row.part, False, head if keep_ids else None))
                start, at = start + n, at + n
                if at == window:
                    seq, at = seq + 1, 0
        return type(pdf)(out, columns=list(pdf.columns[:10])).astype({"doc_id": pdf["doc_id"].dtype})

    return run


def pack(docs: DataFrame, vocab_path: str, *, spaced: bool = True, end_id: int = 0,
         window: int = WINDOW, open_windows: int = OPEN_WINDOWS, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset[, ids]).

    ``keep_ids`` adds each piece's ids as little-endian unsigned 32-bit integers. The placed
    pieces are staged in the shared folder once, as both the closed windows and the merge of
    the open ones read them.
    """
    rows = text_rows(docs, id_col, text_col)
    schema = _schema(rows.schema["doc_id"].dataType)
    placed = staged(rows.mapInArrow(
        _pack_task(vocab_path, spaced, end_id, window, open_windows, keep_ids), schema), "placed")
    merged = (placed.filter("open").withColumn("merge_group", F.floor(F.col("part") / MERGE_PARTS))
              .groupBy("merge_group").applyInPandas(_merge_group(window, keep_ids), schema))
    drop = ["part", "open"] + ([] if keep_ids else ["ids"])
    return placed.filter("NOT open").drop(*drop).unionByName(merged.drop(*drop))
