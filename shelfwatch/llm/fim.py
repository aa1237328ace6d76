"""Fill-in-middle transformation by secondary sort.

1. Every text is cut into prefix, middle and suffix at two places that a hash of its id gives,
   and leaves the task as pieces of at most ``UNIT`` code points, keyed by document and position
   in the output. No piece, batch or state grows with a text.
2. ``repartition`` by document and ``sortWithinPartitions`` by (document, position) bring the
   pieces of an output together in order (the DataFrame form of
   repartitionAndSortWithinPartitions: one shuffle of the texts, external sort). A streaming
   pass feeds each output into an incremental digest.
3. The same pass restores: it reads the output alone, finds the sentinels (also across pieces)
   and hands on what lies between them keyed by place in the original. A second sort within the
   same partitions, without another shuffle, puts that in order for the second digest.

A document's key is a 128-bit hash of id and text, the map task and the number of equal rows
before it there, so rows of a hot id spread over all partitions and equal rows stay apart; a
task that runs again gives the same keys.

Defined results: a null text counts as empty; empty texts and texts that hold a sentinel are
``plain``; a null id hashes like an empty one; repeated rows give a row each; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import STEP_BYTES, text_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Code points of a piece at most.
UNIT = 4096
#: The sentinels of a form in the order of its output.
LAYOUT = {"plain": (), "psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Place of a section in the original text.
_PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_END = 9

_KEY = [("k1", pa.int64()), ("k2", pa.int64()), ("task", pa.int32()), ("nth", pa.int32())]
_KEY_NAMES = [n for n, _ in _KEY]


def cut(doc_id, text: str, plain_percent: int = 10, spm_percent: int = 20, seed: int = 1) -> tuple[str, str, str, str]:
    """(form, prefix, middle, suffix) of one text; a plain text is all prefix."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= 100 - plain_percent:
        return "plain", text, "", ""
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return "spm" if h4 % 100 < spm_percent else "psm", text[:a], text[a:b], text[b:]


def output(form: str, prefix: str, middle: str, suffix: str) -> str:
    """The transformed text, for one that is in memory as a whole."""
    parts = {PREFIX: prefix, MIDDLE: middle, SUFFIX: suffix}
    return "".join(s + parts[s] for s in LAYOUT[form]) or prefix


class Reader:
    """Tells the sections of an output apart while it streams by.

    ``feed`` and ``end`` return (section, text) runs. Between two sentinels nothing else than a
    sentinel starts one (texts that hold any are plain), so the first match is the right one.
    """

    def __init__(self, form: str):
        self.ahead = list(LAYOUT[form])
        self.section = None if self.ahead else PREFIX
        self.carry = ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        text, self.carry = self.carry + text, ""
        out = []
        while self.ahead:
            at = text.find(self.ahead[0])
            if at < 0:
                keep = len(self.ahead[0]) - 1
                text, self.carry = text[:-keep], text[-keep:]
                break
            out.append((self.section, text[:at]))
            self.section, text = self.ahead[0], text[at + len(self.ahead[0]):]
            self.ahead.pop(0)
        out.append((self.section, text))
        if any(s is None and t for s, t in out):
            raise ValueError("text before the first sentinel")
        return [(s, t) for s, t in out if t]

    def end(self) -> list[tuple[str, str]]:
        if self.ahead:
            raise ValueError(f"no {self.ahead[0]} in the output")
        return [(self.section, self.carry)] if self.carry else []


class _Rows:
    """Rows gathered to record batches of about ``STEP_BYTES`` of text."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= STEP_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)],
                                             schema=self.schema)
        self.rows, self.size = [], 0


def _cut_task(id_type: pa.DataType, plain_percent: int, spm_percent: int, seed: int):
    schema = pa.schema([*_KEY, ("doc_id", id_type), ("form", pa.string()), ("pos", pa.int64()), ("piece", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, task, seen = _Rows(schema), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                h = xxhash.xxh3_128_intdigest(f"{doc_id}:{text}".encode())
                k1, k2 = (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)
                key = (k1, k2, task, seen[h])
                seen[h] += 1
                form, prefix, middle, suffix = cut(doc_id, text, plain_percent, spm_percent, seed)
                parts = {PREFIX: prefix, MIDDLE: middle, SUFFIX: suffix}
                pos = 0
                for part in [s + parts[s] for s in LAYOUT[form]] or [prefix]:
                    for lo in range(0, max(len(part), 1), UNIT):
                        piece = part[lo:lo + UNIT]
                        yield from rows.add((*key, doc_id, form, pos + lo, piece), len(piece))
                    pos += len(part)
        yield from rows.flush()
    return run


def pieces(docs: DataFrame, *, plain_percent: int = 10, spm_percent: int = 20, seed: int = 1, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The outputs of all documents in pieces: doc_id, form, pos (code points before it), piece.

    The pieces of an output follow one another in a partition, ordered by ``pos``. The columns
    k1, k2, task and nth name the row of ``docs`` it comes from.
    """
    rows = text_rows(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType([*_key_fields(), T.StructField("doc_id", id_type), T.StructField("form", T.StringType()),
                           T.StructField("pos", T.LongType()), T.StructField("piece", T.StringType())])
    return (rows.mapInArrow(_cut_task(_arrow(id_type), plain_percent, spm_percent, seed), schema)
            .repartition(*_KEY_NAMES).sortWithinPartitions(*_KEY_NAMES, "pos"))


def _key_fields() -> list[T.StructField]:
    return [T.StructField(n, T.LongType() if t == pa.int64() else T.IntegerType()) for n, t in _KEY]


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _restore_task(id_type: pa.DataType):
    """Sorted pieces of outputs to pieces of the originals, and one closing row a document."""
    schema = pa.schema([*_KEY, ("place", pa.int32()), ("at", pa.int64()), ("piece", pa.string()), ("doc_id", id_type),
                        ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                        ("n", pa.int64()), ("output_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(schema)
        key = doc_id = form = digest = reader = None
        sizes: Counter = Counter()

        def hand_on(runs) -> Iterator[pa.RecordBatch]:
            for section, text in runs:
                yield from rows.add((*key, _PLACE[section], sizes[section], text, *[None] * 6), len(text))
                sizes[section] += len(text)

        def close() -> Iterator[pa.RecordBatch]:
            yield from hand_on(reader.end())
            plain = form == "plain"
            yield from rows.add((*key, _END, 0, None, doc_id, form, None if plain else sizes[PREFIX],
                                 None if plain else sizes[MIDDLE], sum(sizes.values()), digest.hexdigest()), 64)

        for batch in batches:
            keys = zip(*(batch.column(n).to_pylist() for n in _KEY_NAMES))
            ids, forms = batch.column("doc_id").to_pylist(), batch.column("form").to_pylist()
            for i, (now, piece) in enumerate(zip(keys, batch.column("piece"))):
                if now != key:
                    if key is not None:
                        yield from close()
                    key, doc_id, form = now, ids[i], forms[i]
                    digest, reader = hashlib.sha256(), Reader(form)
                    sizes.clear()
                text = piece.as_py()
                digest.update(text.encode())
                yield from hand_on(reader.feed(text))
        if key is not None:
            yield from close()
        yield from rows.flush()
    return run


def _digest_task(id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, digest = _Rows(schema), hashlib.sha256()
        for batch in batches:
            closing = batch.select(["place", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"])
            for i, piece in enumerate(batch.column("piece")):
                if piece.is_valid:
                    digest.update(piece.as_py().encode())
                else:
                    place, *values = (c[i].as_py() for c in closing.columns)
                    if place != _END:
                        raise ValueError("piece without text")
                    yield from rows.add((*values, digest.hexdigest()), 128)
                    digest = hashlib.sha256()
        yield from rows.flush()
    return run


def restored(outputs: DataFrame) -> DataFrame:
    """Pieces of the originals, in order within partitions, from ``pieces`` alone.

    ``place`` and ``at`` order the pieces of a document; its last row (place 9, no piece) holds
    its sizes and the digest of the output that was read.
    """
    id_type = outputs.schema["doc_id"].dataType
    schema = T.StructType([*_key_fields(), T.StructField("place", T.IntegerType()), T.StructField("at", T.LongType()),
                           T.StructField("piece", T.StringType()), T.StructField("doc_id", id_type),
                           T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("output_sha256", T.StringType())])
    return (outputs.mapInArrow(_restore_task(_arrow(id_type)), schema)
            .sortWithinPartitions(*_KEY_NAMES, "place", "at"))


def digests(originals: DataFrame) -> DataFrame:
    """One row a document of ``restored``: doc_id, n, form, sizes, digests of output and original."""
    id_type = originals.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n", T.LongType()),
                           T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType()), T.StructField("output_sha256", T.StringType()),
                           T.StructField("restored_sha256", T.StringType())])
    return originals.mapInArrow(_digest_task(_arrow(id_type)), schema)


def _text_task(id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("form", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, key, head, parts = _Rows(schema), None, None, []
        for batch in batches:
            keys = zip(*(batch.column(n).to_pylist() for n in _KEY_NAMES))
            heads = zip(batch.column("doc_id").to_pylist(), batch.column("form").to_pylist())
            for now, this, piece in zip(keys, heads, batch.column("piece")):
                if now != key:
                    if key is not None:
                        text = "".join(parts)
                        yield from rows.add((*head, text), len(text))
                    key, head, parts = now, this, []
                parts.append(piece.as_py())
        if key is not None:
            text = "".join(parts)
            yield from rows.add((*head, text), len(text))
        yield from rows.flush()
    return run


def texts(outputs: DataFrame) -> DataFrame:
    """(doc_id, form, text): every output put together, one document in memory at a time."""
    id_type = outputs.schema["doc_id"].dataType
    return outputs.mapInArrow(_text_task(_arrow(id_type)), T.StructType([
        T.StructField("doc_id", id_type), T.StructField("form", T.StringType()), T.StructField("text", T.StringType())]))


def restore_text(form: str, text: str) -> str:
    """The original of one output in memory."""
    reader = Reader(form)
    found = {PREFIX: "", MIDDLE: "", SUFFIX: ""}
    for section, run in reader.feed(text) + reader.end():
        found[section] += run
    return found[PREFIX] + found[MIDDLE] + found[SUFFIX]


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), h AS (
  SELECT *, CAST(length(text) AS BIGINT) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
    CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4 FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, substr(text, 1, a) AS pre, substr(text, a + 1, b - a) AS mid, substr(text, b + 1) AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
