"""BPE encoding with chunks shared across documents, and decoding.

A text is cut where a rolling hash over its last ``HASH_BYTES`` bytes hits a pattern, so
equal passages give equal chunks wherever they stand. Documents are dealt to tasks by the
smallest of their chunk hashes: documents that share passages tend to share it, and meet in
one task, which encodes each distinct chunk once. Keys that more documents share than a
quarter of an even part are dealt over several tasks (counted first; there are at most four
such keys for each part, as their counts add up to the number of documents).

A chunk's encoding is kept as the ids of the words inside it, with the word fragments at its
two ends. Joining chunks, the fragments that meet are encoded again over a window that grows
until white space (or the document's end) stands at both of its edges; the vocabulary drops
white space and can't merge across it, so from there on both sides agree with the encoding
of the whole text exactly.

Defined results: null and empty texts have no ids and decode to empty text; a null
``doc_id`` and repeated rows stay rows of their own; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import n_parts, raw_texts, staged, text_rows
from .vocab import Vocabulary, vocabulary

HASH_BYTES = 16
#: A chunk ends on average every so many bytes (a power of two), and at these bounds.
MEAN_BYTES, MIN_BYTES, MAX_BYTES = 256, 64, 4096
#: Bytes of chunks and their encodings that a worker keeps.
MEMO_BYTES = 100_000_000
_SEGMENT = 1 << 20
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hashes(data: bytes) -> np.ndarray:
    """At each byte, a hash of it and the ``HASH_BYTES`` - 1 before it: sum of gear << age.

    Built by doubling: a window of 2w is the window of w plus the one w bytes earlier.
    """
    h = _GEAR[np.frombuffer(data, np.uint8)]
    w = 1
    while w < HASH_BYTES:
        h[w:] += h[:-w] << np.uint32(w)
        w *= 2
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text; each lies between two characters."""
    found = []
    for lo in range(0, len(data), _SEGMENT):
        head = min(lo, HASH_BYTES - 1)
        h = rolling_hashes(data[lo - head:lo + _SEGMENT])[head:]
        found.append(np.flatnonzero((h >> np.uint32(8)) % np.uint32(MEAN_BYTES) == 0) + lo + 1)
    cuts, last = [], 0
    for end in [*(np.concatenate(found).tolist() if found else []), len(data)]:
        while end - last > MAX_BYTES:
            at = last + MAX_BYTES
            while data[at] & 0xC0 == 0x80:
                at += 1
            cuts.append(at)
            last = at
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if end - last >= MIN_BYTES or end == len(data) and end > last:
            cuts.append(end)
            last = end
    return cuts


def chunks_of(data: bytes) -> list[bytes]:
    cuts = cut_points(data)
    return [data[a:b] for a, b in zip([0, *cuts], cuts)]


def routing_key(data: bytes) -> int:
    """The smallest chunk hash of a text (as a signed 64-bit number)."""
    return min((xxhash.xxh3_64_intdigest(c) for c in chunks_of(data)), default=0) - (1 << 63)


_SPACE = b" \t\n\r\x0b\x0c"


class ChunkEncoder:
    """Encodes texts chunk by chunk with one memo for all documents that pass by."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.memo, self.size = vocab, {}, 0
        self.asked = self.encoded = 0

    def _fragment(self, word: bytes) -> tuple[bytes, bytes]:
        ids = self.vocab.encode(word, False)
        pieces = self.vocab.pieces
        return ids, b" ".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def _chunk(self, chunk: bytes):
        """(head, inner ids, inner text, tail); tail is None if no white space is inside."""
        self.asked += 1
        got = self.memo.get(chunk)
        if got is None:
            self.encoded += 1
            words = chunk.split(None, 1)
            if not words:                                   # white space alone
                got = (b"", b"", b"", b"")
            else:
                head = b"" if chunk[0] in _SPACE else words[0]
                if len(head) == len(chunk):
                    got = (chunk, b"", b"", None)
                else:
                    inner = chunk[len(head):]
                    tail = b"" if chunk[-1] in _SPACE else inner.rsplit(None, 1)[-1]
                    got = (head, *self._fragment(inner[:len(inner) - len(tail)]), tail)
            if self.size > MEMO_BYTES:
                self.memo.clear()
                self.size = 0
            self.memo[chunk] = got
            self.size += 3 * len(chunk) + len(got[1]) + len(got[2]) + 300
        return got

    def encode(self, data: bytes) -> tuple[bytes, bytes]:
        """Ids (little-endian unsigned 32 bit) and decoded text of a whole UTF-8 text."""
        ids, text, open_word = [], [], []

        def close() -> None:
            if open_word:
                word = b"".join(open_word)
                open_word.clear()
                a, b = self._fragment(word)
                ids.append(a)
                text.append(b)

        for chunk in chunks_of(data):
            head, inner, inner_text, tail = self._chunk(chunk)
            if head:
                open_word.append(head)
            if tail is None:                                # the window grows on
                continue
            close()
            ids.append(inner)
            text.append(inner_text)
            if tail:
                open_word.append(tail)
        close()
        return b"".join(ids), b" ".join([t for t in text if t])


_ENCODERS: dict[str, ChunkEncoder] = {}


def _key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [routing_key(x) for x in raw_texts(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], ["chunk_key"])


def _deal_task(spread: dict[int, int]):
    """(doc_id, text) to (chunk_key, salt, doc_id, text); ``spread``: parts of hot keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            keys = [routing_key(x) for x in raw_texts(batch.column(1))]
            salts = []
            for k in keys:
                n += 1
                salts.append(n % spread[k] if k in spread else 0)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(salts, pa.int32()),
                                              batch.column(0), batch.column(1)],
                                             ["chunk_key", "salt", "doc_id", "text"])
    return run


def _encode_task(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = ChunkEncoder(vocabulary(path))
        encoder = _ENCODERS[path]
        for batch in batches:
            docs, texts = batch.column("doc_id"), raw_texts(batch.column("text"))
            ids, plain, lengths, rows, size = [], [], [], 0, 0

            def flush():
                names = ["doc_id", "n_tokens", "ids_sha256" if digests else "ids", "decoded_sha256" if digests else "decoded"]
                kind = (pa.string(), pa.string()) if digests else (pa.binary(), pa.string())
                out = pa.RecordBatch.from_arrays([docs.slice(rows, len(ids)), pa.array(lengths, pa.int64()),
                                                  pa.array(ids, kind[0]), pa.array(plain, kind[1])], names)
                return out

            for text in texts:
                a, b = encoder.encode(text)
                lengths.append(len(a) // 4)
                size += 0 if digests else len(a) + len(b)
                ids.append(hashlib.sha256(a).hexdigest() if digests else a)
                plain.append(hashlib.sha256(b).hexdigest() if digests else b.decode())
                if size > 16_000_000:
                    yield flush()
                    rows += len(ids)
                    ids, plain, lengths, size = [], [], [], 0
            if ids:
                yield flush()
    return run


def chunk_encode(docs: DataFrame, vocab_path: str, *, id_col: str = "doc_id",
                 text_col: str = "text", digests: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (binary), decoded (string).

    ``digests`` returns the SHA-256 of both instead (ids_sha256, decoded_sha256), so that
    neither leaves the task. The vocabulary must drop white space.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col)
    parts = n_parts(spark)
    counts = staged(rows.select("text").mapInArrow(_key_task, "chunk_key long")
                    .groupBy("chunk_key").count(), "chunk_keys")
    total = counts.agg(F.sum("count")).first()[0] or 0
    even = total // (4 * parts) + 1
    # More than ``even`` documents each: fewer than 4 * parts keys.
    spread = {r[0]: -(-r[1] // even) for r in counts.filter(F.col("count") > even).collect()}
    id_type = rows.schema["doc_id"].dataType
    dealt_schema = T.StructType([
        T.StructField("chunk_key", T.LongType()), T.StructField("salt", T.IntegerType()),
        T.StructField("doc_id", id_type), T.StructField("text", T.StringType())])
    dealt = rows.mapInArrow(_deal_task(spread), dealt_schema).repartition(parts, "chunk_key", "salt")
    kinds = [T.StringType(), T.StringType()] if digests else [T.BinaryType(), T.StringType()]
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType()),
                           *[T.StructField(n, k) for n, k in zip(names, kinds)]])
    return dealt.mapInArrow(_encode_task(vocab_path, digests), schema)
