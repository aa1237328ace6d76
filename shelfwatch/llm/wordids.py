"""Ids of whole text columns for vocabularies that drop white space and lower-case the text.

The same rule as ``vocab._WORDS`` (same characters, other texts go through ``Vocabulary.encode``),
on the bytes of many texts at once: numpy finds where pre-tokens start, Arrow finds the
different ones, and the tokenizers library encodes those that the worker hasn't met (bounded
memo).
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import each_text
from .vocab import _BYTE_CHARS, Vocabulary, vocabulary

#: Text bytes worked on at a time (one row at least).
SLICE_BYTES = 10_000_000
#: Pre-tokens that the newer half of a worker's memo holds (some 200 bytes each).
MEMO_WORDS = 300_000
#: Pre-tokens in one call of the library.
_CALL = 500

_SPACE, _LETTER, _DIGIT, _OTHER, _RARE = range(5)


def _classes() -> np.ndarray:
    """The class of each byte; later bytes of a character have that of ``_OTHER`` at first."""
    out = np.full(256, _RARE, np.uint8)
    out[32:127] = _OTHER
    out[[9, 10, 13, 32]] = _SPACE
    out[48:58] = _DIGIT
    out[65:91] = out[97:123] = out[0xC3] = _LETTER
    out[0x80:0xC0] = out[0xC2] = out[0xE2] = _OTHER
    return out


_CLASS = _classes().tobytes()
_LOWER = bytes(range(256)).lower()
_AFTER_C2 = np.isin(np.arange(256), [0xA7, 0xB0])                # § °
# – — ‘ ’ “ ” „ … • € after 0xE2
_AFTER_E2 = {(0x80, k) for k in (0x93, 0x94, 0x98, 0x99, 0x9C, 0x9D, 0x9E, 0xA2, 0xA6)} | {(0x82, 0xAC)}


def _rare_places(data: np.ndarray, kinds: np.ndarray, high: bool) -> np.ndarray:
    """Places of characters outside ``vocab``'s common ones (bytes of whole UTF-8 texts)."""
    found = [np.flatnonzero(kinds == _RARE)]
    if high:
        signs = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))   # × ÷
        two = np.flatnonzero(data == 0xC2)
        three = np.flatnonzero(data == 0xE2)
        good = np.isin(data[three + 1].astype(np.int32) << 8 | data[three + 2], [a << 8 | b for a, b in _AFTER_E2])
        found += [signs, two[~_AFTER_C2[data[two + 1]]], three[~good]]
    return np.concatenate(found)


def _starts(data: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each byte; ``ends`` holds the borders of the texts."""
    start = np.empty(len(data), bool)
    start[:1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:])
    start |= kinds == _DIGIT
    start[ends[ends < len(data)]] = True
    start &= kinds != _SPACE
    # 's 't 're 've 'm 'll 'd: an apostrophe that starts a pre-token, letters of the same text after it
    at = np.flatnonzero((data[:-1] == 0x27) & start[:-1] & (kinds[1:] == _LETTER))
    if len(at):
        end = ends[np.searchsorted(ends, at, "right")]
        one = data[at + 1] | 0x20                              # ASCII letters in lower case
        two = np.where(at + 2 < end, data[np.minimum(at + 2, len(data) - 1)] | 0x20, 0)
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = np.isin(one.astype(np.int32) << 8 | two, [b[0] << 8 | b[1] for b in (b"re", b"ve", b"ll")])
        hit = (short | long) & (at + 1 < end)
        at, end, size = at[hit], end[hit], np.where(short[hit], 2, 3)
        start[at + 1] = False
        after = at + size
        after = after[after < end]
        start[after[kinds[after] == _LETTER]] = True
    return start


class WordEncoder:
    """Encodes columns; pre-tokens it has met are looked up."""

    def __init__(self, vocab: Vocabulary):
        from tokenizers import Tokenizer, pre_tokenizers
        self.vocab = vocab
        self.suffix = vocab.tokenizer.model.end_of_word_suffix
        # pre-tokens arrive cut, and in the characters of the byte level
        self.library = Tokenizer(vocab.tokenizer.model)
        self.library.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.characters = "".join(c if b != 32 else " " for b, c in enumerate(_BYTE_CHARS))
        self.marks = [m.encode() for m in vocab.marks]
        self.is_last = np.array([bool(self.suffix) and (vocab.tokenizer.id_to_token(k) or "").endswith(self.suffix)
                                 for k in range(vocab.tokenizer.get_vocab_size(with_added_tokens=True))])
        # words met since the memo was last full, and those met before that
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _library_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as the library finds them."""
        if self.suffix:
            calls = [codecs.charmap_decode(b" ".join(words[k:k + _CALL]), "strict", self.characters)[0]
                     for k in range(0, len(words), _CALL)]
            ids = np.concatenate([np.array(e.ids, np.uint32)
                                  for e in self.library.encode_batch_fast(calls, add_special_tokens=False)])
            last = np.flatnonzero(self.is_last[ids])
            if len(last) == len(words) and len(ids) == last[-1] + 1:      # each word ends with its mark
                raw, ends = ids.astype("<u4").tobytes(), (4 * last + 4).tolist()
                return [raw[lo:hi] for lo, hi in zip([0, *ends], ends)]
        return [self.vocab._model(w.decode()) for w in words]

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words; the memo takes in the new ones."""
        out = list(map(self.memo.get, words))
        unmet = [k for k, ids in enumerate(out) if ids is None]
        if unmet:
            for k in unmet:
                out[k] = self.older.get(words[k])
            new = [words[k] for k in unmet if out[k] is None]
            found = iter(self._library_ids(new) if new else [])
            for k in unmet:
                if out[k] is None:
                    out[k] = next(found)
            if len(self.memo) > MEMO_WORDS:
                self.memo, self.older = {}, self.memo
            self.memo.update((words[k], out[k]) for k in unmet)
        return out

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text of a column without nulls, as little-endian unsigned 32-bit bytes."""
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        ends = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        if ends[0] == ends[-1]:
            yield from [b""] * len(texts)
            return
        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        ends -= ends[0]
        whole = bytearray(data)
        data, kinds = np.frombuffer(whole, np.uint8), np.frombuffer(whole.translate(_CLASS), np.uint8)
        high = bool(data.max() >= 0x80)
        if high:
            np.copyto(kinds[1:], _LETTER, where=data[:-1] == 0xC3)
        rare = np.zeros(len(texts), bool)
        rare[np.searchsorted(ends, _rare_places(data, kinds, high), "right") - 1] = True
        # a special token's text stands in few texts, if any
        for m, mark in zip(self.vocab.marks, self.marks):
            if mark in whole:
                rare |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
        if rare.any():
            away = np.repeat(rare, np.diff(ends))                  # they have no words here
            kinds[away], data[away] = _SPACE, 32
        if high:
            capital = data[:-1] == 0xC3
            capital &= (data[1:] >= 0x80) & (data[1:] <= 0x9E)
            data[1:] += capital.view(np.uint8) << 5
        start = _starts(data, kinds, ends)
        at = np.flatnonzero(start)
        word_ends = np.searchsorted(at, ends)
        raw, id_ends = b"", np.zeros(len(ends), np.int64)
        if len(at):
            # a pre-token ends before the next one, or before white space
            start[:-1] = start[1:]
            start[-1] = True
            start[:-1] |= kinds[1:] == _SPACE
            start &= kinds != _SPACE
            borders = np.zeros(len(at) + 1, np.int32)
            np.cumsum(np.flatnonzero(start) - at + 1, out=borders[1:])
            low = whole.translate(_LOWER, b"\t\n\r ")
            words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(borders), pa.py_buffer(low)])
            coded = words.dictionary_encode()
            del at, start, kinds, data, whole, borders, low, words
            ids = pa.array(self._word_ids(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
            raw = memoryview(ids.buffers()[2])
            id_ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1][word_ends]
        for k, (lo, hi) in enumerate(zip(id_ends[:-1].tolist(), id_ends[1:].tolist())):
            yield self.vocab.encode(texts[k].as_py().encode(), False) if rare[k] else bytes(raw[lo:hi])


_ENCODERS: dict[str, WordEncoder] = {}


def encode_texts(path: str, column: pa.Array, spaced: bool) -> Iterator[bytes]:
    """``Vocabulary.encode`` of each text of a column; null counts as empty."""
    if spaced:
        encode = vocabulary(path).encode
        yield from (encode(text, True) for text in each_text(column))
        return
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(vocabulary(path))
    column = column.fill_null("")
    sizes = np.cumsum(pc.binary_length(column).to_numpy(), dtype=np.int64)
    lo = 0
    while lo < len(column):
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, before + SLICE_BYTES)))
        yield from _ENCODERS[path].encode(column.slice(lo, hi - lo))
        lo = hi
