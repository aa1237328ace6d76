"""Exact, memoised encoding with the tokenizers library inside a task.

Both vocabularies encode each pre-token by itself, so a text's ids are its pre-tokens' ids
one after the other. Texts made of the characters in ``_COMMON`` are cut into pre-tokens by
a plain regular expression with the tokenizer's own rule, and each distinct pre-token goes
through the library's model once per Python worker (bounded memo). Any other text is cut
only where the tokenizer can never join two sides, and the units go through the library's
whole encoder.

* ``spaced=False``: vocabularies that drop white space and lower-case the text;
* ``spaced=True``: byte-level vocabularies that keep white space.

Strings of special tokens inside a text are handled as the library handles them by default.
"""

from __future__ import annotations

import os
import re

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries kept per worker (some 40 MB); the memo starts anew when it is full.
MEMO_ENTRIES = 200_000

# ASCII (without control characters other than tab, newline, return), Latin-1 letters and
# common typographic marks: characters whose class, lower case and normal form are plain.
_LATIN = "À-ÖØ-öø-ÿ"
_MARKS = "–—‘’“”„…•€°§"
_UNCOMMON = re.compile(f"[^\\t\\n\\r -~{_LATIN}{_MARKS}]")
# The two pre-token rules, over the characters above.
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACED = re.compile(f"{_SHORT}| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?[^\\sA-Za-z0-9{_LATIN}]+|\\s+(?!\\S)|\\s+")
_WORDS = re.compile(f"{_SHORT}|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


_BYTE_CHARS = _byte_chars()
_LOADED: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """One vocabulary file, with memos text part -> ids (little-endian unsigned 32 bit)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.units: dict[bytes, bytes] = {}
        self._pieces: list[bytes] | None = None

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _model(self, token: str) -> bytes:
        mapped = "".join([_BYTE_CHARS[b] for b in token.encode()])
        return np.array([t.id for t in self.tokenizer.model.tokenize(mapped)], "<u4").tobytes()

    def _by_units(self, text: bytes, spaced: bool) -> bytes:
        units = spaced_units(text) if spaced else text.split()
        if len(self.units) > MEMO_ENTRIES // 2:
            self.units.clear()
        new = [u for u in dict.fromkeys(units) if u not in self.units]
        for i in range(0, len(new), 10_000):
            part = new[i:i + 10_000]
            self.units.update(zip(part, self.encode_plain([u.decode() for u in part])))
        return b"".join(map(self.units.__getitem__, units))

    def encode(self, text: bytes, spaced: bool) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit bytes."""
        s = text.decode()
        if _UNCOMMON.search(s) or any(m in s for m in self.marks):
            return self._by_units(text, spaced)
        tokens = _SPACED.findall(s) if spaced else _WORDS.findall(s.lower())
        memo = self.memo
        try:
            return b"".join(map(memo.__getitem__, tokens))
        except KeyError:
            if len(memo) > MEMO_ENTRIES:
                memo.clear()
            for t in tokens:
                if t not in memo:
                    memo[t] = self._model(t)
            return b"".join(map(memo.__getitem__, tokens))

    @property
    def pieces(self) -> list[bytes]:
        """UTF-8 piece text of each id."""
        if self._pieces is None:
            n = self.tokenizer.get_vocab_size(with_added_tokens=True)
            self._pieces = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(n)]
        return self._pieces


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of ``path``, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


_EDGE = frozenset(range(0x21))  # blank and control bytes


def _safe(left: bytes, right: bytes) -> bool:
    """Whether no white-space rule can reach across a blank between the two sides."""
    if not left or not right or left[-1] in _EDGE or right[0] in _EDGE:
        return False
    if left[-1] < 0x80 and right[0] < 0x80:
        return True
    i, j = len(left) - 1, 1
    while i > 0 and left[i] & 0xC0 == 0x80:
        i -= 1
    while j < len(right) and right[j] & 0xC0 == 0x80:
        j += 1
    return not (left[i:].decode().isspace() or right[:j].decode().isspace())


def spaced_units(text: bytes) -> list[bytes]:
    """Units of a text for a byte-level vocabulary; together they are the whole text.

    A unit starts at a single blank that has no white space on either side: a new pre-token
    starts there whatever stands before, so encoding the sides apart changes nothing.
    """
    parts = text.split(b" ")
    out, cur, last = [], [parts[0]], parts[0]
    for p in parts[1:]:
        if _safe(last, p):
            out.append(b" ".join(cur))
            cur = [b"", p]
        else:
            cur.append(p)
        last = p
    out.append(b" ".join(cur))
    return [u for u in out if u]
