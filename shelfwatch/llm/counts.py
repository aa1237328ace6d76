"""Token counts of a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton enumerates the vocabulary matches of a text in one pass; dynamic
programming over their ends carries the best score and the number of pieces of that path.
Ties go as in the tokenizers library's Unigram model: a later candidate for the same end
replaces the best one only with a strictly higher score, and candidates come by ascending
start, so the longest piece wins. A character that no single piece covers costs the lowest
score less 10 and counts its UTF-8 bytes if the vocabulary has all byte pieces, else one
piece for a whole run of them.

Blanks become the vocabulary's blank mark, one stands before the text. If no piece holds a
blank after another character, no path can cross there, so a text is cut into units, and
each distinct unit is solved once per Python worker (bounded memo). Scores of the given
vocabulary are whole numbers, so adding up units is exact.

Defined results: null and empty texts have 0 tokens and score 0; a null ``doc_id`` and
repeated rows stay rows of their own; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import text_rows

BLANK = "▁"
UNK_PENALTY = 10.0
MEMO_ENTRIES = 400_000

_LOADED: dict[str, "UnigramCounter"] = {}


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick
        self.lowest = min(score for _, score in pieces)
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.bytes = {f"<0x{b:02X}>" for b in range(256)} <= {p for p, _ in pieces}
        self.matches = ahocorasick.Automaton()
        for p, score in pieces:
            if p and p not in self.matches:
                self.matches.add_word(p, (len(p), score))
        self.matches.make_automaton()
        self.memo: dict[str, tuple[int, float]] = {}
        whole = all(float(s).is_integer() for _, s in pieces)
        inside = any(re.search(f"[^{BLANK}]{BLANK}", p) for p, _ in pieces)
        self.cut = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+") if whole and not inside and self.bytes else None

    def solve(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path through the whole text."""
        n = len(text)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        unk = self.lowest - UNK_PENALTY
        found = self.matches.iter(text)
        nxt = next(found, None)
        for end in range(1, n + 1):
            best = None
            while nxt is not None and nxt[0] == end - 1:      # longest first
                length, gain = nxt[1]
                start = end - length
                now = score[start] + gain
                if best is None or now > best:
                    best, at, is_unk = now, start, False
                nxt = next(found, None)
            char = text[end - 1]
            if char not in self.single:
                now = score[end - 1] + unk
                if best is None or now > best:
                    best, at, is_unk = now, end - 1, True
            score[end], unknown[end] = best, is_unk
            if not is_unk:
                count[end] = count[at] + 1
            elif self.bytes:
                count[end] = count[at] + len(char.encode())
            else:
                count[end] = count[at] + (not unknown[at])
        return count[n], score[n]

    def __call__(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = BLANK + text.replace(" ", BLANK)
        if self.cut is None:
            return self.solve(text)
        memo, units = self.memo, self.cut.findall(text)
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        total, score = 0, 0.0
        for u in units:
            got = memo.get(u)
            if got is None:
                got = memo[u] = self.solve(u)
            total += got[0]
            score += got[1]
        return total, score


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, in id order."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


def counter(path: str) -> UnigramCounter:
    """The counter of a vocabulary file, built once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = UnigramCounter(sentencepiece_vocabulary(path))
    return _LOADED[path]


def token_counts(docs: DataFrame, vocab_path: str, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens (long), best_score (double)."""
    rows = text_rows(docs, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("best_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocab_path)
        for batch in batches:
            got = [count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.float64())], ["doc_id", "n_tokens", "best_score"])

    return rows.mapInArrow(run, schema)
