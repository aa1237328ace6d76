"""Personal data: fixed forms first, then bootstrapped contextual extraction.

1. One pass over the texts finds the base spans (email, ip, card, phone) and, outside them,
   candidates: strings that look like an identifier but meet none of the forms. Each is
   taken with its lexical pattern, the two words before it however far off; of what is glued to
   it in its own word since the last digit or '@' ('tel:'), the last run of letters is a word,
   punctuation alone is none.
2. Base spans are the first seeds. A pattern with ``MIN_SEEDS`` different seed instances of one
   kind is worth scoring; how often those patterns occur anywhere in the corpus is counted
   in a second pass (a bit map of ``BITS_A_PATTERN`` bits a pattern picks the word pairs to
   count, a join makes the counts exact). Where no candidate stands behind such a pattern, nothing can be found and
   the second pass is left out.
3. The graph of patterns and instances is scored in ``ROUNDS`` rounds: the confidence of a
   pattern for a kind is the summed score of its instances, each as often as it stands behind
   the pattern, over its occurrences (plus one); copies of a text count on both sides;
   the score of an instance is 1 if it is a seed of the kind, else 1 less the product of
   (1 - confidence) over its patterns.
4. Candidates behind patterns of at least ``MIN_CONFIDENCE`` become spans of that kind, and
   their instances seeds. Steps 2 to 4 (with the counts of all that may become a pattern,
   taken once) are repeated until no instance is added.

Spans count code points, the end is exclusive. Defined results: null and empty texts have no
spans; a null ``doc_id`` and repeated rows stay rows of their own; an empty table gives an
empty result; other columns are ignored by ``find`` and carried along by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import staged

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS, MIN_CONFIDENCE, ROUNDS = 3, 0.7, 3
#: Bits of the map that picks word pairs to count: as many a pattern, within these powers of two.
#: Beyond the upper one (32 MB a task) more pairs than needed are counted, and the join drops them.
BITS_A_PATTERN, LEAST_BITS, MOST_BITS = 16, 20, 28

# The four forms. Each equals its plain form on every text; the look-behind and
# the search from '@' outwards only spare retries inside a run, so the time stays linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Candidates: an address without a full domain, a number, a dotted number. A run of address
# characters is tried once, from its beginning.
_CANDIDATE = re.compile(r"(?<![\w@.%+-])(?:[A-Za-z0-9._%+-]{2,}@[A-Za-z0-9-]{2,}"
                        r"|[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}|[0-9][0-9\x20().-]{5,28}[0-9])(?![\w@])")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Runs of letters, ASCII ones apart from others: an address may begin between the two.
_LETTERS = re.compile(r"[a-z]+|[^\W\d_a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            last = match.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the four forms, in that order."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) < 4 and int(p) < 256 or int(p.lstrip("0")[:4] or "0") < 256
                   for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _kinds_of(value: str) -> list[int]:
    """The kinds that an identifier-like string may be of."""
    if "@" in value:
        return [0]
    digits = len(_NOT_DIGIT.sub("", value))
    out = [1] if re.fullmatch(r"[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}", value) else []
    out += [2] if 12 <= digits <= 19 else []
    return out + ([3] if 7 <= digits <= 15 else [])


def _plain(word: str) -> str:
    return _DIGIT.sub("0", word.lower().strip("\"'()[]<>.,;!?"))


def _forms(word: str) -> tuple[str, ...]:
    """What stands for a word in a pattern: each of its runs of letters, where something is
    glued to them, and the whole word, last ('' for punctuation)."""
    whole = _plain(word)
    runs = [r for r in _LETTERS.findall(word.casefold()) if r != whole]
    return (*runs, whole)


class _Words:
    """The words of a text, for patterns of places that are asked for in ascending order."""

    def __init__(self, text: str):
        self.text = text
        self.ahead = _WORD.finditer(text)
        self.word = next(self.ahead, None)
        self.last: list[str] = []                      # the two words before ``word``
        self.asked = 0                                 # in ``word``, everything before is passed

    def pattern(self, start: int) -> str:
        """The two words before a place, lower-cased, digits as 0; '' where there are none."""
        while self.word and self.word.end() <= start:
            if plain := _plain(self.word.group()):
                self.last = [*self.last[-1:], plain]
            self.word, self.asked = next(self.ahead, None), 0
        last = self.last
        if self.word and self.word.start() < start:
            lo = max(self.word.start(), self.asked)
            glued = self.text[lo:start]
            cut = max(glued.rfind(c) for c in "0123456789@")
            if runs := _LETTERS.findall(glued[cut + 1:].casefold()):
                last = [*last[-1:], runs[-1]]
            if cut >= 0:
                self.asked = lo + cut + 1
        return " ".join(last) if len(last) == 2 else ""


def _pattern(text: str, start: int) -> str:
    return _Words(text).pattern(start)


def mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """(pattern, kind, instance, start, end, seed) of the seeds and the candidates, by start.

    ``spans`` ascend. One walk over spans, candidates and words, linear in the text.
    """
    found = [(start, end, kind, True) for start, kind, end in spans]
    if _DIGIT.search(text) or "@" in text:
        k = reach = 0                                  # spans before k end at ``reach`` or before
        for m in _CANDIDATE.finditer(text):
            while k < len(spans) and spans[k][0] < m.end():
                reach = max(reach, spans[k][2])
                k += 1
            if reach <= m.start():
                found += [(m.start(), m.end(), kind, False) for kind in _kinds_of(m.group())]
    out, words = [], _Words(text)
    for start, end, kind, seed in sorted(found):
        if pattern := words.pattern(start):
            value = text[start:end].lower() if kind == 0 else _NOT_DIGIT.sub("", text[start:end])
            out.append((pattern, kind, value, start, end, seed))
    return out


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                                  T.StructField("end", T.LongType())]))
_MENTION = T.ArrayType(T.StructType([
    T.StructField("pattern", T.StringType()), T.StructField("kind", T.IntegerType()),
    T.StructField("instance", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("seed", T.BooleanType())]))


def _scan(texts: pd.Series) -> pd.DataFrame:
    spans, found = [], []
    for text in texts:
        text = text or ""
        own = base_spans(text)
        spans.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
        found.append([dict(zip(("pattern", "kind", "instance", "start", "end", "seed"), x))
                      for x in mentions(text, own)])
    return pd.DataFrame({"base": spans, "mentions": found})


def _count_task(bits: bytes):
    """Count the word pairs whose bit is set, by the rule of ``_Words.pattern``."""
    size = len(bits) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms: dict[str, tuple[str, ...]] = {}

        def out(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])

        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                before = None
                for w in _WORD.findall(text or ""):
                    f = forms.get(w)
                    if f is None:
                        f = _forms(w)
                        if len(w) <= 64:
                            if len(forms) > 300_000:
                                forms.clear()
                            forms[w] = f
                    if before is not None:
                        for p in f:
                            if p:
                                pair = f"{before} {p}"
                                h = zlib.crc32(pair.encode()) % size
                                if bits[h >> 3] >> (h & 7) & 1:
                                    counts[pair] += 1
                    before = f[-1] or before
                if len(counts) > 200_000:
                    yield out(counts)
                    counts = Counter()
            yield out(counts)
    return run


def _occurrences(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, n): how often each of ``patterns`` occurs in all texts."""
    patterns = staged(patterns, "to_count")
    power = min(max((BITS_A_PATTERN * patterns.count()).bit_length(), LEAST_BITS), MOST_BITS)
    bit = F.crc32(F.encode("pattern", "UTF-8")) % (1 << power)
    # 63 bits of the map a row: its size bounds what comes to the driver
    rows = patterns.select(F.call_function("div", bit, F.lit(63)).alias("part"), (bit % 63).cast("int").alias("at")).groupBy(
        "part").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("mask")).toArrow()
    places = np.concatenate([np.zeros(0, np.int64), *(
        part[(mask >> at) & 1 == 1] * 63 + at for at in range(63)
        for part, mask in [(rows.column("part").to_numpy(), rows.column("mask").to_numpy())])])
    bits = np.zeros(1 << power, np.uint8)
    bits[places] = 1
    counts = texts.mapInArrow(_count_task(np.packbits(bits, bitorder="little").tobytes()), "pattern string, n long")
    return counts.groupBy("pattern").agg(F.sum("n").alias("n")).join(patterns, "pattern", "left_semi")


def _confidences(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) after scoring the graph of patterns and instances."""
    seeds = staged(pairs.select("kind", "instance").distinct().join(
        known.withColumn("known", F.lit(True)), ["kind", "instance"], "left").fillna(False, ["known"]), "instances")
    scores = seeds.select("kind", "instance", "known", F.col("known").cast("double").alias("score"))
    confidence = None
    for _ in range(ROUNDS):
        confidence = staged(pairs.join(scores, ["kind", "instance"]).groupBy("pattern", "kind")
                            .agg((F.sum(F.col("score") * F.col("times")) / (F.max("n") + 1)).alias("confidence")),
                            "confidence")
        scores = staged(pairs.join(confidence, ["pattern", "kind"]).groupBy("kind", "instance").agg(
            F.sum(F.log1p(-F.least("confidence", F.lit(1 - 1e-9)))).alias("doubt"))
            .join(seeds, ["kind", "instance"])
            .select("kind", "instance", "known",
                    F.when(F.col("known"), 1.0).otherwise(1 - F.exp("doubt")).alias("score")), "scores")
    return confidence


def _discover(scanned: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(row, found): spans behind high-confidence patterns; None if there can be none."""
    edges = scanned.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    pairs = staged(edges.groupBy("pattern", "kind", "instance").agg(
        F.max("seed").alias("seed"), F.max(~F.col("seed")).alias("open"), F.count(F.lit(1)).alias("times")), "pairs")

    def several(pairs: DataFrame) -> DataFrame:
        return (pairs.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n_seeds"))
                .filter(F.col("n_seeds") >= MIN_SEEDS).select("pattern", "kind"))

    def strong_by(known: DataFrame) -> DataFrame:
        return staged(several(pairs.join(known, ["kind", "instance"], "left_semi")), "patterns")

    known = staged(pairs.filter("seed").select("kind", "instance").distinct(), "known")
    strong, n_known = strong_by(known), known.count()
    if not pairs.filter("open").join(strong, ["pattern", "kind"], "left_semi").limit(1).count():
        return None
    # all that may become a pattern in some generation is counted in the one pass
    counts = staged(_occurrences(texts, several(pairs).select("pattern").distinct()), "occurrences")
    while True:
        graph = staged(pairs.join(strong.select("pattern").distinct(), "pattern", "left_semi")
                       .join(counts, "pattern"), "graph")
        good = staged(_confidences(graph, known).filter(F.col("confidence") >= MIN_CONFIDENCE)
                      .join(strong, ["pattern", "kind"], "left_semi"), "good")
        accepted = pairs.filter("open").join(good, ["pattern", "kind"], "left_semi").select("kind", "instance")
        known, before = staged(known.union(accepted).distinct(), "known"), n_known
        n_known = known.count()
        if n_known == before:
            break
        strong = strong_by(known)
    best = (edges.filter("NOT seed").join(good, ["pattern", "kind"]).groupBy("row", "start", "end")
            .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("kind"))).alias("best")))
    return best.groupBy("row").agg(F.collect_list(F.struct(
        "start", (-F.col("best.kind")).cast("int").alias("kind"), "end")).alias("found"))


def _joined(spans) -> F.Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _spans(docs: DataFrame, columns: list, text: F.Column) -> DataFrame:
    """``columns`` of every row with base and all spans, each in order."""
    ship_package(docs.sparkSession)
    kind = T.StructType([T.StructField("base", _SPAN), T.StructField("mentions", _MENTION)])
    scan = F.pandas_udf(_scan, kind)
    scanned = staged(docs.select(*columns, scan(text).alias("s")).select(
        "*", "s.base", "s.mentions").drop("s").withColumn("row", F.monotonically_increasing_id()), "scanned")
    found = _discover(scanned.select("row", "mentions"), docs.select(text.alias("text")))
    rest = scanned.drop("mentions")
    if found is None:
        return rest.drop("row").withColumn("spans", F.col("base"))
    return rest.join(found, "row", "left").drop("row").withColumn("spans", F.sort_array(F.concat(
        "base", F.coalesce("found", F.array().cast(_SPAN))))).drop("found")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base and spans (arrays of start, kind number, end)."""
    return _spans(docs, [F.col(id_col).alias("doc_id")], F.col(text_col))


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base spans, their SHA-256, and all spans as text."""
    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    n = [count(k) for k in range(len(KINDS))]
    return found.select("doc_id", *n, F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))


def masked(text: str, spans) -> str:
    """The text with each span (overlapping ones together) replaced by its kind."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{KINDS[s['kind']].upper()}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def _mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None else masked(t, s) for t, s in zip(texts, spans)])


def redact(docs: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span masked; ``length_col``, where present, counts the new text."""
    # the whole row goes along as one struct, so no column of the caller can clash
    text = F.col("doc").getField(text_col)
    found = _spans(docs.select(F.struct("*").alias("doc")), [F.col("doc")], text)
    mask = F.pandas_udf(_mask, T.StringType())
    found = found.withColumn("clean", F.when(F.size("spans") > 0, mask(text, "spans")).otherwise(text))
    out = []
    for f in docs.schema.fields:
        c = F.col("doc").getField(f.name)
        if f.name == text_col:
            c = F.col("clean")
        elif f.name == length_col:
            c = F.when(F.size("spans") > 0, F.length("clean").cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return found.select(*out)


def spans_sha256(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
