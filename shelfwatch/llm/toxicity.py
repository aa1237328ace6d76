"""Toxic spans by a linear-chain conditional random field.

Tags: 1 for a toxic token, 0 for any other. The weight of a tag sequence is the product of
exp(u(token)) over its toxic tokens and of the transition weights 1 to 1 and 1 to 0; u is the sum
of the weights of a token's features (word, first 3 to 6 and last 3 to 5 letters) and a bias.

1. Training rows are a bounded sample of labelled documents (``max_rows`` of each class, by a hash
   of the id), so feature tables and parameters are bounded too. Features are those of toxic
   documents that are ``lift`` times as frequent there as in clean ones.
2. Labelled tokens: all tokens of clean documents are 0. Tokens of toxic documents are 1 where a
   feature is frequent in toxic and rare in clean documents. The field is fitted to them first.
   Then the labels of toxic documents are taken again from the field itself, given that at
   least one token is toxic (labels may be wrong with a chance of ``noise``).
3. Each step of the fit is a Spark job over the encoded sample: forward-backward gives expected
   counts, which tasks return as one vector each.
4. Scoring is one pass over the texts without a shuffle. Forward-backward runs over blocks of
   tokens of many documents at a time: products of the 2x2 steps of each block, messages from
   block to block of a document, then the steps again. The marginals along the chain multiply to
   the chance that no token is toxic; the score is its complement. Runs of tokens with a
   marginal of 0.5 or more are the spans.

Labels, languages, sources and ids are no features. Defined results: null, empty and wordless
texts score 0 without spans; labels that are null or of unknown ids are ignored, several labels of
an id count as toxic if one does, several texts of an id count once; without toxic training rows
all scores are 0; repeated rows give a row each; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import n_parts, slices, staged, text_rows

#: Labelled documents of each class that the field is fitted to, at most.
MAX_ROWS = 4000
MIN_DOCS, LIFT, SEED_LIFT, SEED_SHARE = 5, 3.0, 20.0, 0.01
NOISE, L2, RATE = 0.05, 0.5, 0.4
SEED_STEPS, STEPS = 6, 14
BLOCK = 64
CUT = 0.7
MEMO_WORDS = 500_000
_TOKEN = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """Features of a token; case doesn't matter."""
    w = word.lower()
    return (["=" + w] + ["<" + w[:k] for k in range(3, min(7, len(w)))] + [">" + w[-k:] for k in range(3, min(6, len(w)))])


@dataclass
class Model:
    """Weights of features, and of bias, transition 1 to 1 and transition 1 to 0."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -40.0
    stay: float = 0.0
    leave: float = 0.0

    def __post_init__(self):
        # Three letters that a word with any weight begins or ends with, and shorter words.
        self._first = {f[1:4] for f in self.weights if f[0] != ">"}
        self._last = {f[-3:] for f in self.weights if f[0] == ">"}

    def token(self, word: str) -> float:
        """u of a token."""
        w = word.lower()
        if w[:3] not in self._first and w[-3:] not in self._last:
            return self.bias
        u = self.bias + sum(self.weights.get(f, 0.0) for f in features(w))
        return min(max(u, -40.0), 40.0)


def forward_backward(u: np.ndarray, lengths: np.ndarray, stay: float, leave: float
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """log Z of each sequence; of each token the marginal of tag 1, and of (1, 1) and (1, 0) with the token before.

    Sequences follow one another in ``u``. The tag before the first token is 0 and the weight of
    all tags 0 is 1, so exp(-log Z) is the chance that no token is toxic.
    """
    a11, a10 = np.exp(stay), np.exp(leave)
    n_docs, total = len(lengths), len(u)
    if not total:
        z = np.zeros(0)
        return np.zeros(n_docs), z, z, z
    blocks = -(-lengths // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    n_blocks = int(blocks.sum())
    doc_of = np.repeat(np.arange(n_docs), lengths)
    at = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row, col = at % BLOCK, first_block[doc_of] + at // BLOCK
    e = np.ones((BLOCK, n_blocks))
    real = np.zeros((BLOCK, n_blocks), bool)
    e[row, col], real[row, col] = np.exp(u), True

    # Products of the steps of each block; row i: from tag i.
    p00, p01, p10, p11 = np.ones(n_blocks), np.zeros(n_blocks), np.zeros(n_blocks), np.ones(n_blocks)
    for t in range(BLOCK):
        q00, q01 = p00 + p01 * a10, (p00 + p01 * a11) * e[t]
        q10, q11 = p10 + p11 * a10, (p10 + p11 * a11) * e[t]
        s = q00 + q01 + q10 + q11
        r = real[t]
        p00, p01, p10, p11 = (np.where(r, q / s, p) for q, p in ((q00, p00), (q01, p01), (q10, p10), (q11, p11)))

    # Messages into each block from the left (l) and from the right (h).
    l0, l1, h0, h1 = (np.empty(n_blocks) for _ in range(4))
    order = np.argsort(-blocks, kind="stable")
    deep, starts, counts = int(blocks.max()), first_block[order], blocks[order]
    active = np.searchsorted(-counts, -np.arange(deep), side="left")    # documents with more than k blocks
    m0, m1 = np.ones(n_docs), np.zeros(n_docs)
    for k in range(deep):
        n = active[k]
        b = starts[:n] + k
        l0[b], l1[b] = m0[:n], m1[:n]
        x0, x1 = m0[:n] * p00[b] + m1[:n] * p10[b], m0[:n] * p01[b] + m1[:n] * p11[b]
        s = x0 + x1
        m0[:n], m1[:n] = x0 / s, x1 / s
    m0, m1 = np.ones(n_docs), np.ones(n_docs)
    for k in range(deep - 1, -1, -1):
        n = active[k]
        b = starts[:n] + k
        h0[b], h1[b] = m0[:n], m1[:n]
        x0, x1 = p00[b] * m0[:n] + p01[b] * m1[:n], p10[b] * m0[:n] + p11[b] * m1[:n]
        s = x0 + x1
        m0[:n], m1[:n] = x0 / s, x1 / s

    f0, f1 = np.empty((BLOCK + 1, n_blocks)), np.empty((BLOCK + 1, n_blocks))
    f0[0], f1[0] = l0 / (l0 + l1), l1 / (l0 + l1)
    log_norm = np.zeros(n_blocks)
    for t in range(BLOCK):
        x0, x1 = f0[t] + f1[t] * a10, (f0[t] + f1[t] * a11) * e[t]
        s, r = x0 + x1, real[t]
        f0[t + 1], f1[t + 1] = np.where(r, x0 / s, f0[t]), np.where(r, x1 / s, f1[t])
        log_norm += np.where(r, np.log(s), 0.0)
    log_z = np.zeros(n_docs)
    np.add.at(log_z, np.repeat(np.arange(n_docs), blocks), log_norm)

    one, both, left = (np.empty((BLOCK, n_blocks)) for _ in range(3))
    b0, b1 = h0, h1
    for t in range(BLOCK - 1, -1, -1):
        r, w1 = real[t], e[t] * b1
        c00, c01, c10, c11 = f0[t] * b0, f0[t] * w1, f1[t] * a10 * b0, f1[t] * a11 * w1
        s = c00 + c01 + c10 + c11
        one[t], both[t], left[t] = (c01 + c11) / s, c11 / s, c10 / s
        y0, y1 = b0 + w1, a10 * b0 + a11 * w1
        s = y0 + y1
        b0, b1 = np.where(r, y0 / s, b0), np.where(r, y1 / s, b1)
    return log_z, one[row, col], both[row, col], left[row, col]


# --- fit ---------------------------------------------------------------------------------------

def held_out(id_col: Column) -> Column:
    """Rows whose labels are not learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_rows: int) -> tuple[DataFrame, dict]:
    """(doc_id, toxic, text) of the training sample, and the number of labelled rows by class."""
    marks = (labels.select(labels[id_col].alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [marks.filter(F.col("toxic") == k).orderBy(order, "doc_id").limit(max_rows) for k in (0, 1)]
    # At most 2 * max_rows rows of two numbers: bounded by the parameter, whatever the table.
    picked = F.broadcast(chosen[0].union(chosen[1]))
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).join(picked, "doc_id")
    once = rows.groupBy("doc_id", "toxic").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.xxhash64(F.lit(7), "text"))).alias("text"))
    total = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    return once, total


def _words(text: str | None) -> list[str]:
    return _TOKEN.findall(text) if text else []


def _feature_count_task(wanted: dict[str, int] | None):
    """Number of documents by feature, of all features or of ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        memo: dict[str, tuple] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen = set()
                for w in set(_words(text)):
                    got = memo.get(w)
                    if got is None:
                        got = memo[w] = tuple(f for f in features(w) if wanted is None or f in wanted)
                    seen.update(got)
                count.update(seen)
        if count:
            yield pa.RecordBatch.from_arrays([pa.array(list(count)), pa.array(list(count.values()), pa.int64())],
                                             ["feature", "n"])
    return run


def _encode_task(index: dict[str, int], seeds: np.ndarray):
    """Documents as rows of whole blocks: the tokens as numbers of distinct words, their features, seed labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int8)
            for lo, hi in slices(texts):
                words: dict[str, int] = {}
                tokens = [np.fromiter((words.setdefault(w, len(words)) for w in _words(t)), np.int32)
                          for t in texts[lo:hi]]
                found = [[index[f] for f in features(w) if f in index] for w in words]
                seed = np.array([any(seeds[i] for i in fs) for fs in found], np.int8)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
                    toxic[lo:hi], np.array([len(x) for x in tokens], np.int32),
                    np.concatenate(tokens) if tokens else np.zeros(0, np.int32),
                    np.cumsum([0] + [len(x) for x in found]).astype(np.int32),
                    np.array([i for fs in found for i in fs], np.int32), seed)],
                    ["toxic", "lengths", "tokens", "ends", "found", "seed"])
    return run


def gradient(theta: np.ndarray, toxic: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, ends: np.ndarray,
             found: np.ndarray, seed: np.ndarray, weight: float, noise: float, seeded: bool) -> np.ndarray:
    """Gradient of the log likelihood, and the likelihood last. ``theta``: features, bias, stay, leave.

    ``weight`` counts a clean document several times. ``seeded``: toxic documents have the seed
    labels; else they are known to hold a toxic token.
    """
    n = len(theta) - 3
    word_of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    u_word = np.clip(theta[n] + np.bincount(word_of, theta[found], len(ends) - 1), -40.0, 40.0)
    log_z, one, both, left = forward_backward(u_word[tokens], lengths, theta[n + 1], theta[n + 2])
    doc_of = np.repeat(np.arange(len(lengths)), lengths)
    p0, bad = np.exp(-log_z), toxic == 1
    out = np.zeros(n + 4)
    clean_like = noise + (1 - noise) * p0
    factor = np.where(bad, 0.0, -weight * (1 - noise) * p0 / clean_like)
    out[-1] = weight * np.log(clean_like[~bad]).sum()
    if seeded:
        y = (seed[tokens] & bad[doc_of]).astype(float)
        before = np.concatenate([[0.0], y[:-1]])
        before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0.0
        known = bad & (np.bincount(doc_of, y, len(lengths)) > 0)
        factor = np.where(known, -1.0, factor)
        fixed = y, before * y, before * (1 - y)
        out[-1] += (u_word[tokens] * y).sum() + (theta[n + 1] * fixed[1] + theta[n + 2] * fixed[2]).sum() - log_z[known].sum()
    else:
        like = noise + (1 - noise) * (1 - p0)
        factor = np.where(bad, (1 - noise) * p0 / like, factor)
        fixed = (0.0, 0.0, 0.0)
        out[-1] += np.log(like[bad]).sum()
    by_token = factor[doc_of]
    d_word = np.bincount(tokens, by_token * one + fixed[0], len(ends) - 1)
    out[:n] = np.bincount(found, d_word[word_of], n)[:n] if len(found) else 0.0
    out[n] = d_word.sum()
    out[n + 1] = (by_token * both + fixed[1]).sum()
    out[n + 2] = (by_token * left + fixed[2]).sum()
    return out


def _gradient_task(theta: np.ndarray, weight: float, noise: float, seeded: bool):
    kinds = {"toxic": np.int8, "lengths": np.int32, "tokens": np.int32, "ends": np.int32, "found": np.int32, "seed": np.int8}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(theta) + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                parts = {k: np.frombuffer(batch.column(k)[i].as_py(), kind) for k, kind in kinds.items()}
                total += gradient(theta, **parts, weight=weight, noise=noise, seeded=seeded)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])
    return run


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
        text_col: str = "text", noise: float = NOISE) -> Model:
    """The field fitted to the labelled rows that aren't held out; ``labels``: (id, toxic)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows, labelled = _sample(docs, labels, id_col, text_col, max_rows)
    parts = max(1, min(n_parts(spark), 2 * max_rows // 250))
    rows = staged(rows.repartition(parts, "doc_id").sortWithinPartitions("doc_id"), "labelled")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1):
        return Model()

    def counted(toxic: int, wanted: dict[str, int] | None) -> dict[str, int]:
        got = (rows.filter(F.col("toxic") == toxic).select("text")
               .mapInArrow(_feature_count_task(wanted), "feature string, n long")
               .groupBy("feature").agg(F.sum("n").alias("n")))
        got = got.filter(F.col("n") >= MIN_DOCS) if wanted is None else got
        table = got.toArrow()
        return dict(zip(table.column("feature").to_pylist(), table.column("n").to_pylist()))

    in_toxic = counted(1, None)
    in_clean = counted(0, in_toxic) if n.get(0) else {}
    names = sorted(in_toxic)
    a = np.array([in_toxic[f] for f in names], float)
    b = np.array([in_clean.get(f, 0) for f in names], float)
    lift = (a / n[1]) / ((b + 0.5) / (n.get(0, 0) + 1))
    use = lift >= LIFT
    index = {names[i]: k for k, i in enumerate(np.flatnonzero(use))}
    seeds = ((lift >= SEED_LIFT) & (a >= SEED_SHARE * n[1]))[use]
    blocks = staged(rows.select("toxic", "text").mapInArrow(
        _encode_task(index, seeds), "toxic binary, lengths binary, tokens binary, ends binary, found binary, seed binary"),
        "blocks")

    # Labelled rows that a row of the sample stands for, clean ones against toxic ones.
    weight = max(1.0, labelled.get(0, 0) / max_rows) / max(1.0, labelled[1] / max_rows)
    size = len(index)
    theta = np.zeros(size + 3)
    theta[size] = -6.0
    m, v = np.zeros(size + 3), np.zeros(size + 3)
    for step in range(1, SEED_STEPS + STEPS + 1):
        seeded = step <= SEED_STEPS and bool(seeds.any())
        sums = [np.frombuffer(r["total"]) for r in blocks.mapInArrow(
            _gradient_task(theta, weight, noise, seeded), "total binary").collect()]
        g = np.sum(sums, axis=0)[:-1] - L2 * theta * np.r_[np.ones(size), np.zeros(3)]
        m, v = 0.8 * m + 0.2 * g, 0.95 * v + 0.05 * g * g
        theta = theta + RATE * (m / (1 - 0.8 ** step)) / (np.sqrt(v / (1 - 0.95 ** step)) + 1e-9)
    bias, stay, leave = theta[size:].tolist()
    return Model({f: float(theta[k]) for f, k in index.items()}, bias, stay, leave)


# --- scores ------------------------------------------------------------------------------------

def tag_texts(texts: list[str], model: Model, memo: dict[str, float]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """Scores of texts, and spans (start, end, highest marginal) in code points, end exclusive."""
    if len(memo) > MEMO_WORDS:
        memo.clear()
    u, lengths = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = _words(text)
        for w in set(words).difference(memo):
            memo[w] = model.token(w)
        lengths[i] = len(words)
        u.append(np.fromiter(map(memo.__getitem__, words), float, len(words)))
    log_z, one, _, _ = forward_backward(np.concatenate(u) if u else np.zeros(0), lengths, model.stay, model.leave)
    spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    starts = np.cumsum(lengths) - lengths
    hits = np.flatnonzero(one >= 0.5)
    for i in np.unique(np.searchsorted(starts + lengths, hits, side="right")):
        last = -2
        for k, found in enumerate(_TOKEN.finditer(texts[i])):
            p = float(one[starts[i] + k])
            if p >= 0.5:
                if last == k - 1:
                    start, _, high = spans[i].pop()
                    spans[i].append((start, found.end(), max(high, p)))
                else:
                    spans[i].append((found.start(), found.end(), p))
                last = k
    return -np.expm1(-np.maximum(log_z, 0.0)), spans


def _score_task(model: Model):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, float] = {}
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in slices(texts):
                scores, spans = tag_texts(texts[lo:hi], model, memo)
                found = [[{"start": s, "end": e, "marginal": p} for s, e, p in x] for x in spans]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(scores),
                                                  pa.array(found, kind)], ["doc_id", "score", "spans"])
    return run


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans) of every row; ``spans``: array of (start, end, marginal)."""
    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(_score_task(model), T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
            T.StructField("marginal", T.DoubleType())])))]))
