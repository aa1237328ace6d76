"""Near duplicates by HyperMinHash sketches, verified on full shingle sets.

1. One pass over the texts: the set of 5-word shingles (64-bit hashes), its 128-bit
   fingerprint, and a sketch of ``REGISTERS`` registers. A register keeps, for the smallest
   hash of its bucket, the number of leading zeros (6 bits) and the 10 bits that follow.
   Empty registers borrow from the filled bucket that a fixed random table ranks first, so
   small sets keep the same chance of equal registers as large ones.
2. Documents of equal sets form a class; everything below works on classes, so copies
   cost one row each.
3. Bands of ``BAND`` registers are hashed; classes that share a band meet in a bucket. At
   similarity 0.75 a pair misses all 32 bands with a chance of 5 in a million.
4. In each bucket all members are compared with one leader, its best connected member. Links
   join classes to components.
5. Members of buckets that still hold several components go on by an exact way. Each set's
   shingles are put in order of their number among these members (rare ones first). Sets of n
   and m shingles are linked if they share o = ceil(0.75 (n + m) / 1.75) at least, so a common
   shingle stands where o can still be reached behind it in both (prefix and positional
   filter). The shorter set of a pair is indexed by the short prefix that sets of its own
   size need (a seventh of it), the longer one looks up with up to a quarter. Entries of the
   index that agree in shingle, size, place and component are one cell; look-ups meet cells of
   other components under the size and position conditions, and only what passes is expanded to
   members. Texts that only share a frequent passage, and near copies that are too far from their
   group, have too many shingles of their own before the shared ones and meet nothing.
6. A compared pair is estimated from the two sketches (registers that agree, corrected for
   those that agree by chance); unless the estimate is far below the limit, the texts are
   fetched and the link is decided on both full sets.

Defined results: null, empty and blank texts have no shingles and are their own component;
a null ``doc_id`` never becomes a component's id unless all its ids are null; repeated rows
get the same result each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import each_text, staged, text_rows

SHINGLE = 5
PERCENT = 75
REGISTERS, BAND = 128, 4
_BUCKET_BITS, _MANTISSA = 7, 10
#: Standard errors below the limit at which an estimate rules a pair out.
MARGIN = 6.0
#: Hashes of words and of whole texts that a task keeps (some 20 MB each); it forgets them at its end,
#: as Spark's Python workers live on and later stages need the room.
MEMO_WORDS = 100_000
MEMO_HASHES = 2_000_000

_FILL = np.random.default_rng(4).random((REGISTERS, REGISTERS))
_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_33 = np.uint64(33)
_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (multiply and shift)."""
    x = (x ^ (x >> _33)) * _M1
    x = (x ^ (x >> _33)) * _M2
    return x ^ (x >> _33)


def shingle_set(text: bytes) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the shingles of a UTF-8 text.

    A-Z are lower-cased; words are the runs between ASCII white space. Fewer words than a
    shingle form one, of their own kind; no word, none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    try:
        h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_WORDS) > MEMO_WORDS:
            _WORDS.clear()
        for w in words:
            if w not in _WORDS:
                _WORDS[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    acc = np.full(n, size, np.uint64)
    for k in range(size):
        acc = acc * _P + h[k:k + n]
    return np.unique(_mix(acc))


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers; independent of order."""
    a = _mix(shingles ^ _M1).sum(dtype=np.uint64)
    b = _mix(shingles + _M2).sum(dtype=np.uint64) ^ np.uint64(len(shingles))
    return int(a.view(np.int64)), int(b.view(np.int64))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers (unsigned 16 bit) of a set that isn't empty."""
    bucket = (shingles >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))     # the smallest hash of each bucket
    v = (shingles[first] << np.uint64(_BUCKET_BITS)) >> np.uint64(12)      # 52 bits
    zeros = 52 - np.frexp(v.astype(np.float64))[1]
    fraction = ((v << zeros.astype(np.uint64)) & np.uint64((1 << 51) - 1)) >> np.uint64(51 - _MANTISSA)
    value = (zeros << _MANTISSA) | fraction.astype(np.int64)
    filled = bucket[first]
    out = np.zeros(REGISTERS, np.uint16)
    out[filled] = value
    if len(filled) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), filled, assume_unique=True)
        out[empty] = value[np.argmin(_FILL[empty][:, filled], axis=1)]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One signed 64-bit key for each band of each row of registers."""
    r = registers.astype(np.uint64).reshape(len(registers), REGISTERS // BAND, BAND)
    key = np.zeros(r.shape[:2], np.uint64) + (np.arange(r.shape[1], dtype=np.uint64) + np.uint64(1)) * _P
    for k in range(BAND):
        key = _mix(key ^ (r[:, :, k] + np.uint64(k << 16))) * _P
    return key.view(np.int64)


@functools.lru_cache(4096)
def chance_agreement(half_bits_a: int, half_bits_b: int) -> float:
    """Chance that a register agrees for two disjoint sets of 2 ** (half_bits / 2) shingles."""
    zeros = np.arange(53)[:, None]
    low = 2.0 ** -(zeros + 1.0) * (1 + np.arange(1 << _MANTISSA)[None, :] / (1 << _MANTISSA))
    high = low + 2.0 ** -(zeros + 1.0) / (1 << _MANTISSA)

    def cell(half_bits: int) -> np.ndarray:
        n = max(1.0, 2.0 ** (half_bits / 2) / REGISTERS)
        return np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(high, 1 - 1e-12)))

    return float((cell(half_bits_a) * cell(half_bits_b)).sum())


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """Jaccard similarity from two sketches, corrected for registers that agree by chance."""
    by_chance = chance_agreement(round(2 * np.log2(n_a)), round(2 * np.log2(n_b)))
    return (float((a == b).mean()) - by_chance) / (1 - by_chance)


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, f1, f2, regs = [], [], [], []
        for text in each_text(batch.column("text")):
            s = shingle_set(text)
            a, b = fingerprint(s)
            n.append(len(s))
            f1.append(a)
            f2.append(b)
            regs.append(sketch(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(n, pa.int64()),
             pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(regs, pa.binary())],
            ["doc_id", "k1", "k2", "n_shingles", "f1", "f2", "registers"])
    _WORDS.clear()


def _band_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            now = batch.slice(lo, 4096)
            r = np.frombuffer(b"".join(now.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            keys = band_keys(r)
            cid = np.repeat(now.column("cid").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(cid)], ["band", "cid"])


def _shingle_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, text) to one row (cid, shingle) for each shingle."""
    for batch in batches:
        cids, out, size = [], [], 0
        for cid, text in zip(batch.column("cid").to_pylist(), each_text(batch.column("text"))):
            s = shingle_set(text)
            out.append(s.view(np.int64))
            cids.append(np.full(len(s), cid))
            size += len(s)
            if size > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cids)), pa.array(np.concatenate(out))],
                                                 ["cid", "shingle"])
                cids, out, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cids)), pa.array(np.concatenate(out))],
                                             ["cid", "shingle"])
    _WORDS.clear()


def overlap(n: Column, m: Column, percent: int) -> Column:
    """Common shingles that sets of ``n`` and ``m`` need to be linked."""
    return F.call_function("div", percent * (n + m) + (99 + percent), F.lit(100 + percent))


def prefix_entries(members: DataFrame, percent: int) -> DataFrame:
    """(band, cid, n, place): the shared shingles by which members can find a partner at all.

    ``place`` counts from 1 in the set's order by number of holders; shingles of one member alone
    come first and can't be shared, so they only move the others back.
    """
    rows = staged(members.select("cid", "text").mapInArrow(_shingle_task, "cid long, shingle long"), "shingles")
    shared = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    by_number = W.partitionBy("cid").orderBy("holders", "shingle")
    n = F.col("n_shingles")
    ranked = rows.join(shared, "shingle").join(members.select("cid", "n_shingles"), "cid").withColumn(
        "place", F.row_number().over(by_number) + n - F.count(F.lit(1)).over(W.partitionBy("cid")))
    shortest = F.call_function("div", percent * n + 99, F.lit(100))        # of a set that can be linked at all
    return ranked.filter(F.col("place") <= n - shortest + 1).select(
        F.col("shingle").alias("band"), "cid", n.alias("n"), "place")


def prefix_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of different components that can be linked, from (band, cid, n, place, label)."""
    n, place = F.col("n"), F.col("place")
    index = entries.filter(place <= n - overlap(n, n, percent) + 1)
    cells = index.select("band", "n", "place", "label").distinct()
    seek = entries.select(F.col("band").alias("band_x"), F.col("cid").alias("x"), n.alias("n_x"), place.alias("place_x"),
                          F.col("label").alias("label_x"))
    reach = 1 + F.least(F.col("n_x") - F.col("place_x"), n - place)
    passed = seek.join(cells, (F.col("band_x") == F.col("band")) & (F.col("label") != F.col("label_x"))
                       & (n <= F.col("n_x")) & (100 * n >= percent * F.col("n_x"))
                       & (reach >= overlap(F.col("n_x"), n, percent))).select("x", "band", "n", "place", "label")
    return passed.join(index, ["band", "n", "place", "label"]).select(
        F.least("x", "cid").alias("a"), F.greatest("x", "cid").alias("b")).distinct()


def _estimate_task(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                      for c in ("r_a", "r_b"))
            na, nb = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            agree = (ra == rb).mean(axis=1)
            chance = np.array([chance_agreement(x, y) for x, y in zip(
                np.rint(2 * np.log2(na)).astype(int).tolist(), np.rint(2 * np.log2(nb)).astype(int).tolist())])
            small, large = np.minimum(na, nb), np.maximum(na, nb)
            error = np.sqrt(0.1875 * (1 / REGISTERS + 1 / small))
            stay = ((agree - chance) / (1 - chance) >= percent / 100 - MARGIN * error) & (100 * small >= percent * large)
            yield batch.select(["a", "b"]).filter(pa.array(stay))
    return run


def _verify_task(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        size = 0

        def full(cid: int, text: pa.Scalar) -> np.ndarray:
            nonlocal size
            got = known.get(cid)
            if got is None:
                if size > MEMO_HASHES:
                    known.clear()
                    size = 0
                got = known[cid] = shingle_set(text.as_py())
                size += len(got) + 16
            return got

        for batch in batches:
            ca, cb = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ta, tb = (batch.column(c).cast(pa.binary()) for c in ("t_a", "t_b"))
            linked = []
            for i in range(batch.num_rows):
                x, y = full(ca[i], ta[i]), full(cb[i], tb[i])
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
        _WORDS.clear()
    return run


def verified(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked; ``members``: (cid, n_shingles, registers, text)."""
    def side(x: str, **columns: str) -> DataFrame:
        return members.select(F.col("cid").alias(x), *[F.col(c).alias(f"{k}_{x}") for k, c in columns.items()])
    near = pairs.join(side("a", n="n_shingles", r="registers"), "a").join(
        side("b", n="n_shingles", r="registers"), "b").mapInArrow(_estimate_task(percent), "a long, b long")
    near = staged(near, "near")
    return near.join(side("a", t="text"), "a").join(side("b", t="text"), "b").select(
        "a", "b", "t_a", "t_b").mapInArrow(_verify_task(percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); label: the component's smallest node.

    Each round takes the smallest label among a node and its neighbours, then the label of
    that label. Rounds follow the logarithm of the longest chain, not its length.
    """
    edges = staged(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "edges")
    labels = edges.groupBy("node").agg(F.min("other").alias("low")).select(
        "node", F.least("node", "low").alias("label"))
    while True:
        near = (edges.join(labels.toDF("other", "theirs"), "other").groupBy("node")
                .agg(F.min("theirs").alias("theirs")))
        best = staged(labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "theirs").alias("mid")), "best")
        labels = staged(best.join(best.select(F.col("node").alias("mid"), F.col("mid").alias("label")), "mid")
                        .select("node", "label", "was"), "labels")
        if not labels.filter("label <> was").limit(1).count():
            return labels.drop("was")
        labels = labels.drop("was")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after more ``links`` (a, b), by way of one edge between any two labels."""
    def of(x: str) -> DataFrame:
        return labels.toDF(x, f"label_{x}")
    ends = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")))
    up = components(staged(ends.filter("a <> b").distinct(), "label_links"))
    alone = up.select("node", F.col("node").alias("label")).join(labels.select("node"), "node", "left_anti")
    return staged(labels.unionByName(alone).join(up.toDF("label", "higher"), "label", "left").select(
        "node", F.coalesce("higher", "label").alias("label")), "labels")


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, and its row key (k1, k2).

    The key is a 128-bit hash of id and text: rows of equal id and text share it.
    """
    return _grouped(docs, percent, id_col, text_col).drop("component")


def _grouped(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with ``component``, which doesn't depend on ids (null without words)."""
    rows = text_rows(docs, id_col, text_col)
    rows = rows.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(7), "text", "doc_id")})
    id_type = rows.schema["doc_id"].dataType
    found = staged(rows.mapInArrow(_sketch_task, T.StructType([
        T.StructField("doc_id", id_type), *[T.StructField(c, T.LongType()) for c in ("k1", "k2", "n_shingles", "f1", "f2")],
        T.StructField("registers", T.BinaryType())])), "sketches")
    # One class for each set. Its text is that of one member (the smallest key).
    classes = staged(found.filter("n_shingles > 0").groupBy("f1", "f2").agg(
        F.min("doc_id").alias("min_doc"), F.min(F.struct("k1", "k2")).alias("key"),
        F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")

    bands = classes.select("cid", "registers").mapInArrow(_band_task, "band long, cid long")
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = staged(bands.join(shared, "band"), "met")
    # The leader is the member that meets most others over all its bands: the text that a
    # group of near copies was made from, to which all of them are close.
    degree = met.groupBy("cid").agg(F.sum("size").alias("degree"))
    leaders = met.join(degree, "cid").groupBy("band").agg(
        F.max_by("cid", F.struct("degree", -F.col("cid"))).alias("leader"))
    buckets = staged(met.select("band", "cid").join(leaders, "band"), "buckets")
    ids = buckets.select("cid").distinct()
    wanted = classes.join(ids, "cid").select("cid", "n_shingles", "registers", "key.k1", "key.k2")
    texts = rows.select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    members = staged(texts.join(wanted, ["k1", "k2"]).select("cid", "n_shingles", "registers", "text"), "members")

    pairs = staged(buckets.filter("cid <> leader").select(
        F.least("leader", "cid").alias("a"), F.greatest("leader", "cid").alias("b")).distinct(), "pairs")
    links = staged(verified(pairs, members, percent), "links")
    labels = components(links)

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(labels.toDF("cid", "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))

    rest = labelled(buckets.filter("cid <> leader").drop("leader"))
    several = rest.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    open_ids = staged(rest.join(several, "band").select("cid").distinct(), "open_ids")
    entries = staged(labelled(prefix_entries(members.join(open_ids, "cid"), percent)), "prefixes")
    more = staged(prefix_pairs(entries, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    labels = merged(labels, staged(verified(more, members, percent), "links"))
    named = labels.join(classes.select(F.col("cid").alias("node"), "min_doc"), "node")
    lowest = named.groupBy("label").agg(F.min("min_doc").alias("component_id"))
    of_class = labels.join(lowest, "label").select(
        F.col("node").alias("cid"), "label", "component_id", F.lit(True).alias("in_component"))
    by_set = (classes.select("f1", "f2", "cid", "min_doc").join(of_class, "cid", "left")
              .select("f1", "f2", F.when(F.col("in_component"), F.col("component_id")).otherwise(F.col("min_doc"))
                      .alias("component_id"), F.coalesce("label", "cid").alias("component")))
    full = found.filter("n_shingles > 0").join(by_set, ["f1", "f2"])
    none = found.filter("n_shingles = 0").withColumns(
        {"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")})
    columns = ["doc_id", "n_shingles", "component_id", "k1", "k2", "component"]
    return full.select(*columns).union(none.select(*columns)).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "k1", "k2", "component")


def drop_near_duplicates(docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which one of each group stays: that of the smallest id.

    Null ids come last; of texts that share the smallest id that of the smallest row key stays.
    Rows of equal id and text count as one document, of which one row stays. Documents
    without words all stay.
    """
    found = staged(_grouped(docs, percent, id_col, text_col), "grouped")
    least = found.filter("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("best"))
    keep = (least.select("best.k1", "best.k2").union(found.filter("component IS NULL").select("k1", "k2"))
            .distinct())
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(id_col, text_col).alias("k1"),
                        F.xxhash64(F.lit(7), text_col, id_col).alias("k2"))
    return keyed.dropDuplicates(["k1", "k2"]).join(keep, ["k1", "k2"]).select("doc.*")
