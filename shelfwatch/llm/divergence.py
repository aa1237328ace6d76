"""Source divergence audit by count cells.

How far do the terms of each source lie from those of the other sources of its language, and
which terms does it use more than the language does? Smoothed shares p = 1 + floor(10^9 (c + 1) /
(N + V)) are compared by f(p, q) = floor((p - q)^2 / q), all in whole numbers.

1. One pass counts terms in bounded tables per task; sums by (lang, source, term) and then by
   (lang, term) follow, so a hot source or word meets partial sums only.
2. The value of a term in a group depends on its two counts alone. Terms are therefore grouped
   to cells (group count, lang count), f is worked out once a cell, cells of equal value are
   merged, and ranking them by cumulative multiplicity gives the value at which rank ``top``
   lies. Only the terms of cells from that value up are expanded, in UTF-8 order.
3. For pairs of sources the cells are (count here, count there). Terms of equal counts in all
   sources are folded to one profile first, and only sources that both hold a term meet.
   With n(x, y) cells of both, m(x) and m(y) terms that each holds, and all V terms,
       sum f = sum n(x,y) [f(x,y) - f(x,0) - f(0,y) + f(0,0)] + sum m(x) [f(x,0) - f(0,0)]
             + sum m(y) [f(0,y) - f(0,0)] + V f(0,0),
   so the terms that neither or only one of them holds are never listed for a pair.

A profile has at most one entry for each source of a language; the result itself has a row for
each pair of them.

Defined results: null text, lang and source count as ''; a group without terms takes part with
counts of 0; a language without kept terms has pairs of value 0 and no term rows; repeated rows
are documents each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ship_package
from .common import raw_texts, staged

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
#: Entries of a task's tables at which they are handed on.
TABLE_ENTRIES = 400_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of A-Z, a-z and characters from U+0080, A-Z lower-cased."""
    return text.translate(_LOWER).split(b" ") if text else []


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), summed within the task."""
    tables: dict[tuple, tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in tables.items():
            for c in (n, docs):
                c.pop(b"", None)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                     pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                     pa.array([docs[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])
        tables.clear()

    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        entries = sum(len(n) for n, _ in tables.values())
        for group, text in zip(groups, raw_texts(batch.column("text"))):
            words = terms(text)
            if not words:
                continue
            n, docs = tables.setdefault(group, (Counter(), Counter()))
            before = len(n)
            n.update(words)
            docs.update(set(words))
            entries += len(n) - before
            if entries > TABLE_ENTRIES:
                yield from flush()
                entries = 0
    yield from flush()


def _long(c: Column) -> Column:
    return c.cast("long")


def _wide(c: Column | str) -> Column:
    return F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")


def share(count: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(10^9 (count + 1) / (total + kept)); exact also where 10^9 count passes 63 bits."""
    up = (count.cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    under = F.greatest(total + kept, F.lit(1))
    return F.call_function("div", up, under.cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / q); shares are at most 10^9 + 1, so the square fits 63 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP, lang_col: str = "lang",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` (all ranks) and ``term`` (up to ``top``)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(docs[lang_col], F.lit("")).alias("lang"),
                       F.coalesce(docs[source_col], F.lit("")).alias("source"), docs[text_col].alias("text"))
    counts = staged(rows.mapInArrow(_count_task, "lang string, source string, term string, n long, docs long")
                    .groupBy("lang", "source", "term").agg(F.sum("n").alias("c"), F.sum("docs").alias("docs")), "counts")
    kept_terms = (counts.groupBy("lang", "term").agg(
        F.sum("c").alias("in_lang"), F.sum("docs").alias("docs"),
        F.sort_array(F.collect_list(F.struct("source", "c"))).alias("profile"))
        .filter(F.col("docs") >= min_docs).drop("docs"))
    kept = staged(kept_terms, "kept")

    # Counts of groups; a language's own are the sums of its terms.
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("n_lang"))
    entries = kept.select("lang", "term", "in_lang", F.explode("profile").alias("e")).select(
        "lang", "term", "in_lang", "e.source", "e.c")
    own = entries.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    sources = staged(rows.select("lang", "source").distinct().join(langs, "lang", "left")
                     .join(own, ["lang", "source"], "left").na.fill(0, ["v", "n_lang", "n"]), "sources")

    return _pairs(kept, entries, sources).unionByName(_terms(entries, sources, top))


def _terms(entries: DataFrame, sources: DataFrame, top: int) -> DataFrame:
    group = W.partitionBy("lang", "source")
    cells = (entries.groupBy("lang", "source", "c", "in_lang").agg(F.count(F.lit(1)).alias("times"))
             .join(sources, ["lang", "source"])
             .withColumns({"p": share(F.col("c"), F.col("n"), F.col("v")),
                           "q": share(F.col("in_lang"), F.col("n_lang"), F.col("v"))})
             .filter("p > q").withColumn("value", divergence(F.col("p"), F.col("q")))
             .select("lang", "source", "c", "in_lang", "times", "value"))
    cells = staged(cells, "cells")
    # Among merged values the first ``top`` hold the first ``top`` terms, as each has one at least.
    values = cells.groupBy("lang", "source", "value").agg(F.sum("times").alias("times"))
    best = (values.withColumn("place", F.row_number().over(group.orderBy(F.desc("value"))))
            .filter(F.col("place") <= top)
            .withColumn("before", F.sum("times").over(
                group.orderBy(F.desc("value")).rowsBetween(W.unboundedPreceding, -1)))
            .filter(F.coalesce("before", F.lit(0)) < top))
    chosen = cells.join(best.select("lang", "source", "value"), ["lang", "source", "value"]).drop("times")
    expanded = entries.join(chosen, ["lang", "source", "c", "in_lang"])
    ranked = expanded.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "term")))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(kept: DataFrame, entries: DataFrame, sources: DataFrame) -> DataFrame:
    profiles = kept.groupBy("lang", "profile").agg(F.count(F.lit(1)).alias("times"))
    met = (profiles.select("lang", "times", "profile", F.posexplode("profile").alias("i", "a"))
           .select("lang", "times", "a", F.explode(F.slice(F.col("profile"), F.col("i") + 2, F.size("profile"))).alias("b")))
    cells = met.groupBy("lang", F.col("a.source").alias("s"), F.col("b.source").alias("t"), F.col("a.c").alias("x"),
                        F.col("b.c").alias("y")).agg(F.sum("times").alias("times"))
    side = sources.select("lang", "source", "n", "v")

    def of(k: str) -> DataFrame:
        return side.select("lang", F.col("source").alias(k), F.col("n").alias(f"n_{k}"), F.col("v").alias(f"v_{k}"))

    def at(k: str, count: Column) -> Column:
        return share(count, F.col(f"n_{k}"), F.col(f"v_{k}"))

    zero = F.lit(0).cast("long")
    # Cells of both, for (s, t) and (t, s) at once.
    both = cells.join(of("s"), ["lang", "s"]).join(of("t"), ["lang", "t"]).withColumns(
        {"sx": at("s", F.col("x")), "s0": at("s", zero), "ty": at("t", F.col("y")), "t0": at("t", zero)})

    def mixed(px: str, p0: str, qy: str, q0: str) -> Column:
        f = divergence
        c = {k: F.col(k) for k in (px, p0, qy, q0)}
        return _wide(F.col("times")) * (_wide(f(c[px], c[qy])) - _wide(f(c[px], c[q0])) - _wide(f(c[p0], c[qy]))
                                        + _wide(f(c[p0], c[q0])))

    shared = both.groupBy("lang", "s", "t").agg(
        F.sum(mixed("sx", "s0", "ty", "t0")).alias("there"), F.sum(mixed("ty", "t0", "sx", "s0")).alias("back"))
    part_both = shared.select("lang", F.explode(F.array(
        F.struct(F.col("s").alias("source"), F.col("t").alias("item"), F.col("there").alias("d")),
        F.struct(F.col("t").alias("source"), F.col("s").alias("item"), F.col("back").alias("d")))).alias("e")).select(
        "lang", "e.*")

    # Numbers of terms by count in one source, against every other source of its language.
    alone = entries.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("times"))
    facing = of("s").join(of("t"), "lang").filter("s <> t").withColumns({"s0": at("s", zero), "t0": at("t", zero)})
    facing = staged(facing.withColumn("f00", divergence(F.col("s0"), F.col("t0"))), "facing")
    mine = alone.select("lang", F.col("source").alias("s"), "c", "times").join(facing, ["lang", "s"]).select(
        "lang", F.col("s").alias("source"), F.col("t").alias("item"),
        (_wide(F.col("times")) * (_wide(divergence(at("s", F.col("c")), F.col("t0"))) - _wide("f00"))).alias("d"))
    theirs = alone.select("lang", F.col("source").alias("t"), "c", "times").join(facing, ["lang", "t"]).select(
        "lang", F.col("s").alias("source"), F.col("t").alias("item"),
        (_wide(F.col("times")) * (_wide(divergence(F.col("s0"), at("t", F.col("c")))) - _wide("f00"))).alias("d"))
    none = facing.select("lang", F.col("s").alias("source"), F.col("t").alias("item"),
                         (_wide(F.col("v_s")) * _wide("f00")).alias("d"))

    parts = [x.withColumn("d", _wide("d")) for x in (part_both, mine, theirs, none)]
    total = (parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
             .groupBy("lang", "source", "item").agg(F.sum("d").alias("value")))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return total.select("lang", "source", F.lit("pair").alias("part"), "item", _long(F.col("value")).alias("value"),
                        F.row_number().over(order).alias("rank"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM w GROUP BY ALL HAVING count(DISTINCT row) >= 3
), size AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM d
), held AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w GROUP BY ALL
), cell AS (
  SELECT g.lang, g.source, k.term, coalesce(h.c, 0)::HUGEINT AS c, k.c AS in_lang
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), total AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM cell GROUP BY ALL
), p AS (
  SELECT cell.lang, cell.source, term, cell.c, 1 + (1000000000::HUGEINT * (cell.c + 1)) // (total.n + size.v) AS p,
    1 + (1000000000::HUGEINT * (in_lang + 1)) // (size.n + size.v) AS q
  FROM cell JOIN total ON total.lang = cell.lang AND total.source = cell.source JOIN size ON size.lang = cell.lang
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM size)
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 200
"""
