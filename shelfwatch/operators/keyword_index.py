"""A trigram index for the keyword search.

``build`` writes one row for each (trigram, field, product) of the lower-cased title and upc,
dealt by range of the trigram and sorted, so that a look-up prunes files and row groups by
their statistics. A search takes the trigrams that every match must contain, intersects their
postings to candidate products, and applies the exact predicate to those alone.

``required`` reads them off a literal, or off the parts of a Java regex that every match must
hold: literal characters outside of groups, classes and alternatives, that no quantifier makes
optional. A keyword without such a run of three falls back to the scan, so results never differ.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators.search import SearchSpec, search_catalog

FIELDS = ("title", "upc")
N = 3
#: Trigrams to intersect at most; more would prune little and cost a look-up each.
MOST = 8


def build(catalog: DataFrame, path: str) -> None:
    """Write the postings of ``catalog`` (upc, title) to ``path``."""
    parts = None
    for field in FIELDS:
        text = F.lower(F.col(field))
        # every product has each trigram of a field once
        grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_t") - (N - 1)), lambda i: F.substring("_t", i, N)))
        rows = catalog.select("upc", text.alias("_t")).where(F.length("_t") >= N).select(
            F.explode(grams).alias("trigram"), F.lit(field).alias("field"), "upc")
        parts = rows if parts is None else parts.unionByName(rows)
    (parts.repartitionByRange("trigram", "upc").sortWithinPartitions("trigram", "field", "upc")
     .write.mode("overwrite").parquet(path))


def _runs(regex: str) -> list[str]:
    """Literal runs that every match of a regex holds; [] where the syntax is beyond this reader."""
    runs, run, depth, i = [], "", 0, 0

    def close() -> None:
        nonlocal run
        if run:
            runs.append(run)
        run = ""

    while i < len(regex):
        c = regex[i]
        if c == "|" and depth == 0:
            return []
        if c == "\\":
            if i + 1 >= len(regex) or regex[i + 1] in "QEcxu0pPkN" or regex[i + 1].isdigit():
                return []                              # quotations, code points and references aren't read
            literal, size = (None if regex[i + 1].isalnum() else regex[i + 1]), 2
        elif c == "[":
            size, nested = 1, 1
            while i + size < len(regex) and nested:
                nested += {"[": 1, "]": -1}.get(regex[i + size], 0)
                size += 2 if regex[i + size] == "\\" else 1
            literal = None
        elif c in "()":
            if regex[i:i + 2] == "(?":
                return []                              # flags and look-around
            depth += 1 if c == "(" else -1
            literal, size = None, 1
        else:
            literal, size = (None if c in ".^$" else c), 1
        after = regex[i + size:i + size + 1]
        if after in ("?", "*", "{"):                   # the character may be missing
            literal = None
        if literal is None or depth or not literal.isascii():
            close()
        else:
            run += literal
            if after == "+":
                close()
        i += size
        while regex[i:i + 1] and regex[i] in "?*+":
            i += 1
        if regex[i:i + 1] == "{":
            end = regex.find("}", i)
            if end < 0:
                return []
            i = end + 1
    close()
    return runs


def required(keyword: str, regex: bool = True) -> list[str]:
    """Trigrams that every text matching ``keyword`` contains, lower-cased; the first ``MOST``."""
    runs = _runs(keyword) if regex else [keyword]
    out = dict.fromkeys(r.lower()[k:k + N] for r in runs for k in range(len(r.lower()) - N + 1))
    return list(out)[:MOST]


def candidates(spark: SparkSession, path: str, trigrams: list[str]) -> DataFrame:
    """Products one of whose fields has all of ``trigrams``."""
    rows = spark.read.schema("trigram string, field string, upc string").parquet(path).where(F.col("trigram").isin(trigrams))
    return (rows.groupBy("upc", "field").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(trigrams))
            .select("upc").distinct())


def search(snapshot: DataFrame, spec: SearchSpec, path: str) -> DataFrame:
    """``search_catalog`` by way of the index at ``path``; the same rows."""
    trigrams = required(spec.keyword, spec.keyword_regex) if spec.keyword and spec.title is None else []
    if not trigrams:
        return search_catalog(snapshot, spec)
    few = candidates(snapshot.sparkSession, path, trigrams)
    return search_catalog(snapshot.join(few, "upc", "left_semi"), replace(spec))
