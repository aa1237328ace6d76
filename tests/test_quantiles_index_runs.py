"""Exact quantiles in passes, the keyword index, and the incremental log."""

import datetime as dt
import math
import random
import re
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import keyword_index as K
from shelfwatch.operators import quantiles as Q
from shelfwatch.operators import search as SR
from shelfwatch.schemas import WIDE
from shelfwatch.sinks import log_runs
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.sources.tables import read_history_csv


# ---------------------------------------------------------------- quantiles
def _numbers(kind):
    r = random.Random(kind)
    if kind == "distinct":
        return [r.lognormvariate(0, 20) * r.choice([-1, 1]) for _ in range(20_000)]
    if kind == "ties":
        return [r.choice([1.5, 2.5]) for _ in range(9_999)] + [1.5] * (10_000 - 9_999 % 2)
    if kind == "half":
        return [0.0] * 5_000 + [1.0] * 5_000                           # the median lies between two huge ties
    if kind == "tiny":
        return [3.0, 1.0]
    return [math.inf, -math.inf, 5.0, -0.0, 0.0, 1e-320, -1e308] * 50


@pytest.mark.parametrize("kind", ["distinct", "ties", "half", "tiny", "extreme"])
def test_quantiles_against_sorted_values(spark, kind):
    values = _numbers(kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "x double").repartition(5)
    n = len(values)
    ranks = sorted({0, n // 4, n // 2, n // 2 - 1, (3 * n) // 4, n - 1})
    got = Q.order_statistics(df, "x", ranks, n, accuracy=50, at_hand=40)
    want = sorted(values)
    assert [got[r] for r in ranks] == [want[r] for r in ranks]
    if kind != "extreme":
        fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
        got = Q.quantiles(df, "x", fractions, accuracy=50, at_hand=40)
        assert np.allclose(got, np.quantile(values, fractions), rtol=1e-12)


def test_quantiles_of_nothing_and_of_nan(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert Q.quantiles(empty, "x", [0.5]) == [None]
    row = Q.describe(empty, "x").first()
    assert row["count"] == 0 and row["p50"] is None
    df = spark.createDataFrame([(float("nan"),)] * 60 + [(1.0,)] * 60, "x double")
    got = Q.order_statistics(df, "x", [0, 59, 60, 119], 120, accuracy=10, at_hand=5)
    assert got[0] == got[59] == 1.0 and math.isnan(got[60]) and math.isnan(got[119])


# ---------------------------------------------------------------- keyword index
TITLES = ["The Art of War", "Hot Plum Dress", "HOT tub", "shot put", "plum hot", "a+b (c)", None, "", "ho", "naïve café",
          "x" * 300, "lavender hot-house", "h o t", "Kelvin K", "İstanbul hot"]
KEYWORDS = ["hot", "HOT", "^hot", "hot|war", "h.t", "plum hot$", "hot+", "hott?", "(hot)", "(plum )?hot", "[hp]lum", "a\\+b", "p{1}lum",
            "plu{0,2}m", "\\bhot\\b", "na.ve caf", "u1", "xxxx", "ab", "", "the.*war", "dress\\s*", "hot-house", "kelvin k", "(?i)hot", "\\Qhot"]


@pytest.mark.parametrize("regex", [True, False])
def test_index_gives_what_the_scan_gives(spark, tmp_root, regex):
    snap = spark.createDataFrame([(f"U{k}", t, "c", Decimal("1.00"), "Two", 1, "l") for k, t in enumerate(TITLES)],
                                 "upc string, title string, category string, price decimal(10,2), rating string, "
                                 "stock_quantity int, product_url string")
    K.build(snap, f"{tmp_root}/index")
    for keyword in KEYWORDS:
        if regex and keyword == "\\Qhot":
            assert K.required(keyword) == []
        spec = SR.SearchSpec(keyword=keyword, keyword_regex=regex)
        want = sorted(r.upc for r in SR.search_catalog(snap, spec).collect())
        assert sorted(r.upc for r in K.search(snap, spec, f"{tmp_root}/index").collect()) == want, keyword


def test_required_trigrams_are_in_every_match():
    assert K.required("hot") == ["hot"] and K.required("ab") == [] and K.required("hot|war") == []
    assert K.required("(plum )?hotel") == ["hot", "ote", "tel"] and K.required("hots?") == ["hot"]
    assert K.required("[abc]lum.press") == ["lum", "pre", "res", "ess"] and K.required("a{2}bcd") == ["bcd"]
    r = random.Random(2)
    for _ in range(3000):
        parts = [r.choice(["a", "b", "c", "ab", "abc", "b+", "c?", "a*", "[ab]", ".", "(bc)", "(ab)?", "\\.", "a{2}", "b{0,1}"])
                 for _ in range(r.randrange(1, 6))]
        keyword = "".join(parts)
        need = K.required(keyword)
        text = "".join(r.choice("abc.") for _ in range(12))
        if need and re.search("(?i)" + keyword, text):
            assert all(t in text for t in need), (keyword, text, need)


def test_index_reads_postings_by_value(spark, tmp_root):
    snap = spark.range(500).select(F.col("id").cast("string").alias("upc"), F.concat(F.lit("title "), "id").alias("title"))
    K.build(snap, f"{tmp_root}/index")
    plan = K.candidates(spark, f"{tmp_root}/index", ["tle", "e 4"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trigram, [e 4,tle])]" in plan or "In(trigram" in plan
    assert K.candidates(spark, f"{tmp_root}/index", ["tle", "e 4"]).count() == 111


# ---------------------------------------------------------------- log runs
D = [dt.date(2026, 6, k) for k in range(1, 5)]


def _batch(spark, items):
    return spark.createDataFrame([(t, Decimal(p), "Two", "u", d, "x", "c", 1) for t, d, p in items], WIDE).coalesce(1)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_log_runs_equal_the_whole_log(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    runs = log_runs.LogRuns(spark, wh.log_path, f"{tmp_root}/runs")
    assert runs.compact()["version"] == 0 and runs.read().count() == 0
    r = random.Random(3)
    for n in range(6):
        items = [(r.choice("abcdef"), r.choice([*D[:2 + n // 2], None]), f"{r.randrange(90)}.00") for _ in range(8)]
        wh.append_log(_batch(spark, items), n)
        assert _rows(runs.read()) == _rows(read_history_csv(spark, wh.log_path, with_order=False))
        if n % 2:
            done = runs.compact()
            assert runs.pending() == [] and len(done["files"]) == n + 1
            assert _rows(runs.read()) == _rows(read_history_csv(spark, wh.log_path, with_order=False))
            assert "Aggregate" not in runs.read()._jdf.queryExecution().executedPlan().toString()


def test_log_runs_touch_only_dates_above_the_watermark(spark, tmp_root, monkeypatch):
    wh = Warehouse(spark, tmp_root)
    runs = log_runs.LogRuns(spark, wh.log_path, f"{tmp_root}/runs")
    wh.append_log(_batch(spark, [("a", D[0], "1.00"), ("b", D[1], "1.00")]), 1)
    first = runs.compact()
    wh.append_log(_batch(spark, [("b", D[1], "2.00")]), 2)
    read = []
    real = log_runs.LogRuns._new
    monkeypatch.setattr(log_runs.LogRuns, "_new", lambda self, names: read.append(names) or real(self, names))
    assert {(x.title, x.price) for x in runs.read().collect()} == {("a", Decimal("1.00")), ("b", Decimal("2.00"))}
    assert len(read) == 1 and len(read[0]) == 1                        # one file of the two
    second = runs.compact()
    assert second["days"][str(D[0])] == first["days"][str(D[0])] and second["days"][str(D[1])] != first["days"][str(D[1])]
    # a compaction that breaks off leaves the log as it was
    wh.append_log(_batch(spark, [("c", D[2], "3.00")]), 3)
    monkeypatch.setattr(log_runs.CommitLog, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        runs.compact()
    assert runs.state() == second and runs.read().count() == 3


def test_log_runs_of_plain_files_without_ids(spark, tmp_root):
    import os
    import time
    os.makedirs(f"{tmp_root}/log")
    head = "Title,Price,Rating,URL,Date_Collected,UPC,Category,Stock_Quantity\n"
    runs = log_runs.LogRuns(spark, f"{tmp_root}/log", f"{tmp_root}/runs")
    for n, price in enumerate(["1.00", "2.00", "3.00"]):
        with open(f"{tmp_root}/log/{9 - n}.csv", "w") as f:
            f.write(head + f"a,{price},Two,u,2026-06-01,x,c,1\na,{price[0]}.50,Two,u,2026-06-01,x,c,1\n")
        os.utime(f"{tmp_root}/log/{9 - n}.csv", (time.time() + n, time.time() + n))
        assert [str(x.price) for x in runs.read().collect()] == [f"{n + 1}.50"]
        runs.compact()
        assert [str(x.price) for x in runs.read().collect()] == [f"{n + 1}.50"]
