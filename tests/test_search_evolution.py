import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from shelfwatch.operators import evolution as EV
from shelfwatch.operators import search as SR

D1, D2, D3 = dt.date(2026, 6, 4), dt.date(2026, 6, 5), dt.date(2026, 6, 6)
SNAP = ("upc string, title string, category string, price decimal(10,2), rating string, "
        "stock_quantity int, product_url string")


def _snap(spark):
    rows = [("a1", "Art of War", "History", Decimal("12.00"), "Five", 2, "u1"),
            ("b2", "Love Poems", "Poetry", Decimal("55.00"), "Three", 0, "u2"),
            ("c3", "History of Art", "Art", Decimal("20.00"), "One", 3, "u3"),
            ("d4", None, "Art", Decimal("30.00"), "N/A", 5, "u4"),
            ("ART9", "Zen", None, Decimal("50.00"), "4", 1, "u5")]
    return spark.createDataFrame(rows, SNAP)


def ids(df):
    return sorted(r.upc for r in df.collect())


def test_presets(spark):
    s = _snap(spark)
    p = SR.presets()
    assert ids(SR.search_catalog(s, p["all"])) == ["ART9", "a1", "b2", "c3"]   # rating 0 out
    assert ids(SR.search_catalog(s, p["five_star"])) == ["a1"]
    assert ids(SR.search_catalog(s, p["bargain"])) == ["a1", "c3"]            # <= 20 inclusive
    assert ids(SR.search_catalog(s, p["low_stock"])) == ["ART9", "a1", "c3"]
    assert ids(SR.search_catalog(s, p["premium"])) == ["ART9", "b2"]


def test_keyword_category_title(spark):
    s = _snap(spark)
    assert ids(SR.search_catalog(s, SR.SearchSpec(keyword="art"))) == ["ART9", "a1", "c3"]
    assert ids(SR.search_catalog(s, SR.SearchSpec(keyword="^art"))) == ["ART9", "a1"]
    assert ids(SR.search_catalog(s, SR.SearchSpec(keyword="(", keyword_regex=False))) == []
    assert ids(SR.search_catalog(s, SR.SearchSpec(category="Art"))) == ["c3"]
    assert ids(SR.search_catalog(s, SR.SearchSpec(ratings=()))) == []
    # an exact title bypasses every other criterion
    spec = SR.SearchSpec(title="Love Poems", ratings=(), category="Art", price_max=1.0)
    assert ids(SR.search_catalog(s, spec)) == ["b2"]
    spec = SR.SearchSpec(in_stock_only=True, price_min=15.0, price_max=50.0)
    assert ids(SR.search_catalog(s, spec)) == ["ART9", "c3"]


def test_scd2_and_incremental_apply(spark):
    obs = spark.createDataFrame(
        [("u1", "A", "x", "l", D1), ("u1", "A", "x", "l", D2), ("u1", "A", "y", "l", D3),
         ("u2", "B", "x", "m", D2)],
        "upc string, title string, category string, product_url string, date_collected date")
    v = sorted((r.upc, r.category, r.valid_from, r.valid_to, r.is_current)
               for r in EV.scd2(obs).collect())
    assert v == [("u1", "x", D1, D3, False), ("u1", "y", D3, None, True),
                 ("u2", "x", D2, None, True)]
    early = EV.scd2(obs.where("date_collected < DATE'2026-06-06'"))
    applied = EV.scd2_apply(early, obs.where("date_collected = DATE'2026-06-06'"))
    v2 = sorted((r.upc, r.category, r.valid_from, r.valid_to, r.is_current)
                for r in applied.collect())
    assert v2 == v


def test_merge_facts_updates_price_and_stock_only(spark):
    ex = spark.createDataFrame([("u1", Decimal("1.00"), "One", 5, D1),
                                ("u2", Decimal("2.00"), "Two", 6, D1)],
                               "upc string, price decimal(10,2), rating string, "
                               "stock_quantity int, date_collected date")
    new = spark.createDataFrame([("u1", Decimal("1.50"), "Five", 4, D1),
                                 ("u3", Decimal("3.00"), "Three", 7, D1)], ex.schema)
    got = sorted(tuple(r) for r in EV.merge_facts(ex, new).collect())
    assert got == [("u1", Decimal("1.50"), "One", 4, D1), ("u2", Decimal("2.00"), "Two", 6, D1),
                   ("u3", Decimal("3.00"), "Three", 7, D1)]


def test_schema_evolution(spark):
    old = spark.createDataFrame([("u1", Decimal("1.00"))], "upc string, price decimal(10,2)")
    new = spark.createDataFrame([("u2", Decimal("2.00"), "Poetry")],
                                "upc string, price decimal(10,2), category string")
    both = EV.union_evolving(old, new)
    assert sorted((r.upc, r.category) for r in both.collect()) == [("u1", None),
                                                                   ("u2", "Poetry")]
    target = T.StructType([T.StructField("upc", T.StringType()),
                           T.StructField("category", T.StringType()),
                           T.StructField("price", T.DecimalType(10, 2))])
    aligned = EV.align_schema(old, target)
    assert aligned.columns == ["upc", "category", "price"]


def _history(rows):
    """SCD2 over (upc, title, date) rows in plain Python: (upc, title, from, to)."""
    out = []
    for upc in {r[0] for r in rows}:
        seen = sorted({r[2]: r[1] for r in rows if r[0] == upc}.items())
        starts = [(d, t) for i, (d, t) in enumerate(seen) if i == 0 or seen[i - 1][1] != t]
        out += [(upc, t, d, starts[i + 1][0] if i + 1 < len(starts) else None) for i, (d, t) in enumerate(starts)]
    return sorted(out, key=str)


def test_scd2_merge_in_every_order_of_batches(spark):
    d = [dt.date(2026, 6, k) for k in range(1, 8)]
    batches = [[("u1", "One", d[0]), ("u2", "x", d[3]), (None, "n", d[2])],
               [("u1", "Two", d[5]), ("u2", "y", d[1]), ("u2", "x", d[6])],
               [("u1", "Five", d[2]), ("u1", "One", d[1]), ("u3", None, d[0]), (None, "m", d[4])],
               [("u1", "One", d[3]), ("u2", None, d[2]), ("u3", None, d[4]), (None, "n", d[5])]]
    schema = "upc string, title string, date_collected date"
    want = _history([r for b in batches for r in b])
    frames = [spark.createDataFrame(b, schema) for b in batches]

    def rows(table):
        got = table.collect()
        assert all(r.is_current == (r.valid_to is None) and r.observed[0] == r.valid_from for r in got)
        return sorted(((r.upc, r.title, r.valid_from, r.valid_to) for r in got), key=str)

    whole = EV.scd2(frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3]),
                    attrs=["title"], keep_dates=True)
    assert rows(whole) == want
    for order in itertools.permutations(range(4)):
        table = None
        for n in order:
            table = EV.scd2_merge(table, frames[n], attrs=["title"])
        if order in ((0, 1, 2, 3), (3, 2, 1, 0), (1, 0, 3, 2), (2, 3, 0, 1), (1, 2, 0, 3)):
            assert rows(table) == want, order


def test_scd2_merge_corrects_and_repeats(spark):
    d = [dt.date(2026, 6, k) for k in range(1, 6)]
    schema = "upc string, title string, date_collected date, ingest_seq long"
    base = EV.scd2(spark.createDataFrame([("u", "a", x, 0) for x in d], schema), attrs=["title"], keep_dates=True)
    fix = spark.createDataFrame([("u", "z", d[2], 1), ("u", "b", d[2], 2)], schema)      # the last by ingest_seq
    once = EV.scd2_merge(base, fix, attrs=["title"])
    twice = EV.scd2_merge(once, fix, attrs=["title"])
    want = [("u", "a", d[0], d[2]), ("u", "b", d[2], d[3]), ("u", "a", d[3], None)]
    for table in (once, twice):
        assert sorted([(r.upc, r.title, r.valid_from, r.valid_to) for r in table.collect()], key=lambda r: r[2]) == want
    back = EV.scd2_merge(once, spark.createDataFrame([("u", "a", d[2], 3)], schema), attrs=["title"])
    assert [(r.valid_from, r.valid_to, len(r.observed)) for r in back.collect()] == [(d[0], None, 5)]
    assert EV.scd2_merge(once, fix.limit(0), attrs=["title"]).count() == 3


def test_scd2_apply_refuses_a_late_batch(spark):
    obs = spark.createDataFrame([("u", "One", "c", "l", D1), ("u", "Two", "c", "l", D3)],
                                "upc string, title string, category string, product_url string, date_collected date")
    late = spark.createDataFrame([("u", "Five", "c", "l", D2)], obs.schema)
    with pytest.raises(Exception, match="late batch"):
        EV.scd2_apply(EV.scd2(obs), late).collect()
