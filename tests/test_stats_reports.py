import datetime as dt
from decimal import Decimal

import pandas as pd

from shelfwatch.operators import stats as ST
from shelfwatch.operators.dedup import dedup_keep_first, dedup_keep_last
from shelfwatch.plans import reports as R

D = dt.date(2026, 6, 6)
SCHEMA = ("title string, price decimal(10,2), rating string, product_url string, "
          "date_collected date, upc string, category string, stock_quantity int, "
          "ingest_seq long")


def _snap(spark, prices, ratings, titles=None):
    titles = titles or [f"T{i}" for i in range(len(prices))]
    rows = [(t, Decimal(p), r, f"u/{i}", D, f"u{i}", "c", 1, i)
            for i, (t, p, r) in enumerate(zip(titles, prices, ratings))]
    return spark.createDataFrame(rows, SCHEMA)


def test_statistics_report_matches_pandas(spark):
    prices = ["51.77", "53.74", "50.10", "47.82", "54.23", "22.65", "33.34", "17.93",
              "22.60", "52.15", "13.99", "20.66", "10.00", "59.99"]
    ratings = ["Three", "One", "One", "Four", "Five", "One", "Four", "Three", "Four", "One",
               "Two", "Four", "5", "N/A"]
    titles = [f"Book {i}" for i in range(len(prices))]
    snap = _snap(spark, prices, ratings, titles)
    lines = [r.line for r in R.ordered(R.statistics_report(snap, "CSV Snapshot Backup")).collect()]
    s = pd.Series([float(p) for p in prices], name="Price")
    word = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
    stars = pd.Series(ratings).map(word).fillna(pd.to_numeric(pd.Series(ratings),
                                                              errors="coerce")).fillna(0)
    counts = stars.astype(int).value_counts().sort_index()
    expected = ["=" * 50, "       BOOKS.TOSCRAPE.COM - DATA ANALYSIS", "=" * 50,
                "Data Source : CSV Snapshot Backup", f"Total books in dataset: {len(s)}",
                "", "--- Price Statistics ---", f"Average price: {round(s.mean(), 2)}",
                f"Highest price: {s.max()}", f"Lowest price:  {s.min()}", "",
                f"Most expensive: {titles[s.idxmax()]} ({s.max()})",
                f"Cheapest:       {titles[s.idxmin()]} ({s.min()})", "",
                "--- Rating Distribution ---", "Stars | Count", "-" * 20]
    expected += [f"  {k}   |  {v:>3}  {'*' * int(v / 10)}" for k, v in counts.items()]
    expected += ["", "--- Full Price Summary (.describe()) ---"]
    expected += str(s.describe()).split("\n")
    expected += ["", "=" * 50, "Analysis complete."]
    assert lines == expected


def test_price_ties_first_row_wins(spark):
    snap = _snap(spark, ["9.00", "9.00", "1.00", "1.00"], ["One"] * 4,
                 ["first dear", "second dear", "first cheap", "second cheap"])
    r = ST.extremes(snap).first()
    assert (r.most_expensive_title, r.cheapest_title) == ("first dear", "first cheap")
    rev = snap.selectExpr("*").withColumn("ingest_seq", -snap["ingest_seq"])
    r2 = ST.extremes(rev).first()
    assert (r2.most_expensive_title, r2.cheapest_title) == ("second dear", "second cheap")


def test_describe_quartiles_interpolate(spark):
    snap = _snap(spark, ["1.00", "2.00", "3.00", "4.00"], ["One"] * 4)
    d = ST.describe_price(snap).first()
    s = pd.Series([1.0, 2.0, 3.0, 4.0]).describe()
    assert (d["count"], d.mean, d.p25, d.p50, d.p75) == (4, s["mean"], s["25%"], s["50%"],
                                                          s["75%"])
    assert abs(d.std - s["std"]) < 1e-5


def test_same_day_rerun_keeps_later_row(spark):
    rows = [("A", Decimal("10.00"), "One", "u", D, "1", "c", 1, 5),
            ("A", Decimal("12.00"), "One", "u", D, "1", "c", 1, 9),
            ("A", Decimal("11.00"), "One", "u", D, "1", "c", 1, 7),
            (None, Decimal("1.00"), "One", None, D, "2", "c", 1, 1),
            (None, Decimal("2.00"), "One", None, D, "2", "c", 1, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    last = {r.upc: r.price for r in
            dedup_keep_last(df, ["title", "product_url", "date_collected"]).collect()}
    first = {r.upc: r.price for r in
             dedup_keep_first(df, ["title", "product_url", "date_collected"]).collect()}
    assert last == {"1": Decimal("12.00"), "2": Decimal("2.00")}   # NULL keys group together
    assert first == {"1": Decimal("10.00"), "2": Decimal("1.00")}
    assert dedup_keep_last(df, ["title", "product_url", "date_collected"]).columns == df.columns
