"""The CSV dialect against pandas, both ways."""
import datetime as dt
import glob
import os
from decimal import Decimal

import pandas as pd

from shelfwatch.schemas import CSV_HEADER, WIDE
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.sources.tables import csv_rejects, read_history_csv, read_snapshot_csv

D = dt.date(2026, 6, 5)
TITLES = ['He said "hi", twice', "  pad ", "", None, "a,b", '"', "back\\slash", "tab\there", "'single'", "ü £"]


def test_pandas_files_are_read_as_written(spark, tmp_root):
    path = f"{tmp_root}/books.csv"
    pd.DataFrame([[t, "1.50", "Two", f"https://x/{i}", "2026-06-05", f"u{i}", "Poetry", 3]
                  for i, t in enumerate(TITLES)], columns=CSV_HEADER).to_csv(path, index=False)
    got = {r.upc: r for r in read_snapshot_csv(spark, path).collect()}
    assert len(got) == len(TITLES)
    for i, t in enumerate(TITLES):
        assert got[f"u{i}"].title == (t or None)       # pandas writes both as nothing
        assert (got[f"u{i}"].price, got[f"u{i}"].product_url) == (Decimal("1.50"), f"https://x/{i}")
    assert csv_rejects(spark, path).count() == 0


def test_line_breaks_of_foreign_files_and_corrupt_lines(spark, tmp_root):
    path = f"{tmp_root}/books.csv"
    pd.DataFrame([["two\nlines", "1.50", "Two", "u", "2026-06-05", "u1", "Poetry", 3]],
                 columns=CSV_HEADER).to_csv(path, index=False)
    assert read_snapshot_csv(spark, path, multi_line=True).first().title == "two\nlines"
    bad = f"{tmp_root}/bad.csv"
    with open(bad, "w", encoding="utf-8") as f:
        f.write(",".join(CSV_HEADER) + "\nA,1.00,One,u,2026-06-05,u1,Poetry,3\nonly,three,fields\n"
                + "B,1.00,One,u,2026-06-05,u2,Poetry,3,surplus\n")
    assert [r.upc for r in read_snapshot_csv(spark, bad).collect()] == ["u1"]
    assert sorted(r.corrupt_record for r in csv_rejects(spark, bad).collect()) == [
        "B,1.00,One,u,2026-06-05,u2,Poetry,3,surplus", "only,three,fields"]


def test_our_files_are_read_by_pandas_as_written(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    rows = [(t, Decimal("1.50"), "Two", f"https://x/{i}", D, f"u{i}", "Poetry", 3) for i, t in enumerate(TITLES)]
    wh.write_snapshot(spark.createDataFrame(rows, WIDE))
    files = [f for f in glob.glob(f"{wh.snapshot_path}/part-*.csv") if os.path.getsize(f)]
    got = pd.concat([pd.read_csv(f, dtype=str, keep_default_na=False) for f in files]).set_index("UPC")
    for i, t in enumerate(TITLES):
        assert got.loc[f"u{i}", "Title"] == (t or "")
    back = {r.upc: r.title for r in read_snapshot_csv(spark, wh.snapshot_path).collect()}
    assert back == {f"u{i}": t for i, t in enumerate(TITLES)}


def test_plain_logs_over_several_files_follow_their_times(spark, tmp_root):
    os.makedirs(f"{tmp_root}/log")
    for name, when, price in (("b.csv", 1_000, "1.00"), ("a.csv", 2_000, "2.00"), ("c.csv", 1_500, "3.00")):
        path = f"{tmp_root}/log/{name}"
        pd.DataFrame([["A", price, "One", "u", "2026-06-05", "u1", "Poetry", 3]], columns=CSV_HEADER).to_csv(path, index=False)
        os.utime(path, (1_780_000_000 + when, 1_780_000_000 + when))
    assert [r.price for r in read_history_csv(spark, f"{tmp_root}/log").collect()] == [Decimal("2.00")]
