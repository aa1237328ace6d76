"""End to end: HTML pages -> load (two runs) -> statistics and change reports, via the CLI
functions (the same path as ``python -m shelfwatch``)."""

import glob

import pytest

from shelfwatch.__main__ import analyze, compare, export, ingest_csv, ingest_pages, main
from shelfwatch.sinks.ledger import Ledger, open_store

BASE = "https://books.toscrape.com/catalogue/"


def _listing(prices):
    cards = "".join(
        f'<article class="product_pod"><h3><a href="book-{i}_{i}/index.html" title="Book {i}">'
        f'B</a></h3><p class="star-rating {w}"></p><p class="price_color">£{p}</p></article>'
        for i, (p, w) in enumerate(prices))
    return f"<html><body>{cards}</body></html>"


def _detail(i, stock):
    return (f"<html><body><ul class='breadcrumb'><li>Home</li><li>Books</li><li>Cat{i % 2}</li>"
            f"<li>Book {i}</li></ul><table class='table table-striped'><tr><th>UPC</th>"
            f"<td>upc{i}</td></tr><tr><th>Availability</th><td>In stock ({stock} available)"
            f"</td></tr></table></body></html>")


def _write_pages(spark, root, tag, prices):
    listing = spark.createDataFrame([(1, "https://books.toscrape.com/", _listing(prices))],
                                    "page_id long, url string, html string")
    detail = spark.createDataFrame(
        [(10 + i, f"{BASE}book-{i}_{i}/index.html", _detail(i, 5 + i)) for i in range(len(prices))],
        "page_id long, url string, html string")
    listing.write.parquet(f"{root}/{tag}/listing")
    detail.write.parquet(f"{root}/{tag}/detail")
    return f"{root}/{tag}/listing", f"{root}/{tag}/detail"


def _text(path):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))


@pytest.mark.parametrize("ledger", [False, True])
def test_pages_to_reports(spark, tmp_root, ledger):
    wh = f"{tmp_root}/wh"
    day1 = _write_pages(spark, tmp_root, "d1", [("51.77", "Three"), ("13.99", "One"),
                                                ("53.74", "Five")])
    day2 = _write_pages(spark, tmp_root, "d2", [("45.99", "Three"), ("13.99", "One"),
                                                ("56.24", "Five")])
    ingest_pages(spark, wh, *day1, run_date="2026-06-05", ledger=ledger)
    info = ingest_pages(spark, wh, *day2, run_date="2026-06-06")
    assert info["rejected_listings"] == 0
    assert analyze(spark, wh, f"{tmp_root}/analysis") == "Parquet warehouse"
    stats = _text(f"{tmp_root}/analysis")
    assert "Total books in dataset: 3" in stats
    assert "Most expensive: Book 2 (56.24)" in stats
    assert "  1   |    1  " in stats and "  5   |    1  " in stats
    compare(spark, wh, f"{tmp_root}/changes")
    report = _text(f"{tmp_root}/changes")
    assert "Comparing date: 2026-06-05  -->  2026-06-06" in report
    assert "  Old Price: £51.77  |  New Price: £45.99  |  Change: £-5.78 (-11.16%)" in report
    assert "  Old Price: £53.74  |  New Price: £56.24  |  Change: +£2.50 (+4.65%)" in report
    assert "  Total Changes   : 2" in report
    export(spark, wh, f"{tmp_root}/export")
    assert len(_text(f"{tmp_root}/export/history").strip().split("\n")) == 7   # header + 6
    assert isinstance(open_store(spark, wh), Ledger) == ledger                 # the second load found the ledger


def test_fallback_label(spark, tmp_root):
    from shelfwatch.schemas import CSV_HEADER
    csv = f"{tmp_root}/books.csv"
    with open(csv, "w", encoding="utf-8") as f:
        f.write(",".join(CSV_HEADER) + "\n")
        f.write("A,10.00,Two,https://x/a,2026-06-05,u1,Poetry,3\n")
    label = analyze(spark, f"{tmp_root}/no-warehouse", f"{tmp_root}/out", csv_fallback=csv)
    assert label.startswith("CSV Snapshot Backup")
    assert "Data Source : CSV Snapshot Backup" in _text(f"{tmp_root}/out")
    assert main(["analyze", "--warehouse", f"{tmp_root}/none", "--out", f"{tmp_root}/o2",
                 "--csv-fallback", csv]) == 0


def test_broken_pages_and_lines_are_kept_and_counted(spark, tmp_root):
    from shelfwatch.schemas import CSV_HEADER
    wh = f"{tmp_root}/wh"
    listing, detail = _write_pages(spark, tmp_root, "d1", [("51.77", "Three"), ("13.99", "One")])
    broken = _listing([("9.99", "One")]) + "<![broken["
    for path, row in ((listing, (2, "l2", broken)), (detail, (20, f"{BASE}book-9_9/index.html", broken))):
        spark.createDataFrame([row], "page_id long, url string, html string").write.mode("append").parquet(path)
    info = ingest_pages(spark, wh, listing, detail, run_date="2026-06-05")
    assert (info["rejected_listings"], info["rejected_pages"]) == (0, 2)
    got = spark.read.parquet(f"{wh}/rejected_pages").collect()
    assert sorted((r.kind, r.page_id, r.parse_error.split(":")[0]) for r in got) == [
        ("detail", 20, "AssertionError"), ("listing", 2, "AssertionError")]

    csv = f"{tmp_root}/books.csv"
    with open(csv, "w", encoding="utf-8") as f:
        f.write(",".join(CSV_HEADER) + "\nA,10.00,Two,https://x/a,2026-06-05,u1,Poetry,3\nonly,three,fields\n"
                + 'B,10.00,Two,https://x/b,2026-06-05,u2,"Poe\ntry",3\n')
    info = ingest_csv(spark, f"{tmp_root}/wh2", csv)
    assert info["rejected_lines"] == 3
    lines = ['B,10.00,Two,https://x/b,2026-06-05,u2,"Poe', "only,three,fields", 'try",3']
    assert sorted(r.corrupt_record for r in spark.read.parquet(f"{tmp_root}/wh2/rejected_lines").collect()) == lines
    label = analyze(spark, f"{tmp_root}/none", f"{tmp_root}/a", csv_fallback=csv)
    assert label.endswith(", 3 lines rejected") and label in _text(f"{tmp_root}/a")
    label = compare(spark, f"{tmp_root}/none", f"{tmp_root}/c", log_fallback=csv)
    assert label.endswith(", 3 lines rejected") and label in _text(f"{tmp_root}/c")
    for out in ("a", "c"):
        assert spark.read.parquet(f"{tmp_root}/{out}_rejected_lines").count() == 3
