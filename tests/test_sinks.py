import datetime as dt
import glob
import os
from decimal import Decimal

from shelfwatch.operators import changes as C
from shelfwatch.plans import reports as R
from shelfwatch.schemas import WIDE
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.sources.tables import read_snapshot_csv

D1, D2 = dt.date(2026, 6, 5), dt.date(2026, 6, 6)


def _rows(spark, d, prices):
    return spark.createDataFrame(
        [(f"T{i}", Decimal(p), "Two", f"https://x/{i}", d, f"u{i}", "Poetry", 3)
         for i, p in enumerate(prices)], WIDE)


def test_archive_export_views_and_vacuum(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.ingest(_rows(spark, D1, ["1.00", "2.00"]), batch_id=1)
    wh.ingest(_rows(spark, D2, ["1.50", "2.00", "3.00"]), batch_id=2)
    days = sorted(os.path.basename(x) for x in glob.glob(f"{wh.archive_path}/run_date=*"))
    assert days == ["run_date=2026-06-05", "run_date=2026-06-06"]
    day = read_snapshot_csv(spark, f"{wh.archive_path}/run_date=2026-06-05").collect()
    assert {(r.upc, r.category, r.date_collected) for r in day} == {("u0", "Poetry", D1), ("u1", "Poetry", D1)}
    assert read_snapshot_csv(spark, wh.snapshot_path).count() == 3      # latest run only
    wh.export(wh.books(), f"{tmp_root}/export")
    assert read_snapshot_csv(spark, f"{tmp_root}/export").count() == 5
    wh.ensure_tables()
    assert spark.sql("SELECT COUNT(*) AS n FROM books").first().n == 5
    assert spark.sql("SELECT COUNT(*) AS n FROM price_history").first().n == 5
    removed = wh.vacuum_catalog(keep=1)
    assert len(removed) == 1 and wh.catalog().count() == 3


def test_write_report_in_order(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.ingest(_rows(spark, D1, ["10.00", "20.00", "30.00"]), batch_id=1)
    wh.ingest(_rows(spark, D2, ["9.00", "20.00", "33.00"]), batch_id=2)
    ch = C.latest_changes(wh.books(), wh.history(), C.URL_KEYS, ())
    lines = R.change_report(ch, "2026-06-05", "2026-06-06", "Warehouse")
    out = f"{tmp_root}/report"
    R.write_report(lines, out)
    text = "".join(open(f, encoding="utf-8").read()
                   for f in sorted(glob.glob(f"{out}/part-*")))
    want = [r.line for r in R.ordered(lines).collect()]
    assert text.split("\n")[:-1] == want
    assert "  Old Price: £10.00  |  New Price: £9.00  |  Change: £-1.00 (-10.0%)" in want
    assert "  Old Price: £30.00  |  New Price: £33.00  |  Change: +£3.00 (+10.0%)" in want
