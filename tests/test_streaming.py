import csv
import datetime as dt
import os
from decimal import Decimal

import pytest

from shelfwatch.sinks.ledger import Ledger, open_store
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.streaming.incremental import start_ingest

HEADER = "Title,Price,Rating,URL,Date_Collected,UPC,Category,Stock_Quantity\n"


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER)
        for r in rows:
            f.write(",".join(str(x) for x in r) + "\n")


@pytest.mark.parametrize("ledger", [False, True])
def test_stream_ingests_each_run_once(spark, tmp_root, ledger):
    src = os.path.join(tmp_root, "incoming")
    os.makedirs(src)
    _write(os.path.join(src, "books_2026-06-05.csv"),
           [("A", "51.77", "Three", "https://x/a", "2026-06-05", "u1", "Poetry", 3),
            ("B", "13.99", "One", "https://x/b", "2026-06-05", "u2", "Travel", 0)])
    _write(os.path.join(src, "books_2026-06-06.csv"),
           [("A", "45.99", "3", "https://x/a", "2026-06-06", "u1", "Poetry", 2)])
    _write(os.path.join(src, "books_bad.csv"),
           [("C", "-1.00", "Two", "https://x/c", "2026-06-07", "u3", "Travel", 1)])
    wh_root = os.path.join(tmp_root, "wh")
    q = start_ingest(spark, src, wh_root, os.path.join(tmp_root, "ckpt"),
                     available_now=True, rejected_path=os.path.join(tmp_root, "rejected"), ledger=ledger)
    q.awaitTermination(300)
    wh = open_store(spark, wh_root)
    assert isinstance(wh, Ledger) == ledger
    got = sorted((r.upc, r.date_collected, r.price) for r in wh.history().collect())
    assert got == [("u1", dt.date(2026, 6, 5), Decimal("51.77")),
                   ("u1", dt.date(2026, 6, 6), Decimal("45.99")),
                   ("u2", dt.date(2026, 6, 5), Decimal("13.99"))]
    rejected = spark.read.parquet(os.path.join(tmp_root, "rejected")).collect()
    assert [(r.upc, r.violated_rules) for r in rejected] == [("u3", ["price_non_negative"])]
    # a restart with the same checkpoint finds nothing new
    q2 = start_ingest(spark, src, wh_root, os.path.join(tmp_root, "ckpt"), available_now=True)
    q2.awaitTermination(300)
    assert wh.history().count() == 3


def test_result_does_not_depend_on_files_per_batch(spark, tmp_root):
    """One day in three files, one key in two of them: the same tables for any trigger, and on replay."""
    src = os.path.join(tmp_root, "incoming")
    os.makedirs(src)
    parts = [[("A, \"x\"", "10.00", "One", "https://x/a", "2026-06-05", "u1", "Poetry", 3),
              ("B", "11.00", "One", "https://x/b", "2026-06-05", "u2", "Poetry", 3)],
             [("C", "12.00", "Two", "https://x/c", "2026-06-05", "u3", "Travel", 1)],
             [("B again", "9.00", "Two", "https://x/b", "2026-06-05", "u2", "Poetry", 2),
              ("D", "13.00", "Two", "https://x/d", "2026-06-06", "u4", "Travel", 1)]]
    for i, rows in enumerate(parts):
        path = os.path.join(src, f"part-{i}.csv")
        with open(path, "w", encoding="utf-8", newline="") as f:
            csv.writer(f).writerows([HEADER.strip().split(","), *rows])
        os.utime(path, (1_780_000_000 + i, 1_780_000_000 + i))
    seen = []
    for n in (1, 2, 100):
        root = os.path.join(tmp_root, f"wh{n}")
        for replay in range(2 if n == 2 else 1):      # a second stream applies all files again
            start_ingest(spark, src, root, os.path.join(tmp_root, f"ckpt{n}-{replay}"), available_now=True,
                         files_per_batch=n).awaitTermination(300)
        wh = Warehouse(spark, root)
        seen.append((sorted((r.upc, str(r.date_collected), str(r.price), r.rating, r.stock_quantity)
                            for r in wh.history().collect()),
                     sorted((r.upc, r.title) for r in wh.catalog().collect())))
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][0] == [("u1", "2026-06-05", "10.00", "One", 3), ("u2", "2026-06-05", "9.00", "Two", 2),
                          ("u3", "2026-06-05", "12.00", "Two", 1), ("u4", "2026-06-06", "13.00", "Two", 1)]
    assert seen[0][1] == [("u1", 'A, "x"'), ("u2", "B again"), ("u3", "C"), ("u4", "D")]
