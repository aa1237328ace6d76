"""Price alerts on a stream equal those of all rows at once, in any order of files."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest

from shelfwatch.operators import changes as C
from shelfwatch.streaming import alerts as A

SCHEMA = "upc string, date_collected date, price decimal(10,2), ingest_seq long"
DAY = dt.date(2026, 6, 1)


def _write(spark, source, name, rows):
    """One file of rows; the name of the file gives no order, its time does."""
    folder = os.path.join(source, "..", "made-" + name)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(folder)
    os.makedirs(source, exist_ok=True)
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.link(os.path.join(folder, part), os.path.join(source, f"{name}.parquet"))


def _run(spark, source, root, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(source)
    A.start_alerts(stream, f"{root}/pairs", f"{root}/ckpt", available_now=True, **options).awaitTermination(300)


def _rows(changes):
    return sorted(((r.upc, r.date_collected, r.previous_date, r.price_old, r.price_new, r.change, r.pct)
                   for r in changes.collect()), key=str)


def _expected(spark, rows):
    last = {}
    for u, d, p, s in rows:
        if u is not None and d is not None and p is not None and (s, p) >= last.get((u, d), (-1, Decimal(0))):
            last[u, d] = s, p
    return C.consecutive_changes(spark.createDataFrame([(u, d, p, s) for (u, d), (s, p) in last.items()], SCHEMA))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_files_and_a_restart(spark, tmp_root, seed):
    r = random.Random(seed)
    rows = [(f"u{r.randrange(6)}", DAY + dt.timedelta(r.randrange(12)), Decimal(r.randrange(100, 2000)) / 100, k)
            for k in range(90)]
    rows += [(None, DAY, Decimal("1.00"), 0), ("u1", None, Decimal("1.00"), 0), ("u1", DAY, None, 999),
             ("zero", DAY, Decimal("0.00"), 1), ("zero", DAY + dt.timedelta(1), Decimal("3.00"), 1)]
    files = [rows[k::7] for k in range(7)]
    r.shuffle(files)
    source = os.path.join(tmp_root, "in")
    for k, part in enumerate(files[:4]):
        _write(spark, source, f"{seed}-{k}", part)
    _run(spark, source, tmp_root)
    assert _rows(A.current(spark, f"{tmp_root}/pairs")) == _rows(_expected(spark, [x for f in files[:4] for x in f]))
    for k, part in enumerate(files[4:], 4):
        _write(spark, source, f"{seed}-{k}", part)
    _run(spark, source, tmp_root)                        # goes on where it stopped
    want = _expected(spark, rows)
    assert _rows(A.current(spark, f"{tmp_root}/pairs")) == _rows(want)
    few = _rows(A.alerts(A.current(spark, f"{tmp_root}/pairs"), 20))
    assert few == _rows(A.alerts(want, 20)) and 0 < len(few) < want.count()
    assert all(x[5] < 0 and abs(x[6]) >= 20 for x in few)


def test_late_row_changes_both_pairs():
    known = A.merged({}, [(1, 0, 1000), (9, 0, 500)])
    assert A.pairs(known) == {1: (None, None, 1000), 9: (1, 1000, 500)}
    late = A.merged(known, [(5, 0, 2000), (9, -1, 1)])      # and an older version of a row that is known
    assert A.pairs(late) == {1: (None, None, 1000), 5: (1, 1000, 2000), 9: (5, 2000, 500)}


def test_forgotten_products_keep_their_last_price(spark, tmp_root):
    source = os.path.join(tmp_root, "in")
    day = [DAY + dt.timedelta(k) for k in (0, 1, 60, 120, 121)]
    for k, part in enumerate([[("old", day[0], Decimal("9.00"), 1), ("old", day[1], Decimal("8.00"), 1)],
                              [("new", day[2], Decimal("5.00"), 1)], [("new", day[3], Decimal("5.00"), 1)],
                              [("old", day[4], Decimal("4.00"), 1)]]):
        _write(spark, source, str(k), part)
        _run(spark, source, tmp_root, forget_after=10)
    got = {(r.upc, r.date_collected): (r.previous_date, r.price_old) for r in A.current(spark, f"{tmp_root}/pairs").collect()}
    assert got["old", day[4]] == (day[1], Decimal("8.00")) and got["old", day[1]] == (day[0], Decimal("9.00"))
