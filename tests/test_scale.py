"""Work is dealt by its size: pages, buckets, keys and the groups of a stream's state."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import changes as C
from shelfwatch.operators import evolution as EV
from shelfwatch.plans import registry as R
from shelfwatch.plans import registry_ledger as RG
from shelfwatch.plans import registry_loads as RL
from shelfwatch.sources import binding as B
from shelfwatch.sources import html as H
from shelfwatch.streaming import alerts as A

DAY = dt.date(2026, 6, 1)


@pytest.fixture()
def tables(spark, tmp_root):
    """90 parts; 400 line items of 30 of them, several in a quarter."""
    r = random.Random(3)
    items = [(r.randrange(50), r.randrange(30), r.randrange(5), r.randrange(1, 8), float(r.randrange(1, 50)),
              float(r.randrange(100, 900)), r.randrange(11) / 100, dt.datetime(2026, 1, 1) + dt.timedelta(r.randrange(500)))
             for _ in range(400)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_root}/lineitem.parquet")
    spark.createDataFrame([(k, f"name {k}", f"Brand#{k % 3}", k % 50, 900.0 + k) for k in range(90)],
                          "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double"
                          ).coalesce(1).write.parquet(f"{tmp_root}/part.parquet")
    return tmp_root, items


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _dealt_first(df, keys):
    """The plain rows are dealt by ``keys`` below the first aggregate, not after it."""
    below = _plan(df).split("partial_max_by", 1)[1]
    exchange = next(line for line in below.splitlines() if "Exchange" in line)
    return f"hashpartitioning({keys}" in exchange and "REPARTITION_BY_COL" in exchange


def test_fact_is_dealt_by_key_before_it_is_sorted(spark, tables):
    root, items = tables
    history = B.build_history(spark, root)
    assert _dealt_first(history, "l_partkey")
    last = {}
    for order, part, supp, line, qty, price, discount, ship in items:
        key = str(part), dt.date(ship.year, ship.month - (ship.month - 1) % 3, 1)
        last[key] = max(last.get(key, ()), (ship, order, line, supp, price, qty))
    got = {(r.upc, r.date_collected): tuple(r.log_order) for r in history.collect()}
    assert got == last and history.count() == len(last) < len(items)


def test_log_is_dealt_by_key_before_it_is_sorted(spark, tables):
    root, _ = tables
    assert _dealt_first(R.dedup_history(spark, root), "title")
    assert _dealt_first(R.scd2_dimension(spark, root), "upc")


def test_pages_are_parsed_by_tasks_of_bounded_work(spark, tables, monkeypatch):
    monkeypatch.setattr(RL, "PAGES_PER_TASK", 20)
    for pages, n in ((RL._listing_pages(spark, tables[0]), 90), (RL._detail_pages(spark, tables[0]), 81)):
        per_task = H.parse_pages(pages).groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) == 5 and sum(x["count"] for x in per_task) == n


def test_buckets_grow_with_the_fact(spark, tables, monkeypatch):
    monkeypatch.setattr(RG, "BUCKET_ROWS", 10)
    rows = B.fact(spark, tables[0]).count()
    assert RG._ledger(spark, tables[0]).buckets == -(-rows // 10) > 4
    got = RG.ledger_micro_batches(spark, tables[0])
    assert got.count() == rows == got.select("upc", "date_collected").distinct().count()


def test_late_batches_dealt_into_given_partitions(spark):
    r = random.Random(5)
    rows = list({(f"u{r.randrange(9)}", DAY + dt.timedelta(r.randrange(15))): None for _ in range(80)})
    seen = spark.createDataFrame([(u, d, r.choice("ab")) for u, d in rows], "upc string, date_collected date, rating string").cache()
    part = F.pmod(F.xxhash64("upc", "date_collected"), F.lit(3))
    table = None
    for n in (2, 0, 1):
        table = EV.scd2_merge(table, seen.where(part == n), "upc", ["rating"], partitions=7)
    assert _plan(table).count(", 7), REPARTITION_BY_NUM") >= 3
    want = EV.scd2(seen, "upc", ["rating"])
    assert sorted(map(tuple, table.drop("observed").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_state_of_many_products_in_few_rows(spark, tmp_root):
    r = random.Random(7)
    rows = [(f"u{r.randrange(300)}", DAY + dt.timedelta(r.randrange(20)), Decimal(r.randrange(100, 2000)) / 100, k) for k in range(1500)]
    schema = "upc string, date_collected date, price decimal(10,2), ingest_seq long"
    for k in range(3):
        spark.createDataFrame(rows[k::3], schema).coalesce(1).write.mode("append").parquet(os.path.join(tmp_root, "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_root}/in")
    query = A.start_alerts(stream, f"{tmp_root}/pairs", f"{tmp_root}/ckpt", available_now=True, groups=4)
    query.awaitTermination(300)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
    last = {}
    for u, d, p, s in rows:
        last[u, d] = u, d, p, s
    want = C.consecutive_changes(spark.createDataFrame(list(last.values()), schema))
    got = A.current(spark, f"{tmp_root}/pairs").select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
