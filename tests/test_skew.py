"""A key holding a third of all rows: results stay exact and whole."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shelfwatch.operators import changes as C
from shelfwatch.operators.dedup import dedup_keep_last
from shelfwatch.operators.quality import violations
from shelfwatch.schemas import WIDE
from shelfwatch.sinks.warehouse import Warehouse, merge_catalog

N = 90_000


def _log(spark):
    # one third of the rows share (title, url, date); the rest are spread over 3,000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 3000).cast("string"))).alias("title"),
        F.lit("u").alias("product_url"),
        F.lit(dt.date(2026, 6, 6)).alias("date_collected"),
        (F.col("id") % 1000).cast("decimal(10,2)").alias("price"),
        F.col("id").alias("ingest_seq"))


def test_dedup_hot_key(spark):
    out = dedup_keep_last(_log(spark), ["title", "product_url", "date_collected"])
    got = {r.title: r.ingest_seq for r in out.collect()}
    assert got["hot"] == N - 3          # last id divisible by 3
    assert len(got) == 1 + 2000         # ids % 3 != 0 hit 2,000 of the 3,000 k-keys
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan     # map-side combine before the shuffle


def test_hot_key_join_and_upsert(spark, tmp_root):
    d1, d2 = dt.date(2026, 6, 5), dt.date(2026, 6, 6)
    rows = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("Unknown")).otherwise(
            F.col("id").cast("string")).alias("upc"),
        F.col("id").cast("string").alias("title"),
        F.lit("c").alias("category"), F.lit("u").alias("product_url"),
        (F.col("id") % 100).cast("decimal(10,2)").alias("price"),
        F.col("id").alias("ingest_seq"))
    books = rows.withColumn("date_collected", F.lit(d1)).unionByName(
        rows.withColumn("date_collected", F.lit(d2))
            .withColumn("price", (F.col("price") + 1).cast("decimal(10,2)")))
    ch = C.latest_changes(books)
    s = C.change_summary(ch).first()
    assert (s.compared, s.hikes) == (N, N)
    assert "CartesianProduct" not in ch._jdf.queryExecution().executedPlan().toString()
    # upsert: the hot upc collapses to its last row, every other product kept
    cat = merge_catalog(spark.createDataFrame([], "upc string, title string, category string,"
                                               " product_url string"), rows, ["ingest_seq"])
    assert cat.count() == N - N // 3 + 1
    v = violations(rows.withColumn("date_collected", F.lit(d1))
                   .withColumn("rating", F.lit("One"))
                   .withColumn("stock_quantity", F.lit(1)))
    assert [(r.rule, r.upc) for r in v.collect()] == [("unique_upc_date", "Unknown")]


def test_ensure_tables_on_empty_warehouse(spark, tmp_root):
    wh = Warehouse(spark, f"{tmp_root}/fresh")
    name = wh.ensure_tables()
    assert spark.sql("SELECT COUNT(*) AS n FROM books").first().n == 0
    assert wh.catalog().count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_two_warehouses_in_one_session(spark, tmp_root):
    day = dt.date(2026, 6, 6)
    houses = [Warehouse(spark, f"{tmp_root}/{k}") for k in ("a", "b")]
    names = []
    for n, wh in enumerate(houses, 1):
        rows = spark.createDataFrame(
            [(f"T{i}", Decimal("1.00"), "Two", f"https://x/{i}", day, f"u{i}", "Poetry", 3) for i in range(n)], WIDE)
        wh.ingest(rows, batch_id=1, write_csv=False)
        names.append(wh.ensure_tables())
    assert len(set(names)) == 2
    assert [spark.table(x).count() for x in names] == [1, 2]
    assert spark.table("price_history").count() == 2            # the views show the last one
    houses[0].ensure_tables()                                   # again, and the first one
    assert spark.table("price_history").count() == 1
    for x in names:
        spark.sql(f"DROP TABLE {x}")
    assert [wh.history().count() for wh in houses] == [1, 2]    # the data isn't the catalog's
