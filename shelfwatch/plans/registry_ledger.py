"""Registered queries of the ledger warehouse, the alert stream, the keyword index, exact quantiles and log runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators import keyword_index as KI
from shelfwatch.operators import quantiles as Q
from shelfwatch.operators import search as SR
from shelfwatch.operators import snapshots as S
from shelfwatch.plans import oracle as O
from shelfwatch.plans.registry import _STARS, ALERT_PCT, KEYWORD, _search_sql, register
from shelfwatch.plans.registry_loads import _HARD_SQL, _LOADED_SQL, _PART_SQL, _hard_texts, _scratch, _wide
from shelfwatch.schemas import PRICE, WIDE_COLUMNS
from shelfwatch.sinks.ledger import Ledger
from shelfwatch.sinks.log_runs import LogRuns
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.sources import binding as B
from shelfwatch.streaming import alerts as AL


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.books(spark, sf_dir).select(*WIDE_COLUMNS)


#: Rows of the fact in one bucket, over all dates; a load is written by one task a bucket.
BUCKET_ROWS = 1_000_000


def _ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    rows = B.fact(spark, sf_dir).count()                             # footers are read, no rows
    return Ledger(spark, _scratch(spark), buckets=max(4, -(-rows // BUCKET_ROWS)))


def _loaded(ledger: Ledger) -> DataFrame:
    return ledger.books().select("upc", "title", F.col("price").cast("double").alias("price"), "rating", "stock_quantity",
                                 "date_collected")


@register("ledger_star_join", O.q(
    f"SELECT upc, CASE WHEN upc IN (SELECT upc FROM snapshot WHERE CAST(upc AS BIGINT) % 5 = 0) THEN title || ' II' ELSE title "
    f"END AS title, {_LOADED_SQL.split(', ', 2)[2]} FROM books"))
def ledger_star_join(spark, sf_dir):
    """All dates loaded at once, then some products of the latest date under a new
    title, which the dimension's delta shows on every date."""
    ledger, rows = _ledger(spark, sf_dir), _rows(spark, sf_dir)
    ledger.ingest(rows, batch_id="all", write_csv=False, single_date=False)
    ledger.compact()
    latest = S.latest_snapshot(rows, B.fact(spark, sf_dir)).where("CAST(upc AS BIGINT) % 5 = 0")
    for _ in range(2):                                               # the second time changes nothing
        ledger.ingest_part(latest.withColumn("title", F.concat("title", F.lit(" II"))), ["ingest_seq"], "renamed", False)
    return _loaded(ledger)


@register("ledger_cascade_delete", O.q(f"SELECT {_LOADED_SQL} FROM books WHERE CAST(upc AS BIGINT) % 3 <> 0"))
def ledger_cascade_delete(spark, sf_dir):
    """J6 over all dates: every third product with all its facts, in one commit."""
    ledger = _ledger(spark, sf_dir)
    ledger.ingest(_rows(spark, sf_dir), write_csv=False, single_date=False)
    ledger.delete_products(B.catalog(spark, sf_dir).where("CAST(upc AS BIGINT) % 3 = 0").select("upc"))
    return _loaded(ledger)


@register("ledger_added_column", O.q(
    "SELECT upc, CAST(price AS DOUBLE) AS price, date_collected, CASE WHEN date_collected = (SELECT latest_date FROM dates) "
    "THEN 'C' || CAST(stock_quantity % 3 AS VARCHAR) END AS currency FROM books"))
def ledger_added_column(spark, sf_dir):
    """E5: earlier dates without a column, the latest with it, then one of the earlier dates again."""
    ledger, rows, fact = _ledger(spark, sf_dir), _rows(spark, sf_dir), B.fact(spark, sf_dir)
    latest = F.col("date_collected") == S.latest_date(fact)
    ledger.ingest(rows.where(~latest), write_csv=False, single_date=False)
    ledger.ingest(rows.where(latest).withColumn("currency", F.concat(
        F.lit("C"), (F.col("stock_quantity") % 3).cast("string"))), write_csv=False)
    ledger.ingest(S.snapshot_at(rows, S.previous_date(fact)), write_csv=False)
    return ledger.books().select("upc", F.col("price").cast("double").alias("price"), "date_collected", "currency")


@register("ledger_dates", O.q(
    "SELECT date_collected, coalesce(date_collected = (SELECT max(date_collected) FROM books WHERE date_collected < "
    "(SELECT latest_date FROM dates)), false) AS is_previous, date_collected = (SELECT latest_date FROM dates) AS is_latest "
    "FROM (SELECT DISTINCT date_collected FROM books)"))
def ledger_dates(spark, sf_dir):
    """A13, A15, W2 from the commit: no fact file is read."""
    ledger = _ledger(spark, sf_dir)
    ledger.ingest(_rows(spark, sf_dir), write_csv=False, single_date=False)
    state = ledger.state()
    two = [None, *ledger.dates(state)][-2:]
    flags = [F.coalesce(F.col("date_collected") == F.lit(d), F.lit(False)) for d in two]
    return ledger.collection_dates(state).select("date_collected", flags[0].alias("is_previous"), flags[1].alias("is_latest"))


@register("ledger_micro_batches", O.q(
    "SELECT upc, title, CAST(CASE WHEN CAST(upc AS BIGINT) % 4 = 0 THEN price + 1 ELSE price END AS DOUBLE) AS price, rating, "
    "stock_quantity, date_collected FROM books"))
def ledger_micro_batches(spark, sf_dir):
    """E2 + E6 over all dates: the observations in parts, one of them three times, then a
    correction of some products."""
    ledger, rows = _ledger(spark, sf_dir), _rows(spark, sf_dir)
    part = F.pmod(F.xxhash64("upc", "date_collected"), F.lit(3))
    for n, load in ((0, "a"), (1, "b"), (1, "b"), (2, "c"), (1, None)):
        ledger.ingest_part(rows.where(part == n), ["ingest_seq"], load, False)
    ledger.ingest_part(rows.where("CAST(upc AS BIGINT) % 4 = 0").withColumn("price", (F.col("price") + 1).cast(PRICE)),
                       ["ingest_seq"], "fix", False)
    return _loaded(ledger)


@register("search_keyword_indexed", _search_sql(
    f"(coalesce(regexp_matches(title, '(?i){KEYWORD}'), false) OR "
    f"coalesce(regexp_matches(upc, '(?i){KEYWORD}'), false)) AND {_STARS}"))
def search_keyword_indexed(spark, sf_dir):
    """F9 by way of the trigram index of the whole dimension."""
    path = f"{_scratch(spark)}/postings"
    KI.build(B.catalog(spark, sf_dir), path)
    snapshot = S.latest_snapshot(B.books(spark, sf_dir), B.fact(spark, sf_dir))
    return KI.search(snapshot, SR.SearchSpec(keyword=KEYWORD), path).withColumn("price", F.col("price").cast("double"))


_NET = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


@register("describe_net_price", "SELECT count(x) AS count, round(avg(x), 3) AS mean, round(stddev_samp(x), 3) AS std, min(x) AS min, "
          + ", ".join(f"round(quantile_cont(x, {q / 1000}), 6) AS p{q / 10:g}" for q in (250, 500, 750, 995)).replace("p99.5", "p99_5")
          + f", max(x) AS max FROM (SELECT {_NET} AS x FROM lineitem)")
def describe_net_price(spark, sf_dir):
    """A12 on a column of distinct doubles: quartiles by selection in passes, not one map of all values."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(_NET).alias("x"))
    out = Q.describe(rows, "x", (0.25, 0.5, 0.75, 0.995), accuracy=2000, at_hand=2000)
    return out.select("count", F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"), "min",
                      *[F.round(f"`{c}`", 6).alias(c.replace(".", "_")) for c in ("p25", "p50", "p75", "p99.5")], "max")


@register("csv_log_runs", f"""WITH {_PART_SQL}, {_HARD_SQL}
SELECT title, CASE WHEN CAST(upc AS BIGINT) % 3 = 0 THEN price + 1 ELSE price END AS price, rating, product_url,
  date_collected, upc, category, stock_quantity FROM hard""")
def csv_log_runs(spark, sf_dir):
    """A run taken into the compacted log, a later one above its watermark."""
    root = _scratch(spark)
    files, rows = Warehouse(spark, root), _hard_texts(spark, sf_dir)
    runs = LogRuns(spark, files.log_path, f"{root}/runs")
    files.append_log(rows, 1)
    runs.compact()
    files.append_log(rows.where("CAST(upc AS BIGINT) % 3 = 0").withColumn("price", (F.col("price") + 1).cast(PRICE)), 2)
    return _wide(runs.read())


@register("stream_price_alerts", O.q(
    "SELECT upc, date_collected, previous_date, CAST(price_old AS DOUBLE) AS price_old, CAST(price_new AS DOUBLE) AS price_new, "
    "CAST(price_new - price_old AS DOUBLE) AS change FROM (SELECT upc, date_collected, lag(date_collected) OVER w AS "
    "previous_date, lag(price) OVER w AS price_old, price AS price_new FROM fact "
    "WINDOW w AS (PARTITION BY upc ORDER BY date_collected)) "
    # at least 9.995 percent, which half-even rounding to two places makes 10
    "WHERE price_new < price_old AND (price_old - price_new) * 100000 >= 9995 * price_old"))
def stream_price_alerts(spark, sf_dir):
    """E3 on a stream: all observations as files whose dates interleave, two files a micro-batch."""
    root = _scratch(spark)
    rows = B.fact(spark, sf_dir).select("upc", "date_collected", "price", F.lit(0).cast("long").alias("ingest_seq"))
    part = F.pmod(F.xxhash64("upc", "date_collected"), F.lit(4))
    rows.withColumn("part", part).repartition(4, "part").drop("part").write.parquet(f"{root}/files")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/files")
    AL.start_alerts(stream, f"{root}/pairs", f"{root}/state", available_now=True).awaitTermination()
    out = AL.alerts(AL.current(spark, f"{root}/pairs"), ALERT_PCT).drop("pct")
    return out.select("upc", "date_collected", "previous_date",
                      *[F.col(c).cast("double").alias(c) for c in ("price_old", "price_new", "change")])
