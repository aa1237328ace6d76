"""The ledger warehouse: loads of both tables at once, deltas, added columns, dates from commits."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators.quality import ValidationError
from shelfwatch.schemas import WIDE
from shelfwatch.sinks import ledger as L

D = [dt.date(2026, 6, k) for k in range(1, 6)]


def rows(spark, items):
    """Wide rows of (upc, title, price, date)."""
    return spark.createDataFrame([(t, Decimal(p), "Two", f"https://x/{u}", d, u, "Poetry", 3) for u, t, p, d in items], WIDE)


def facts(ledger, state=None):
    return sorted((r.upc, r.title, float(r.price), r.date_collected) for r in ledger.books(state).collect())


def titles(ledger, state=None):
    return {r.upc: r.title for r in ledger.catalog(state).collect()}


@pytest.fixture()
def ledger(spark, tmp_root):
    return L.Ledger(spark, tmp_root, buckets=4, max_deltas=3)


def test_loads_replays_and_days(spark, ledger):
    assert ledger.dates() == [] and ledger.books().count() == 0 and ledger.last_two_dates().count() == 0
    ledger.ingest(rows(spark, [("u1", "A", "1.00", D[0]), ("u2", "B", "2.00", D[0])]), batch_id=1)
    ledger.ingest(rows(spark, [("u1", "A2", "3.00", D[1]), ("u3", "C", "4.00", D[1])]), batch_id=2)
    want = [("u1", "A2", 1.0, D[0]), ("u1", "A2", 3.0, D[1]), ("u2", "B", 2.0, D[0]), ("u3", "C", 4.0, D[1])]
    assert facts(ledger) == want and titles(ledger) == {"u1": "A2", "u2": "B", "u3": "C"}
    again = ledger.ingest(rows(spark, [("u1", "late", "9.00", D[0])]), batch_id=1)      # a known load changes nothing
    assert not again["loaded"] and facts(ledger) == want and ledger.files._exists(ledger.files.log_path)
    ledger.ingest(rows(spark, [("u2", "B", "5.00", D[0])]), batch_id=3)                  # the day is replaced
    assert facts(ledger) == [("u1", "A2", 3.0, D[1]), ("u2", "B", 5.0, D[0]), ("u3", "C", 4.0, D[1])]
    assert ledger.dates() == D[:2]
    assert tuple(ledger.last_two_dates().first()) == (D[0], D[1])
    assert facts(ledger, ledger.state(2)) == want                                        # an earlier commit is still there


@pytest.mark.parametrize("step", ["_write 1", "_write 2", "_publish 1"])
def test_a_load_that_breaks_off_shows_nothing(spark, ledger, monkeypatch, step):
    ledger.ingest(rows(spark, [("u1", "A", "1.00", D[0])]), batch_id=1)
    name, at = step.split()
    real, calls = getattr(L.Ledger, name), []

    def dies(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == int(at):
            raise KeyboardInterrupt
        return real(self, *args, **kwargs)
    monkeypatch.setattr(L.Ledger, name, dies)
    second = rows(spark, [("u1", "B", "2.00", D[1])])
    with pytest.raises(KeyboardInterrupt):
        ledger.ingest(second, batch_id=2)
    monkeypatch.undo()
    assert facts(ledger) == [("u1", "A", 1.0, D[0])] and titles(ledger) == {"u1": "A"} and ledger.dates() == [D[0]]
    ledger.ingest(second, batch_id=2)
    assert facts(ledger) == [("u1", "B", 1.0, D[0]), ("u1", "B", 2.0, D[1])]
    assert len(ledger.vacuum(keep=1, older_than_seconds=0)) >= (step != "_write 1")      # what was left behind
    assert facts(ledger) == [("u1", "B", 1.0, D[0]), ("u1", "B", 2.0, D[1])]


def test_killed_after_the_commit_counts_as_loaded(spark, ledger, monkeypatch):
    def dies(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(ledger.files, "write_snapshot", dies)
    batch = rows(spark, [("u1", "A", "1.00", D[0])])
    with pytest.raises(KeyboardInterrupt):
        ledger.ingest(batch, batch_id=1)
    assert facts(ledger) == [("u1", "A", 1.0, D[0])]
    assert not ledger.ingest(batch, batch_id=1)["loaded"]


def test_racing_loads_both_stay(spark, ledger, monkeypatch):
    other = L.Ledger(spark, ledger.root, buckets=4)
    real, won = L.Ledger._publish, []

    def slow(self, state):
        if self is ledger and not won:
            won.append(other.ingest(rows(spark, [("u9", "Z", "9.00", D[1])]), batch_id="other", write_csv=False))
        return real(self, state)
    monkeypatch.setattr(L.Ledger, "_publish", slow)
    ledger.ingest(rows(spark, [("u1", "A", "1.00", D[0])]), batch_id="mine", write_csv=False)
    assert ledger.state()["version"] == 2 and won
    assert facts(ledger) == [("u1", "A", 1.0, D[0]), ("u9", "Z", 9.0, D[1])]


def test_racing_parts_of_one_day_are_merged(spark, ledger, monkeypatch):
    other = L.Ledger(spark, ledger.root, buckets=4)
    real, won = L.Ledger._publish, []

    def slow(self, state):
        if self is ledger and not won:
            won.append(1)
            other.ingest_part(rows(spark, [("u2", "B", "2.00", D[0])]), ["ingest_seq"], write_log=False)
        return real(self, state)
    monkeypatch.setattr(L.Ledger, "_publish", slow)
    ledger.ingest_part(rows(spark, [("u1", "A", "1.00", D[0])]), ["ingest_seq"], write_log=False)
    assert facts(ledger) == [("u1", "A", 1.0, D[0]), ("u2", "B", 2.0, D[0])]


def test_publish_creates_a_commit_once(spark, ledger):
    state = ledger._empty() | {"version": 1}
    assert ledger._publish(state) and not ledger._publish(state | {"operation": "other"})
    assert ledger.state()["operation"] == "new" and ledger.commits() == [1]


def test_rejected_batches_write_nothing(spark, ledger):
    bad = [rows(spark, [("u1", "A", "-1.00", D[0])]), rows(spark, [("u1", "A", "1.00", D[0]), ("u1", "B", "1.00", D[0])]),
           rows(spark, [("u1", "A", "1.00", D[0]), ("u2", "B", "1.00", D[1])])]
    for batch in bad:
        with pytest.raises(ValidationError):
            ledger.ingest(batch)
    assert ledger.commits() == [] and not ledger.files._exists(f"{ledger.root}/history")
    ledger.ingest(bad[2], single_date=False, write_csv=False)
    assert ledger.dates() == D[:2]


def test_parts_deltas_and_compaction_against_dicts(spark, ledger):
    rng, names, prices = random.Random(4), {}, {}
    for n in range(7):
        part = {(f"u{rng.randrange(8)}", D[rng.randrange(4)]): (f"T{rng.randrange(99)}", rng.randrange(100)) for _ in range(6)}
        batch = rows(spark, [(u, t, f"{p}.00", d) for (u, d), (t, p) in part.items()]).coalesce(1)
        ledger.ingest_part(batch, ["ingest_seq"], batch_id=n, write_log=False)
        ledger.ingest_part(batch, ["ingest_seq"], batch_id=n, write_log=False)           # replayed
        for (u, d), (t, p) in part.items():
            names[u], prices[u, d] = t, float(p)
        assert facts(ledger) == sorted((u, names[u], p, d) for (u, d), p in prices.items())
        assert len(ledger.state()["deltas"]) <= ledger.max_deltas
    assert ledger.state()["base"] and titles(ledger) == names
    ledger.compact()
    assert ledger.state()["deltas"] == [] and titles(ledger) == names
    assert facts(ledger) == sorted((u, names[u], p, d) for (u, d), p in prices.items())


def test_delete_products_by_value_and_by_join(spark, ledger, monkeypatch):
    for limit in (1000, 0):
        monkeypatch.setattr(L, "KEYS_BY_VALUE", limit)
        ledger.ingest(rows(spark, [("u1", "A", "1.00", D[0]), ("u2", "B", "2.00", D[0])]), write_csv=False)
        ledger.ingest(rows(spark, [("u1", "A", "1.00", D[1])]), write_csv=False)
        ledger.ingest(rows(spark, [("u2", "B", "2.00", D[2])]), write_csv=False)
        untouched = ledger.state()["days"][D[2].isoformat()]
        ledger.delete_products(spark.createDataFrame([("u1",), ("none",)], "upc string"))
        assert facts(ledger) == [("u2", "B", 2.0, D[0]), ("u2", "B", 2.0, D[2])]
        assert ledger.dates() == [D[0], D[2]]                        # the day left empty ends
        assert ledger.state()["days"][D[2].isoformat()] == untouched
        assert titles(ledger) == {"u2": "B"}


def test_delete_by_value_reads_the_buckets_of_its_keys(spark, ledger):
    ledger.ingest(rows(spark, [(f"u{k}", "T", "1.00", D[0]) for k in range(200)]), write_csv=False)
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"        # its scan prunes too, but doesn't say so
    spark.conf.set(key, "false")
    try:
        plan = ledger.history().where(F.col("upc").isin(["u1"]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(key)
    assert "SelectedBucketsCount: 1 out of 4" in plan


def test_books_exchanges_neither_fact_nor_base(spark, ledger):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ledger.ingest(rows(spark, [(f"u{k}", "T", "1.00", D[0]) for k in range(50)]), write_csv=False)
        ledger.compact()
        def plan():
            return ledger.books()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan() and "SortMergeJoin" in plan()
        ledger.ingest(rows(spark, [("u1", "new", "1.00", D[1])]), write_csv=False)
        # Only the delta moves: one exchange, of the load's rows.
        final = plan().split("Initial Plan")[-1]
        assert final.count("Exchange hashpartitioning") == 1
        assert len(facts(ledger)) == 51 and titles(ledger)["u1"] == "new"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_load_writes_in_proportion_to_its_batch(spark, ledger):
    def size():
        fs, p = ledger.files._fs(f"{ledger.root}/catalog")
        return fs.getContentSummary(p).getLength()
    ledger.ingest(rows(spark, [(f"u{k}", f"title {k} " * 5, "1.00", D[0]) for k in range(5000)]), write_csv=False)
    before = size()
    ledger.ingest(rows(spark, [("u1", "new", "1.00", D[1])]), write_csv=False)
    assert size() - before < before / 10


def test_added_columns_are_kept(spark, ledger):
    ledger.ingest(rows(spark, [("u1", "A", "1.00", D[0]), ("u2", "B", "1.00", D[0])]), write_csv=False)
    with_more = rows(spark, [("u1", "A", "2.00", D[1])]).withColumns(
        {"currency": F.lit("GBP"), "publisher": F.lit("House"), "ingest_seq": F.lit(0)})
    ledger.ingest(with_more, write_csv=False, dimension=["publisher"])
    ledger.ingest(rows(spark, [("u1", "A3", "3.00", D[2])]), write_csv=False)            # neither column

    def seen():
        return sorted(((r.upc, r.title, r.date_collected, r.currency, r.publisher) for r in ledger.books().collect()), key=str)
    want = [("u1", "A3", D[0], None, "House"), ("u1", "A3", D[1], "GBP", "House"), ("u1", "A3", D[2], None, "House"),
            ("u2", "B", D[0], None, None)]
    assert seen() == want
    ledger.compact()
    assert seen() == want
    ledger.ingest_part(rows(spark, [("u2", "B", "9.00", D[1])]).withColumn("currency", F.lit("EUR")), ["ingest_seq"],
                       write_log=False)
    assert ("u2", "B", D[1], "EUR", None) in seen() and ("u1", "A3", D[1], "GBP", "House") in seen()
    assert [f["name"] for f in ledger.state(1)["history"]["fields"]][-1] == "date_collected"
    with pytest.raises(ValueError, match="currency"):
        ledger.ingest(rows(spark, [("u1", "A", "1.00", D[3])]).withColumn("currency", F.lit(1)), write_csv=False)
    assert D[3] not in ledger.dates()


def test_dates_read_no_data(spark, ledger):
    ledger.ingest(rows(spark, [("u1", "A", "1.00", D[0]), ("u1", "A", "1.00", D[3])]), single_date=False, write_csv=False)
    for df in (ledger.collection_dates(), ledger.last_two_dates()):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in ledger.collection_dates().collect()] == [D[0], D[3]]
    plan = ledger.latest_snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "date_collected" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ledger.latest_snapshot().count() == 1


def test_two_ledgers_and_views(spark, ledger, tmp_root):
    other = L.Ledger(spark, f"{tmp_root}/other", buckets=2)
    ledger.ingest(rows(spark, [("u1", "A", "1.00", D[0])]), write_csv=False)
    other.ingest(rows(spark, [("u1", "A", "1.00", D[0]), ("u2", "A", "1.00", D[0])]), write_csv=False)
    for x, n in ((ledger, 1), (other, 2)):
        x.ensure_tables()
        assert [spark.table(t).count() for t in ("price_history", "catalog", "books")] == [n] * 3


def test_a_ledger_on_another_file_system(spark, tmp_root):
    """A root that isn't a local path: commits by rename without overwrite."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.default.link./shelf", f"file://{tmp_root}")
    remote = L.Ledger(spark, "viewfs:///shelf/ledger", buckets=2)
    remote.ingest(rows(spark, [("u1", "A", "1.00", D[0])]), batch_id=1, write_csv=False)
    state = remote.state()
    assert state["version"] == 1 and not remote._publish(state) and remote.commits() == [1]
    remote.ingest(rows(spark, [("u1", "B", "2.00", D[1])]), batch_id=2, write_csv=False)
    assert facts(remote) == [("u1", "B", 1.0, D[0]), ("u1", "B", 2.0, D[1])]
