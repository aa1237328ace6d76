import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators.quality import ValidationError, orphans, violations
from shelfwatch.schemas import WIDE
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.sources.tables import read_first_available, read_history_csv, \
    read_snapshot_csv

D1, D2 = dt.date(2026, 6, 5), dt.date(2026, 6, 6)


def row(title, price, upc, d, rating="Three", stock=5, cat="Poetry", url=None):
    return (title, Decimal(price) if price is not None else None, rating,
            url or f"https://x/{upc}", d, upc, cat, stock)


def batch(spark, rows):
    return spark.createDataFrame(rows, WIDE)


def test_ingest_is_idempotent_and_keeps_other_days(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    day1 = batch(spark, [row("A", "10.00", "u1", D1), row("B", "20.00", "u2", D1)])
    day2 = batch(spark, [row("A", "9.00", "u1", D2), row("C", "30.00", "u3", D2,
                                                            cat="Travel")])
    wh.ingest(day1, batch_id=1)
    wh.ingest(day2, batch_id=2)
    first = sorted(tuple(r) for r in wh.books().select("upc", "price", "date_collected")
                   .collect())
    wh.ingest(day2, batch_id=3)                     # re-run of day 2
    second = sorted(tuple(r) for r in wh.books().select("upc", "price", "date_collected")
                    .collect())
    assert first == second
    assert len(first) == 4
    assert wh.catalog().count() == 3
    # dimension: last load wins per upc
    day2b = batch(spark, [row("A renamed", "9.50", "u1", D2)])
    wh.ingest(day2b, batch_id=4)
    cat = {r.upc: r.title for r in wh.catalog().collect()}
    assert cat == {"u1": "A renamed", "u2": "B", "u3": "C"}
    # day 2 now holds only the re-run's row, day 1 is untouched
    by_day = {(r.date_collected, r.upc) for r in wh.history().collect()}
    assert by_day == {(D1, "u1"), (D1, "u2"), (D2, "u1")}


def test_same_day_rerun_in_log_keeps_last(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.append_log(batch(spark, [row("A", "10.00", "u1", D1)]), batch_id=1)
    wh.append_log(batch(spark, [row("A", "11.00", "u1", D1)]), batch_id=2)
    got = read_history_csv(spark, wh.log_path).collect()
    assert len(got) == 1 and got[0].price == Decimal("11.00")


def test_snapshot_csv_roundtrip_and_fallback(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    b = batch(spark, [row("A", "10.00", "u1", D1, rating="Four")])
    wh.write_snapshot(b)
    back = read_snapshot_csv(spark, wh.snapshot_path).first()
    assert (back.title, back.price, back.rating, back.date_collected) == (
        "A", Decimal("10.00"), "Four", D1)
    df, label = read_first_available([
        ("database", lambda: (_ for _ in ()).throw(ConnectionError("down"))),
        ("empty", lambda: b.limit(0)),
        ("csv", lambda: read_snapshot_csv(spark, wh.snapshot_path))])
    assert label == "csv" and df.count() == 1
    with pytest.raises(FileNotFoundError):
        read_first_available([("none", lambda: read_snapshot_csv(spark, tmp_root + "/nope"))])


def test_constraint_breakers(spark, tmp_root):
    rows = [row("neg", "-1.00", "u1", D1), row("negstock", "1.00", "u2", D1, stock=-3),
            row("dup", "1.00", "u3", D1), row("dup", "2.00", "u3", D1),
            row(None, "1.00", "u4", D1)]
    b = batch(spark, rows)
    v = sorted((r.rule, r.upc) for r in violations(b).collect())
    assert v == [("price_non_negative", "u1"), ("stock_non_negative", "u2"),
                 ("title_not_null", "u4"), ("unique_upc_date", "u3")]
    wh = Warehouse(spark, tmp_root)
    with pytest.raises(ValidationError):
        wh.ingest(b)
    assert wh.history().count() == 0 and wh.catalog().count() == 0   # nothing written


def test_two_dates_in_batch_rejected(spark, tmp_root):
    b = batch(spark, [row("A", "1.00", "u1", D1), row("B", "1.00", "u2", D2)])
    rules = {r.rule for r in violations(b).collect()}
    assert rules == {"one_date_per_batch"}
    with pytest.raises(ValidationError):
        Warehouse(spark, tmp_root).ingest(b)


def test_orphans_and_cascade_delete(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.ingest(batch(spark, [row("A", "1.00", "u1", D1), row("B", "2.00", "u2", D1)]))
    wh.ingest(batch(spark, [row("A", "1.50", "u1", D2)]))
    cat_without_u2 = wh.catalog().where("upc <> 'u2'")
    assert [r.upc for r in orphans(wh.history(), cat_without_u2).collect()] == ["u2"]
    wh.delete_products(spark.createDataFrame([("u1",)], "upc string"))
    assert {r.upc for r in wh.catalog().collect()} == {"u2"}
    assert {(r.upc, r.date_collected) for r in wh.history().collect()} == {("u2", D1)}


def test_run_date_stamp(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    b = batch(spark, [row("A", "1.00", "u1", None)])
    wh.ingest(b, run_date="2026-06-07")
    assert wh.history().first().date_collected == dt.date(2026, 6, 7)
    assert wh.books().where(F.col("title") == "A").count() == 1


def test_validate_splits_rows(spark):
    from shelfwatch.operators.quality import validate
    b = batch(spark, [row("ok", "1.00", "u1", D1), row("neg", "-1.00", "u2", D1)])
    good, bad = validate(b)
    assert [r.upc for r in good.collect()] == ["u1"]
    assert [(r.rule, r.upc) for r in bad.collect()] == [("price_non_negative", "u2")]


def test_plain_history_csv_keeps_last_in_file_order(spark, tmp_root):
    """A log in the original 8-column layout (no batch / row ids): file order decides."""
    path = f"{tmp_root}/history.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("Title,Price,Rating,URL,Date_Collected,UPC,Category,Stock_Quantity\n")
        f.write("A,10.00,Three,https://x/a,2026-06-05,u1,Poetry,3\n")
        f.write("B,5.00,One,https://x/b,2026-06-05,u2,Poetry,1\n")
        f.write("A,12.00,Three,https://x/a,2026-06-05,u1,Poetry,2\n")   # same-day re-run
        f.write("A,11.00,Three,https://x/a,2026-06-06,u1,Poetry,2\n")
    got = sorted((r.title, r.date_collected, r.price, r.stock_quantity)
                 for r in read_history_csv(spark, path).collect())
    assert got == [("A", D1, Decimal("12.00"), 2), ("A", D2, Decimal("11.00"), 2),
                   ("B", D1, Decimal("5.00"), 1)]


def test_versions_count_up_and_no_load_is_lost(spark, tmp_root, monkeypatch):
    """Two loads that start from the same version: the second redoes its change on the first's."""
    wh, other = Warehouse(spark, tmp_root), Warehouse(spark, tmp_root)
    wh.ingest(batch(spark, [row("A", "1.00", "u1", D1)]))
    publish, raced = Warehouse._publish_catalog, []

    def racing(self, rows, version):
        if self is wh and not raced:
            raced.append(version)
            other.ingest(batch(spark, [row("B", "1.00", "u2", D2)]))
        return publish(self, rows, version)

    monkeypatch.setattr(Warehouse, "_publish_catalog", racing)
    wh.upsert_catalog(batch(spark, [row("C", "1.00", "u3", D2)]), ["title"])
    assert raced == [2] and wh.versions() == [1, 2, 3]
    assert {r.upc for r in wh.catalog().collect()} == {"u1", "u2", "u3"}
    assert not publish(wh, wh.catalog(), 2)                       # an existing version is never touched
    assert {r.upc for r in wh.catalog(2).collect()} == {"u1", "u2"}


def test_an_emptied_catalog_stays_empty(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.ingest(batch(spark, [row("A", "1.00", "u1", D1)]))
    wh.delete_products(spark.createDataFrame([("u1",)], "upc string"))
    assert wh.catalog().count() == 0 and wh.history().count() == 0 and wh.books().count() == 0


def test_fact_upsert_keeps_the_rest_of_the_day(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.ingest(batch(spark, [row("A", "1.00", "u1", D1), row("B", "2.00", "u2", D1)]))
    new = batch(spark, [row("A", "1.50", "u1", D1, rating="One"), row("C", "3.00", "u3", D1)]) \
        .withColumn("ingest_seq", F.lit(9).cast("long"))
    for _ in range(2):                                            # a replay changes nothing
        wh.upsert_facts(new)
        got = {(r.upc, r.price, r.rating) for r in wh.history().collect()}
        assert got == {("u1", Decimal("1.50"), "Three"), ("u2", Decimal("2.00"), "Three"), ("u3", Decimal("3.00"), "Three")}


def test_session_keeps_what_is_set(spark):
    from shelfwatch.session import get_session
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert get_session().conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ties_on_one_date_go_to_the_last_logged(spark):
    from shelfwatch.operators.evolution import scd2
    rows = spark.createDataFrame([("u", "z", D1, 1), ("u", "a", D1, 2), ("u", "a", D2, 3)],
                                 "upc string, title string, date_collected date, ingest_seq long")
    assert [(r.title, r.valid_from) for r in scd2(rows, attrs=["title"]).collect()] == [("a", D1)]
