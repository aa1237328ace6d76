"""Command line: the three jobs of the source application, as Spark jobs.

    python -m shelfwatch ingest-pages --warehouse W --listing L --detail D [--run-date D]
    python -m shelfwatch ingest-csv   --warehouse W --csv PATH
    python -m shelfwatch analyze      --warehouse W --out DIR [--csv-fallback PATH]
    python -m shelfwatch compare      --warehouse W --out DIR [--log-fallback PATH]
    python -m shelfwatch export       --warehouse W --out DIR

``--ledger`` on the first load of a new warehouse makes it a ledger (loads of both tables in one
commit); later loads and all readers find that out by themselves.

Works the same under ``spark-submit``: the active session (and its cluster settings) is
used when there is one.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators import changes as C
from shelfwatch.operators import snapshots as S
from shelfwatch.plans import reports as R
from shelfwatch.schemas import WIDE_COLUMNS
from shelfwatch.session import checkpointed, get_session
from shelfwatch.sinks.ledger import Ledger, open_store
from shelfwatch.sinks.warehouse import Warehouse
from shelfwatch.sources import html as H
from shelfwatch.sources.tables import csv_rejects, read_first_available, read_history_csv, \
    read_snapshot_csv

WAREHOUSE_LABEL = "Parquet warehouse"


def _nonempty_warehouse(wh: Warehouse | Ledger) -> DataFrame:
    if isinstance(wh, Ledger):
        state = wh.state()
        if not state["days"]:
            raise FileNotFoundError(wh.root)
        return wh.books(state)
    if not wh._exists(wh.history_path):
        raise FileNotFoundError(wh.history_path)
    return wh.books()


def _latest(wh: Warehouse | Ledger) -> DataFrame:
    books = _nonempty_warehouse(wh)
    return wh.latest_snapshot() if isinstance(wh, Ledger) else S.latest_snapshot(books, wh.history())


def ingest_pages(spark: SparkSession, warehouse: str, listing: str, detail: str,
                 run_date: str | None = None, ledger: bool = False) -> dict:
    """Listing pages + detail pages (parquet tables page_id, url, html) -> one load.

    Beside it: listings without a whole detail page in ``rejected_listings``, pages that the
    parser could not finish in ``rejected_pages``. Their numbers are returned.
    """
    with checkpointed(H.parse_pages(spark.read.parquet(listing))) as lst, \
            checkpointed(H.parse_pages(spark.read.parquet(detail))) as det:   # one parse of the pages
        with checkpointed(H.enrich_flagged(H.parse_listing(lst), H.parse_detail(det), run_date)) as flagged:
            bad = F.col("reject_reason").isNotNull()
            info = open_store(spark, warehouse, ledger).ingest(flagged.where(~bad).select(*WIDE_COLUMNS))
            rejected = flagged.where(bad).select("page_id", "title", "product_url", "reject_reason")
            rejected.write.mode("append").parquet(f"{warehouse}/rejected_listings")
            info["rejected_listings"] = rejected.count()
        pages = [H.page_rejects(p).select(F.lit(kind).alias("kind"), "*")
                 for kind, p in (("listing", lst), ("detail", det))]
        broken = pages[0].union(pages[1])
        broken.write.mode("append").parquet(f"{warehouse}/rejected_pages")
        info["rejected_pages"] = broken.count()
    return info


def _write_csv_rejects(spark: SparkSession, csv: str, target: str, mode: str, log: bool = False) -> int:
    """Write the lines of ``csv`` without the right columns to ``target``; their number."""
    with checkpointed(csv_rejects(spark, csv, log)) as rejects:
        rejects.write.mode(mode).parquet(target)
        return rejects.count()


def _with_csv_rejects(spark: SparkSession, label: str, csv: str, out: str, log: bool = False) -> str:
    """``label`` with the number of lines left out, which are written beside the report."""
    n = _write_csv_rejects(spark, csv, f"{out.rstrip('/')}_rejected_lines", "overwrite", log)
    return f"{label}, {n} lines rejected" if n else label


def ingest_csv(spark: SparkSession, warehouse: str, csv: str, ledger: bool = False) -> dict:
    """A snapshot CSV -> one load; lines without its columns go to ``rejected_lines``."""
    info = open_store(spark, warehouse, ledger).ingest(read_snapshot_csv(spark, csv))
    info["rejected_lines"] = _write_csv_rejects(spark, csv, f"{warehouse}/rejected_lines", "append")
    return info


def analyze(spark: SparkSession, warehouse: str, out: str,
            csv_fallback: str | None = None) -> str:
    """K7: statistics report of the latest snapshot; warehouse first, CSV snapshot second."""
    wh = open_store(spark, warehouse)
    readers = [(WAREHOUSE_LABEL, lambda: _latest(wh))]
    if csv_fallback:
        readers.append((f"CSV Snapshot Backup ({csv_fallback})",
                        lambda: read_snapshot_csv(spark, csv_fallback)
                        .withColumn("ingest_seq", F.monotonically_increasing_id())))
    snap, label = read_first_available(readers)
    if label != WAREHOUSE_LABEL:
        label = _with_csv_rejects(spark, label, csv_fallback, out)
    R.write_report(R.statistics_report(snap, label), out)
    return label


def compare(spark: SparkSession, warehouse: str, out: str,
            log_fallback: str | None = None) -> str:
    """K8: change report between the two latest collection dates."""
    wh = open_store(spark, warehouse)
    readers = [(WAREHOUSE_LABEL, lambda: _nonempty_warehouse(wh))]
    if log_fallback:
        readers.append(("CSV Backup Log (Fallback)",
                        lambda: read_history_csv(spark, log_fallback)))
    books, label = read_first_available(readers)
    if label != WAREHOUSE_LABEL:
        label = _with_csv_rejects(spark, label, log_fallback, out, log=True)
    ch = C.latest_changes(books, books, C.URL_KEYS, ())
    R.write_report(R.change_report(ch, S.previous_date(books), S.latest_date(books), label),
                   out)
    return label


def export(spark: SparkSession, warehouse: str, out: str) -> None:
    """K9: snapshot and full history as CSV with the original header."""
    wh = open_store(spark, warehouse)
    books = wh.books()
    wh.export(_latest(wh), f"{out}/snapshot")
    wh.export(S.full_history(books), f"{out}/history")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shelfwatch")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("ingest-pages")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--listing", required=True)
    p.add_argument("--detail", required=True)
    p.add_argument("--run-date")
    p.add_argument("--ledger", action="store_true")
    p = sub.add_parser("ingest-csv")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--csv", required=True)
    p.add_argument("--ledger", action="store_true")
    for name, extra in (("analyze", "--csv-fallback"), ("compare", "--log-fallback")):
        p = sub.add_parser(name)
        p.add_argument("--warehouse", required=True)
        p.add_argument("--out", required=True)
        p.add_argument(extra)
    p = sub.add_parser("export")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or get_session()
    if a.cmd == "ingest-pages":
        print(ingest_pages(spark, a.warehouse, a.listing, a.detail, a.run_date, a.ledger))
    elif a.cmd == "ingest-csv":
        print(ingest_csv(spark, a.warehouse, a.csv, a.ledger))
    elif a.cmd == "analyze":
        print(analyze(spark, a.warehouse, a.out, a.csv_fallback))
    elif a.cmd == "compare":
        print(compare(spark, a.warehouse, a.out, a.log_fallback))
    else:
        export(spark, a.warehouse, a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
