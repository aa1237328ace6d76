"""Text reports built as Spark DataFrames of lines (K7, K8).

Every line is produced by column expressions next to the data it describes, and each
report is a DataFrame ``(block, k1, k2, k3, sub, line)`` whose sort key orders the lines.
``write_report`` range-sorts by that key and writes text, so a report with millions of
product blocks is written by many tasks in order, never assembled on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions import fmt
from shelfwatch.operators import analytics as A
from shelfwatch.operators import changes as C
from shelfwatch.operators import stats as ST

# ---- fixed values: layout of the two reports -----------------------------------------
STATS_RULE = "=" * 50
STATS_TITLE = "       BOOKS.TOSCRAPE.COM - DATA ANALYSIS"
HIST_RULE = "-" * 20
CHANGE_RULE = "=" * 65
CHANGE_SUBRULE = "-" * 65
CHANGE_TITLE = "         PRICE CHANGE DETECTOR REPORT"
SUMMARY_TITLE = "                       SUMMARY"
DESCRIBE_LABELS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
DESCRIBE_FOOTER = "Name: Price, dtype: float64"
STATS_SOURCE, CHANGE_SOURCE = "Data Source : ", "Data Source:    "
COMPARING = "Comparing date: "
ARROW = "  -->  "
CHECKED = "Total books checked: "
FOUND = "Total price changes found: "
DROPS_HEAD = "[DECREASE] Price Drops (Good Deals):"
NO_DROPS = "  No price drops found."
HIKES_HEAD = "[INCREASE] Price Hikes (More Expensive):"
NO_HIKES = "  No price increases found."
SUM_CHECKED = "  Checked Books   : "
SUM_DROPS = "  Price Drops     : "
SUM_HIKES = "  Price Hikes     : "
SUM_TOTAL = "  Total Changes   : "
OLD_PRICE = "  Old Price: "
NEW_PRICE = "  |  New Price: "
CHANGE_BY = "  |  Change: "
LINK = "  Link: "
DATASET = "Total books in dataset: "
PRICE_HEAD = "--- Price Statistics ---"
AVERAGE = "Average price: "
HIGHEST = "Highest price: "
LOWEST = "Lowest price:  "
DEAREST = "Most expensive: "
CHEAPEST = "Cheapest:       "
RATING_HEAD = "--- Rating Distribution ---"
RATING_COLUMNS = "Stars | Count"
SUMMARY_HEAD = "--- Full Price Summary (.describe()) ---"
COMPLETE = "Analysis complete."
# --------------------------------------------------------------------------------------

KEY_COLS = ("block", "k1", "k2", "k3", "sub")


def _lines(df: DataFrame, block: int, parts: Sequence[Column], k1: Column | None = None,
           k2: Column | None = None, k3: Column | None = None,
           block_col: Column | None = None) -> DataFrame:
    """One output row per element of ``parts`` for each input row."""
    arr = F.array(*[F.struct(F.lit(i).alias("sub"), p.cast("string").alias("line"))
                    for i, p in enumerate(parts)])
    nul = F.lit(None).cast("string")
    b = block_col if block_col is not None else F.lit(block)
    return df.select(b.alias("block"),
                     (k1 if k1 is not None else nul).cast("string").alias("k1"),
                     (k2 if k2 is not None else nul).cast("string").alias("k2"),
                     (k3 if k3 is not None else nul).cast("string").alias("k3"),
                     F.inline(arr))


def _date_text(d: Column | str) -> Column:
    return F.lit(d) if isinstance(d, str) else F.date_format(d, "yyyy-MM-dd")


def _py_float(c: Column) -> Column:
    """str(float) of a double (shortest round-trip text, '10.0' for integers)."""
    return fmt.plain_number(c)


def _describe_lines() -> list[Column]:
    """pandas ``Series.describe()`` text lines over columns ``_v0``..``_v7`` (each value
    printed with 6 decimals) and ``_k`` (trailing zeros common to all values, at most 5)."""
    cut = [F.expr(f"substring(_v{i}, 1, length(_v{i}) - _k)")
           for i in range(len(DESCRIBE_LABELS))]
    width = F.greatest(*[F.length(c) for c in cut])
    label_w = max(len(x) for x in DESCRIBE_LABELS)
    return [F.concat(F.rpad(F.lit(lab), label_w, " "), F.lpad(c, width + 4, " "))
            for lab, c in zip(DESCRIBE_LABELS, cut)]


def statistics_report(snapshot: DataFrame, source_label: str,
                      order: Sequence[Column | str] = ("ingest_seq",)) -> DataFrame:
    """K7: the descriptive statistics report of a snapshot."""
    d_aggs, d_post = ST.describe_columns(rounded=False)
    head = snapshot.agg(
        F.count(F.lit(1)).alias("n"),
        F.bround(F.sum("price").cast("decimal(20,2)")
                 / F.count("price").cast("decimal(20,0)"), 2).cast("double").alias("avg"),
        *ST.extreme_columns(order), *d_aggs)
    names = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    head = head.select("n", "avg", "most_expensive_title", "highest_price", "cheapest_title",
                       "lowest_price", *d_post)
    head = head.select("*", *[F.format_string("%.6f", F.col(n).cast("double")).alias(f"_v{i}")
                              for i, n in enumerate(names)])
    zeros = [F.length(F.col(f"_v{i}")) - F.length(F.regexp_replace(F.col(f"_v{i}"), "0+$", ""))
             for i in range(len(names))]
    head = head.withColumn("_k", F.least(*zeros, F.lit(5)))
    hi, lo = _py_float(F.col("highest_price")), _py_float(F.col("lowest_price"))
    fixed = _blocks(head, [
        (0, [F.lit(STATS_RULE), F.lit(STATS_TITLE), F.lit(STATS_RULE),
             F.lit(STATS_SOURCE + source_label),
             F.concat(F.lit(DATASET), F.col("n").cast("string")),
             F.lit(""), F.lit(PRICE_HEAD),
             F.concat(F.lit(AVERAGE), _py_float(F.col("avg"))),
             F.concat(F.lit(HIGHEST), hi),
             F.concat(F.lit(LOWEST), lo),
             F.lit(""),
             F.concat(F.lit(DEAREST), F.col("most_expensive_title"), F.lit(" ("),
                      hi, F.lit(")")),
             F.concat(F.lit(CHEAPEST), F.col("cheapest_title"), F.lit(" ("), lo,
                      F.lit(")")),
             F.lit(""), F.lit(RATING_HEAD), F.lit(RATING_COLUMNS),
             F.lit(HIST_RULE)]),
        (2, [F.lit(""), F.lit(SUMMARY_HEAD),
             *_describe_lines(), F.lit(DESCRIBE_FOOTER), F.lit(""), F.lit(STATS_RULE),
             F.lit(COMPLETE)])])
    dist = A.rating_distribution(snapshot)
    hist = _lines(dist, 1, [F.concat(F.lit("  "), F.col("rating_numeric").cast("string"),
                                     F.lit("   |  "), fmt.right_align("book_count"),
                                     F.lit("  "), F.col("bar"))],
                  k1=F.lpad(F.col("rating_numeric").cast("string"), 12, "0"))
    return fixed.unionByName(hist)


def _blocks(df: DataFrame, blocks: Sequence[tuple[int, Sequence[Column]]]) -> DataFrame:
    """Fixed lines of several blocks from one row, in one projection (the input is read
    once, whatever the number of blocks)."""
    arr = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(i).alias("sub"),
                             p.cast("string").alias("line"))
                    for b, parts in blocks for i, p in enumerate(parts)])
    nul = F.lit(None).cast("string")
    return (df.select(F.inline(arr))
              .select("block", nul.alias("k1"), nul.alias("k2"), nul.alias("k3"), "sub",
                      "line"))


def change_report(ch: DataFrame, previous: Column | str, latest: Column | str,
                  source_label: str) -> DataFrame:
    """K8: the price change report, one block of lines per dropped / raised product.

    ``ch`` is the output of ``price_changes`` on (title, product_url). Products are listed
    by title and URL inside each section. The change set is read twice: once for the
    summary counts (one aggregate feeding every fixed line) and once for the product
    blocks (drops and hikes in the same pass).
    """
    summary = C.change_summary(ch).select("*", _date_text(previous).alias("_prev"),
                                          _date_text(latest).alias("_last"))
    fixed = _blocks(summary, [
        (0, [F.lit(CHANGE_RULE), F.lit(CHANGE_TITLE), F.lit(CHANGE_RULE),
             F.concat(F.lit(COMPARING), F.col("_prev"), F.lit(ARROW),
                      F.col("_last")),
             F.lit(CHANGE_SOURCE + source_label),
             F.concat(F.lit(CHECKED), F.col("compared").cast("string")),
             F.concat(F.lit(FOUND),
                      F.col("total_changed").cast("string")),
             F.lit(CHANGE_RULE), F.lit(""), F.lit(DROPS_HEAD),
             F.lit(CHANGE_SUBRULE),
             F.when(F.col("drops") == 0, F.lit(NO_DROPS))]),
        (2, [F.lit(HIKES_HEAD), F.lit(CHANGE_SUBRULE),
             F.when(F.col("hikes") == 0, F.lit(NO_HIKES))]),
        (4, [F.lit(CHANGE_RULE), F.lit(SUMMARY_TITLE), F.lit(CHANGE_RULE),
             F.concat(F.lit(SUM_CHECKED), F.col("compared").cast("string")),
             F.concat(F.lit(SUM_DROPS), F.col("drops").cast("string")),
             F.concat(F.lit(SUM_HIKES), F.col("hikes").cast("string")),
             F.concat(F.lit(SUM_TOTAL), F.col("total_changed").cast("string")),
             F.lit(CHANGE_RULE)])])
    pct_txt = F.coalesce(_py_float(F.col("pct")), F.lit("inf"))
    drop = F.col("change") < 0
    change_txt = F.when(drop, F.concat(fmt.money_signed("change"), F.lit(" (")))\
        .otherwise(F.concat(fmt.money_gain("change"), F.lit(" (+")))
    moved = ch.where(F.col("change") != 0).withColumn(
        "_block", F.when(drop, F.lit(1)).otherwise(F.lit(3)))
    products = _lines(moved, 0, [
        F.concat(F.lit("* "), F.col("title")),
        F.concat(F.lit(OLD_PRICE), fmt.money("price_old"), F.lit(NEW_PRICE),
                 fmt.money("price_new"), F.lit(CHANGE_BY), change_txt, pct_txt,
                 F.lit("%)")),
        F.concat(F.lit(LINK), F.col("product_url")), F.lit("")],
        k1=F.col("title"), k2=F.col("product_url"), block_col=F.col("_block"))
    return fixed.unionByName(products).where(F.col("line").isNotNull())


def ordered(lines: DataFrame) -> DataFrame:
    return lines.orderBy(*[F.col(c).asc_nulls_first() for c in KEY_COLS])


def write_report(lines: DataFrame, path: str) -> None:
    """Write the lines in report order as text (range-sorted; part files are in order)."""
    ordered(lines).select("line").write.mode("overwrite").text(path)
