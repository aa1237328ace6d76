"""Date-over-date changes: pairs, orders, and the lines of the change report."""

import datetime as dt
from decimal import Decimal

from shelfwatch.operators import analytics as A
from shelfwatch.operators import changes as C
from shelfwatch.operators import snapshots as S
from shelfwatch.plans import reports as R

OLD, NEW = dt.date(2026, 3, 30), dt.date(2026, 4, 2)
SCHEMA = "title string, product_url string, upc string, category string, price decimal(10,2), date_collected date"

#: title, url, old price, new price; and the change and percentage that follow.
CASES = [
    ("gauge", "/g", "40.00", "30.00", "-10.00", -25.0),
    ("gauge", "/g2", "12.00", "9.00", "-3.00", -25.0),          # ties with the one before
    ("valve", "/v", "200.00", "199.99", "-0.01", 0.0),          # rounds to nothing, half to even
    ("hinge", "/h", "8.00", "9.00", "1.00", 12.5),
    ("bolt", "/b", "80.00", "90.00", "10.00", 12.5),
    ("nut", "/n", "3.00", "3.00", "0.00", 0.0),
    ("gift", "/gift", "0.00", "4.00", "4.00", None),            # from zero: no percentage
    ("was unknown", "/q", None, "4.00", None, None),
    ("now unknown", "/q", "4.00", None, None, None),
    ("no link", None, "6.00", "7.50", "1.50", 25.0),            # NULL keys meet each other
]


def money(text):
    return None if text is None else Decimal(text)


def books(spark, cases=CASES):
    rows = []
    for title, url, old, new, *_ in cases:
        rows += [(title, url, f"{title}{url}", "c", money(old), OLD), (title, url, f"{title}{url}", "c", money(new), NEW)]
    rows += [("only then", "/o", "o", "c", Decimal("1.00"), OLD), ("only now", "/p", "p", "c", Decimal("1.00"), NEW)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def changes(spark, cases=CASES):
    return C.latest_changes(books(spark, cases), keys=C.URL_KEYS, carry=())


def test_changes_of_every_case(spark):
    got = {(r.title, r.product_url): (r.change, r.pct) for r in changes(spark).collect()}
    assert got == {(t, u): (money(change), pct) for t, u, _, _, change, pct in CASES}
    s = C.change_summary(changes(spark)).first()
    assert (s.compared, s.drops, s.hikes, s.total_changed) == (10, 3, 4, 9)
    assert C.changed(changes(spark)).count() == 9               # an unknown change counts as one


def test_whole_order_of_drops_and_hikes(spark):
    """By percentage, unknown ones last, ties by title and link."""
    ch = changes(spark)
    assert [(r.title, r.product_url) for r in C.drops(ch).collect()] == [("gauge", "/g"), ("gauge", "/g2"), ("valve", "/v")]
    assert [r.title for r in C.hikes(ch).collect()] == ["no link", "bolt", "hinge", "gift"]
    assert [r.product_url for r in C.drops(ch, 25).collect()] == ["/g", "/g2"]
    assert C.drops(ch, 25.01).count() == 0


def test_whole_order_of_history_and_ratings(spark):
    """By date, then product; O7: by stars."""
    got = [(r.date_collected, r.upc) for r in S.full_history(books(spark)).collect()]
    assert got == sorted(got) and len(got) == 22
    rated = spark.createDataFrame([(r,) for r in ["Five", "One", "4", "Two", "One", "x", None]], "rating string")
    rows = A.rating_distribution(rated).collect()
    stars = [r.rating_numeric for r in rows]
    assert stars == sorted(stars) == [0, 1, 2, 4, 5] and [r.book_count for r in rows] == [2, 2, 1, 1, 1]


def test_one_date_has_no_changes(spark):
    ch = C.latest_changes(books(spark).where(f"date_collected = DATE'{OLD}'"), keys=C.URL_KEYS, carry=())
    assert ch.count() == 0


def report_lines(cases, label):
    """The report in its fixed layout, put together line by line."""
    thick, thin = "=" * 65, "-" * 65
    moved = [c for c in sorted(cases, key=lambda c: (c[0], c[1] or "")) if c[4] is not None]
    drops, hikes = ([c for c in moved if (money(c[4]) < 0) == down and money(c[4])] for down in (True, False))

    def block(case):
        title, url, old, new, change, pct = case
        sign = "" if change.startswith("-") else "+"
        by = f"£{change}" if change.startswith("-") else f"+£{change}"
        link = [f"  Link: {url}"] if url else []
        return [f"* {title}", f"  Old Price: £{old}  |  New Price: £{new}  |  Change: {by} "
                f"({sign}{'inf' if pct is None else pct}%)", *link, ""]

    def section(head, found, none):
        return [head, thin, *([none] if not found else [x for c in found for x in block(c)])]

    total = len(drops) + len(hikes) + sum(c[4] is None for c in cases)
    return [thick, "         PRICE CHANGE DETECTOR REPORT", thick, f"Comparing date: {OLD}  -->  {NEW}", f"Data Source:    {label}",
            f"Total books checked: {len(cases)}", f"Total price changes found: {total}", thick, "",
            *section("[DECREASE] Price Drops (Good Deals):", drops, "  No price drops found."),
            *section("[INCREASE] Price Hikes (More Expensive):", hikes, "  No price increases found."),
            thick, " " * 23 + "SUMMARY", thick, f"  Checked Books   : {len(cases)}", f"  Price Drops     : {len(drops)}",
            f"  Price Hikes     : {len(hikes)}", f"  Total Changes   : {total}", thick]


def lines_of(spark, cases, label):
    report = R.change_report(changes(spark, cases), str(OLD), str(NEW), label)
    return [r.line for r in R.ordered(report).collect()]


def test_report_of_every_case(spark):
    assert lines_of(spark, CASES, "Warehouse") == report_lines(CASES, "Warehouse")


def test_report_without_any_change(spark):
    same = [c for c in CASES if c[0] == "nut"]
    got = lines_of(spark, same, "CSV")
    assert got == report_lines(same, "CSV")
    assert "  No price drops found." in got and "  No price increases found." in got
