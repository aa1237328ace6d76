from decimal import Decimal

from pyspark.sql import functions as F

from shelfwatch.functions import clean as X
from shelfwatch.functions import fmt


def test_rating_values(spark):
    vals = ["One", "Two", "Three", "Four", "Five", "one", "4", " 3 ", "3.7", "3d", "N/A", "",
            None]
    want = [1, 2, 3, 4, 5, 0, 4, 3, 3, 0, 0, 0, 0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, r string")
    got = [r.n for r in df.select("i", X.parse_rating("r").alias("n")).orderBy("i").collect()]
    assert got == want


def test_price_text(spark):
    vals = ["£51.77", "Â£51.77", "1.2.3", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, t string")
    got = [r.p for r in df.select("i", X.clean_price("t").alias("p")).orderBy("i").collect()]
    assert got == [Decimal("51.77"), Decimal("51.77"), None, None, None]


def test_stock_text(spark):
    vals = ["In stock (22 available)", "In stock", "2 of 22", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, t string")
    got = [r.s for r in df.select("i", X.clean_stock("t").alias("s")).orderBy("i").collect()]
    assert got == [22, 0, 222, 0]


def test_url_resolution(spark):
    df = spark.createDataFrame([("catalogue/a_1/index.html", "catalogue/page-2.html"),
                                ("a_1/index.html", "page-3.html"),
                                ("../../a_1/index.html", None)], "h string, n string")
    rows = df.select(X.resolve_product_url("h").alias("u"),
                     X.resolve_next_url("n").alias("nx")).collect()
    assert rows[0].u == "https://books.toscrape.com/catalogue/a_1/index.html"
    assert rows[0].nx == "https://books.toscrape.com/catalogue/page-2.html"
    assert rows[1].u == "https://books.toscrape.com/catalogue/a_1/index.html"
    assert rows[1].nx == "https://books.toscrape.com/catalogue/page-3.html"
    assert rows[2].u == "https://books.toscrape.com/catalogue/../../a_1/index.html"
    assert rows[2].nx is None


def test_formats(spark):
    df = spark.createDataFrame([(Decimal("51.77"), Decimal("-5.78"), -11.16, 1234567)],
                               "p decimal(10,2), c decimal(11,2), pct double, n long")
    r = df.select(fmt.money("p").alias("a"), fmt.money_drop("c").alias("b"),
                  fmt.money_gain(F.abs("c")).alias("c2"), fmt.percent("pct").alias("d"),
                  fmt.percent_gain(F.abs("pct")).alias("e"), fmt.thousands("n").alias("f"),
                  fmt.star_bar(F.lit(226)).alias("g"), fmt.right_align(F.lit(7)).alias("h"),
                  fmt.plain_number(F.lit(10.0)).alias("i")).first()
    assert (r.a, r.b, r.c2, r.d, r.e, r.f) == ("£51.77", "-£5.78", "+£5.78", "-11.16%",
                                                "+11.16%", "1,234,567")
    assert r.g == "*" * 22 and r.h == "  7" and r.i == "10.0"
