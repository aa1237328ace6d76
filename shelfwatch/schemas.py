"""Canonical table schemas (explicit; nothing is ever inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)

# Product dimension: one row per upc.
CATALOG = T.StructType([
    T.StructField("upc", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("category", T.StringType(), True),
    T.StructField("product_url", T.StringType(), False),
])

# Price fact, stored partitioned by date_collected; (upc, date_collected) is unique.
HISTORY = T.StructType([
    T.StructField("upc", T.StringType(), True),
    T.StructField("price", PRICE, False),
    T.StructField("rating", T.StringType(), True),
    T.StructField("stock_quantity", T.IntegerType(), True),
    T.StructField("ingest_seq", T.LongType(), False),
    T.StructField("date_collected", T.DateType(), False),
])

# The wide snapshot row (flat `books` view and the CSV snapshot / log files).
WIDE = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("price", PRICE, True),
    T.StructField("rating", T.StringType(), True),
    T.StructField("product_url", T.StringType(), True),
    T.StructField("date_collected", T.DateType(), True),
    T.StructField("upc", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("stock_quantity", T.IntegerType(), True),
])

WIDE_COLUMNS = [f.name for f in WIDE.fields]

# Header names of the CSV files written by the extraction job, in file order.
CSV_HEADER = ["Title", "Price", "Rating", "URL", "Date_Collected", "UPC", "Category",
              "Stock_Quantity"]

# CSV schema as it lies on disk (Rating may be a word or a number, so it stays text).
CSV_SCHEMA = T.StructType([
    T.StructField("Title", T.StringType(), True),
    T.StructField("Price", T.StringType(), True),
    T.StructField("Rating", T.StringType(), True),
    T.StructField("URL", T.StringType(), True),
    T.StructField("Date_Collected", T.StringType(), True),
    T.StructField("UPC", T.StringType(), True),
    T.StructField("Category", T.StringType(), True),
    T.StructField("Stock_Quantity", T.StringType(), True),
])

# The one CSV dialect of all readers and writers: quotes are doubled inside quotes, blanks
# belong to the value, empty text is written as "" and NULL as nothing.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "encoding": "UTF-8",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Reading, Spark takes an empty value for NULL; a quoted one comes as this mark until parsed.
CSV_EMPTY = "\u0001empty\u0001"
CSV_READ = {**CSV_DIALECT, "emptyValue": CSV_EMPTY, "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": "corrupt_record"}
CSV_WRITE = {**CSV_DIALECT, "emptyValue": '""'}
