"""Property tests: the Spark scalars against the pandas / Python behaviour they replace."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwatch.functions import clean as X

WORDS = ["One", "Two", "Three", "Four", "Five", "one", "N/A", ""]
text = st.one_of(st.sampled_from(WORDS),
                 st.text(alphabet="0123456789.+-eE ", min_size=0, max_size=8))


def pandas_rating(values):
    s = pd.Series(values, dtype=object)
    mapped = s.map(X.RATING_WORDS)
    numeric = pd.to_numeric(s, errors="coerce")
    out = []
    for m, n in zip(mapped, numeric):
        v = m if not pd.isna(m) else n
        if pd.isna(v) or math.isinf(v) or abs(v) >= 2 ** 31:
            out.append(0)          # NaN -> 0; out-of-range values are not ratings
        else:
            out.append(int(v))
    return out


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(text, min_size=1, max_size=40))
def test_rating_parse_equals_pandas(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, r string")
    got = [r.n for r in df.select("i", X.parse_rating("r").alias("n")).orderBy("i").collect()]
    assert got == pandas_rating(values)


def python_stock(value):
    digits = "".join(c for c in value if c.isdigit())
    return int(digits) if digits and int(digits) < 2 ** 31 else 0


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="In stock()0123456789 av", max_size=30), min_size=1,
                max_size=30))
def test_stock_parse_equals_python(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    got = [r.s for r in df.select("i", X.clean_stock("t").alias("s")).orderBy("i").collect()]
    assert got == [python_stock(v) for v in values]
