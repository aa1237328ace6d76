"""Plan shapes: what is summed below the join, pushed to the scan, or kept from one task."""
import re

import pytest

from shelfwatch.operators import analytics as A
from shelfwatch.operators import search as SR
from shelfwatch.operators import snapshots as S
from shelfwatch.sources import binding as B

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("rollup", [A.star_total_records, A.star_average_price, A.star_category_counts,
                                    A.star_category_avg_price, A.star_category_stock, A.star_observation_counts])
def test_rollups_sum_the_fact_before_the_join(spark, no_broadcast, rollup):
    text = plan(rollup(A.product_totals(B.fact(spark, SF), B.catalog(spark, SF))))
    join = text.index("SortMergeJoin")
    fact = text.index("functions=[partial_", join)                  # below the join
    exchange = text.index("Exchange hashpartitioning(upc", join)
    assert exchange < fact < text.index("FileScan", fact)


def test_price_bounds_reach_the_scan(spark):
    snap = S.latest_snapshot(B.books(spark, SF), B.fact(spark, SF))
    text = plan(SR.search_catalog(snap, SR.SearchSpec(price_min=900.5, price_max=950)))
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\n]*", text))
    assert "GreaterThanOrEqual(price,900.5" in pushed and "LessThanOrEqual(price,950" in pushed


def test_full_history_sorts_by_more_than_the_date(spark):
    text = plan(S.full_history(B.books(spark, SF)))
    assert re.search(r"Exchange rangepartitioning\(date_collected[^)]*upc", text)
