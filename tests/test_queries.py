"""Every registered query gives the rows its SQL gives."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from logweir.plans.views import view
from tests.compare import difference, oracle

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    assert difference(duck, QUERIES[name](spark, sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_return_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert set(rows.columns) == {"endpoint", "service_name", "error_rate_pct", "total_requests"}
    assert rows.count() > 0


def test_sketch_of_p95_has_the_right_rank(spark, sf_dir):
    calls = view(spark, sf_dir, "api_metrics").where("metric_date = DATE'2024-01-05'")
    for name, value in QUERIES["agg11_p95_by_service_approx"](spark, sf_dir).collect():
        ms = sorted(r[0] for r in calls.where(F.col("service_name") == name).select("response_time_ms").collect())
        assert sum(v < value for v in ms) <= 0.95 * len(ms) <= sum(v <= value for v in ms)


def test_sketches_of_distinct_counts_are_close(spark, sf_dir):
    exact = {r["user_id"]: r for r in QUERIES["agg13_user_behaviour"](spark, sf_dir).collect()}
    for r in QUERIES["agg13_user_behaviour_approx"](spark, sf_dir).collect():
        assert r["total_events"] == exact[r["user_id"]]["total_events"]
        assert abs(r["sessions"] - exact[r["user_id"]]["sessions"]) <= 1
