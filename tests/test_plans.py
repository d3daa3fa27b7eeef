"""What the physical plans look like: pushdown, shuffles, joins, parsing."""

import pytest
from pyspark.sql import functions as F

from logweir.functions import envelope as E
from logweir.operators import reports as R
from logweir.plans import all_queries
from logweir.plans.views import view


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


REPORTS = [n for n in all_queries() if n[:3] in ("agg", "ts1", "ts2", "ts3", "top", "jon", "set", "uc1", "uc4", "flt")
           and n not in ("agg19_table_growth", "top2_first_ingested", "top2_last_ingested", "flt1_route_by_type")]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_stay_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    text = plan_of(all_queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "ArrowEval"):
        assert bad not in text


def test_day_filter_reaches_the_scan(spark, sf_dir):
    text = plan_of(R.service_latency_on(view(spark, sf_dir, "api_metrics"), "2024-01-05"))
    assert "GreaterThanOrEqual(ts,2024-01-05" in text and "LessThan(ts,2024-01-06" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_encode_and_decode_do_not_shuffle(spark, sf_dir, config):
    c = config("api_metrics", "d")
    messages = E.encode(view(spark, sf_dir, "api_metrics"), c)
    good = E.records(E.classify(messages, [c]), c)
    assert "Exchange" not in plan_of(good) and "Exchange" not in plan_of(E.decode(messages, c))


def test_each_message_is_parsed_once_per_schema(spark, sf_dir, config):
    c = config("api_metrics", "d")
    messages = E.encode(view(spark, sf_dir, "api_metrics"), c)
    assert plan_of(E.records(E.classify(messages, [c]), c)).count("from_json(") == 2
    assert plan_of(E.decode(messages, c)).count("from_json(") == 1


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(R.newest(view(spark, sf_dir, "user_events"), 5))


def test_hot_key_is_counted_before_the_key_comes_together(spark):
    """A third of all rows under one key: its values are counted under (key, value) first."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 997).alias("v"),
    )
    exact = R.percentile_by(rows, ["k"], "v", 0.95, "p")
    text = plan_of(exact)
    assert "hashpartitioning(k" in text and text.index("Window") < text.rindex("partial_count")
    want = {r.k: r.p for r in rows.groupBy("k").agg(F.percentile("v", 0.95).alias("p")).collect()}
    got = {r.k: r.p for r in exact.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_percentile_ignores_nulls_and_handles_one_value(spark):
    rows = spark.createDataFrame([("a", 5), ("a", None), ("b", None), ("c", 1), ("c", 2)], "k string, v long")
    got = {r.k: r.p for r in R.percentile_by(rows, ["k"], "v", 0.5, "p").collect()}
    assert got == {"a": 5.0, "b": None, "c": 1.5}
