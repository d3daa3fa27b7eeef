"""Sketches, bitmaps and as-of features beside plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logweir.operators import engagement, features, sketches
from tests.test_plans import plan_of

DAY0 = dt.date(2024, 1, 1)


def test_merged_sketches_keep_their_rank_error(spark, tmp_path):
    n, k = 60_000, 400
    calls = spark.range(n).select((F.date_add(F.lit(DAY0), (F.col("id") % 30).cast("int"))).alias("metric_date"),
                                  F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("service_name"),
                                  F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("response_time_ms"))
    path = f"{tmp_path}/latency"
    sketches.refresh(sketches.daily_latency(calls, ["service_name"], k=k), path, "metric_date")
    before = sketches.latency_over(sketches.read(spark, path, "metric_date"), ["service_name"]).collect()
    late = calls.where(F.col("metric_date") == F.lit(DAY0))
    sketches.refresh(sketches.daily_latency(late, ["service_name"], k=k), path, "metric_date")  # a day again adds nothing
    again = sketches.latency_over(sketches.read(spark, path, "metric_date"), ["service_name"]).collect()
    assert sorted((r.service_name, r.calls, r.avg_ms) for r in before) == sorted((r.service_name, r.calls, r.avg_ms) for r in again)
    assert sum(r.calls for r in again) == n
    for r in again:
        values = [x[0] for x in calls.where((F.col("service_name") == r.service_name) & F.col("response_time_ms").isNotNull()).select("response_time_ms").collect()]
        rank = sum(v <= r.p95_ms for v in values) / len(values)
        assert abs(rank - 0.95) < 2.3 / k
        assert (r.min_ms, r.max_ms) == (min(values), max(values))


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_quantiles_beyond_what_a_sketch_keeps_are_exact(spark, p):
    rows = spark.range(30_000).select(F.date_add(F.lit(DAY0), (F.col("id") % 30).cast("int")).alias("metric_date"),
                                      F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 > 0, "b").alias("service_name"),
                                      F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64("id"), F.lit(9_000))).alias("response_time_ms"))
    rows = rows.unionByName(spark.createDataFrame([(DAY0, "none", None)], rows.schema))
    daily, values = sketches.daily_latency(rows, ["service_name"], k=8), sketches.daily_values(rows, ["service_name"])
    name = f"p{round(100 * p)}_ms"
    for k in (8, 100_000):  # the second claims a smaller error than the sketches have, so bounds miss
        got = {r.service_name: r for r in sketches.exact_over(daily, values, ["service_name"], p, k).collect()}
        assert got.keys() == {"hot", "b", None, "none"} and got["none"][name] is None and got["none"].calls == 1
        for key in ("hot", "b", None):
            held = sorted(r[0] for r in rows.where(F.col("service_name").eqNullSafe(key)).select("response_time_ms").collect() if r[0] is not None)
            assert got[key][name] == held[max(-(-len(held) * round(100 * p) // 100), 1) - 1]
            assert (got[key].min_ms, got[key].max_ms) == (held[0], held[-1])


def test_month_reads_only_sketches_of_its_days(spark, tmp_path):
    calls = spark.range(300).select(F.date_add(F.lit(DAY0), (F.col("id") % 30).cast("int")).alias("metric_date"), F.lit("s").alias("service_name"),
                                    F.col("id").alias("response_time_ms"))
    sketches.refresh(sketches.daily_latency(calls, ["service_name"]), f"{tmp_path}/l", "metric_date")
    week = sketches.read(spark, f"{tmp_path}/l", "metric_date", "2024-01-08", "2024-01-15")
    out = sketches.latency_over(week, ["service_name"])
    text = plan_of(out)
    assert text.count("FileScan parquet") == 1 and "latency" in text and "PartitionFilters: [isnotnull(metric_date" in text
    assert out.collect()[0].calls == 70
    with pytest.raises(ValueError, match="no sketch table"):
        sketches.read(spark, f"{tmp_path}/none", "metric_date")


def test_sketches_of_nothing_and_of_nulls(spark, tmp_path):
    rows = spark.createDataFrame([(DAY0, "a", None), (DAY0, "b", 5)], "metric_date date, service_name string, response_time_ms long")
    got = {r.service_name: r for r in sketches.latency_over(sketches.daily_latency(rows, ["service_name"]), ["service_name"]).collect()}
    assert (got["a"].calls, got["a"].p95_ms, got["a"].avg_ms) == (1, None, None) and got["b"].p95_ms == 5
    assert sketches.latency_over(sketches.daily_latency(rows.limit(0), ["service_name"]), ["service_name"]).collect() == []


def test_active_users_and_retention(spark):
    rng = random.Random(7)
    seen = [(DAY0 + dt.timedelta(rng.choice([0, 1, 2, 5, 6, 9, 36, 40])), f"u{int(rng.paretovariate(0.7)) % 90}") for _ in range(700)]
    seen += [(DAY0, None), (None, "u1"), (None, "only_here")]
    events = spark.createDataFrame(seen, "event_date date, user_id string")
    numbers = engagement.user_numbers(events, lanes=4)
    daily = engagement.daily_bitmaps(events, numbers)
    plain = [(d, u) for d, u in seen if d and u]
    want = {day: tuple(len({u for d, u in plain if day - dt.timedelta(w) < d <= day}) for w in (1, 7, 30)) for day in {d for d, _ in plain}}
    assert {r.day: tuple(r)[1:] for r in engagement.active_users(daily).collect()} == want
    first = {}
    for d, u in plain:
        first[u] = min(first.get(u, d), d)
    kept = {}
    for d, u in set(plain):
        if (d - first[u]).days <= 30:
            kept[first[u], (d - first[u]).days] = kept.get((first[u], (d - first[u]).days), 0) + 1
    assert {(r.cohort, r.days_later): r.users for r in engagement.retention(daily, engagement.cohort_bitmaps(events, numbers)).collect()} == kept


def test_user_numbers_are_dense_and_stable(spark):
    users = spark.range(100_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    numbers = engagement.user_numbers(users)
    assert numbers.select("number").distinct().count() == 100_000
    assert numbers.agg(F.min("number"), F.max("number")).first()[1] < 140_000
    assert numbers.exceptAll(engagement.user_numbers(users.repartition(7))).count() == 0
    days = engagement.daily_bitmaps(users.withColumn("event_date", F.lit(DAY0)), numbers)
    assert days.count() > 1 and engagement.active_users(days).first().active_30 == 100_000


def as_of(labels, known, days=None):
    out = []
    for key, at, n in labels:
        fits = [(t, v, w) for k, t, v, w in known if key is not None and k == key and at is not None and t is not None and t <= at]
        best = max(fits, key=lambda f: (f[0], f[1] is not None, f[1] or 0, f[2]), default=(None, None, None))
        if days is not None and best[0] is not None and at - best[0] > dt.timedelta(days=days):
            best = (None, None, None)
        out.append((key, at, n, best[1], best[2], best[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("days", [None, 3])
def test_no_feature_is_later_than_its_label(spark, days):
    rng = random.Random(5)

    def moment():
        return None if rng.random() < 0.02 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(0, 30 * 1440, 15))

    def key():
        return rng.choices(["hot", "a", "b", None, "lonely"], [10, 3, 3, 1, 0.2])[0]

    labels = [(key(), moment(), i) for i in range(400)]
    known = [(key(), moment(), rng.choice([None, 1, 2, 3]), f"w{i}") for i in range(300)] + [("x", dt.datetime(2024, 1, 1), 1, "w")]
    left = spark.createDataFrame(labels, "user string, timestamp timestamp_ntz, n int")
    right = spark.createDataFrame(known, "user string, timestamp timestamp_ntz, v int, w string")
    got = features.as_of_join(left, right, ["user"], ["v", "w"], max_age=None if days is None else f"{days} days")
    assert got.columns == ["user", "timestamp", "n", "v", "w", "feature_at"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == as_of(labels, known, days)
    assert all(r[5] is None or r[5] <= r[1] for r in rows)


def test_as_of_join_of_empty_sides(spark):
    labels = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], "user string, timestamp timestamp, n int")
    known = spark.createDataFrame([], "user string, timestamp timestamp, v int")
    assert [tuple(r)[2:] for r in features.as_of_join(labels, known, ["user"], ["v"]).collect()] == [(1, None, None)]
    assert features.as_of_join(labels.limit(0), known, ["user"], ["v"]).collect() == []


def test_hot_key_is_dealt_by_slot(spark):
    labels = spark.range(10).select(F.lit("a").alias("user"), F.timestamp_seconds("id").alias("timestamp"))
    text = plan_of(features.as_of_join(labels, labels.withColumn("v", F.lit(1)), ["user"], ["v"]))
    assert "hashpartitioning(_k0" in text and "_slot" in text.split("hashpartitioning(_k0", 1)[1]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
