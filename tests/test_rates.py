"""Rates kept while messages stream in, against the same figures of all messages at once."""

import datetime as dt

from pyspark.sql import functions as F

from logweir.plans import staging
from logweir.session import list_names, session_conf
from logweir.sources.topics import FileTopics
from logweir.streaming import rates as L

DDL = "_log_type string, event_time timestamp, _reason string"
START = dt.datetime(2024, 1, 1)
NOW = {"availableNow": True}


def send(spark, path, rows):
    made = [(kind, START + dt.timedelta(minutes=minute), reason) for kind, minute, reason in rows]
    spark.createDataFrame(made, DDL).coalesce(1).write.mode("append").parquet(path)


def step(spark, tmp_path, rows, delay, fold_every=100):
    """Send one file of messages and run the query over it."""
    send(spark, f"{tmp_path}/in", rows)
    stream = spark.readStream.schema(DDL).parquet(f"{tmp_path}/in")
    query = L.start_rates(L.rates(stream, "1 hour", delay), f"{tmp_path}/out", f"{tmp_path}/state", NOW, fold_every)
    query.awaitTermination()
    return query


def figures(found):
    return {(r._log_type, r.period): (r.messages, r.invalid) for r in found.collect()}


def test_late_rows_within_the_delay_equal_the_batch_figures(spark, tmp_path):
    assert figures(L.read_rates(spark, f"{tmp_path}/out")) == {}
    files = [
        [("a", 5, None), ("a", 59, "bad_type"), ("b", 70, None)],
        [("a", 190, None), ("a", 6, None), (None, 10, "no_envelope")],  # two hours late
        [("b", 71, "malformed"), ("a", 60, None), ("a", 5, None)],
        [("b", 400, None)],
    ]
    for rows in files:
        step(spark, tmp_path, rows, "12 hours", fold_every=2)
        got = figures(L.read_rates(spark, f"{tmp_path}/out"))
        assert got == figures(L.rates(spark.read.schema(DDL).parquet(f"{tmp_path}/in")))
    assert got["a", START] == (4, 1) and got[None, START] == (1, 1)
    names = list_names(spark, f"{tmp_path}/out")
    assert sum(n.startswith("base-") for n in names) == 1 and len(names) <= 3


def test_too_late_rows_are_left_out_and_state_is_bounded(spark, tmp_path):
    held, late = [], 0
    for hour in range(0, 40, 10):
        query = step(spark, tmp_path, [("a", 60 * (hour + i), None) for i in range(10)], "2 hours")
        held.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 12
    before = figures(L.read_rates(spark, f"{tmp_path}/out"))
    assert before == figures(L.rates(spark.read.schema(DDL).parquet(f"{tmp_path}/in")))
    query = step(spark, tmp_path, [("a", 1, None), ("a", 60 * 39 + 1, None)], "2 hours")
    assert L.late_groups(query) == 1
    after = figures(L.read_rates(spark, f"{tmp_path}/out"))
    newest = ("a", START + dt.timedelta(hours=39))
    assert after == before | {newest: (2, 0)}


def test_a_batch_that_runs_again_and_a_half_written_fold(spark, tmp_path):
    write = L._Updates(f"{tmp_path}/out", 2)
    one = spark.createDataFrame([("a", START, 3, 1)], L._DDL)
    two = spark.createDataFrame([("a", START, 5, 1)], L._DDL)
    write(one, 0)
    write(one, 1)
    write(two, 1)
    assert figures(L.read_rates(spark, f"{tmp_path}/out")) == {("a", START): (5, 1)}
    two.limit(0).write.parquet(f"{tmp_path}/out/base-000000000001")
    (tmp_path / "out" / "base-000000000001" / "_SUCCESS").unlink()
    assert figures(L.read_rates(spark, f"{tmp_path}/out")) == {("a", START): (5, 1)}
    for _ in range(2):  # the batch that folds, again
        write(two.withColumn("messages", F.lit(6).cast("long")), 2)
        assert figures(L.read_rates(spark, f"{tmp_path}/out")) == {("a", START): (6, 1)}
    assert list_names(spark, f"{tmp_path}/out") == ["base-000000000001", "batch-000000000002"]


def test_state_has_tasks_of_its_own_behind_the_writing_one(spark, tmp_path):
    send(spark, f"{tmp_path}/in", [("a", 60 * hour, None) for hour in range(40)])
    stream = spark.readStream.schema(DDL).parquet(f"{tmp_path}/in")
    with session_conf(spark, {"spark.sql.shuffle.partitions": "30"}):
        query = L.start_rates(L.rates(stream), f"{tmp_path}/out", f"{tmp_path}/state", NOW, state_tasks=3)
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "30"
    assert {p["stateOperators"][0]["numShufflePartitions"] for p in query.recentProgress} == {3}
    tasks = spark.range(0, 50, 1, 5).select(F.lit("a").alias("_log_type"), F.lit(START).alias("period"),
                                            F.spark_partition_id().cast("long").alias("messages"), F.lit(0).cast("long").alias("invalid"))
    L._Updates(f"{tmp_path}/written", 100)(tasks, 0)
    assert {r.messages for r in spark.read.parquet(f"{tmp_path}/written/batch-000000000000").collect()} == set(range(5))


def test_batches_do_not_follow_the_number_of_files(spark, tmp_path):
    topics = FileTopics(f"{tmp_path}/topics")
    for files, each in ((3, 1), (30, 5)):
        spark.range(100).selectExpr("'k' AS key", "'v' AS value").repartition(files).write.parquet(topics.path(f"t{files}"))
        assert staging.in_batches(spark, topics, f"t{files}", 6).max_files_per_trigger == each
