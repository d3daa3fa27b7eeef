"""Drift between files, catalog and config; origin of quarantined messages."""

import dataclasses

from pyspark.sql import functions as F

from logweir.functions.envelope import encode, with_ingestion_time
from logweir.operators import drift, quality, tables
from logweir.sources.configs import Field
from logweir.sources.topics import FileTopics
from logweir.streaming.ingest import start_ingest


def rows(spark, n):
    return with_ingestion_time(spark.range(n).selectExpr(
        "timestamp'2024-01-01 10:00:00' AS timestamp", "date'2024-01-01' AS event_date",
        "concat('user_', id) AS user_id", "'click' AS event_type", "CAST(id AS INT) AS code"))


def test_drift_of_added_widened_removed_and_refused_fields(spark, tmp_path, config, database):
    base = config("demo_events", database)
    first = dataclasses.replace(base, fields=(*base.fields, Field("code", "int", required=False), Field("old", "string", required=False)))
    try:
        tables.ensure_table(spark, first, str(tmp_path))
        tables.append_batch(rows(spark, 30).withColumn("old", F.lit("x")), first, 0)
        assert drift.drift(spark, first).where("files_lacking + files_other_type > 0").count() == 0
        later = dataclasses.replace(base, fields=(*base.fields, Field("code", "long", required=False), Field("fresh", "double", required=False)))
        tables.ensure_table(spark, later, str(tmp_path))
        tables.append_batch(rows(spark, 12).withColumn("code", F.col("code").cast("long")).withColumn("fresh", F.lit(1.0)), later, 1)
        before = spark.table(later.table).schema
        found = {r.field: r for r in drift.drift(spark, later).collect()}
        assert {f: (r.rows_lacking, r.rows_other_type) for f, r in found.items() if r.rows_lacking or r.rows_other_type} == {
            "code": (0, 30), "fresh": (30, 0)}  # a field that left the config is written as NULL, so files still hold it
        assert found["code"].stored_types == ["bigint", "int"] and found["code"].files_other_type == 1
        assert found["old"].config_type is None and found["old"].table_type == "string"
        assert "event_date" not in found and all(r.row_count == 42 and r.files == 2 for r in found.values())
        refused = dataclasses.replace(later, fields=tuple(dataclasses.replace(f, type="int") if f.name == "user_id" else f for f in later.fields))
        wrong = {r.field: r for r in drift.drift(spark, refused).collect()}["user_id"]
        assert (wrong.config_type, wrong.table_type, wrong.rows_other_type) == ("int", "string", 42)
        assert spark.table(later.table).schema == before and spark.table(later.table).count() == 42
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_drift_reads_footers_only_and_an_empty_table_gives_nothing(spark, tmp_path, config, database):
    empty = config("demo_events", database)
    try:
        tables.ensure_table(spark, empty, str(tmp_path))
        assert drift.drift(spark, empty).count() == 0
        plan = drift.footers(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<path:string>" in plan
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_files_other_writers_left_are_read_too(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": pa.array([1, 2], pa.int32()), "b": ["x", None]}), f"{tmp_path}/a file%20é.parquet")
    got = drift.footers(spark, str(tmp_path)).collect()
    assert [(r.row_count, r.stored) for r in got] == [(2, {"a": "int", "b": "string"})]


def test_rejects_keep_their_origin(spark, tmp_path, config, database):
    demo = config("demo_events", database)
    for kind in ("parquet", "text"):
        topics = FileTopics(f"{tmp_path}/{kind}", format=kind)
        good = encode(rows(spark, 20).drop("code"), demo).select("key", "value")
        bad = spark.range(5).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("broken "), "id").alias("value"))
        topics.publish(good.unionAll(bad).repartition(3), demo.topic)
        here = dataclasses.replace(demo, table=f"{database}_{kind}.demo_events")
        try:
            start_ingest(spark, [here], topics, f"{tmp_path}/w_{kind}", f"{tmp_path}/c_{kind}", trigger={"availableNow": True}).finish()
            rejected = tables.read_table(spark, f"{database}_{kind}.quarantine")
            got = quality.origin_check(rejected, topics.read(spark, demo.topic)).collect()
            assert [(r.topic, r.messages, r.found_at_origin) for r in got] == [(demo.topic, 5, 5 if kind == "parquet" else 0)]
            assert rejected.where("topic_partition IS NULL OR produced_at IS NULL").count() == 0
            assert rejected.where("topic_offset IS NULL").count() == (0 if kind == "parquet" else 5)
        finally:
            spark.sql(f"DROP DATABASE IF EXISTS {database}_{kind} CASCADE")
