"""Table lifecycle: each query writes a table of its own and reads back what is left in it."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Window, functions as F

from logweir.functions.envelope import with_ingestion_time
from logweir.functions.types import record_schema
from logweir.operators import history, reports as R, tables
from logweir.plans import log_types, staging as S
from logweir.plans.ingest_queries import API, API_SQL
from logweir.plans.registry import query
from logweir.plans.views import view

PER_PARTITION = "SELECT metric_date, service_name, count(*) AS row_count FROM api_metrics"


@query("tbl6_widened_types", """
    SELECT event_id, CASE WHEN log_ts < TIMESTAMP '2024-01-16 00:00:00' THEN response_time_ms
                          ELSE event_id * 4000000000 END AS code,
           CASE WHEN log_ts < TIMESTAMP '2024-01-16 00:00:00' THEN CAST(event_id % 64 AS DOUBLE) / 8
                ELSE response_time_ms / 3.0::DOUBLE END AS ratio
    FROM api_metrics""")
def _(spark, sf):
    """int -> long and float -> double: old files stay as they are, new ones are written wide."""
    stage = S.new_table(spark, "demo_events", ("event_id long", "code int", "ratio float"))
    narrow = stage.configs["demo_events"]
    wider = {"code": "long", "ratio": "double"}
    wide = dataclasses.replace(
        narrow, fields=tuple(dataclasses.replace(f, type=wider.get(f.name, f.type)) for f in narrow.fields)
    )
    rows = with_ingestion_time(view(spark, sf, "api_metrics")).withColumn("event_date", F.col("metric_date"))
    first = S.in_slice(rows, 0).withColumns(
        {"code": F.col("response_time_ms"), "ratio": (F.col("event_id") % 64).cast("double") / 8}
    )
    tables.append_batch(first, narrow, 0)
    tables.ensure_table(spark, wide, stage.warehouse)
    second = S.in_slice(rows, 1).withColumns(
        {"code": F.col("event_id") * 4000000000, "ratio": F.col("response_time_ms") / F.lit(3.0)}
    )
    tables.append_batch(second, wide, 1)
    return stage.table("demo_events").select("event_id", "code", "ratio")


@query("tbl8_removed_field", """
    SELECT CASE WHEN log_ts < TIMESTAMP '2024-01-16 00:00:00' THEN error_message END AS error_message,
           count(*) AS row_count
    FROM api_metrics GROUP BY 1""")
def _(spark, sf):
    """A field that leaves the config stays in the table; new rows hold NULL in it."""
    stage = S.new_table(spark, "api_metrics")
    full = stage.configs["api_metrics"]
    rows = with_ingestion_time(view(spark, sf, "api_metrics"))
    tables.append_batch(S.in_slice(rows, 0), full, 0)
    less = dataclasses.replace(full, fields=tuple(f for f in full.fields if f.name != "error_message"))
    tables.ensure_table(spark, less, stage.warehouse)
    tables.append_batch(S.in_slice(rows, 1).drop("error_message"), less, 1)
    return R.count_by(stage.table("api_metrics"), ["error_message"], "row_count")


@query("tbl9_replayed_append", API_SQL)
def _(spark, sf):
    """A batch written twice is in the table once."""
    stage = S.new_table(spark, "api_metrics")
    config = stage.configs["api_metrics"]
    early, late = S.half_day_batches(spark, sf, "api_metrics")
    for number, batch in ((0, early), (1, late), (1, late)):
        tables.append_batch(batch, config, number)
    return stage.table("api_metrics").select(*API)


@query("tbl10_append_without_shuffle", f"{PER_PARTITION} GROUP BY 1, 2")
def _(spark, sf):
    stage = S.new_table(spark, "api_metrics")
    rows = with_ingestion_time(view(spark, sf, "api_metrics"))
    tables.append_batch(rows, stage.configs["api_metrics"], 0, cluster=False)
    return R.count_by(stage.table("api_metrics"), ["metric_date", "service_name"], "row_count")


@query("tbl11_sorted_files", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS out_of_order FROM api_metrics")
def _(spark, sf):
    """Within every file the rows follow the declared sort order."""
    table = S.warehouse(spark, sf, "api-metrics").table("api_metrics")
    rows = table.select("timestamp", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    before = F.lag("timestamp").over(Window.partitionBy("f").orderBy("i"))
    return rows.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("before") > F.col("timestamp")).alias("out_of_order")
    )


@query("tbl12_zstd_table", f"{PER_PARTITION} GROUP BY 1, 2")
def _(spark, sf):
    stage = S.new_table(spark, "api_metrics", codec="zstd")
    rows = with_ingestion_time(view(spark, sf, "api_metrics"))
    tables.append_batch(rows, stage.configs["api_metrics"], 0, max_records_per_file=1_000_000)
    return R.count_by(stage.table("api_metrics"), ["metric_date", "service_name"], "row_count")


@query("tbl13_retention", f"{PER_PARTITION} WHERE metric_date >= DATE '2024-02-15' - INTERVAL 30 DAY GROUP BY 1, 2")
def _(spark, sf):
    stage = S.two_batch_table(spark, sf)
    tables.apply_retention(spark, stage.configs["api_metrics"], dt.date(2024, 2, 15))
    return R.count_by(stage.table("api_metrics"), ["metric_date", "service_name"], "row_count")


@query("tbl14_compaction", """
    SELECT metric_date, service_name, count(*) AS row_count, CAST(1 AS BIGINT) AS commits,
           count(DISTINCT CASE WHEN hour(log_ts) < 12 THEN 0 ELSE 1 END) AS batches
    FROM api_metrics GROUP BY 1, 2""")
def _(spark, sf):
    """Both commits of each table partition become one; rows keep their batch."""
    stage = S.two_batch_table(spark, sf)
    tables.compact(spark, stage.configs["api_metrics"], include_latest=True)
    return stage.table("api_metrics").groupBy("metric_date", "service_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("_commit").alias("commits"),
        F.countDistinct("_batch_id").alias("batches"),
    )


@query("tbl14_packed_by_size", """
    SELECT metric_date, service_name, count(*) AS row_count, sum(response_time_ms)::BIGINT AS total_ms,
           count(DISTINCT CASE WHEN hour(log_ts) < 12 THEN 0 ELSE 1 END) AS batches
    FROM api_metrics GROUP BY 1, 2""")
def _(spark, sf):
    """Files packed to a target size, then the second batch written once more: the same rows."""
    stage = S.two_batch_table(spark, sf)
    config = stage.configs["api_metrics"]
    tables.compact(spark, config, include_latest=True, target_bytes=32 << 10)
    for number, batch in enumerate(S.half_day_batches(spark, sf, "api_metrics")):
        if number == 1:
            tables.append_batch(batch, config, number)
    tables.compact(spark, config, target_bytes=32 << 10)
    return stage.table("api_metrics").groupBy("metric_date", "service_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("response_time_ms").alias("total_ms"),
        F.countDistinct("_batch_id").alias("batches"),
    )


@query("tbl15_reset_and_reload", f"{PER_PARTITION} GROUP BY 1, 2")
def _(spark, sf):
    """All tables of the database dropped, the table made anew, both batches loaded again."""
    stage = S.two_batch_table(spark, sf)
    config = stage.configs["api_metrics"]
    tables.drop_tables(spark, config.table.split(".")[0])
    tables.ensure_table(spark, config, stage.warehouse)
    for number, batch in enumerate(S.half_day_batches(spark, sf, "api_metrics")):
        tables.append_batch(batch, config, number)
    return R.count_by(stage.table("api_metrics"), ["metric_date", "service_name"], "row_count")


@query("src7_parquet_files", API_SQL)
def _(spark, sf):
    """Rows written as snappy Parquet files and read back with the declared schema."""
    stage = S.new_stage(spark, [log_types.document("api_metrics")])
    rows = view(spark, sf, "api_metrics").withColumn("timestamp", F.col("timestamp").cast("timestamp")).select(*API)
    rows.write.option("compression", "snappy").parquet(f"{stage.root}/files")
    return spark.read.schema(record_schema(stage.configs["api_metrics"].fields)).parquet(f"{stage.root}/files")


@query("tbl16_backfill", """
    SELECT log_ts AS "timestamp", event_date, user_id, event_type, duration_ms / 1000.0::DOUBLE AS duration_s
    FROM user_events""")
def _(spark, sf):
    """A second version of a table, filled from the first with changed columns, one column dropped."""
    old = S.two_batch_table(spark, sf, "user_events")
    new = S.new_table(spark, "demo_events", ("duration_s double?",))
    source = old.table("user_events").withColumn("duration_s", F.col("duration_ms") / F.lit(1000.0))
    tables.backfill(spark, source, new.configs["demo_events"])
    return new.table("demo_events").select("timestamp", "event_date", "user_id", "event_type", "duration_s")


@query("tbl17_renamed_field", """
    SELECT user_id AS account_id, count(*) AS row_count FROM user_events GROUP BY user_id""")
def _(spark, sf):
    """First batch knows user_id only, second fills account_id; readers see one column."""
    stage = S.new_table(spark, "demo_events", ("account_id string?",))
    config = stage.configs["demo_events"]
    rows = with_ingestion_time(view(spark, sf, "user_events"))
    tables.append_batch(S.in_slice(rows, 0), config, 0)
    tables.append_batch(S.in_slice(rows, 1).withColumn("account_id", F.col("user_id")), config, 1)
    merged = tables.merge_renamed(stage.table("demo_events"), "user_id", "account_id")
    return R.count_by(merged, ["account_id"], "row_count")


@query("tbl19_new_partitioning", """
    SELECT event_day, CAST(CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 10 AS INT) AS user_bucket,
           count(*) AS row_count
    FROM (SELECT CAST(log_ts AS DATE) AS event_day, user_id FROM user_events) GROUP BY 1, 2""")
def _(spark, sf):
    """The rows again in a table partitioned by day and by a bucket of the user."""
    stage = S.new_table(spark, "demo_events", ("event_day date", "user_bucket int"))
    config = dataclasses.replace(
        S.new_stage(spark, [log_types.document("demo_events", ("event_day date", "user_bucket int"))]).configs[
            "demo_events"
        ],
        partition_by=("event_day", "user_bucket"),
    )
    tables.ensure_table(spark, config, stage.warehouse)
    rows = with_ingestion_time(view(spark, sf, "user_events"))
    rows = tables.add_bucket(tables.add_day(rows, "timestamp", "event_day"), "user_id", 10, "user_bucket")
    tables.backfill(spark, rows, config)
    out = tables.read_table(spark, config.table)
    return out.groupBy("event_day", "user_bucket").agg(F.count(F.lit(1)).alias("row_count"))


@query("tbl20_api_health_view", """
    SELECT service_name, date_trunc('minute', log_ts) AS minute, avg(response_time_ms) AS avg_response_time,
           max(response_time_ms) AS max_response_time, count(*) AS request_count,
           CAST(sum(CASE WHEN status_code >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS error_count
    FROM api_metrics WHERE metric_date >= DATE '2024-01-31' - INTERVAL 30 DAY GROUP BY 1, 2""")
def _(spark, sf):
    R.api_health(view(spark, sf, "api_metrics"), "2024-01-31", days=30).createOrReplaceTempView("api_health")
    return spark.sql("SELECT * FROM api_health")


@query("met7_rollback", """
    SELECT metric_date, service_name, count(*) AS row_count FROM api_metrics WHERE hour(log_ts) < 12 GROUP BY 1, 2""")
def _(spark, sf):
    """Back to the first batch, after both had been compacted into one."""
    stage = S.two_batch_table(spark, sf)
    config = stage.configs["api_metrics"]
    tables.compact(spark, config, include_latest=True)
    tables.rollback(spark, config, version=0)
    return R.count_by(stage.table("api_metrics"), ["metric_date", "service_name"], "row_count")


@query("met5_as_of_version_after_compaction", """
    SELECT metric_date, count(*) AS row_count FROM api_metrics WHERE hour(log_ts) < 12 GROUP BY 1""")
def _(spark, sf):
    stage = S.two_batch_table(spark, sf)
    config = stage.configs["api_metrics"]
    tables.compact(spark, config, include_latest=True)
    return R.count_by(history.as_of(spark, config.table, version=0), ["metric_date"], "row_count")
