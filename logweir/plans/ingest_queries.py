"""Encoding, decoding, routing and streaming, checked against the rows they started from."""

from __future__ import annotations

import dataclasses
import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from logweir.functions import envelope as E
from logweir.operators import drift, history, quality, reports as R, tables
from logweir.plans import log_types, staging as S
from logweir.plans.flagship import error_rate_after_ingest
from logweir.plans.registry import query
from logweir.plans.staging import DAMAGE_SQL
from logweir.plans.views import view
from logweir.sources.configs import collect_configs, enabled_configs, load_configs, with_defaults
from logweir.sources.topics import replay, totals
from logweir.streaming import ledger, progress, rates

USER_EVENTS = ["timestamp", "event_date", "user_id", "session_id", "event_type", "page_url", "device_type",
               "duration_ms"]
USER_EVENTS_SQL = """log_ts AS "timestamp", event_date, user_id, session_id, event_type, page_url, device_type,
    duration_ms, json_extract_string(properties_json, '$.k') AS k"""
API = ["timestamp", "metric_date", "service_name", "endpoint", "method", "status_code", "response_time_ms",
       "request_size_bytes", "response_size_bytes", "user_id", "client_ip", "error_message"]
API_SQL = 'SELECT log_ts AS "timestamp", ' + ", ".join(API[1:]) + " FROM api_metrics"
ACTIVITY = ["user_id", "event_type", "event_date", "timestamp", "endpoint", "status_code", "response_time_ms",
            "session_id"]

# Messages of the shared topic with what is wrong with each, for the oracles.
SHARED_SQL = f"""(SELECT 'user_events' AS log_type, user_id, log_ts, {DAMAGE_SQL} AS reason FROM user_events
    UNION ALL SELECT 'user_activity', user_id, log_ts, {DAMAGE_SQL} FROM user_activity)"""


def single(spark, log_type, **changes):
    return S.new_stage(spark, [log_types.document(log_type, **changes)])


def with_k(rows: DataFrame) -> DataFrame:
    return rows.select(*USER_EVENTS, F.col("properties")["k"].alias("k"))


# --- sources -------------------------------------------------------------------------------


@query("entry_error_rate_after_ingest", """
    SELECT endpoint, service_name,
           CAST(sum(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*)
             AS error_rate_pct,
           count(*) AS total_requests
    FROM api_metrics WHERE metric_date >= DATE '2024-01-15'
    GROUP BY endpoint, service_name HAVING count(*) > 10""")
def _(spark, sf):
    return error_rate_after_ingest(spark, sf)


@query("src1_config_catalog", f"""
    SELECT c.log_type, c.name, c.topic, c.n_fields, coalesce(m.messages, 0) AS messages
    FROM (VALUES ('user_events', 'UserEvents', 'user-events', 9), ('api_metrics', 'ApiMetrics', 'api-metrics', 12),
                 ('user_activity', 'UserActivity', 'user-events', 13)) c(log_type, name, topic, n_fields)
    LEFT JOIN (SELECT log_type, count(*) AS messages FROM {SHARED_SQL}
               WHERE coalesce(reason, '') NOT IN ('no_envelope', 'malformed', 'unknown_type') GROUP BY 1
               UNION ALL SELECT 'api_metrics', count(*) FROM api_metrics) m ON m.log_type = c.log_type""")
def _(spark, sf):
    catalog = with_defaults(load_configs(spark, f"{S.prepared(spark, sf).root}/configs"))
    topics = [S.topic(spark, sf, t).read(spark, t) for t in ("user-events", "api-metrics")]
    sent = reduce(DataFrame.unionAll, topics).select(
        F.get_json_object("value", "$._log_type").alias("log_type")
    ).groupBy("log_type").agg(F.count(F.lit(1)).alias("n"))
    return catalog.join(sent, "log_type", "left").select(
        "log_type", "name", "topic", F.size("fields").alias("n_fields"), F.coalesce("n", F.lit(0)).alias("messages")
    )


@query("src2_rows_of_enabled_types", f"""
    SELECT log_type, count(*) AS row_count FROM {SHARED_SQL}
    WHERE reason IS NULL AND log_type = 'user_events' GROUP BY 1""")
def _(spark, sf):
    stage = S.new_stage(
        spark, [log_types.document("user_events"), log_types.document("user_activity", iceberg={"enabled": False})]
    )
    found = load_configs(spark, f"{stage.root}/configs")
    on = collect_configs(enabled_configs(found))
    messages = S.shared_topic_messages(spark, sf, stage.configs)
    good = E.classify(messages, on).where(F.col("_reason").isNull())
    return good.groupBy(F.col("_log_type").alias("log_type")).agg(F.count(F.lit(1)).alias("row_count"))


@query("src3_topic_stream", "SELECT user_id AS key, count(*) AS messages FROM api_metrics GROUP BY user_id")
def _(spark, sf):
    """The topic followed by a stream into the exactly-once Parquet file sink."""
    out = f"{S.new_stage(spark, [log_types.document('api_metrics')]).root}/landed"
    stream = S.topic(spark, sf, "api-metrics").stream(spark, "api-metrics").select("key", "value")
    stream.writeStream.format("parquet").trigger(availableNow=True).option(
        "checkpointLocation", f"{out}-checkpoint"
    ).start(out).awaitTermination()
    return spark.read.schema("key string, value string").parquet(out).groupBy("key").agg(
        F.count(F.lit(1)).alias("messages")
    )


@query("src4_topic_replay", API_SQL)
def _(spark, sf):
    messages = replay(S.topic(spark, sf, "api-metrics").read(spark, "api-metrics"))
    return E.decode(messages, S.prepared(spark, sf).configs["api_metrics"])


@query("src5_topic_totals", f"""
    SELECT 'user-events' AS topic, CAST(count(*) AS BIGINT) AS total_messages FROM {SHARED_SQL}
    UNION ALL SELECT 'api-metrics', count(*) FROM api_metrics""")
def _(spark, sf):
    held = [totals(S.topic(spark, sf, t).ends(spark, t)) for t in ("user-events", "api-metrics")]
    return held[0].unionAll(held[1])


@query("src5_recorded_totals", f"""
    SELECT 'user-events' AS topic, count(*) AS total_messages, count(*) AS read_messages FROM {SHARED_SQL}
    UNION ALL SELECT 'api-metrics', count(*), count(*) FROM api_metrics""")
def _(spark, sf):
    """As the streams' own progress reports tell, without the topic."""
    return progress.recorded_totals(S.warehouse(spark, sf).progress)


@query("src6_table_scan", f"SELECT {USER_EVENTS_SQL} FROM user_events WHERE {DAMAGE_SQL} IS NULL")
def _(spark, sf):
    return with_k(S.warehouse(spark, sf, "user-events").table("user_events"))


# --- decode and encode -----------------------------------------------------------------------


@query("prj1_all_types_round_trip", """
    SELECT c_string, c_int, c_long, CAST(c_float AS DOUBLE) AS c_float, c_double, c_boolean, c_timestamp, c_date,
           concat(c_string, '|x') AS strings, c_int + 7 AS ints, c_long + 9 AS longs, c_string AS k
    FROM all_types""")
def _(spark, sf):
    config = single(spark, "all_types").configs["all_types"]
    out = E.decode(E.encode(view(spark, sf, "all_types"), config), config)
    return out.select(
        "c_string", "c_int", "c_long", F.col("c_float").cast("double").alias("c_float"), "c_double", "c_boolean",
        "c_timestamp", "c_date", F.array_join("c_strings", "|").alias("strings"),
        (F.col("c_ints")[0] + F.col("c_ints")[1]).alias("ints"),
        (F.col("c_longs")[0] + F.col("c_longs")[1]).alias("longs"), F.col("c_map")["k"].alias("k"),
    )


@query("prj5_envelope_decode", f"SELECT {USER_EVENTS_SQL} FROM user_events")
def _(spark, sf):
    config = single(spark, "user_events").configs["user_events"]
    return with_k(E.decode(E.encode(view(spark, sf, "user_events"), config), config))


@query("prj4_binary_payload", API_SQL)
def _(spark, sf):
    """Payloads as bytes, the way a broker hands them over."""
    config = single(spark, "api_metrics").configs["api_metrics"]
    messages = E.encode(view(spark, sf, "api_metrics"), config)
    return E.decode(messages.withColumn("value", F.encode("value", "UTF-8")), config)


@query("prj6_flatten_unrouted", f"""
    SELECT CASE WHEN log_type = 'user_events' AND reason IS NULL THEN 'whole' WHEN keyless THEN 'empty'
                ELSE 'part' END AS content, count(*) AS messages
    FROM (SELECT *, coalesce(reason IN ('no_envelope', 'malformed'), FALSE) AS keyless FROM {SHARED_SQL})
    GROUP BY 1""")
def _(spark, sf):
    """One type's schema over every message of the shared topic: misfits become NULLs, not losses."""
    stage = S.prepared(spark, sf)
    config = stage.configs["user_events"]
    rows = E.decode(S.shared_topic_messages(spark, sf, stage.configs), config, keep=("value",))
    own = F.coalesce(F.get_json_object("value", "$._log_type") == "user_events", F.lit(False))
    needed = [F.col(f.name).isNotNull() for f in config.fields if f.required]
    whole = reduce(lambda a, b: a & b, needed) & own
    empty = reduce(lambda a, b: a & b, [F.col(f.name).isNull() for f in config.fields])
    content = F.when(whole, "whole").when(empty, "empty").otherwise("part").alias("content")
    return rows.groupBy(content).agg(F.count(F.lit(1)).alias("messages"))


@query("prj7_ingestion_columns", f"""
    SELECT count(*) AS row_count, count(*) AS stamped, count(*) AS same_day FROM user_events
    WHERE {DAMAGE_SQL} IS NULL""")
def _(spark, sf):
    at, day = F.col("_ingestion_timestamp"), F.col("_ingestion_date")
    return S.warehouse(spark, sf, "user-events").table("user_events").agg(
        F.count(F.lit(1)).alias("row_count"), F.count(at).alias("stamped"),
        F.count_if(F.to_date(at) == day).alias("same_day"),
    )


@query("prj8_timestamps_normalised", """
    SELECT service_name, min(log_ts) AS first_call, max(log_ts) AS last_call FROM api_metrics GROUP BY service_name""")
def _(spark, sf):
    rows = E.normalise_timestamps(view(spark, sf, "api_metrics"))
    return rows.groupBy("service_name").agg(
        F.min("timestamp").alias("first_call"), F.max("timestamp").alias("last_call")
    )


DB_HEAD = """'{"_log_type":"database_metrics","_log_class":"DatabaseMetrics","_version":"1.0.0","data":{"timestamp":"'
    || strftime(log_ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","metric_date":"' || CAST(metric_date AS VARCHAR)
    || '","database_name":"' || database_name || '","query_type":"' || query_type || '","execution_time_ms":'
    || CAST(execution_time_ms AS VARCHAR)"""


@query("prj9_envelope_encode", f"""
    SELECT {DB_HEAD} || CASE WHEN rows_affected IS NULL THEN ''
             ELSE ',"rows_affected":' || CAST(rows_affected AS VARCHAR) END || '}}}}' AS value
    FROM database_metrics""")
def _(spark, sf):
    config = single(spark, "database_metrics").configs["database_metrics"]
    return E.encode(view(spark, sf, "database_metrics"), config).select("value")


@query("prj10_encode_with_nulls", f"""
    SELECT {DB_HEAD} || ',"rows_affected":' || coalesce(CAST(rows_affected AS VARCHAR), 'null')
             || ',"connection_pool_size":null,"error_message":null}}}}' AS value
    FROM database_metrics""")
def _(spark, sf):
    config = single(spark, "database_metrics").configs["database_metrics"]
    return E.encode(view(spark, sf, "database_metrics"), config, keep_nulls=True).select("value")


@query("prj11_message_keys", """
    SELECT 'api_metrics' AS log_type, user_id AS key, count(*) AS messages FROM api_metrics GROUP BY user_id
    UNION ALL SELECT 'database_metrics', strftime(min(log_ts), '%Y-%m-%d'), count(*) FROM database_metrics
    GROUP BY metric_date""")
def _(spark, sf):
    """A log type with a user field is keyed by it; one without is keyed by its first field."""
    stage = S.new_stage(spark, [log_types.document("api_metrics"), log_types.document("database_metrics")])
    keys = []
    for log_type, key in (("api_metrics", F.col("key")), ("database_metrics", F.substring("key", 1, 10))):
        messages = E.encode(view(spark, sf, log_type), stage.configs[log_type])
        keys.append(messages.select(F.lit(log_type).alias("log_type"), key.alias("key")))
    return keys[0].unionAll(keys[1]).groupBy("log_type", "key").agg(F.count(F.lit(1)).alias("messages"))


@query("prj14_field_defaults", """
    SELECT coalesce(device_type, 'unknown') AS device_type, sum(coalesce(duration_ms, 0))::BIGINT AS total_ms,
           count(*) AS row_count
    FROM user_events GROUP BY 1""")
def _(spark, sf):
    config = single(spark, "user_events").configs["user_events"]
    defaults = {"device_type": "unknown", "duration_ms": "0"}
    fields = tuple(dataclasses.replace(f, default=defaults.get(f.name)) for f in config.fields)
    config = dataclasses.replace(config, fields=fields)
    rows = E.decode(E.encode(view(spark, sf, "user_events"), config), config)
    return rows.groupBy("device_type").agg(
        F.sum("duration_ms").alias("total_ms"), F.count(F.lit(1)).alias("row_count")
    )


# --- routing ---------------------------------------------------------------------------------


@query("flt1_route_by_type", f"""
    SELECT user_id, event_type, event_date, log_ts AS "timestamp", endpoint, status_code, response_time_ms, session_id
    FROM user_activity WHERE {DAMAGE_SQL} IS NULL""")
def _(spark, sf):
    return S.warehouse(spark, sf, "user-events").table("user_activity").select(*ACTIVITY)


@query("rte1_dedicated_topic", API_SQL)
def _(spark, sf):
    return S.warehouse(spark, sf, "api-metrics").table("api_metrics").select(*API)


def counts(stage, names) -> DataFrame:
    loaded = {n: stage.table(n) for n in names}
    return R.table_counts({**loaded, "quarantine": stage.quarantine})


ROUTED_SQL = f"""
    SELECT CASE WHEN reason IS NULL THEN log_type ELSE 'quarantine' END AS table_name, count(*) AS row_count
    FROM {SHARED_SQL} GROUP BY 1"""


@query("rte2_query_per_type", ROUTED_SQL)
def _(spark, sf):
    return counts(S.per_type(spark, sf), ("user_events", "user_activity"))


@query("rte2_unrouted_tables", f"""
    SELECT t.name AS table_name, count(*) AS row_count,
           count(*) FILTER (coalesce(reason, '') NOT IN ('no_envelope', 'malformed', 'missing_required'))
             AS with_user
    FROM {SHARED_SQL}, (VALUES ('user_events'), ('user_activity')) t(name) GROUP BY 1""")
def _(spark, sf):
    """Without routing each table takes the whole topic."""
    stage = S.unrouted(spark, sf)
    parts = [
        stage.table(t).agg(F.count(F.lit(1)).alias("row_count"), F.count("user_id").alias("with_user")).select(
            F.lit(t).alias("table_name"), "row_count", "with_user"
        )
        for t in ("user_events", "user_activity")
    ]
    return parts[0].unionAll(parts[1])


@query("rte3_shared_topic_fan_out", ROUTED_SQL)
def _(spark, sf):
    return counts(S.warehouse(spark, sf, "user-events"), ("user_events", "user_activity"))


@query("rte5_dead_letters", f"""
    SELECT reason, CASE WHEN reason IN ('bad_type', 'missing_required') THEN log_type
                        WHEN reason = 'unknown_type' THEN 'unknown_type' END AS log_type, count(*) AS messages
    FROM {SHARED_SQL} WHERE reason IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    rejected = S.warehouse(spark, sf, "user-events").quarantine
    return rejected.groupBy("reason", F.col("_log_type").alias("log_type")).agg(
        F.count(F.lit(1)).alias("messages")
    )


@query("rte5_reject_origin", f"""
    SELECT 'user-events' AS topic, reason, count(*) AS messages, count(*) AS found_at_origin
    FROM {SHARED_SQL} WHERE reason IS NOT NULL GROUP BY 2""")
def _(spark, sf):
    """Every quarantined message is found again at the partition and offset noted with it."""
    stage = S.warehouse(spark, sf, "user-events")
    return quality.origin_check(stage.quarantine, stage.topics.read(spark, "user-events"))


@query("rte5_reject_counts", f"SELECT coalesce(reason, 'valid') AS reason, count(*) AS messages FROM {SHARED_SQL} GROUP BY 1")
def _(spark, sf):
    stage = S.prepared(spark, sf)
    shared = [stage.configs["user_events"], stage.configs["user_activity"]]
    return quality.reject_counts(E.classify(S.shared_topic_messages(spark, sf, stage.configs), shared))


@query("rte5_null_row_tables", f"""
    SELECT t.name AS table_name, count(*) AS row_count,
           count(*) FILTER (reason IN ('no_envelope', 'malformed', 'unknown_type')) AS without_user_or_type
    FROM {SHARED_SQL} m, (VALUES ('user_events'), ('user_activity')) t(name)
    WHERE reason IN ('no_envelope', 'malformed', 'unknown_type') OR m.log_type = t.name GROUP BY 1""")
def _(spark, sf):
    """Bad messages kept as rows of NULLs, as far as they do not decode."""
    stage = S.null_rows(spark, sf)
    parts = []
    for t in ("user_events", "user_activity"):
        empty = F.col("user_id").isNull() & F.col("event_type").isNull()
        one = stage.table(t).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(empty).alias("without_user_or_type"))
        parts.append(one.select(F.lit(t).alias("table_name"), "row_count", "without_user_or_type"))
    return parts[0].unionAll(parts[1])


# --- streams, history and health --------------------------------------------------------------


@query("str6_progress", f"""
    SELECT 'user-events' AS query, count(*) AS input_rows FROM {SHARED_SQL}
    UNION ALL SELECT 'api-metrics', count(*) FROM api_metrics""")
def _(spark, sf):
    return S.warehouse(spark, sf).progress.groupBy("query").agg(F.sum("input_rows").alias("input_rows"))


@query("str6_rows_and_rejects", f"""
    SELECT 'user-events' AS source, coalesce(reason, log_type) AS what, count(*) AS messages FROM {SHARED_SQL} GROUP BY 2
    UNION ALL SELECT 'api-metrics', 'api_metrics', count(*) FROM api_metrics""")
def _(spark, sf):
    """Rows per type and rejects per reason, as the writing tasks counted them."""
    stored = S.warehouse(spark, sf).ledger.batches(spark)
    good = stored.where("log_type <> 'quarantine'").groupBy("source", F.col("log_type").alias("what")).agg(
        F.sum("rows").alias("messages"))
    return good.unionAll(ledger.reject_counts(stored))


@query("agg19_rates_while_streaming", f"""
    SELECT log_type AS _log_type, date_trunc('hour', log_ts) AS period, count(*) AS messages, count(reason) AS invalid
    FROM {SHARED_SQL} WHERE reason IS NULL OR reason IN ('bad_type', 'missing_required') GROUP BY 1, 2""")
def _(spark, sf):
    """Several micro-batches, each with messages of days that earlier ones had; the rest have no time of their own."""
    stage, topics = S.prepared(spark, sf), S.topic(spark, sf, "user-events")
    source = S.in_batches(spark, topics, "user-events", 6).stream(spark, "user-events")
    configs = [stage.configs["user_events"], stage.configs["user_activity"]]
    folder = f"{stage.root}/rates_{uuid.uuid4().hex[:12]}"
    live = rates.rates(rates.timed(source, configs), "1 hour", "40 days")
    rates.start_rates(live, f"{folder}/figures", f"{folder}/state", S.NOW).awaitTermination()
    return rates.read_rates(spark, f"{folder}/figures")


@query("str7_restart_with_new_fields", """
    SELECT count(*) AS row_count, count(country_code) AS with_country
    FROM demo_events GROUP BY CASE WHEN log_ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END""")
def _(spark, sf):
    """One row per batch: the first without the new field, the second with it."""
    return S.evolved(spark, sf).table("demo_events").groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("country_code").alias("with_country")
    ).drop("_batch_id")


@query("tbl5_added_columns", """
    SELECT log_ts AS "timestamp", event_date, user_id, event_type, country_code, session_id FROM demo_events""")
def _(spark, sf):
    rows = S.evolved(spark, sf).table("demo_events")
    return rows.select("timestamp", "event_date", "user_id", "event_type", "country_code", "session_id")


@query("chk7_drift", """
    SELECT name AS field, 'string' AS config_type, 'string' AS table_type, count(*) AS row_count,
           count(*) FILTER (log_ts < TIMESTAMP '2024-01-16 00:00:00') AS rows_lacking, CAST(0 AS BIGINT) AS rows_other_type
    FROM demo_events, (VALUES ('country_code'), ('session_id')) f(name) GROUP BY name""")
def _(spark, sf):
    """Fields that files lack or hold with another type, from footers alone: those the first run did not know."""
    stage = S.evolved(spark, sf)
    found = drift.drift(spark, stage.configs["demo_events"]).where("rows_lacking + rows_other_type > 0")
    return found.select("field", "config_type", "table_type", "row_count", "rows_lacking", "rows_other_type")


@query("top2_first_ingested", """
    SELECT user_id, event_type, country_code, session_id, log_ts AS "timestamp" FROM demo_events
    WHERE log_ts < TIMESTAMP '2024-01-16 00:00:00' ORDER BY log_ts LIMIT 6""")
def _(spark, sf):
    rows = S.evolved(spark, sf).table("demo_events")
    return R.newest(rows, 6, by="_ingestion_timestamp", oldest=True, ties=["timestamp"],
                    columns=["user_id", "event_type", "country_code", "session_id", "timestamp"])


@query("top2_last_ingested", """
    SELECT user_id, event_type, country_code, session_id, log_ts AS "timestamp" FROM demo_events
    WHERE log_ts >= TIMESTAMP '2024-01-16 00:00:00' ORDER BY log_ts LIMIT 10""")
def _(spark, sf):
    rows = S.evolved(spark, sf).table("demo_events")
    return R.newest(rows, 10, by="_ingestion_timestamp", ties=["timestamp"],
                    columns=["user_id", "event_type", "country_code", "session_id", "timestamp"])


@query("met8_tables_of_the_database", f"""{ROUTED_SQL} UNION ALL SELECT 'api_metrics', count(*) FROM api_metrics""")
def _(spark, sf):
    """Every table the catalog lists in the warehouse's database, with its rows."""
    database = S.warehouse(spark, sf).configs["api_metrics"].table.split(".")[0]
    names = [r.tableName for r in history.tables(spark, database).where("NOT isTemporary").collect()]
    return R.table_counts({n: tables.read_table(spark, f"{database}.{n}") for n in names})


BATCHES = """SELECT *, CASE WHEN log_ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS batch
    FROM api_metrics"""


@query("met1_snapshots", f"""
    SELECT count(*) AS added_records, 'append' AS operation, TRUE AS numbered_by_time
    FROM ({BATCHES}) GROUP BY batch""")
def _(spark, sf):
    stage = S.warehouse(spark, sf, "api-metrics")
    out = ledger.snapshots(stage.ledger.batches(spark), stage.configs["api_metrics"].table)
    by_time = F.col("_batch_id") == F.unix_millis("committed_at")
    return out.select("added_records", "operation", by_time.alias("numbered_by_time"))


def first_version(stage, log_type) -> int:
    return history.snapshots(stage.table(log_type)).agg(F.min("_batch_id")).first()[0]


@query("met2_files", """
    SELECT metric_date, service_name, CAST(count(*) AS BIGINT) AS record_count, TRUE AS sized
    FROM api_metrics GROUP BY 1, 2""")
def _(spark, sf):
    out = history.files(S.warehouse(spark, sf, "api-metrics").table("api_metrics"), ["metric_date", "service_name"])
    return out.groupBy("metric_date", "service_name").agg(
        F.sum("record_count").alias("record_count"), (F.min("size_mb") > 0).alias("sized")
    )


@query("met3_partitions", """
    SELECT metric_date, service_name, CAST(count(*) AS BIGINT) AS record_count, TRUE AS has_files
    FROM api_metrics GROUP BY 1, 2""")
def _(spark, sf):
    out = history.partitions(S.warehouse(spark, sf, "api-metrics").table("api_metrics"), ["metric_date", "service_name"])
    return out.select("metric_date", "service_name", "record_count", (F.col("file_count") > 0).alias("has_files"))


@query("met5_as_of_version", f"SELECT event_date, count(*) AS row_count FROM user_events WHERE {DAMAGE_SQL} IS NULL "
       "AND log_ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1")
def _(spark, sf):
    stage = S.warehouse(spark, sf, "user-events")
    rows = history.as_of(spark, stage.configs["user_events"].table, version=first_version(stage, "user_events"))
    return R.count_by(rows, ["event_date"], "row_count")


@query("met6_as_of_time", f"SELECT event_date, count(*) AS row_count FROM user_events WHERE {DAMAGE_SQL} IS NULL "
       "AND log_ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1")
def _(spark, sf):
    stage = S.warehouse(spark, sf, "user-events")
    first = history.snapshots(stage.table("user_events")).agg(F.min("committed_at")).first()[0]
    rows = history.as_of(spark, stage.configs["user_events"].table, timestamp=first)
    return R.count_by(rows, ["event_date"], "row_count")


@query("chk4_count_delta", f"""
    SELECT CAST(sum(1 - batch) AS BIGINT) AS rows_before, count(*) AS rows_after,
           CAST(sum(batch) AS BIGINT) AS gained, sum(batch) = 0 AS as_expected FROM ({BATCHES})""")
def _(spark, sf):
    stage = S.warehouse(spark, sf, "api-metrics")
    table = stage.configs["api_metrics"].table
    before = history.as_of(spark, table, version=first_version(stage, "api_metrics"))
    return quality.count_delta(before, stage.table("api_metrics"), expected=0)


@query("chk5_health", f"""
    SELECT 'user-events' AS topic, count(*) AS total_messages, count(*) AS rows, CAST(0 AS BIGINT) AS lag
    FROM {SHARED_SQL} UNION ALL SELECT 'api-metrics', count(*), count(*), 0 FROM api_metrics""")
def _(spark, sf):
    """Messages per topic against rows in its tables and in quarantine: nothing may be missing."""
    stage = S.warehouse(spark, sf)
    held = [totals(stage.topics.ends(spark, t)) for t in ("user-events", "api-metrics")]
    return quality.health(held[0].unionAll(held[1]), ledger.loaded(stage.ledger.batches(spark)))
