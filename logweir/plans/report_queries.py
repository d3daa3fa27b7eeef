"""Reports over the log-type rows of the ``events`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweir.operators import quality, reports as R
from logweir.plans.registry import query
from logweir.plans.staging import DAMAGE_SQL, prepared, shared_topic_messages, warehouse
from logweir.plans.views import read, view

AS_OF = "2024-01-31"
DAY = "2024-01-05"
SINCE = "2024-01-15"
PICK_EVENT = ["user_id", "event_type", "page_url", "device_type", "timestamp"]
PICK_CALL = ["service_name", "endpoint", "method", "status_code", "response_time_ms", "timestamp"]


@query("agg1_row_count", "SELECT count(*) AS row_count FROM user_events")
def _(spark, sf):
    return R.row_count(view(spark, sf, "user_events"))


@query("agg2_events_by_type", "SELECT event_type, count(*) AS event_count FROM user_events GROUP BY event_type")
def _(spark, sf):
    return R.count_by(view(spark, sf, "user_events"), ["event_type"])


@query("agg3_events_by_type_on_day", f"""
    SELECT event_type, count(*) AS event_count FROM user_events
    WHERE event_date = DATE '{DAY}' GROUP BY event_type""")
def _(spark, sf):
    return R.count_by_on(view(spark, sf, "user_events"), ["event_type"], "event_date", DAY)


@query("agg4_events_by_device", "SELECT device_type, count(*) AS event_count FROM user_events GROUP BY device_type")
def _(spark, sf):
    return R.count_by(view(spark, sf, "user_events"), ["device_type"])


@query("agg5_device_summary", f"""
    SELECT device_type, count(*) AS event_count, avg(duration_ms) AS avg_duration FROM user_events
    WHERE event_date >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY device_type""")
def _(spark, sf):
    return R.device_summary(view(spark, sf, "user_events"), AS_OF)


@query("agg6_service_calls", """
    SELECT service_name, count(*) AS calls, avg(response_time_ms) AS avg_response_ms
    FROM api_metrics GROUP BY service_name""")
def _(spark, sf):
    return R.service_calls(view(spark, sf, "api_metrics"))


@query("agg7_service_latency_on_day", f"""
    SELECT service_name, avg(response_time_ms) AS avg_response_ms, count(*) AS request_count
    FROM api_metrics WHERE metric_date = DATE '{DAY}' GROUP BY service_name""")
def _(spark, sf):
    return R.service_latency_on(view(spark, sf, "api_metrics"), DAY)


@query("agg8_service_summary", f"""
    SELECT service_name, count(*) AS total_calls, avg(response_time_ms) AS avg_response_ms,
           CAST(sum(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) AS BIGINT) AS errors
    FROM api_metrics WHERE metric_date >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY service_name""")
def _(spark, sf):
    return R.service_summary(view(spark, sf, "api_metrics"), AS_OF)


@query("agg9_calls_by_status", "SELECT status_code, count(*) AS call_count FROM api_metrics GROUP BY status_code")
def _(spark, sf):
    return R.calls_by_status(view(spark, sf, "api_metrics"))


@query("agg10_error_rate", f"""
    SELECT endpoint, service_name,
           CAST(sum(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*)
             AS error_rate_pct,
           count(*) AS total_requests
    FROM api_metrics WHERE metric_date >= DATE '{SINCE}'
    GROUP BY endpoint, service_name HAVING count(*) > 10""")
def _(spark, sf):
    return R.error_rate(view(spark, sf, "api_metrics"), SINCE)


@query("agg11_p95_by_service", f"""
    SELECT service_name, round(quantile_cont(response_time_ms, 0.95), 6) AS p95_response_time
    FROM api_metrics WHERE metric_date = DATE '{DAY}' GROUP BY service_name""")
def _(spark, sf):
    out = R.p95_by_service(view(spark, sf, "api_metrics"), DAY)
    return out.withColumn("p95_response_time", F.round("p95_response_time", 6))


@query("agg11_p95_by_service_approx")
def _(spark, sf):
    return R.p95_by_service_approx(view(spark, sf, "api_metrics"), DAY)


@query("agg12_endpoint_profile", f"""
    SELECT endpoint, count(*) AS calls, min(response_time_ms) AS min_ms, avg(response_time_ms) AS avg_ms,
           max(response_time_ms) AS max_ms, round(quantile_cont(response_time_ms, 0.95), 6) AS p95_ms
    FROM api_metrics WHERE metric_date = DATE '{DAY}' GROUP BY endpoint""")
def _(spark, sf):
    out = R.endpoint_profile(view(spark, sf, "api_metrics"), DAY)
    return out.withColumn("p95_ms", F.round("p95_ms", 6))


@query("agg13_user_behaviour", """
    SELECT user_id, count(*) AS total_events, count(DISTINCT session_id) AS sessions,
           count(DISTINCT page_url) AS pages_visited
    FROM user_events GROUP BY user_id""")
def _(spark, sf):
    return R.user_behaviour(view(spark, sf, "user_events"))


@query("agg13_user_behaviour_on_day", f"""
    SELECT user_id, count(*) AS total_events, count(DISTINCT session_id) AS sessions,
           count(DISTINCT page_url) AS pages_visited
    FROM user_events WHERE event_date = DATE '{DAY}' GROUP BY user_id""")
def _(spark, sf):
    return R.user_behaviour(view(spark, sf, "user_events"), DAY)


@query("agg13_user_behaviour_approx")
def _(spark, sf):
    return R.user_behaviour_approx(view(spark, sf, "user_events"))


@query("agg14_top_clickers", f"""
    SELECT user_id, count(*) AS clicks FROM user_events
    WHERE event_date = DATE '{DAY}' AND event_type = 'click'
    GROUP BY user_id ORDER BY clicks DESC, user_id LIMIT 10""")
def _(spark, sf):
    return R.top_users(view(spark, sf, "user_events"), "click", DAY)


@query("agg14_clickers_on_day", f"""
    SELECT user_id, count(*) AS clicks FROM user_events
    WHERE event_date = DATE '{DAY}' AND event_type = 'click' GROUP BY user_id""")
def _(spark, sf):
    return R.top_users(view(spark, sf, "user_events"), "click", DAY, n=None)


@query("agg15_database_summary", f"""
    SELECT database_name, query_type, count(*) AS query_count, avg(execution_time_ms) AS avg_time_ms,
           max(execution_time_ms) AS max_time_ms
    FROM database_metrics WHERE metric_date = DATE '{DAY}' GROUP BY database_name, query_type""")
def _(spark, sf):
    return R.database_summary(view(spark, sf, "database_metrics"), DAY)


@query("agg16_new_field_by_day", """
    SELECT event_date, country_code, count(*) AS row_count FROM demo_events
    GROUP BY event_date, country_code""")
def _(spark, sf):
    return R.new_field_by_day(view(spark, sf, "demo_events"), "country_code")


@query("agg17_rows_by_country", "SELECT country_code, count(*) AS row_count FROM demo_events GROUP BY country_code")
def _(spark, sf):
    return R.count_by_nulls_first(view(spark, sf, "demo_events"), "country_code")


@query("agg18_frequent_types", """
    SELECT event_type, count(*) AS cnt FROM user_events WHERE log_ts > TIMESTAMP '2024-01-10 00:00:00'
    GROUP BY event_type HAVING count(*) > 10 ORDER BY cnt DESC, event_type LIMIT 5""")
def _(spark, sf):
    return R.frequent_types(view(spark, sf, "user_events"), "2024-01-10")


@query("agg19_message_rates", f"""
    SELECT _log_type, date_trunc('hour', log_ts) AS period, count(*) AS messages,
           count(reason) AS invalid, CAST(count(reason) AS DOUBLE) * 100.0 / count(*) AS error_rate_pct
    FROM (SELECT 'user_events' AS _log_type, log_ts, {DAMAGE_SQL} AS reason FROM user_events
          UNION ALL SELECT 'user_activity', log_ts, {DAMAGE_SQL} FROM user_activity)
    GROUP BY 1, 2""")
def _(spark, sf):
    parts = [
        view(spark, sf, t).select(
            F.lit(t).alias("_log_type"), "timestamp", F.expr(DAMAGE_SQL).alias("_reason")
        )
        for t in ("user_events", "user_activity")
    ]
    out = R.message_rates(parts[0].unionAll(parts[1]))
    return out.withColumn("period", F.col("period").cast("timestamp_ntz"))


@query("agg19_table_growth", f"""
    SELECT count(*) AS added_rows, TRUE AS lag_measured FROM user_events WHERE {DAMAGE_SQL} IS NULL
    GROUP BY CASE WHEN log_ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END""")
def _(spark, sf):
    out = R.processing_lag(warehouse(spark, sf, "user-events").table("user_events"))
    return out.select("added_rows", (F.col("max_lag_s") >= F.col("avg_lag_s")).alias("lag_measured"))


@query("ts1_events_per_hour", """
    SELECT date_trunc('hour', log_ts) AS hour, count(*) AS events FROM user_events GROUP BY 1""")
def _(spark, sf):
    return R.events_per_hour(view(spark, sf, "user_events"))


@query("ts2_events_per_hour_and_type", f"""
    SELECT date_trunc('hour', log_ts) AS hour, event_type, count(*) AS events FROM user_events
    WHERE event_date >= DATE '{SINCE}' GROUP BY 1, 2""")
def _(spark, sf):
    return R.events_per_hour_and_type(view(spark, sf, "user_events"), SINCE)


@query("ts3_failing_minutes", """
    SELECT service_name, date_trunc('minute', log_ts) AS minute, avg(response_time_ms) AS avg_response_time,
           max(response_time_ms) AS max_response_time, count(*) AS request_count,
           CAST(sum(CASE WHEN status_code >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS error_count
    FROM api_metrics WHERE metric_date >= DATE '2024-01-31' - INTERVAL 1 DAY
    GROUP BY 1, 2 HAVING sum(CASE WHEN status_code >= 500 THEN 1 ELSE 0 END) > 0""")
def _(spark, sf):
    return R.failing_minutes(R.api_health(view(spark, sf, "api_metrics"), AS_OF))


@query("top1_newest_events", """
    SELECT user_id, event_type, page_url, device_type, log_ts AS "timestamp" FROM user_events
    ORDER BY log_ts DESC LIMIT 5""")
def _(spark, sf):
    return R.newest(view(spark, sf, "user_events"), 5, columns=PICK_EVENT)


@query("top1_newest_calls", """
    SELECT service_name, endpoint, method, status_code, response_time_ms, log_ts AS "timestamp"
    FROM api_metrics ORDER BY log_ts DESC LIMIT 10""")
def _(spark, sf):
    return R.newest(view(spark, sf, "api_metrics"), 10, columns=PICK_CALL)


@query("top1_newest_events_on_day", f"""
    SELECT user_id, event_type, page_url, device_type, log_ts AS "timestamp" FROM user_events
    WHERE event_date = DATE '{DAY}' ORDER BY log_ts DESC LIMIT 10""")
def _(spark, sf):
    today = R.on_day(view(spark, sf, "user_events"), "event_date", DAY)
    return R.newest(today, 10, columns=PICK_EVENT)


@query("top3_failed_calls", """
    SELECT service_name, endpoint, status_code, error_message, log_ts AS "timestamp" FROM api_metrics
    WHERE status_code >= 400 ORDER BY log_ts DESC, service_name, endpoint LIMIT 20""")
def _(spark, sf):
    return R.failed_calls(view(spark, sf, "api_metrics"))


@query("top4_clicks_on_day", f"""
    SELECT user_id, page_url, log_ts AS "timestamp" FROM user_events
    WHERE event_date = DATE '{DAY}' AND event_type = 'click'""")
def _(spark, sf):
    return R.events_of_type_on(view(spark, sf, "user_events"), "click", DAY)


@query("top5_slow_calls", """
    SELECT service_name, endpoint, method, status_code, response_time_ms, log_ts AS "timestamp"
    FROM api_metrics WHERE response_time_ms > 100""")
def _(spark, sf):
    return R.slow_calls(view(spark, sf, "api_metrics")).select(*PICK_CALL)


@query("top6_preview", """
    SELECT user_id, event_type, page_url, device_type, log_ts AS "timestamp" FROM user_events
    ORDER BY event_id LIMIT 10""")
def _(spark, sf):
    return R.preview(view(spark, sf, "user_events"), 10, by=["event_id"]).select(*PICK_EVENT)


@query("flt2_events_of_type_since", f"""
    SELECT event_id, user_id, event_type, event_date FROM user_events
    WHERE event_type = 'purchase' AND event_date >= DATE '{DAY}' AND event_date < DATE '{SINCE}'""")
def _(spark, sf):
    rows = view(spark, sf, "user_events")
    chosen = rows.where(
        (F.col("event_type") == "purchase") & (F.col("event_date") >= DAY) & (F.col("event_date") < SINCE)
    )
    return chosen.select("event_id", "user_id", "event_type", "event_date")


@query("flt3_last_seven_days", f"""
    SELECT event_id, user_id, event_date FROM user_events
    WHERE event_date >= DATE '{AS_OF}' - INTERVAL 7 DAY""")
def _(spark, sf):
    rows = view(spark, sf, "user_events")
    return rows.where(R.since_days("event_date", AS_OF, 7)).select("event_id", "user_id", "event_date")


@query("jon1_events_with_calls", f"""
    SELECT u.user_id, u.event_type, a.endpoint, a.response_time_ms, a.status_code
    FROM user_events u JOIN api_metrics a ON u.log_ts = a.log_ts
    WHERE u.event_date = DATE '{DAY}' AND a.metric_date = DATE '{DAY}'""")
def _(spark, sf):
    return R.events_with_calls(view(spark, sf, "user_events"), view(spark, sf, "api_metrics"), DAY)


@query("jon2_events_with_customers", """
    SELECT u.event_id, u.event_type, c.c_mktsegment, c.c_nationkey
    FROM user_events u LEFT JOIN customer c ON u.user_id = concat('user_', CAST(c.c_custkey AS VARCHAR))""")
def _(spark, sf):
    customers = read(spark, sf, "customer").select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("c_user"), "c_mktsegment", "c_nationkey"
    )
    out = R.enrich(view(spark, sf, "user_events"), customers, F.col("user_id") == F.col("c_user"))
    return out.select("event_id", "event_type", "c_mktsegment", "c_nationkey")


COUNTS = """
    SELECT 'user_events' AS table_name, {n} AS row_count FROM user_events
    UNION ALL SELECT 'user_activity', {n} FROM user_activity
    UNION ALL SELECT 'api_metrics', {n} FROM api_metrics"""


@query("set1_table_counts", COUNTS.format(n="count(*)"))
def _(spark, sf):
    return R.table_counts({t: view(spark, sf, t) for t in ("user_events", "user_activity", "api_metrics")})


@query("set2_table_counts_as_text", """
    SELECT 'user_events' AS table_name, CAST(count(*) AS VARCHAR) AS row_count FROM user_events
    UNION ALL SELECT 'api_metrics', CAST(count(*) AS VARCHAR) FROM api_metrics""")
def _(spark, sf):
    return R.table_counts({t: view(spark, sf, t) for t in ("user_events", "api_metrics")}, as_text=True)


@query("uc1_session_steps", """
    SELECT user_id, session_id, min(CASE WHEN event_type = 'view' THEN log_ts END) AS "view",
           min(CASE WHEN event_type = 'click' THEN log_ts END) AS click,
           min(CASE WHEN event_type = 'purchase' THEN log_ts END) AS purchase
    FROM user_events GROUP BY user_id, session_id""")
def _(spark, sf):
    return R.session_steps(view(spark, sf, "user_events"), ["view", "click", "purchase"])


# Written as a chain of joins: the first time of a step, then each later step joined to the one before.
@query("uc1_funnel", """
    , first_view AS (SELECT user_id, session_id, min(log_ts) AS at FROM user_events WHERE event_type = 'view' GROUP BY ALL),
    first_click AS (SELECT e.user_id, e.session_id, min(e.log_ts) AS at FROM user_events e JOIN first_view b
                    ON e.user_id = b.user_id AND e.session_id = b.session_id AND e.log_ts >= b.at WHERE e.event_type = 'click' GROUP BY ALL),
    first_purchase AS (SELECT e.user_id, e.session_id, min(e.log_ts) AS at FROM user_events e JOIN first_click b
                       ON e.user_id = b.user_id AND e.session_id = b.session_id AND e.log_ts >= b.at WHERE e.event_type = 'purchase' GROUP BY ALL)
    SELECT 0 AS step_no, 'view' AS step, count(*) AS sessions FROM first_view
    UNION ALL SELECT 1, 'click', count(*) FROM first_click
    UNION ALL SELECT 2, 'purchase', count(*) FROM first_purchase""")
def _(spark, sf):
    return R.funnel(view(spark, sf, "user_events"), ["view", "click", "purchase"])


@query("uc1_session_paths", """
    SELECT user_id, session_id, string_agg(event_type, '>' ORDER BY log_ts, event_id) AS path, count(*) AS events
    FROM user_events GROUP BY user_id, session_id""")
def _(spark, sf):
    return R.session_paths(view(spark, sf, "user_events"))


@query("uc4_user_day_features", """
    SELECT user_id, event_date, count(*) AS events, count(DISTINCT session_id) AS sessions,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
           avg(duration_ms) AS avg_duration_ms, max(log_ts) AS last_seen
    FROM user_events GROUP BY user_id, event_date""")
def _(spark, sf):
    return R.user_day_features(view(spark, sf, "user_events"))


@query("chk6_null_audit", """
    SELECT count(*) AS row_count,
           count(*) FILTER (page_url IS NULL AND device_type IS NULL AND duration_ms IS NULL) AS all_null_rows,
           count(*) FILTER (page_url IS NULL) AS null_page_url,
           count(*) FILTER (device_type IS NULL) AS null_device_type,
           count(*) FILTER (duration_ms IS NULL) AS null_duration_ms
    FROM user_events""")
def _(spark, sf):
    return quality.null_audit(view(spark, sf, "user_events"), ["page_url", "device_type", "duration_ms"])


@query("chk1_envelope_report", f"""
    SELECT count(*) AS messages, count(*) FILTER (bare) AS without_log_type,
           count(*) FILTER (bare) AS without_log_class, count(*) FILTER (bare) AS without_version,
           count(*) FILTER (bare) AS without_data
    FROM (SELECT coalesce({DAMAGE_SQL} IN ('no_envelope', 'malformed'), FALSE) AS bare
          FROM (SELECT event_id FROM user_events UNION ALL SELECT event_id FROM user_activity))""")
def _(spark, sf):
    configs = prepared(spark, sf).configs
    return quality.envelope_report(shared_topic_messages(spark, sf, configs))
