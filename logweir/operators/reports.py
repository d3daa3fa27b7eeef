"""Analyst reports over log tables.  Every function is a plan: DataFrame in, DataFrame out.

Tables call the event time ``timestamp``; ``time`` names the column where it is called
otherwise.  Relative dates count back from ``as_of``.  Rates and averages are doubles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

Day = dt.date | str


def _day(value: Day) -> Column:
    return F.lit(str(value)).cast("date")


def since_days(column: str, as_of: Day, days: int) -> Column:
    """``column`` lies in the last ``days`` days; the bound is a constant, so it is pushed down."""
    return F.col(column) >= F.date_sub(_day(as_of), days)


def _rows() -> Column:
    return F.count(F.lit(1))


def _sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def percent(part: Column, whole: Column) -> Column:
    return part.cast("double") * 100.0 / whole


# --- counts and group summaries ----------------------------------------------------------


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(_rows().alias("row_count"))


def count_by(table: DataFrame, keys: Sequence[str], name: str = "event_count") -> DataFrame:
    """Rows per key, most frequent first; NULL is a key of its own."""
    return table.groupBy(*keys).agg(_rows().alias(name)).orderBy(F.desc(name), *keys)


def count_by_on(table: DataFrame, keys: Sequence[str], date: str, day: Day) -> DataFrame:
    return count_by(table.where(F.col(date) == _day(day)), keys)


def device_summary(events: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """Events and mean duration per device over the last days."""
    recent = events.where(since_days("event_date", as_of, days))
    return recent.groupBy("device_type").agg(
        _rows().alias("event_count"), F.avg("duration_ms").alias("avg_duration")
    )


def service_calls(metrics: DataFrame) -> DataFrame:
    out = metrics.groupBy("service_name").agg(
        _rows().alias("calls"), F.avg("response_time_ms").alias("avg_response_ms")
    )
    return out.orderBy(F.desc("calls"), "service_name")


def service_latency_on(metrics: DataFrame, day: Day) -> DataFrame:
    out = metrics.where(F.col("metric_date") == _day(day)).groupBy("service_name").agg(
        F.avg("response_time_ms").alias("avg_response_ms"), _rows().alias("request_count")
    )
    return out.orderBy(F.desc("avg_response_ms"))


def service_summary(metrics: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    recent = metrics.where(since_days("metric_date", as_of, days))
    out = recent.groupBy("service_name").agg(
        _rows().alias("total_calls"),
        F.avg("response_time_ms").alias("avg_response_ms"),
        _sum_if(F.col("status_code") >= 400).alias("errors"),
    )
    return out.orderBy(F.desc("total_calls"), "service_name")


def calls_by_status(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("status_code").agg(_rows().alias("call_count")).orderBy(F.asc_nulls_last("status_code"))


def error_rate(metrics: DataFrame, since: Day, min_requests: int = 10) -> DataFrame:
    """Share of failed calls per endpoint and service with more than ``min_requests`` calls."""
    calls = metrics.where(F.col("metric_date") >= _day(since))
    counted = calls.groupBy("endpoint", "service_name").agg(
        _sum_if(F.col("status_code") >= 400).alias("_errors"), _rows().alias("total_requests")
    )
    out = counted.where(F.col("total_requests") > min_requests).select(
        "endpoint",
        "service_name",
        percent(F.col("_errors"), F.col("total_requests")).alias("error_rate_pct"),
        "total_requests",
    )
    return out.orderBy(F.desc("error_rate_pct"), "endpoint", "service_name")


def _ranked(table: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Distinct values per key with how often (``_n``) and at which ranks they stand.

    Values are counted spread over (key, value), so only distinct values of a key come
    together; they are sorted and summed with spilling, whatever their number.
    """
    counted = table.groupBy(*keys, column).agg(_rows().alias("_n"))
    present = F.when(F.col(column).isNotNull(), F.col("_n")).otherwise(0)
    by_key = Window.partitionBy(*keys)
    upto = by_key.orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumns({"_upto": F.sum(present).over(upto), "_all": F.sum(present).over(by_key)})


def _percentile(column: str, p: float) -> Column:
    """Aggregate over ranked values: the interpolated value at rank ``p * (all - 1)``."""
    at = F.lit(p) * (F.col("_all") - 1)
    value = F.col(column)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank), value))

    low, high = value_at(F.floor(at)), value_at(F.ceil(at))
    return low + (high - low) * F.max(at - F.floor(at))


def percentile_by(table: DataFrame, keys: Sequence[str], column: str, p: float, name: str) -> DataFrame:
    """Exact interpolated percentile per key."""
    return _ranked(table, keys, column).groupBy(*keys).agg(_percentile(column, p).alias(name))


def p95_by_service(metrics: DataFrame, day: Day) -> DataFrame:
    on_day = metrics.where(F.col("metric_date") == _day(day))
    return percentile_by(on_day, ["service_name"], "response_time_ms", 0.95, "p95_response_time")


def p95_by_service_approx(metrics: DataFrame, day: Day, accuracy: int = 10_000) -> DataFrame:
    """The same from a fixed-size sketch per service."""
    return metrics.where(F.col("metric_date") == _day(day)).groupBy("service_name").agg(
        F.percentile_approx("response_time_ms", 0.95, accuracy).alias("p95_response_time")
    )


def endpoint_profile(metrics: DataFrame, day: Day) -> DataFrame:
    """Calls, extremes, mean and exact p95 per endpoint, slowest first.

    All figures come from the counts of equal response times, so the table is read once and
    shuffled as counts.
    """
    ranked = _ranked(metrics.where(F.col("metric_date") == _day(day)), ["endpoint"], "response_time_ms")
    value = F.col("response_time_ms")
    out = ranked.groupBy("endpoint").agg(
        F.sum("_n").alias("calls"),
        F.min(value).alias("min_ms"),
        (F.sum(value.cast("double") * F.col("_n")) / F.max("_all")).alias("avg_ms"),
        F.max(value).alias("max_ms"),
        _percentile("response_time_ms", 0.95).alias("p95_ms"),
    )
    return out.orderBy(F.desc("avg_ms"), "endpoint")


def user_behaviour(events: DataFrame, day: Day | None = None) -> DataFrame:
    """Events, distinct sessions and distinct pages per user."""
    rows = events if day is None else events.where(F.col("event_date") == _day(day))
    out = rows.groupBy("user_id").agg(
        _rows().alias("total_events"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("page_url").alias("pages_visited"),
    )
    return out.orderBy(F.desc("total_events"), "user_id")


def user_behaviour_approx(events: DataFrame, day: Day | None = None, rsd: float = 0.05) -> DataFrame:
    """The same with distinct counts from sketches: one shuffle of one row per user and task."""
    rows = events if day is None else events.where(F.col("event_date") == _day(day))
    return rows.groupBy("user_id").agg(
        _rows().alias("total_events"),
        F.approx_count_distinct("session_id", rsd).alias("sessions"),
        F.approx_count_distinct("page_url", rsd).alias("pages_visited"),
    )


def top_users(events: DataFrame, event_type: str, day: Day, n: int | None = 10) -> DataFrame:
    """Users with most events of a type on a day."""
    chosen = events.where((F.col("event_date") == _day(day)) & (F.col("event_type") == event_type))
    out = count_by(chosen, ["user_id"], "clicks")
    return out if n is None else out.limit(n)


def database_summary(metrics: DataFrame, day: Day) -> DataFrame:
    out = metrics.where(F.col("metric_date") == _day(day)).groupBy("database_name", "query_type").agg(
        _rows().alias("query_count"),
        F.avg("execution_time_ms").alias("avg_time_ms"),
        F.max("execution_time_ms").alias("max_time_ms"),
    )
    return out.orderBy(F.desc("query_count"), "database_name", "query_type")


def new_field_by_day(table: DataFrame, field: str, date: str = "event_date") -> DataFrame:
    """How an added column fills up, day by day; NULL counts the rows from before."""
    return table.groupBy(date, field).agg(_rows().alias("row_count")).orderBy(date, F.asc_nulls_first(field))


def count_by_nulls_first(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(_rows().alias("row_count")).orderBy(F.asc_nulls_first(key))


def frequent_types(events: DataFrame, after: dt.datetime | str, min_rows: int = 10, n: int = 5,
                   time: str = "timestamp") -> DataFrame:
    """Event types with more than ``min_rows`` rows after a moment, the top ``n``."""
    later = events.where(F.col(time) > F.lit(str(after)).cast("timestamp"))
    out = later.groupBy("event_type").agg(_rows().alias("cnt")).where(F.col("cnt") > min_rows)
    return out.orderBy(F.desc("cnt"), "event_type").limit(n)


def message_rates(classified: DataFrame, time: str = "timestamp", per: str = "hour") -> DataFrame:
    """Messages, rejects and reject share per log type and period of the message time."""
    out = classified.groupBy("_log_type", F.date_trunc(per, time).alias("period")).agg(
        _rows().alias("messages"), F.count("_reason").alias("invalid")
    )
    return out.withColumn("error_rate_pct", percent(F.col("invalid"), F.col("messages")))


def processing_lag(table: DataFrame, time: str = "timestamp") -> DataFrame:
    """Seconds from event time to ingestion, and growth, per batch of a table."""
    lag = F.unix_micros("_ingestion_timestamp") - F.unix_micros(F.col(time).cast("timestamp"))
    return table.groupBy("_batch_id").agg(
        _rows().alias("added_rows"),
        (F.avg(lag) / 1e6).alias("avg_lag_s"),
        (F.max(lag) / 1e6).alias("max_lag_s"),
    )


# --- time series ---------------------------------------------------------------------------


def events_per_hour(events: DataFrame, time: str = "timestamp") -> DataFrame:
    out = events.groupBy(F.date_trunc("hour", time).alias("hour")).agg(_rows().alias("events"))
    return out.orderBy(F.desc("hour"))


def events_per_hour_and_type(events: DataFrame, since: Day, time: str = "timestamp") -> DataFrame:
    rows = events.where(F.col("event_date") >= _day(since))
    out = rows.groupBy(F.date_trunc("hour", time).alias("hour"), "event_type").agg(_rows().alias("events"))
    return out.orderBy("hour", "event_type")


def api_health(metrics: DataFrame, as_of: Day, days: int = 1, time: str = "timestamp") -> DataFrame:
    """Latency, calls and server errors per service and minute."""
    recent = metrics.where(since_days("metric_date", as_of, days))
    return recent.groupBy("service_name", F.date_trunc("minute", time).alias("minute")).agg(
        F.avg("response_time_ms").alias("avg_response_time"),
        F.max("response_time_ms").alias("max_response_time"),
        _rows().alias("request_count"),
        _sum_if(F.col("status_code") >= 500).alias("error_count"),
    )


def failing_minutes(health: DataFrame) -> DataFrame:
    return health.where(F.col("error_count") > 0).orderBy(F.desc("minute"), "service_name")


# --- newest rows, filters ------------------------------------------------------------------


def newest(table: DataFrame, n: int, by: str = "timestamp", columns: Sequence[str] | None = None,
           oldest: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows latest (or earliest) by a column; ``ties`` settles equal ones."""
    order = F.asc_nulls_last(by) if oldest else F.desc_nulls_last(by)
    top = table.orderBy(order, *ties).limit(n)
    return top.select(*columns) if columns else top


def failed_calls(metrics: DataFrame, n: int | None = 20, time: str = "timestamp") -> DataFrame:
    out = metrics.where(F.col("status_code") >= 400).select(
        "service_name", "endpoint", "status_code", "error_message", time
    )
    out = out.orderBy(F.desc(time), "service_name", "endpoint")
    return out if n is None else out.limit(n)


def events_of_type_on(events: DataFrame, event_type: str, day: Day, time: str = "timestamp") -> DataFrame:
    """All events of a type on a day, newest first."""
    chosen = events.where((F.col("event_date") == _day(day)) & (F.col("event_type") == event_type))
    return chosen.select("user_id", "page_url", time).orderBy(F.desc(time))


def slow_calls(metrics: DataFrame, over_ms: int = 100) -> DataFrame:
    return metrics.where(F.col("response_time_ms") > over_ms)


def on_day(table: DataFrame, date: str, day: Day) -> DataFrame:
    return table.where(F.col(date) == _day(day))


def preview(table: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows; the same ones every time if ``by`` is a unique order."""
    return (table.orderBy(*by) if by else table).limit(n)


# --- joins and unions ----------------------------------------------------------------------


def events_with_calls(events: DataFrame, metrics: DataFrame, day: Day, time: str = "timestamp",
                      n: int | None = None) -> DataFrame:
    """Events and API calls at the same moment of a day.

    Both sides are cut to the day before the join; AQE chooses the join and splits hot keys.
    """
    left = events.where(F.col("event_date") == _day(day)).select(time, "user_id", "event_type")
    right = metrics.where(F.col("metric_date") == _day(day)).select(
        time, "endpoint", "response_time_ms", "status_code"
    )
    out = left.join(right, time).select("user_id", "event_type", "endpoint", "response_time_ms", "status_code")
    return out if n is None else out.limit(n)


def enrich(logs: DataFrame, dimension: DataFrame, key: Column) -> DataFrame:
    """Logs with the columns of a dimension table, all logs kept.  No side is forced to broadcast."""
    return logs.join(dimension, key, "left")


def table_counts(tables: dict[str, DataFrame], as_text: bool = False) -> DataFrame:
    """Rows of every table, one row each."""
    out = None
    for name, table in tables.items():
        n = _rows().cast("string") if as_text else _rows()
        one = table.agg(n.alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionAll(one)
    return out


# --- use cases built from the same parts -------------------------------------------------


def session_steps(events: DataFrame, steps: Sequence[str], time: str = "timestamp") -> DataFrame:
    """First time each step was seen, per user and session: one row per session, no lists."""
    firsts = [F.min(F.when(F.col("event_type") == s, F.col(time))).alias(s) for s in steps]
    return events.groupBy("user_id", "session_id").agg(*firsts)


def reached_steps(events: DataFrame, steps: Sequence[str], time: str = "timestamp") -> DataFrame:
    """When each session reached each step: the first time of a step at or after the one before was reached.

    One shuffle by session; each step is an aggregate over the session on the same partitioning.
    """
    session = Window.partitionBy("user_id", "session_id")
    rows, before = events.select("user_id", "session_id", "event_type", F.col(time).alias("_at")), None
    for number, step in enumerate(steps):
        hit = F.col("event_type") == step
        if before is not None:
            hit = hit & (F.col("_at") >= F.col(before))
        before = f"_reached_{number}"
        rows = rows.withColumn(before, F.min(F.when(hit, F.col("_at"))).over(session))
    return rows.groupBy("user_id", "session_id").agg(*[F.min(f"_reached_{n}").alias(s) for n, s in enumerate(steps)])


def funnel(events: DataFrame, steps: Sequence[str], time: str = "timestamp") -> DataFrame:
    """Sessions that reached each step after the one before it."""
    wide = reached_steps(events, steps, time).agg(*[F.count(F.col(f"`{s}`")).alias(s) for s in steps])
    pairs = ", ".join(f"{i}, '{s}', `{s}`" for i, s in enumerate(steps))
    return wide.selectExpr(f"stack({len(steps)}, {pairs}) AS (step_no, step, sessions)")


def session_paths(events: DataFrame, time: str = "timestamp", tie: str = "event_id") -> DataFrame:
    """Each session's event types in order of time, joined by ``>``; equal times go by ``tie``."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(time).alias("at"), F.col(tie).alias("tie"), "event_type")))
    return events.groupBy("user_id", "session_id").agg(
        F.array_join(F.transform(ordered, lambda e: e["event_type"]), ">").alias("path"), _rows().alias("events"))


def user_day_features(events: DataFrame, time: str = "timestamp") -> DataFrame:
    """Per user and day: activity figures to learn from."""
    return events.groupBy("user_id", "event_date").agg(
        _rows().alias("events"),
        F.countDistinct("session_id").alias("sessions"),
        _sum_if(F.col("event_type") == "purchase").alias("purchases"),
        F.avg("duration_ms").alias("avg_duration_ms"),
        F.max(time).alias("last_seen"),
    )
