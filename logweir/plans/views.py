"""Log-type rows derived from the ``events`` table; the SQL text serves Spark and the oracles.

``log_ts`` stands for the field ``timestamp``; ``event_id`` is kept to tell rows apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

VIEWS: dict[str, tuple[dict[str, str], str]] = {
    "user_events": (
        {
            "event_id": "event_id",
            "log_ts": "ts",
            "event_date": "CAST(ts AS DATE)",
            "user_id": "concat('user_', CAST(user_id AS STRING))",
            "session_id": "concat('sess_', CAST(user_id AS STRING), '_', CAST(event_id % 5 AS STRING))",
            "event_type": "event_type",
            "page_url": "CASE WHEN event_id % 11 = 0 THEN NULL "
                        "ELSE concat('/p/', CAST(event_id % 10 AS STRING)) END",
            "properties_json": "props",
            "device_type": "CASE event_id % 4 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' "
                           "WHEN 2 THEN 'tablet' ELSE NULL END",
            "duration_ms": "CASE WHEN event_id % 7 = 0 THEN NULL "
                           "ELSE CAST(floor(value * 100) AS BIGINT) END",
        },
        "event_type <> 'error'",
    ),
    "api_metrics": (
        {
            "event_id": "event_id",
            "log_ts": "ts",
            "metric_date": "CAST(ts AS DATE)",
            "service_name": "concat('svc-', CAST(user_id % 5 AS STRING))",
            "endpoint": "concat('/api/v1/', CAST(event_id % 8 AS STRING))",
            "method": "CASE event_id % 4 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' WHEN 2 THEN 'PUT' "
                      "ELSE 'DELETE' END",
            "status_code": "CAST(CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 400 "
                           "WHEN 1 THEN 404 WHEN 2 THEN 500 ELSE 503 END "
                           "WHEN event_type = 'purchase' THEN 201 ELSE 200 END AS INT)",
            "response_time_ms": "CAST(floor(value * 10) AS BIGINT)",
            "request_size_bytes": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 10000 END",
            "response_size_bytes": "(event_id * 7) % 50000",
            "user_id": "CASE WHEN event_id % 6 = 0 THEN NULL "
                       "ELSE concat('user_', CAST(user_id AS STRING)) END",
            "client_ip": "concat('10.0.', CAST(user_id % 256 AS STRING), '.', "
                         "CAST(event_id % 256 AS STRING))",
            "error_message": "CASE WHEN event_type = 'error' "
                             "THEN concat('Error occurred: ', CAST(event_id AS STRING)) ELSE NULL END",
        },
        "TRUE",
    ),
    "user_activity": (
        {
            "event_id": "event_id",
            "user_id": "concat('user_', CAST(user_id AS STRING))",
            "event_type": "CASE WHEN event_type = 'signup' THEN 'LOGIN' ELSE 'API_ACCESS' END",
            "event_date": "CAST(ts AS DATE)",
            "log_ts": "ts",
            "endpoint": "CASE WHEN event_type = 'error' "
                        "THEN concat('/api/v1/', CAST(event_id % 8 AS STRING)) ELSE NULL END",
            "status_code": "CASE WHEN event_type = 'error' THEN 500 ELSE NULL END",
            "response_time_ms": "CAST(floor(value * 10) AS BIGINT)",
            "session_id": "concat('sess_', CAST(user_id AS STRING), '_', CAST(event_id % 5 AS STRING))",
        },
        "event_type IN ('signup', 'error')",
    ),
    "database_metrics": (
        {
            "event_id": "event_id",
            "log_ts": "ts",
            "metric_date": "CAST(ts AS DATE)",
            "database_name": "concat('db-', CAST(user_id % 3 AS STRING))",
            "query_type": "CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'click' THEN 'SELECT' "
                          "WHEN 'purchase' THEN 'UPDATE' ELSE 'INSERT' END",
            "execution_time_ms": "CAST(floor(value * 10) AS BIGINT)",
            "rows_affected": "CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE event_id % 100 END",
        },
        "TRUE",
    ),
    "demo_events": (
        {
            "event_id": "event_id",
            "log_ts": "ts",
            "event_date": "CAST(ts AS DATE)",
            "user_id": "concat('user_', CAST(user_id AS STRING))",
            "event_type": "event_type",
            "country_code": "CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN NULL "
                            "ELSE CASE event_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'DE' "
                            "WHEN 3 THEN 'FR' ELSE 'JP' END END",
            "session_id": "CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN NULL "
                          "ELSE concat('sess_', CAST(event_id % 5 AS STRING)) END",
        },
        "TRUE",
    ),
    "all_types": (
        {
            "event_id": "event_id",
            "c_string": "concat(event_type, '/\"', props, '\"')",
            "c_int": "CAST(user_id AS INT)",
            "c_long": "event_id * 4000000000",
            "c_float": "CAST(event_id % 64 AS FLOAT) / CAST(8 AS FLOAT)",
            "c_double": "value / 3",
            "c_boolean": "event_type = 'click'",
            "c_timestamp": "ts",
            "c_date": "CAST(ts AS DATE)",
        },
        "TRUE",
    ),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Rows of a log type with the config's column names."""
    columns, where = VIEWS[name]
    rows = read(spark, sf_dir, "events").where(where)
    out = rows.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])
    if name == "user_events":
        out = out.withColumn("properties", F.from_json("properties_json", "map<string,string>"))
    if name == "all_types":
        out = out.withColumns(
            {
                "c_strings": F.array("c_string", F.lit("x")),
                "c_ints": F.array("c_int", F.lit(7)),
                "c_longs": F.array("c_long", F.lit(9)),
                "c_map": F.create_map(F.lit("k"), "c_string"),
            }
        )
    return out.withColumnRenamed("log_ts", "timestamp")


def with_views(query: str) -> str:
    """DuckDB text of a query over the views it names.  A query may go on with CTEs of its own."""
    ctes = []
    for name, (columns, where) in VIEWS.items():
        if name in query:
            picks = ", ".join(f"{e} AS {n}" for n, e in columns.items())
            ctes.append(f"{name} AS (SELECT {picks} FROM events WHERE {where})")
    if query.startswith(","):
        text = "WITH " + ", ".join(ctes) + (query if ctes else query.removeprefix(","))
    else:
        text = f"WITH {', '.join(ctes)} {query}" if ctes else query
    return text.replace("AS STRING)", "AS VARCHAR)")
