"""Time the headline queries; prints one JSON line.

Every query runs twice and its better time counts, so JVM warm-up is left out.  Rows go to the
noop sink: everything is computed, nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from logweir.functions import envelope as E
from logweir.operators import history
from logweir.plans import all_queries
from logweir.plans.staging import warehouse
from logweir.session import build_session

HEADLINE = [
    "entry_error_rate_after_ingest",
    "prj9_envelope_encode",
    "rte5_reject_counts",
    "src4_topic_replay",
    "agg2_events_by_type",
    "agg8_service_summary",
    "agg10_error_rate",
    "agg11_p95_by_service",
    "agg12_endpoint_profile",
    "agg13_user_behaviour",
    "agg14_top_clickers",
    "agg19_message_rates",
    "ts1_events_per_hour",
    "ts2_events_per_hour_and_type",
    "ts3_failing_minutes",
    "top1_newest_events",
    "top3_failed_calls",
    "jon1_events_with_calls",
    "jon2_events_with_customers",
    "set1_table_counts",
    "uc1_funnel",
    "uc4_user_day_features",
    "met3_partitions",
    "met5_as_of_version",
    "chk5_health",
    "tbl9_replayed_append",
    "tbl14_compaction",
]


def timed(run) -> float:
    start = time.time()
    run().write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "logweir-bench", master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()

    start = time.time()
    stage = warehouse(spark, sf_dir)
    ingest = time.time() - start
    messages = sum(r.input_rows for r in stage.progress.collect())

    times = {"first_ingest": round(ingest, 3)}  # rows -> messages -> topics -> streams -> tables, once
    for name in HEADLINE:
        times[name] = round(min(timed(lambda: registered[name](spark, sf_dir)) for _ in range(2)), 3)

    configs = [stage.configs["user_events"], stage.configs["user_activity"]]
    shared = stage.topics.read(spark, "user-events")
    decode = min(timed(lambda: E.classify(shared, configs)) for _ in range(2))
    calls = stage.table("api_metrics")
    files = history.files(calls, ["metric_date", "service_name"])
    table_bytes = files.agg(F.sum("file_size_in_bytes")).first()[0]
    json_bytes = stage.topics.read(spark, "api-metrics").agg(F.avg(F.octet_length("value"))).first()[0]
    sizes = {
        "json_bytes_per_row": round(json_bytes),
        "table_bytes_per_row": round(table_bytes / calls.count()),
        "messages_ingested": messages,
        "first_ingest_sec": round(ingest, 3),
        "decode_messages_per_sec": round(shared.count() / decode),
    }
    print(json.dumps({
        "metric": "first ingest, and headline queries (better of two runs), summed",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        **sizes,
    }))


if __name__ == "__main__":
    sys.exit(main())
