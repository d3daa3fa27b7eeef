"""The whole way from rows to a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweir.functions.envelope import encode
from logweir.operators.reports import error_rate
from logweir.plans import log_types
from logweir.plans.staging import NOW, dealt, new_stage
from logweir.plans.views import view
from logweir.streaming.ingest import start_ingest


def error_rate_after_ingest(spark: SparkSession, sf_dir: str, since: str = "2024-01-15") -> DataFrame:
    """Publish API calls as messages, ingest them, and report error rates from the table."""
    stage = new_stage(spark, [log_types.document("api_metrics")])
    config = stage.configs["api_metrics"]
    calls = dealt(view(spark, sf_dir, "api_metrics"))
    stage.topics.publish(encode(calls, config), config.topic)
    run = start_ingest(spark, [config], stage.topics, stage.warehouse, f"{stage.root}/checkpoints", trigger=NOW)
    run.finish()
    return error_rate(stage.table("api_metrics"), since)
