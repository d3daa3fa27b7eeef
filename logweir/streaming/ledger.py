"""What every micro-batch put where: rows per table and rejects per reason, counted while they are written."""

from __future__ import annotations

import datetime as dt
import json
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from logweir.session import delete_paths, list_names, path_exists, write_text

_KEYS = ["source", "batch_id"]
_DDL = ("source string, topic string, batch_id long, table_name string, log_type string, rows long, "
        "rejects map<string,long>, recorded_at long")


class Ledger:
    """Batch records under ``folder``: one small JSON file per batch, folded into Parquet by day.

    The counts are observed by the tasks that write the rows, behind the last shuffle, where Spark takes
    each partition's figures once however often its task is tried; no job runs for them.  A batch that is
    replayed replaces its record.
    """

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def record(self, spark: SparkSession, source: str, topic: str, batch_id: int, written: list[dict]) -> None:
        """``written``: for each table ``table_name``, ``log_type``, ``rows`` and, for the quarantine, ``rejects``."""
        day = dt.datetime.fromtimestamp(batch_id / 1000, dt.timezone.utc).date()
        head = {"source": source, "topic": topic, "batch_id": batch_id, "recorded_at": time.time_ns() // 1_000_000}
        lines = "\n".join(json.dumps(head | one) for one in written)
        write_text(spark, f"{self.folder}/new/{day}/{source}-{batch_id}.json", lines)

    def batches(self, spark: SparkSession) -> DataFrame:
        """One row per batch and table.  Of a batch recorded more than once the last record counts."""
        fresh, folded = f"{self.folder}/new", f"{self.folder}/folded"
        parts = []
        if path_exists(spark, fresh):
            parts.append(spark.read.schema(_DDL).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(fresh))
        if path_exists(spark, folded):
            parts.append(spark.read.schema(_DDL).parquet(folded))
        if not parts:
            return spark.createDataFrame([], _DDL).drop("recorded_at")
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        last = F.max("recorded_at").over(Window.partitionBy(*_KEYS))
        kept = both.withColumn("_last", last).where(F.col("recorded_at") == F.col("_last"))
        return kept.dropDuplicates([*_KEYS, "table_name"]).drop("recorded_at", "_last")

    def fold(self, spark: SparkSession, before: dt.date) -> int:
        """Move the records of earlier days into one Parquet file each run; returns the days moved.

        Stopped in between, the next run moves the same records again, which reads as once.
        """
        names = [n for n in list_names(spark, f"{self.folder}/new") if n < before.isoformat()]
        if names:
            paths = [f"{self.folder}/new/{n}" for n in names]
            rows = spark.read.schema(_DDL).option("pathGlobFilter", "*.json").json(paths)
            rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/folded")
            delete_paths(spark, paths)
        return len(names)


def snapshots(batches: DataFrame, table: str) -> DataFrame:
    """One row per ingested batch of a table that gave it rows, newest first; reads records only."""
    mine = batches.where((F.col("table_name") == table) & (F.col("rows") > 0))
    return (
        mine.groupBy("batch_id").agg(F.sum("rows").alias("added_records"))
        .select(F.col("batch_id").alias("_batch_id"), F.timestamp_millis("batch_id").alias("committed_at"),
                "added_records", F.lit("append").alias("operation"))
        .orderBy(F.desc("_batch_id"))
    )


def loaded(batches: DataFrame) -> DataFrame:
    """Rows per topic in tables and quarantine, as ``quality.health`` takes them."""
    return batches.groupBy("topic").agg(F.sum("rows").alias("rows"))


def reject_counts(batches: DataFrame) -> DataFrame:
    """Rejects per source and reason."""
    each = batches.where("rejects IS NOT NULL").select("source", F.explode("rejects").alias("reason", "n"))
    return each.groupBy("source", "reason").agg(F.sum("n").alias("messages")).where("messages > 0")
