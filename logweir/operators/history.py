"""What a log table knows about itself: batches, files, partitions, and reads as of a moment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.operators.tables import COMMIT, quoted, read_table

_MB = 1024.0 * 1024.0


def snapshots(table: DataFrame) -> DataFrame:
    """One row per ingested batch, newest first; ``_batch_id`` is the version.  Reads two columns."""
    return (
        table.groupBy("_batch_id")
        .agg(F.min("_ingestion_timestamp").alias("committed_at"), F.count(F.lit(1)).alias("added_records"))
        .withColumn("operation", F.lit("append"))
        .orderBy(F.desc("_batch_id"))
    )


def files(table: DataFrame, partition_by: list[str]) -> DataFrame:
    """Data files with partition, size and rows, largest first.

    Only partition values and file metadata are read; rows are counted before they move.
    """
    return (
        table.groupBy(
            *partition_by,
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size_in_bytes"),
        )
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("size_mb", F.col("file_size_in_bytes") / F.lit(_MB))
        .orderBy(F.desc("file_size_in_bytes"), "file_path")
    )


def partitions(table: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows, files and bytes per table partition."""
    per_file = files(table, partition_by).groupBy(*partition_by)
    return per_file.agg(
        F.sum("record_count").alias("record_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size_in_bytes").alias("total_bytes"),
    )


def as_of(spark: SparkSession, table: str, version: int | None = None,
          timestamp: dt.datetime | None = None) -> DataFrame:
    """The table as it stood after a batch, or at a moment.

    Later batches are pruned as partitions, by number or, as a batch is numbered by its ingestion time,
    by moment; a compaction may hold earlier rows, so its partitions stay in and their rows are filtered.
    """
    rows = read_table(spark, table)
    if version is not None:
        rows = rows.where((F.col(COMMIT) <= 2 * version + 1) | (F.col(COMMIT) % 2 == 1))
        rows = rows.where(F.col("_batch_id") <= version)
    if timestamp is not None:
        latest = F.unix_millis(F.lit(timestamp).cast("timestamp")) * 2 + 1
        rows = rows.where((F.col(COMMIT) <= latest) | (F.col(COMMIT) % 2 == 1))
        rows = rows.where(F.col("_ingestion_timestamp") <= F.lit(timestamp))
    return rows


def tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {quoted(table)}")


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")
