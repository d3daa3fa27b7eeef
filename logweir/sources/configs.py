"""The log-config catalog: JSON files -> DataFrame -> LogConfig objects on the driver."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, functions as F

# `iceberg` is the optional on/off and layout section some configs carry beside the schema.
CONFIG_DDL = """
    name string, log_type string, version string, description string,
    kafka struct<topic: string, partitions: int, replication_factor: int, retention_ms: bigint>,
    warehouse struct<table_name: string, partition_by: array<string>, sort_by: array<string>,
                     retention_days: int>,
    iceberg struct<enabled: boolean, partition_fields: array<string>, sort_fields: array<string>>,
    fields array<struct<name: string, type: string, required: boolean, default: string,
                        description: string>>
"""

# What a config means when it leaves these out.
DEFAULT_VERSION = "1.0.0"
DEFAULT_PARTITIONS = 3
DEFAULT_REPLICATION = 1
DEFAULT_RETENTION_MS = 604_800_000
DEFAULT_NAMESPACE = "analytics_logs"


@dataclasses.dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = True
    default: str | None = None


@dataclasses.dataclass(frozen=True)
class LogConfig:
    name: str
    log_type: str
    topic: str
    table: str
    fields: tuple[Field, ...]
    version: str = DEFAULT_VERSION
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    retention_days: int | None = None

    @property
    def key_field(self) -> str:
        """Message key: the first field naming a user or a session, else the first field; empty without fields."""
        named = [f.name for f in self.fields if "user_id" in f.name or "session_id" in f.name]
        return next(iter([*named, *[f.name for f in self.fields]]), "")


def load_configs(spark: SparkSession, path: str, on_error: str = "abort") -> DataFrame:
    """Every ``*.json`` of a folder, or one file.  ``.json.disabled`` and the like are not read.

    ``on_error="abort"`` fails on the first unreadable file, ``"skip"`` leaves such files out;
    ``unreadable_configs`` says which they are.
    """
    reader = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json")
    if on_error == "abort":
        return reader.schema(CONFIG_DDL).option("mode", "FAILFAST").json(path)
    if on_error != "skip":
        raise ValueError("on_error is 'abort' or 'skip'")
    rows = reader.schema(CONFIG_DDL + ", _corrupt_record string").json(path)
    return rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def unreadable_configs(spark: SparkSession, path: str) -> DataFrame:
    """Files that ``on_error="skip"`` leaves out: file, content."""
    texts = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    parsed = F.from_json("value", CONFIG_DDL + ", _corrupt_record string", {"mode": "PERMISSIVE"})
    return (texts.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"), parsed.alias("config"))
            .where("config._corrupt_record IS NOT NULL").drop("config"))


def enabled_configs(configs: DataFrame) -> DataFrame:
    """Leave out configs whose ingest is switched off."""
    return configs.where(F.coalesce(F.col("iceberg.enabled"), F.lit(True)))


def with_defaults(configs: DataFrame, namespace: str | None = None) -> DataFrame:
    """Fill what a config may leave out and flatten it to one row of plain columns.

    ``namespace`` replaces the database part of the table name; without it the config's own
    two-part name stands.
    """
    last_part = F.element_at(F.split("warehouse.table_name", r"\."), -1)
    short = F.coalesce(last_part, F.lower("name"))
    if namespace is None:
        table = F.coalesce(
            F.col("warehouse.table_name"), F.concat(F.lit(DEFAULT_NAMESPACE + "."), F.lower("name"))
        )
    else:
        table = F.concat(F.lit(namespace + "."), short)
    return configs.select(
        "name",
        F.coalesce("log_type", F.lower("name")).alias("log_type"),
        F.coalesce("version", F.lit(DEFAULT_VERSION)).alias("version"),
        F.col("kafka.topic").alias("topic"),
        F.coalesce("kafka.partitions", F.lit(DEFAULT_PARTITIONS)).alias("partitions"),
        F.coalesce("kafka.replication_factor", F.lit(DEFAULT_REPLICATION)).alias("replication_factor"),
        F.coalesce("kafka.retention_ms", F.lit(DEFAULT_RETENTION_MS)).cast("long").alias("retention_ms"),
        table.alias("table_name"),
        F.coalesce("warehouse.partition_by", F.array().cast("array<string>")).alias("partition_by"),
        F.coalesce("warehouse.sort_by", F.array().cast("array<string>")).alias("sort_by"),
        F.col("warehouse.retention_days").alias("retention_days"),
        "fields",
    )


def collect_configs(configs: DataFrame, namespace: str | None = None) -> list[LogConfig]:
    """Config rows as driver objects.  A catalog is one row per log type, never log data."""
    rows = with_defaults(configs, namespace).orderBy("log_type").collect()
    return [
        LogConfig(
            name=r.name,
            log_type=r.log_type,
            version=r.version,
            topic=r.topic,
            table=r.table_name,
            partition_by=tuple(r.partition_by),
            sort_by=tuple(r.sort_by),
            retention_days=r.retention_days,
            fields=tuple(
                Field(f["name"], f["type"], f["required"] is not False, f["default"]) for f in r.fields or []
            ),
        )
        for r in rows
    ]
