"""Ingested warehouses the registered queries read: written once per session and data folder.

Everything is derived from the ``events`` table and goes the whole way: rows -> messages ->
file topic -> stream -> tables, in the folder ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import dataclasses
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.functions.envelope import encode, with_ingestion_time
from logweir.operators import tables
from logweir.plans import log_types
from logweir.plans.views import view
from logweir.session import delete_paths, list_names, shared_dir
from logweir.sources.configs import LogConfig, collect_configs, load_configs
from logweir.sources.topics import FileTopics
from logweir.streaming.ingest import start_ingest
from logweir.streaming.ledger import Ledger
from logweir.streaming.progress import ProgressLog, progress

# Messages before this moment go into the first batch, the rest into the second.
SPLIT = "2024-01-16 00:00:00"
NOW = {"availableNow": True}

# How the shared topic is damaged: the first rule whose divisor divides event_id.
DAMAGE = [
    (97, "no_envelope"),
    (101, "malformed"),
    (103, "missing_required"),
    (107, "unknown_type"),
    (109, "bad_type"),
]
DAMAGE_SQL = "CASE " + " ".join(f"WHEN event_id % {n} = 0 THEN '{r}'" for n, r in DAMAGE) + " END"


@dataclasses.dataclass
class Stage:
    """One written warehouse: where it is and the configs it was written with."""

    spark: SparkSession
    root: str
    configs: dict[str, LogConfig]
    topics: FileTopics
    progress: DataFrame | None = None
    ledger: Ledger | None = None
    ingested: set[str] = dataclasses.field(default_factory=set)
    sent: set[str] = dataclasses.field(default_factory=set)

    def table(self, log_type: str) -> DataFrame:
        return tables.read_table(self.spark, self.configs[log_type].table)

    @property
    def quarantine(self) -> DataFrame:
        database = next(iter(self.configs.values())).table.split(".")[0]
        return tables.read_table(self.spark, f"{database}.quarantine")

    def remove(self) -> None:
        """Drop the tables and delete the folder."""
        for database in {c.table.split(".")[0] for c in self.configs.values()}:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
        delete_paths(self.spark, [self.root])

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"


_stages: dict[tuple, Stage] = {}


def once(build):
    """Build a stage the first time a session asks for it."""

    def get(spark: SparkSession, sf_dir: str) -> Stage:
        key = (build.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _stages:
            _stages[key] = build(spark, sf_dir)
        return _stages[key]

    return get


def forget(stage: Stage) -> None:
    for key in [k for k, s in _stages.items() if s is stage]:
        del _stages[key]


def new_stage(spark: SparkSession, documents: list[dict]) -> Stage:
    name = f"logs_{uuid.uuid4().hex[:12]}"
    root = f"{shared_dir(spark)}/logweir/{name}"
    folder = log_types.write_configs(spark, documents, f"{root}/configs")
    found = collect_configs(load_configs(spark, folder), namespace=name)
    return Stage(spark, root, {c.log_type: c for c in found}, FileTopics(f"{root}/topics"))


def dealt(rows: DataFrame) -> DataFrame:
    """Staged topics have several files, as topics have partitions: as many as the session shuffles into."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "event_id")


def in_batches(spark: SparkSession, topics: FileTopics, topic: str, batches: int) -> FileTopics:
    """The topics with micro-batches of such a share of one topic's files, however many these are."""
    held = sum(name.endswith(".parquet") for name in list_names(spark, topics.path(topic)))
    return dataclasses.replace(topics, max_files_per_trigger=max(1, -(-held // batches)))


def in_slice(rows: DataFrame, number: int) -> DataFrame:
    early = F.col("timestamp") < F.lit(SPLIT).cast("timestamp_ntz")
    return rows.where(early if number == 0 else ~early)


def damaged(rows: DataFrame, config: LogConfig) -> DataFrame:
    """Messages of the rows, damaged by DAMAGE; event_id stays as a column."""
    marked = rows.withColumn("_damage", F.expr(DAMAGE_SQL))
    marked = marked.withColumn(
        "user_id", F.when(F.col("_damage").eqNullSafe("missing_required"), None).otherwise(F.col("user_id"))
    )
    messages = encode(marked, config, keep=("_damage",))
    value, damage = F.col("value"), F.col("_damage")
    spoiled = (
        F.when(damage == "no_envelope", F.get_json_object(value, "$.data"))
        .when(damage == "malformed", F.substring(value, 1, 20))
        .when(damage == "unknown_type",
              F.regexp_replace(value, '"_log_type":"[a-z_]+"', '"_log_type":"unknown_type"'))
        .when(damage == "bad_type",
              F.regexp_replace(value, '"event_date":"[^"]*"', '"event_date":"not-a-date"'))
        .otherwise(value)
    )
    return messages.select("key", spoiled.alias("value"))


def shared_topic_messages(spark: SparkSession, sf_dir: str, configs: dict[str, LogConfig],
                          number: int | None = None) -> DataFrame:
    """Both types of the shared topic, damaged."""
    parts = []
    for log_type in ("user_events", "user_activity"):
        rows = view(spark, sf_dir, log_type)
        rows = dealt(rows if number is None else in_slice(rows, number))
        parts.append(damaged(rows, configs[log_type]))
    return reduce(DataFrame.unionAll, parts)


@once
def prepared(spark: SparkSession, sf_dir: str) -> Stage:
    """Configs of a shared topic's two types and of a dedicated topic's one; nothing is sent yet."""
    return new_stage(
        spark,
        [
            log_types.document("user_events", iceberg={"enabled": True}),
            log_types.document("api_metrics"),
            log_types.document("user_activity", iceberg={"enabled": True}),
        ],
    )


def topic_messages(spark: SparkSession, sf_dir: str, configs: dict[str, LogConfig], topic: str,
                   number: int | None = None) -> DataFrame:
    """What is sent to a topic, all of it or one slice."""
    if topic == "user-events":
        return shared_topic_messages(spark, sf_dir, configs, number)
    calls = view(spark, sf_dir, "api_metrics")
    return encode(dealt(calls if number is None else in_slice(calls, number)), configs["api_metrics"])


def topic(spark: SparkSession, sf_dir: str, name: str) -> FileTopics:
    """Topics of which one holds all its messages; no table is written for that."""
    stage = prepared(spark, sf_dir)
    if name in stage.ingested:
        return stage.topics
    alone = FileTopics(f"{stage.root}/sent")
    if name not in stage.sent:
        alone.publish(topic_messages(spark, sf_dir, stage.configs, name), name)
        stage.sent.add(name)
    return alone


def warehouse(spark: SparkSession, sf_dir: str, *topics: str) -> Stage:
    """The named topics, or both, sent and ingested in two batches each, one read per topic.

    Each topic is ingested when a query first asks for it, so a query waits for its own topics only.
    """
    stage = prepared(spark, sf_dir)
    missing = sorted((set(topics) or {c.topic for c in stage.configs.values()}) - stage.ingested)
    if not missing:
        return stage
    wanted = [c for c in stage.configs.values() if c.topic in missing]
    log = ProgressLog(spark, f"{stage.root}/progress")
    try:
        for number in (0, 1):
            for name in missing:
                stage.topics.publish(topic_messages(spark, sf_dir, stage.configs, name, number), name)
            run = start_ingest(spark, wanted, stage.topics, stage.warehouse, f"{stage.root}/checkpoints", trigger=NOW)
            run.finish()
            log.wait_for(run.queries)
    except BaseException:
        forget(stage)  # half of it is there: the next query starts anew
        raise
    finally:
        log.close()
    stage.ingested |= set(missing)
    stage.progress, stage.ledger = progress(spark, f"{stage.root}/progress"), run.ledger
    return stage


def shared_topic_once(spark: SparkSession, sf_dir: str, **how) -> Stage:
    """The shared topic in one batch, ingested another way."""
    stage = new_stage(spark, [log_types.document("user_events"), log_types.document("user_activity")])
    stage.topics.publish(shared_topic_messages(spark, sf_dir, stage.configs), "user-events")
    run = start_ingest(spark, list(stage.configs.values()), stage.topics, stage.warehouse,
                       f"{stage.root}/checkpoints", fan_out="type", trigger=NOW, **how)
    run.finish()
    return stage


@once
def per_type(spark: SparkSession, sf_dir: str) -> Stage:
    return shared_topic_once(spark, sf_dir)


@once
def unrouted(spark: SparkSession, sf_dir: str) -> Stage:
    return shared_topic_once(spark, sf_dir, route=False)


@once
def null_rows(spark: SparkSession, sf_dir: str) -> Stage:
    return shared_topic_once(spark, sf_dir, on_invalid="null_row")


@once
def evolved(spark: SparkSession, sf_dir: str) -> Stage:
    """A type that gains two fields between two runs of the same checkpoint."""
    stage = new_stage(spark, [log_types.document("demo_events")])
    later = new_stage(
        spark,
        [log_types.document("demo_events", ("country_code string?", "session_id string?"), version="1.1.0")],
    ).configs["demo_events"]
    v1 = stage.configs["demo_events"]
    v2 = dataclasses.replace(later, table=v1.table)
    for number, config in enumerate((v1, v2)):
        rows = dealt(in_slice(view(spark, sf_dir, "demo_events"), number))
        stage.topics.publish(encode(rows, config), config.topic)
        start_ingest(spark, [config], stage.topics, stage.warehouse, f"{stage.root}/checkpoints",
                     trigger=NOW).finish()
    stage.configs["demo_events"] = v2
    return stage


def new_table(spark: SparkSession, log_type: str, extra_fields: tuple[str, ...] = (), codec: str = "snappy",
              **changes) -> Stage:
    """An empty table of one log type in a database of its own."""
    stage = new_stage(spark, [log_types.document(log_type, extra_fields, **changes)])
    for config in stage.configs.values():
        tables.ensure_table(spark, config, stage.warehouse, codec)
    return stage


def half_day_batches(spark: SparkSession, sf_dir: str, log_type: str) -> list[DataFrame]:
    """All rows as two batches that share every date: mornings, then afternoons."""
    rows = with_ingestion_time(dealt(view(spark, sf_dir, log_type)))
    morning = F.hour("timestamp") < 12
    return [rows.where(morning), rows.where(~morning)]


def two_batch_table(spark: SparkSession, sf_dir: str, log_type: str = "api_metrics") -> Stage:
    stage = new_table(spark, log_type)
    for number, batch in enumerate(half_day_batches(spark, sf_dir, log_type)):
        tables.append_batch(batch, stage.configs[log_type], number)
    return stage
