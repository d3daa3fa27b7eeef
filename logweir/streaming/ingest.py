"""Streaming ingest: topics -> classified messages -> log tables, plus a table of rejects."""

from __future__ import annotations

import dataclasses
from collections import Counter

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.functions.envelope import (
    REASONS,
    classify,
    decode,
    null_rows,
    records,
    rejects,
    with_ingestion_time,
)
from logweir.operators import tables
from logweir.sources.configs import Field, LogConfig
from logweir.streaming.ledger import Ledger

INGESTED = ("_ingestion_timestamp", "_ingestion_date")
MODES = ("quarantine", "null_row", "drop")


@dataclasses.dataclass
class IngestRun:
    """Started queries, the types that could not be started with the reason, and the record of batches."""

    queries: list[StreamingQuery]
    failures: dict[str, str]
    ledger: Ledger

    def finish(self) -> None:
        """Wait for bounded queries; the first failure is raised."""
        for query in self.queries:
            query.awaitTermination()

    def watch(self, seconds: float = 1.0) -> None:
        """Wait until any of these queries ends; a failure is raised within a round of waits."""
        while not any(query.awaitTermination(seconds) for query in self.queries):
            pass


def quarantine_config(database: str) -> LogConfig:
    """Table of messages not accepted, with their place in the topic; partitioned by the query that met them and by day."""
    names = ["source", "key", "value", "_log_type", "_version", "reason", "topic", "topic_partition"]
    origin = (Field("topic_offset", "long", required=False), Field("produced_at", "timestamp", required=False))
    return LogConfig(
        name="Quarantine",
        log_type="quarantine",
        topic="",
        table=f"{database}.quarantine",
        partition_by=("source", "_ingestion_date"),
        fields=(*(Field(n, "string", required=False) for n in names), *origin),
    )


def start_ingest(
    spark: SparkSession,
    configs: list[LogConfig],
    topics,
    warehouse: str,
    checkpoint: str,
    fan_out: str = "topic",
    on_invalid: str = "quarantine",
    route: bool = True,
    starting: str = "earliest",
    trigger: dict | None = None,
    codec: str = "snappy",
    cluster: bool = True,
    repartition: int | None = None,
) -> IngestRun:
    """Start the streaming queries that fill the tables of ``configs``.

    ``fan_out="topic"``: one query per topic reads it once and writes every type on it.
    ``fan_out="type"``: one query per type; a shared topic is read once for each type on it.
    ``route=False`` (with ``"type"``): every table takes every message of its topic, decoded
    with its own schema, misfits as NULL.
    ``on_invalid``: what becomes of messages that are not accepted: kept with a reason in the
    quarantine table, written to the type's table as NULLs, or left out.
    ``cluster=False`` writes without a shuffle, one file per task and table partition.
    ``repartition``: deal each micro-batch over so many tasks before it is parsed, always; for topics with
    few, large partitions.  Without it a batch is parsed in the tasks it is read in.

    Rows per table and rejects per reason of every batch are recorded in ``_batches`` of the warehouse
    (``IngestRun.ledger``), counted by the writing tasks.  Messages left out (``"drop"``) are not counted.

    A type that cannot be set up is reported with the reason.  It does not stop other topics, but no
    query of its own topic starts that would move past its messages: with one query per topic the
    whole topic waits, with one query per type only that type does.  Once the config is mended, the next
    start takes all messages up where the checkpoint left them.  Checkpoints belong to one ``fan_out``:
    the other way starts from ``starting`` again.
    """
    if on_invalid not in MODES:
        raise ValueError(f"on_invalid is one of {MODES}")
    trigger = trigger or {"processingTime": "10 seconds"}
    ready, failures = [], {}
    owner: dict[str, str] = {}
    kinds = Counter((c.topic, c.log_type) for c in configs)
    for config in configs:
        try:
            if not config.fields:
                raise ValueError(f"{config.log_type} declares no fields")
            if kinds[config.topic, config.log_type] > 1:
                raise ValueError(f"{config.log_type} is declared more than once on topic {config.topic}")
            if config.table in owner:
                raise ValueError(f"table {config.table} already belongs to {owner[config.table]}")
            effective, _ = tables.ensure_table(spark, config, warehouse, codec)
            tables.recover(spark, config.table)
            owner[config.table] = config.log_type
            ready.append(effective)
        except Exception as error:  # one bad config must not stop the rest
            failures[config.log_type] = str(error)

    by_topic: dict[str, list[LogConfig]] = {}
    for config in ready:
        by_topic.setdefault(config.topic, []).append(config)
    held = {topic: sorted({c.log_type for c in configs if c.topic == topic and c.log_type in failures}) for topic in by_topic}
    queries, ledger = [], Ledger(f"{warehouse}/_batches")
    for topic, members in by_topic.items():
        if held[topic] and fan_out == "topic":
            failures |= {c.log_type: f"topic {topic} waits for {', '.join(held[topic])}" for c in members if c.log_type not in failures}
            continue
        groups = [members] if fan_out == "topic" else [[c] for c in members]
        for number, group in enumerate(groups):
            name = topic if fan_out == "topic" else group[0].log_type
            writer = _BatchWriter(
                source=name,
                configs=group,
                others=(*[c.log_type for c in members if c not in group], *held[topic]),
                repartition=repartition,
                lead=number == 0,
                ledger=ledger,
                topic=topic,
                on_invalid=on_invalid,
                route=route,
                cluster=cluster,
                quarantine=quarantine_config(group[0].table.split(".")[0]),
            )
            try:
                if on_invalid == "quarantine" and route:
                    tables.ensure_table(spark, writer.quarantine, warehouse, codec)
                stream = with_ingestion_time(topics.stream(spark, topic, starting))
                queries.append(
                    stream.writeStream.outputMode("append")
                    .queryName(name)
                    .trigger(**trigger)
                    .option("checkpointLocation", f"{checkpoint}/{name}")
                    .foreachBatch(writer)
                    .start()
                )
            except Exception as error:  # nor one topic that cannot be read
                failures |= {c.log_type: str(error) for c in group}
    return IngestRun(queries, failures, ledger)


@dataclasses.dataclass
class _BatchWriter:
    """foreachBatch body: classify the micro-batch once, then write each table.

    Every write is keyed by the batch's ingestion time, which the stream's checkpoint keeps, so
    a batch that is replayed after a failure replaces what its first attempt left.
    """

    source: str
    configs: list[LogConfig]
    others: tuple[str, ...]
    lead: bool
    on_invalid: str
    route: bool
    quarantine: LogConfig
    cluster: bool
    ledger: Ledger
    topic: str
    repartition: int | None = None

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        if self.repartition:
            batch = batch.repartition(self.repartition)
        if self.route:
            # Only rejects keep their text: the cached batch holds each message once.
            text = F.when(F.col("_reason").isNotNull(), F.col("value"))
            batch = self._attributed(classify(batch, self.configs)).withColumn("value", text)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # The batch's number is its ingestion time, one for all rows; an empty batch has nothing to write.  All
            # tasks parse and keep their part for it: for the first row one would do a whole partition alone.
            number = batch.agg(F.max(F.unix_millis("_ingestion_timestamp"))).first()[0]
            if number is not None:
                self._write(batch, number)
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, number: int) -> None:
        held, written = {"rows": F.count(F.lit(1))}, []
        for config in self.configs:
            if not self.route:
                rows = decode(batch, config, INGESTED)
            else:
                rows = records(batch, config, INGESTED)
                if self.on_invalid == "null_row":
                    rows = rows.unionByName(null_rows(batch, config, INGESTED))
            counts = tables.append_batch(rows, config, batch_id=number, cluster=self.cluster, figures=held)
            written.append({"table_name": config.table, "log_type": config.log_type, "rows": counts["rows"]})
        if self.route and self.on_invalid == "quarantine":
            why = {r: F.count_if(F.col("reason") == r) for r in REASONS}
            counts = tables.append_batch(self._rejects(batch), self.quarantine, batch_id=number, figures=held | why)
            written.append({"table_name": self.quarantine.table, "log_type": self.quarantine.log_type, "rows": counts["rows"],
                            "rejects": {r: counts[r] for r in REASONS}})
        self.ledger.record(batch.sparkSession, self.source, self.topic, number, written)

    def _attributed(self, classified: DataFrame) -> DataFrame:
        """Of a topic other queries read too, only this query's share of the messages.

        Messages of no known type go to the topic's first query, so they are quarantined once.
        """
        if self.others:
            theirs = F.coalesce(F.col("_log_type").isin(list(self.others)), F.lit(False))
            classified = classified.where(~theirs)
        if not self.lead and self.on_invalid != "null_row":
            mine = F.col("_log_type").isin([c.log_type for c in self.configs])
            classified = classified.where(F.coalesce(mine, F.lit(False)))
        return classified

    def _rejects(self, classified: DataFrame) -> DataFrame:
        whole = rejects(classified, ("topic", "partition", "offset", "timestamp", *INGESTED))
        return whole.withColumns({
            "source": F.lit(self.source), "topic_partition": F.col("partition").cast("string"), "topic_offset": F.col("offset"),
            "produced_at": F.col("timestamp")}).drop("partition", "offset", "timestamp")
