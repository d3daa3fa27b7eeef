"""Topics as Spark sources and sinks: a Kafka cluster, or folders of Parquet message files.

Both give messages as ``topic, partition, offset, key, value, timestamp``.  In a file topic a
file is a partition and the row's place in the file is its offset.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MESSAGE_DDL = "key string, value string, timestamp timestamp"
COLUMNS = ["topic", "partition", "offset", "key", "value", "timestamp"]


@dataclasses.dataclass(frozen=True)
class FileTopics:
    """Topics as sub-folders of ``root``.  Producers drop files there, readers follow them.

    ``format="parquet"``: files of ``key, value, timestamp``, as ``publish`` writes them.
    ``format="text"``: one message per line, without keys and offsets.  A micro-batch takes at most ``max_bytes_per_trigger`` of files, or ``max_files_per_trigger``
    files if that is given, so catching up on a long topic stays a row of bounded batches.
    """

    root: str
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int = 100 * 1024**3
    format: str = "parquet"

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def publish(self, messages: DataFrame, topic: str) -> None:
        if self.format == "text":
            messages.select("value").write.mode("append").text(self.path(topic))
            return
        out = messages.select("key", "value", F.current_timestamp().alias("timestamp"))
        out.write.mode("append").option("compression", "snappy").parquet(self.path(topic))

    def stream(self, spark: SparkSession, topic: str, starting: str = "earliest") -> DataFrame:
        if starting != "earliest":
            raise ValueError("a file topic is read from its first file")
        reader = self._reader(spark.readStream)
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        else:
            reader = reader.option("maxBytesPerTrigger", self.max_bytes_per_trigger)
        return self._messages(reader.load(self.path(topic)), topic)

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return self._messages(self._reader(spark.read).load(self.path(topic)), topic)

    def ends(self, spark: SparkSession, topic: str) -> DataFrame:
        """``end_offsets`` of the topic's files.  Of Parquet files no column is read, only how many rows their
        footers tell; text files have to be read to count their lines."""
        files = self._reader(spark.read).load(self.path(topic))
        held = files.groupBy(F.col("_metadata.file_name").alias("partition")).agg(F.count(F.lit(1)).alias("messages"))
        return held.select(F.lit(topic).alias("topic"), "partition", F.col("messages").alias("end_offset"), "messages")

    def _reader(self, reader):
        schema = "value string" if self.format == "text" else MESSAGE_DDL
        return reader.format(self.format).schema(schema)

    def _messages(self, files: DataFrame, topic: str) -> DataFrame:
        text = self.format == "text"
        return files.select(
            F.lit(topic).alias("topic"),
            F.col("_metadata.file_name").alias("partition"),
            (F.lit(None).cast("long") if text else F.col("_metadata.row_index")).alias("offset"),
            (F.lit(None).cast("string") if text else F.col("key")).alias("key"),
            "value",
            F.col("_metadata.file_modification_time" if text else "timestamp").alias("timestamp"),
        )


@dataclasses.dataclass(frozen=True)
class KafkaTopics:
    """Topics on Kafka brokers.  Needs the spark-sql-kafka package on the classpath.

    ``min_partitions`` splits the partitions of a hot topic into more tasks.
    ``fail_on_data_loss``: whether a stream stops when messages it has not read are gone from the topic;
    without it the stream goes on, which suits topics of short retention.  Bounded reads always fail then.
    """

    servers: str
    max_offsets_per_trigger: int | None = 200_000_000
    min_partitions: int | None = None
    fail_on_data_loss: bool = False

    def publish(self, messages: DataFrame, topic: str) -> None:
        """Keyed messages; the broker's partitioner places them by key.

        Send settings: leader acknowledgement, three retries, 10 ms linger, snappy.
        """
        (
            messages.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("topic", topic)
            .option("kafka.acks", "1")
            .option("kafka.retries", "3")
            .option("kafka.linger.ms", "10")
            .option("kafka.batch.size", "32768")
            .option("kafka.compression.type", "snappy")
            .save()
        )

    def stream(self, spark: SparkSession, topic: str, starting: str = "earliest") -> DataFrame:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(self.fail_on_data_loss).lower())
        )
        if self.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", self.max_offsets_per_trigger)
        if self.min_partitions:
            reader = reader.option("minPartitions", self.min_partitions)
        return self._messages(reader.load())

    def read(self, spark: SparkSession, topic: str, offsets: dict[int, int] | None = None,
             until: dict[int, int] | None = None) -> DataFrame:
        reader = spark.read.format("kafka").options(**self.read_options(topic, offsets, until))
        return self._messages(reader.load())

    def read_options(self, topic: str, offsets: dict[int, int] | None = None, until: dict[int, int] | None = None) -> dict[str, str]:
        """Options of a bounded read: the whole topic, or the named partitions from an offset on, up to ``until`` (not included).

        The connector wants an offset for every partition it reads, so only the named ones are assigned;
        one that is named on one side only is read from its start, or to its end.
        """
        options = {"kafka.bootstrap.servers": self.servers, "failOnDataLoss": "true"}
        if not offsets and not until:
            return options | {"subscribe": topic, "startingOffsets": "earliest", "endingOffsets": "latest"}
        start, end = offsets or {}, until or {}
        named = sorted(start | end)

        def as_json(given: dict[int, int], otherwise: int) -> str:
            return json.dumps({topic: {str(p): given.get(p, otherwise) for p in named}})

        return options | {"assign": json.dumps({topic: named}), "startingOffsets": as_json(start, -2), "endingOffsets": as_json(end, -1)}

    @staticmethod
    def _messages(kafka: DataFrame) -> DataFrame:
        return kafka.withColumn("key", F.col("key").cast("string")).withColumn(
            "value", F.col("value").cast("string")
        ).select(*COLUMNS)


def replay(messages: DataFrame, from_offsets: dict | None = None) -> DataFrame:
    """All messages, or only those of the named partitions from the given offset on."""
    if from_offsets is None:
        return messages
    wanted: Column = F.lit(False)
    for partition, offset in from_offsets.items():
        wanted |= (F.col("partition") == partition) & (F.col("offset") >= offset)
    return messages.where(wanted)


def peek(messages: DataFrame, n: int, newest: bool = False) -> DataFrame:
    """The first (or last) ``n`` messages in offset order, partition by partition number."""
    order = ["offset", "partition"]
    return messages.orderBy(*[F.desc(c) if newest else F.asc(c) for c in order]).limit(n)


def end_offsets(messages: DataFrame) -> DataFrame:
    """Next offset of every partition and how many messages it holds now; messages without offsets (text topics) are counted."""
    held = F.count(F.lit(1))
    return messages.groupBy("topic", "partition").agg(
        F.coalesce(F.max("offset") + 1, held).alias("end_offset"), held.alias("messages")
    )


def topic_totals(messages: DataFrame) -> DataFrame:
    """Messages ever written per topic: the sum of its end offsets.  Scans the topic."""
    return totals(end_offsets(messages))


def totals(ends: DataFrame) -> DataFrame:
    """Messages ever written per topic, from the end offsets of its partitions."""
    return ends.groupBy("topic").agg(F.sum("end_offset").alias("total_messages"))


def topic_plan(configs: DataFrame) -> DataFrame:
    """One row per topic of a catalog (see ``with_defaults``): what a shared topic needs.

    The most partitions, the highest replication and the longest retention any of its types
    asks for.
    """
    return configs.groupBy("topic").agg(
        F.max("partitions").alias("partitions"),
        F.max("replication_factor").alias("replication_factor"),
        F.max("retention_ms").alias("retention_ms"),
        F.countDistinct("log_type").alias("log_types"),
    )


def topic_types(configs: DataFrame) -> DataFrame:
    """Which types travel on which topic, one row each."""
    return configs.select("topic", "log_type").distinct()
