"""Progress of streaming queries as a table: every micro-batch, however many there were."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from logweir.session import path_exists, write_text

_DDL = "query string, run string, batch_id long, at string, input_rows long, duration_ms long, end_offsets string, latest_offsets string"


class ProgressLog(StreamingQueryListener):
    """Writes one small JSON file per micro-batch of any query of the session to ``folder``.

    A query keeps only its last progress reports itself; the log keeps all, across restarts too.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.written: set[tuple[str, int]] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query": p.name, "run": str(p.runId), "batch_id": p.batchId, "at": p.timestamp, "input_rows": p.numInputRows,
               "duration_ms": p.durationMs.get("triggerExecution"), "end_offsets": json.dumps([s.endOffset for s in p.sources]),
               "latest_offsets": json.dumps([s.latestOffset for s in p.sources])}
        write_text(self.spark, f"{self.folder}/{p.runId}-{p.batchId}.json", json.dumps(row))
        self.written.add((str(p.runId), p.batchId))

    def wait_for(self, queries, seconds: float = 30.0) -> None:
        """Reports come a moment after their batch: wait until the last one of each query is written."""
        last = {(str(q.runId), q.lastProgress["batchId"]) for q in queries if q.lastProgress}
        until = time.time() + seconds
        while not last <= self.written:
            if time.time() > until:
                raise TimeoutError(f"no progress report of {sorted(last - self.written)}")
            time.sleep(0.05)

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row per micro-batch in a log's folder: rows read, time taken, end offsets."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], _DDL)
    return spark.read.schema(_DDL).json(folder)


_OFFSETS = "map<string,map<string,long>>"


def recorded_totals(log: DataFrame) -> DataFrame:
    """Messages per topic as its stream last saw them (``topic, total_messages, read_messages``), from the log alone.

    ``log``: rows of ``progress`` of queries named after their topic.  A source that reports numbered
    offsets (Kafka) gives the end of the topic and how far the stream has come; others give what was read.
    A batch that ran again after a restart counts once.
    """
    last = Window.partitionBy("query", "batch_id").orderBy(F.desc("at"), F.desc("run"))
    once = log.withColumn("_n", F.row_number().over(last)).where("_n = 1")

    def total(name: str) -> Column:
        """The sum of a source's offsets, NULL where they are no numbers by partition.  Offsets reach the log as JSON text."""
        text = F.get_json_object(F.coalesce(name, F.lit("[]")), "$[0]")
        topics = F.map_values(F.from_json(text, _OFFSETS))
        each = F.flatten(F.transform(topics, F.map_values))
        known = F.filter(each, lambda v: v.isNotNull())
        return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("long"), lambda a, v: a + v))

    seen = once.select("query", "batch_id", "input_rows", total("end_offsets").alias("_end"), total("latest_offsets").alias("_latest"))
    out = seen.groupBy(F.col("query").alias("topic")).agg(
        F.sum("input_rows").alias("_rows"), F.max_by("_end", "batch_id").alias("_end"), F.max_by("_latest", "batch_id").alias("_latest"))
    read = F.coalesce("_end", "_rows")
    return out.select("topic", F.greatest(F.coalesce("_latest", read), read).alias("total_messages"), read.alias("read_messages"))
