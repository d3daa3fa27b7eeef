"""Message and reject rates per log type while messages stream in: state with a watermark, updates in place.

A period's figures change as long as its messages may still arrive.  ``delay`` says for how long after the
newest event time seen; a period that ended before that is dropped from the state, which therefore holds no
more than types x (delay / period) figures, and messages of it that come later still are left out of the
figures (``late_groups`` tells that there were some; the batch report over the tables counts them).
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.functions.envelope import classify, record_column
from logweir.session import delete_paths, list_names, path_exists, session_conf

_DDL = "_log_type string, period timestamp, messages long, invalid long"
_KEYS = ["_log_type", "period"]


def timed(raw: DataFrame, configs, field: str = "timestamp") -> DataFrame:
    """A topic's messages as ``_log_type, event_time, _reason``; the time is the record's own.

    Messages without a readable time belong to no period and are left out; were they dated by their arrival,
    old messages that are read anew would all be late.  The batch ledger counts them by reason.
    """
    seen = classify(raw, configs)
    own: list[Column] = [F.col(f"`{record_column(c)}`").getField(field) for c in configs if field in [f.name for f in c.fields]]
    return seen.select("_log_type", F.coalesce(*own).cast("timestamp").alias("event_time"), "_reason").where("event_time IS NOT NULL")


def rates(messages: DataFrame, per: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Messages and rejects per type and period, of a stream or of a table.  In a stream for update mode."""
    found = messages.withWatermark("event_time", delay).groupBy("_log_type", F.window("event_time", per).alias("_w"))
    out = found.agg(F.count(F.lit(1)).alias("messages"), F.count("_reason").alias("invalid"))
    return out.select("_log_type", F.col("_w.start").alias("period"), "messages", "invalid")


@dataclasses.dataclass
class _Updates:
    """foreachBatch body: each batch's changed figures in a folder of its own, folded now and then."""

    folder: str
    fold_every: int

    def __call__(self, changed: DataFrame, epoch: int) -> None:
        spark = changed.sparkSession
        if epoch and epoch % self.fold_every == 0:
            self._fold(spark, epoch - 1)
        # A shuffle, as coalesce would draw all tasks that hold the state into the writing one.
        changed.repartition(1).write.mode("overwrite").parquet(f"{self.folder}/{_name('batch', epoch)}")

    def _fold(self, spark: SparkSession, upto: int) -> None:
        """One file of all figures up to a batch; what it replaces is deleted only when it is whole."""
        base = _name("base", upto)
        if base not in [name for name, _, _ in _parts(spark, self.folder)]:
            read_rates(spark, self.folder).repartition(1).write.mode("overwrite").parquet(f"{self.folder}/{base}")
        old = [name for name, _, number in _parts(spark, self.folder) if number <= upto and name != base]
        delete_paths(spark, [f"{self.folder}/{name}" for name in old])


def start_rates(found: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None, fold_every: int = 100,
                state_tasks: int = 8) -> StreamingQuery:
    """Keep the figures of ``rates`` over a stream in ``folder``.  A batch that runs again replaces its own updates.

    The state lies in ``state_tasks`` parts: each is loaded and stored in every batch, and only counts reach
    them.  A checkpoint keeps the number it was started with.
    """
    writer = (
        found.writeStream.outputMode("update")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_Updates(folder.rstrip("/"), fold_every))
    )
    with session_conf(found.sparkSession, {"spark.sql.shuffle.partitions": str(state_tasks)}):
        return writer.start()


def read_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The figures as of the last batch: of each type and period the newest update."""
    parts = _parts(spark, folder)
    base = max((number for _, kind, number in parts if kind == "base"), default=-1)
    live = [name for name, kind, number in parts if (kind, number) == ("base", base) or (kind == "batch" and number > base)]
    if not live:
        return spark.createDataFrame([], _DDL)
    rows = spark.read.schema(_DDL).parquet(*[f"{folder}/{name}" for name in live])
    epoch = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:base|batch)-(\d+)/[^/]*$", 1).cast("long")
    newest = rows.select("*", epoch.alias("_epoch")).groupBy(*_KEYS).agg(F.max_by(F.struct("messages", "invalid"), "_epoch").alias("_f"))
    return newest.select(*_KEYS, "_f.messages", "_f.invalid")


def late_groups(query: StreamingQuery) -> int:
    """Updates left out as too late in the query's last batches: one for each type, period and task that held some."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def _name(kind: str, epoch: int) -> str:
    return f"{kind}-{epoch:012d}"


def _parts(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """Folders that are written whole: name, kind and batch."""
    found = [(name, re.fullmatch(r"(base|batch)-(\d+)", name)) for name in list_names(spark, folder)]
    return [(name, m[1], int(m[2])) for name, m in found if m and path_exists(spark, f"{folder}/{name}/_SUCCESS")]
