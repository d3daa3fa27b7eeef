"""Daily sketches of latencies and distinct counts: stored once, merged over any range of days.

A day's figures are one row per key with a KLL sketch (quantiles) or HLL sketches (distinct counts).
Sketches of days, tasks or late batches merge without the rows they came from, so a month's p95 reads
some thousand small rows and no log row.  Up to ``k`` values a KLL sketch is exact; beyond, its rank error
stays below about 2.3 / k whatever the number of values (0.06 % at the default).

Where the quantile itself is asked for, counts per day, key and value are kept beside the sketches (no more rows
than there are different values) and ``exact_over`` looks it up there, near the rank the sketch points to.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from logweir.session import path_exists, session_conf

KLL_K = 4096
HLL_LG_K = 12


def daily_latency(calls: DataFrame, keys: Sequence[str], date: str = "metric_date", value: str = "response_time_ms",
                  k: int = KLL_K) -> DataFrame:
    """Per day and key: calls, sum, extremes and a sketch of the values; NULL values only count as calls."""
    ms = F.col(value).cast("long")
    return calls.groupBy(date, *keys).agg(
        F.count(F.lit(1)).alias("calls"), F.count(ms).alias("timed"), F.sum(ms).alias("total_ms"),
        F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"), F.kll_sketch_agg_bigint(ms, F.lit(k)).alias("latency"))


def daily_values(calls: DataFrame, keys: Sequence[str], date: str = "metric_date", value: str = "response_time_ms") -> DataFrame:
    """Per day, key and value: how often it came."""
    ms = F.col(value).cast("long").alias("value")
    return calls.where(F.col(value).isNotNull()).groupBy(date, *keys, ms).agg(F.count(F.lit(1)).alias("n"))


def daily_users(events: DataFrame, date: str = "event_date", lg_k: int = HLL_LG_K) -> DataFrame:
    """Per day and user: events, and sketches of the sessions and pages seen."""
    return events.groupBy(date, "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.hll_sketch_agg("session_id", F.lit(lg_k)).alias("sessions"),
        F.hll_sketch_agg("page_url", F.lit(lg_k)).alias("pages"))


def refresh(sketches: DataFrame, path: str, date: str) -> None:
    """Write the days at hand to the sketch table and leave its other days alone.

    A day that got late rows is computed again from that day's rows only.
    """
    days = sketches.repartition(date)  # one small file per day
    with session_conf(sketches.sparkSession, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        days.write.mode("overwrite").partitionBy(date).parquet(path)


def read(spark: SparkSession, path: str, date: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Sketches of the days from ``since`` to before ``until``; other days' folders are not opened."""
    if not path_exists(spark, path):
        raise ValueError(f"no sketch table at {path}")
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.where(F.col(date) >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(F.col(date) < F.lit(until).cast("date"))
    return rows


def quantile(sketch: Column | str, p: float) -> Column:
    """The smallest value that has a share ``p`` of the values at or below it."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(p))


def _merged(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.sum("calls").alias("calls"), F.min("min_ms").alias("min_ms"),
        (F.sum("total_ms").cast("double") / F.sum("timed")).alias("avg_ms"), F.max("max_ms").alias("max_ms"),
        F.sum("timed").alias("_timed"), F.kll_merge_agg_bigint("latency").alias("_latency"))


def _quantile_of(p: float) -> Column:
    return F.when(F.col("min_ms").isNotNull(), quantile("_latency", p))


def latency_over(sketches: DataFrame, keys: Sequence[str | Column], p: float = 0.95) -> DataFrame:
    """Calls, extremes, mean and the p-th quantile per key over all days at hand; the quantile within the sketch's error."""
    merged = _merged(sketches, keys)
    return merged.withColumn(f"p{round(100 * p)}_ms", _quantile_of(p)).drop("_latency", "_timed")


def exact_over(sketches: DataFrame, values: DataFrame, keys: Sequence[str | Column], p: float = 0.95, k: int = KLL_K) -> DataFrame:
    """``latency_over`` with the exact quantile, from sketches and ``daily_values`` of the same days.

    The sketch gives two values that enclose the quantile.  Values are counted below, between and above them,
    and only the part in which the rank lies is put in order.  That is the small middle part, unless the sketch's
    error was larger than expected, which costs time but changes no result.
    """
    merged = _merged(sketches, keys)
    names = merged.columns[:len(keys)]
    low, high = _quantile_of(max(p - 2.3 / k, 0.0)), _quantile_of(min(p + 2.3 / k, 1.0))
    rank = F.greatest(F.ceil(F.col("_timed") * F.lit(Decimal(str(p)))).cast("long"), F.lit(1))
    bounds = merged.where("_timed > 0").select(*names, rank.alias("_rank"), low.alias("_low"), high.alias("_high"))

    def join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        """On the keys, NULL a key like others."""
        other = right.toDF(*[f"_r_{c}" if c in names else c for c in right.columns])
        same = reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_r_{c}`")) for c in names])
        return left.join(other, same, how).drop(*[f"_r_{c}" for c in names])

    counted = values.groupBy(*keys, "value").agg(F.sum("n").alias("_n")).toDF(*names, "_value", "_n")
    part = F.when(F.col("_value") < F.col("_low"), 0).when(F.col("_value") <= F.col("_high"), 1).otherwise(2)
    # Merging sketches is random, so the bounds are carried along: worked out again they would be others.
    upto = [F.sum(F.when(part < i, F.col("_n")).otherwise(0)).alias(f"_upto{i}") for i in (1, 2)]
    carried = [F.max(c).alias(c) for c in ("_rank", "_low", "_high")]
    before = join(counted, bounds).groupBy(*names).agg(*upto, *carried)
    chosen = F.when(F.col("_rank") <= F.col("_upto1"), 0).when(F.col("_rank") <= F.col("_upto2"), 1).otherwise(2)
    start = F.when(chosen == 0, 0).when(chosen == 1, F.col("_upto1")).otherwise(F.col("_upto2"))
    at = join(counted, before.withColumns({"_chosen": chosen, "_start": start})).where(part == F.col("_chosen"))
    running = F.sum("_n").over(Window.partitionBy(*names).orderBy("_value"))
    reached = at.withColumn("_seen", F.col("_start") + running).where("_seen >= _rank")
    exact = reached.groupBy(*names).agg(F.min("_value").alias(f"p{round(100 * p)}_ms"))
    return join(merged.drop("_latency", "_timed"), exact, "left")


def users_over(sketches: DataFrame) -> DataFrame:
    """Events, distinct sessions and distinct pages per user over all days at hand."""
    return sketches.groupBy("user_id").agg(
        F.sum("events").alias("total_events"), F.hll_sketch_estimate(F.hll_union_agg("sessions")).alias("sessions"),
        F.hll_sketch_estimate(F.hll_union_agg("pages")).alias("pages_visited"))
