"""Point-in-time features: each label row gets the last feature row at or before its own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def as_of_join(labels: DataFrame, features: DataFrame, keys: Sequence[str], columns: Sequence[str],
               label_time: str = "timestamp", feature_time: str = "timestamp", slot: str = "DAY", max_age: str | None = None) -> DataFrame:
    """All label rows with ``columns`` and ``feature_at`` of the newest feature row of their key that is not later.

    A feature at the label's very moment counts; of features of one key and moment the one with the largest
    ``columns`` is taken.  NULL keys and times match nothing.  ``max_age`` (``"7 days"``) sets how old a feature
    may be.

    Both sides are dealt by (key, time slot): a key with a third of all rows is spread over its slots.  What
    a slot inherits is found from one row per key and slot, and a window inside the slot carries the rest.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    own = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]
    present = " AND ".join(f"{n} IS NOT NULL" for n in [*names, "_at"])
    value = F.struct(F.col(f"`{feature_time}`").alias("feature_at"), *[F.col(f"`{c}`") for c in columns])
    known = features.select(*own, F.col(f"`{feature_time}`").alias("_at"), value.alias("_value")).where(present)
    known = known.withColumn("_slot", F.date_trunc(slot, "_at"))
    asked = labels.select(*own, F.col(f"`{label_time}`").alias("_at"), F.struct("*").alias("_label")).withColumn("_slot", F.date_trunc(slot, "_at"))
    matchable, rest = asked.where(present), asked.where(f"NOT ({present})")

    # One row per key and slot: the slot's newest feature, and whether labels ask for the slot.
    ends = known.groupBy(*names, "_slot").agg(F.max("_value").alias("_last"), F.lit(False).alias("_asked"))
    slots = matchable.groupBy(*names, "_slot").agg(F.max(F.lit(None).cast(ends.schema["_last"].dataType)).alias("_last"),
                                                   F.lit(True).alias("_asked"))
    each = ends.unionByName(slots).groupBy(*names, "_slot").agg(F.max("_last").alias("_last"), F.max("_asked").alias("_asked"))
    before = Window.partitionBy(*names).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = each.withColumn("_value", F.last("_last", ignorenulls=True).over(before)).where("_asked AND _value IS NOT NULL")

    # Inside a slot: what is carried in, then features, then labels of the same moment.
    nothing = F.lit(None).cast(asked.schema["_label"].dataType).alias("_label")
    rows = (known.select(*names, "_slot", "_at", F.lit(1).alias("_side"), "_value", nothing)
            .unionByName(carried.select(*names, "_slot", F.lit(None).cast(known.schema["_at"].dataType).alias("_at"),
                                        F.lit(0).alias("_side"), "_value", nothing))
            .unionByName(matchable.select(*names, "_slot", "_at", F.lit(2).alias("_side"),
                                          F.lit(None).cast(known.schema["_value"].dataType).alias("_value"), "_label")))
    so_far = Window.partitionBy(*names, "_slot").orderBy(F.col("_at").asc_nulls_first(), "_side", "_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = rows.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far)).where("_side = 2").select("_label", "_value", "_at")
    if max_age is not None:
        fresh = F.col("_value.feature_at") >= F.col("_at") - F.expr(f"INTERVAL {max_age}")
        joined = joined.withColumn("_value", F.when(fresh, F.col("_value")))
    unmatched = rest.select("_label", F.lit(None).cast(known.schema["_value"].dataType).alias("_value"), "_at")
    return joined.unionByName(unmatched).select("_label.*", *[F.col("_value").getField(c).alias(c) for c in [*columns, "feature_at"]])
