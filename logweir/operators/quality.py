"""Checks on configs, messages and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logweir.functions.types import FIELD_TYPES

# What names and versions look like.
NAME_PATTERN = "^[a-zA-Z][a-zA-Z0-9_]*$"
VERSION_PATTERN = r"^[0-9]+\.[0-9]+\.[0-9]+$"


def validate_configs(configs: DataFrame) -> DataFrame:
    """Rule violations of a config catalog, one row each: ``name, rule, detail``.

    Each config is checked in its own row; nothing is shuffled.
    """
    f_names = F.transform(F.coalesce("fields", F.array()), lambda f: f["name"])
    part_by = F.coalesce("warehouse.partition_by", F.array().cast("array<string>"))
    sort_by = F.coalesce("warehouse.sort_by", F.array().cast("array<string>"))
    table = F.col("warehouse.table_name")

    def rule(name, broken, detail):
        return F.when(F.coalesce(broken, F.lit(False)),
                      F.struct(F.lit(name).alias("rule"), detail.cast("string").alias("detail")))

    none = F.lit(None).cast("string")
    rules = [
        rule(f"missing_{key}", F.col(key).isNull(), none)
        for key in ("name", "version", "kafka", "warehouse", "fields")
    ]
    rules += [
        rule("missing_topic", F.col("kafka").isNotNull() & F.col("kafka.topic").isNull(), none),
        rule("missing_table_name", F.col("warehouse").isNotNull() & table.isNull(), none),
        rule("bad_name", ~F.col("name").rlike(NAME_PATTERN), F.col("name")),
        rule("bad_version", ~F.col("version").rlike(VERSION_PATTERN), F.col("version")),
        rule("no_fields", F.size("fields") == 0, none),
        rule("partitions_below_1", F.col("kafka.partitions") < 1, F.col("kafka.partitions")),
        rule("replication_below_1", F.col("kafka.replication_factor") < 1, F.col("kafka.replication_factor")),
        rule("retention_below_1", F.col("warehouse.retention_days") < 1, F.col("warehouse.retention_days")),
        rule("table_name_not_two_parts", F.size(F.split(table, r"\.")) != 2, table),
    ]
    fields = F.coalesce("fields", F.array())
    per_field = [
        _each(fields, "bad_field_name", lambda f: ~f["name"].rlike(NAME_PATTERN), lambda f: f["name"]),
        _each(fields, "missing_field_name", lambda f: f["name"].isNull(), lambda f: f["type"]),
        _each(fields, "bad_field_type",
              lambda f: ~f["type"].isin(list(FIELD_TYPES)) | f["type"].isNull(),
              lambda f: F.concat_ws(":", f["name"], f["type"])),
        _each(F.array_except(part_by, f_names), "partition_by_not_a_field", lambda _: F.lit(True), lambda c: c),
        _each(F.array_except(sort_by, f_names), "sort_by_not_a_field", lambda _: F.lit(True), lambda c: c),
    ]
    found = F.concat(F.array_compact(F.array(*rules)), *per_field)
    return configs.select("name", F.explode(found).alias("v")).select("name", "v.rule", "v.detail")


def _each(items, name, broken, detail):
    bad = F.filter(items, lambda x: F.coalesce(broken(x), F.lit(False)))
    return F.transform(bad, lambda x: F.struct(F.lit(name).alias("rule"), detail(x).cast("string").alias("detail")))


def shared_tables(configs: DataFrame) -> DataFrame:
    """Tables more than one log type claims (catalog as of ``with_defaults``)."""
    counted = configs.groupBy("table_name").agg(F.countDistinct("log_type").alias("log_types"))
    return counted.where(F.col("log_types") > 1)


def reject_counts(classified: DataFrame) -> DataFrame:
    """Messages per reason; good ones under ``valid``."""
    reason = F.coalesce("_reason", F.lit("valid")).alias("reason")
    return classified.groupBy(reason).agg(F.count(F.lit(1)).alias("messages"))


def origin_check(rejected: DataFrame, messages: DataFrame) -> DataFrame:
    """Quarantined messages per topic and reason, and how many stand unchanged at the place noted with them.

    ``messages``: the topics as they are now; what retention has taken away is not found.  Text topics have no
    offsets, so none of theirs is.
    """
    place = [F.col("partition").cast("string").alias("topic_partition"), F.col("offset").alias("topic_offset")]
    there = messages.select("topic", *place, F.col("value").alias("_there"), F.lit(True).alias("_found"))
    both = rejected.join(there, ["topic", "topic_partition", "topic_offset"], "left")
    same = F.col("_found") & F.col("value").eqNullSafe(F.col("_there"))
    return both.groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("messages"), F.count_if(same).alias("found_at_origin"))


def envelope_report(messages: DataFrame) -> DataFrame:
    """Which envelope parts messages lack, over a whole topic."""
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    flags = [
        F.sum(F.when(F.array_contains(keys, k), 0).otherwise(1)).alias(f"without_{k.strip('_')}")
        for k in ("_log_type", "_log_class", "_version", "data")
    ]
    return messages.agg(F.count(F.lit(1)).alias("messages"), *flags)


def count_delta(before: DataFrame, after: DataFrame, expected: int) -> DataFrame:
    """Rows gained between two states of a table, against what was sent."""
    n, zero = F.count(F.lit(1)), F.lit(0).cast("long")
    counts = before.agg(n.alias("rows_before")).withColumn("rows_after", zero).unionByName(
        after.agg(n.alias("rows_after")).withColumn("rows_before", zero)
    )
    both = counts.agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))
    gained = F.col("rows_after") - F.col("rows_before")
    return both.withColumn("gained", gained).withColumn("as_expected", gained == expected)


def null_audit(table: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per business column, and rows where every one is NULL; one pass."""
    nulls = [F.col(f"`{c}`").isNull() for c in columns]
    every = F.lit(True)
    for n in nulls:
        every &= n
    counts = [F.count_if(n).alias(f"null_{c}") for c, n in zip(columns, nulls)]
    return table.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(every).alias("all_null_rows"), *counts)


def health(topic_totals: DataFrame, loaded: DataFrame) -> DataFrame:
    """Messages in each topic against rows loaded from it (``topic, rows``): what is still out.

    Both sides hold one row per topic.
    """
    both = topic_totals.join(loaded, "topic", "full_outer")
    total, rows = F.coalesce("total_messages", F.lit(0)), F.coalesce("rows", F.lit(0))
    return both.select("topic", total.alias("total_messages"), rows.alias("rows"), (total - rows).alias("lag"))
