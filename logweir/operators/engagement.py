"""Active users and retention from bitmaps of user numbers.

Users get numbers once; a day's users are bitmaps of 32,768 numbers each.  Windows of days and cohorts
are unions and intersections of bitmaps, so no user is counted twice and no row of the log is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

LANES = 256


def user_numbers(events: DataFrame, user: str = "user_id", lanes: int = LANES) -> DataFrame:
    """user, number: nearly dense numbers from 1 on, the same for the same set of users.

    Users are numbered inside lanes that a hash deals them to, so no task sees them all.
    """
    users = events.where(F.col(user).isNotNull()).select(F.col(user).alias("user")).distinct()
    users = users.withColumn("lane", F.pmod(F.xxhash64("user"), F.lit(lanes)))
    place = F.row_number().over(Window.partitionBy("lane").orderBy("user"))
    return users.select("user", ((place.cast("long") - 1) * lanes + F.col("lane") + 1).alias("number"))


def _bitmaps(rows: DataFrame, *keys: str) -> DataFrame:
    number = F.col("number")
    return rows.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("users"))


def daily_bitmaps(events: DataFrame, numbers: DataFrame, date: str = "event_date", user: str = "user_id") -> DataFrame:
    """day, bucket, users: who was active on each day."""
    seen = events.select(F.col(date).alias("day"), F.col(user).alias("user")).where("user IS NOT NULL AND day IS NOT NULL").distinct()
    return _bitmaps(seen.join(numbers, "user"), "day")


def cohort_bitmaps(events: DataFrame, numbers: DataFrame, date: str = "event_date", user: str = "user_id") -> DataFrame:
    """cohort, bucket, users: who was first seen on each day."""
    first = events.where(F.col(user).isNotNull()).groupBy(F.col(user).alias("user")).agg(F.min(date).alias("cohort"))
    return _bitmaps(first.where("cohort IS NOT NULL").join(numbers, "user"), "cohort")


def active_users(daily: DataFrame, windows: Sequence[int] = (1, 7, 30)) -> DataFrame:
    """For each day with activity the users active in the last so many days: ``active_1``, ``active_7``, ..."""
    longest = max(windows)
    aged = daily.select(F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("age"), "day", "bucket", "users")
    by_day = aged.groupBy(F.date_add("day", F.col("age")).alias("day"), "bucket").agg(
        F.min("age").alias("nearest"),
        *[F.bitmap_count(F.bitmap_or_agg(F.when(F.col("age") < w, F.col("users")).otherwise(F.lit(b"").cast("binary")))).alias(f"active_{w}")
          for w in windows])
    out = by_day.groupBy("day").agg(F.min("nearest").alias("nearest"), *[F.sum(f"active_{w}").alias(f"active_{w}") for w in windows])
    return out.where("nearest = 0").drop("nearest")


def retention(daily: DataFrame, cohorts: DataFrame, horizon: int = 30) -> DataFrame:
    """cohort, days_later, users: how many of each day's new users were active so many days later.

    Both sides of an intersection share the bucket; the work is days times horizon bitmaps, not users.
    """
    pairs = cohorts.withColumnRenamed("users", "new").join(daily, "bucket").where(
        (F.col("day") >= F.col("cohort")) & (F.datediff("day", "cohort") <= horizon))
    both = pairs.select("cohort", "day", "bucket", F.explode(F.array("new", "users")).alias("users"))
    kept = both.groupBy("cohort", "day", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("users")).alias("users"))
    return kept.groupBy("cohort", F.datediff("day", "cohort").alias("days_later")).agg(F.sum("users").alias("users")).where("users > 0")
