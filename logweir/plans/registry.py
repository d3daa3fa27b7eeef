"""The registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logweir.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the DuckDB text over the raw tables it is compared to."""

    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return zone_free(build(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(" ".join(sql.split()))
        return build

    return add


def pin_utc(spark: SparkSession) -> None:
    """Event times in the given tables have no zone; they are read and written as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def zone_free(df: DataFrame) -> DataFrame:
    """Timestamps as plain date-times, as in the given tables."""
    return df.select(
        [F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
         if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`") for f in df.schema]
    )
