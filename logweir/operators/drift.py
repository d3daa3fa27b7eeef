"""Schema drift as the files themselves tell it: what each Parquet footer holds against the config and the catalog."""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_type

from logweir.functions.types import record_schema
from logweir.operators.tables import COMMIT, partition_columns, table_path
from logweir.sources.configs import LogConfig

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_FOOTER = "path string, row_count long, stored map<string,string>"


def footers(spark: SparkSession, path: str) -> DataFrame:
    """``path, row_count, stored`` (field -> type) of every Parquet file below a folder.

    Files are listed by Spark and dealt over tasks by size; a task opens the footers of its files and no data.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [_footer(p) for p in paths]
            yield pa.RecordBatch.from_arrays([
                pa.array(paths, pa.string()), pa.array([n for n, _ in found], pa.int64()),
                pa.array([list(fields.items()) for _, fields in found], pa.map_(pa.string(), pa.string()))],
                names=["path", "row_count", "stored"])

    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(path).select("path"))
    return listed.mapInArrow(read, _FOOTER)


def _footer(uri: str) -> tuple[int, dict[str, str]]:
    if uri.startswith(("file:", "/")):  # paths come as they are, without escapes
        system, place = None, "/" + uri.removeprefix("file:").lstrip("/")
    else:
        system, place = FileSystem.from_uri(quote(uri, safe=":/"))
    footer = pq.ParquetFile(place, filesystem=system)
    try:
        kept = (footer.schema_arrow.metadata or {}).get(_SPARK_SCHEMA)
        schema = (T.StructType.fromJson(json.loads(kept)) if kept else
                  T.StructType([T.StructField(f.name, from_arrow_type(f.type)) for f in footer.schema_arrow]))
        return footer.metadata.num_rows, {f.name: f.dataType.simpleString() for f in schema}
    finally:
        footer.close()


def drift(spark: SparkSession, config: LogConfig) -> DataFrame:
    """One row per field of the table or of its config: how many files and rows lack it or hold another type.

    ``field, config_type, table_type, files, row_count, files_lacking, rows_lacking, files_other_type, rows_other_type,
    stored_types``; another type is one that differs from the config's, or from the catalog's where the config has no such
    field.  Partition columns stand in folder names, not in files, and are left out, as are the library's own columns.
    Nothing is altered.  A table without files gives no rows.
    """
    outside = {*partition_columns(spark, config.table), COMMIT}
    wanted = {f.name: f.dataType.simpleString() for f in record_schema(config.fields)}
    have = {f.name: f.dataType.simpleString() for f in spark.table(config.table).schema if not f.name.startswith("_")}
    names = [n for n in dict.fromkeys([*wanted, *have]) if n not in outside]

    def text(value: str | None):
        return F.lit(value).cast("string")

    expected = F.array(*[F.struct(F.lit(n).alias("field"), text(wanted.get(n)).alias("config_type"), text(have.get(n)).alias("table_type"))
                         for n in names])
    each = footers(spark, table_path(spark, config.table)).select("row_count", "stored", F.explode(expected).alias("e"))
    held = F.try_element_at("stored", F.col("e.field"))
    other = held != F.coalesce("e.config_type", "e.table_type")

    def rows(condition):
        return F.sum(F.when(condition, F.col("row_count")).otherwise(0))

    return each.groupBy("e.field", "e.config_type", "e.table_type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"),
        F.count_if(held.isNull()).alias("files_lacking"), rows(held.isNull()).alias("rows_lacking"),
        F.count_if(other).alias("files_other_type"), rows(other).alias("rows_other_type"),
        F.array_sort(F.collect_set(held)).alias("stored_types"))
