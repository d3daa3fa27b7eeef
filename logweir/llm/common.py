"""What the operators share: reading tables, cutting lineage, word rules, columns of their own."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logweir.session import delete_paths, shared_dir

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it.

    A cluster whose machines do not have it there gets it with --py-files, as usual.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to the shared checkpoint folder and read them from there.

    The files are on storage all executors share, so a lost executor costs a read, not a recomputation.
    The collection afterwards lets Spark's cleaner drop shuffle files that nothing refers to any more.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_dir(spark)}/checkpoints-{uuid.uuid4().hex}")
    kept = df.checkpoint(eager=True)
    context._jvm.System.gc()
    return kept


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them again; the files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        delete_paths(spark, [path])


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary file lies."""
    return public_tokenizers.path(name)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """The same words as UTF-8 bytes: bytes.split() cuts at exactly 0x20 and 0x09-0x0D."""
    return text.encode().split() if text else []


def slices(batch: pa.RecordBatch, rows: int = 256, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch with at most so many rows and, beyond one row, bytes of text.

    Only the texts of one slice are Python objects at a time, so very long texts do not add up.
    """
    lengths = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            lengths += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        fits = int(np.searchsorted(ends, before + size, "right"))
        stop = min(batch.num_rows, start + rows, max(fits, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


def packed(df: DataFrame) -> DataFrame:
    """One struct column ``row`` with all columns but the text, and ``body``, the text: no name of the input can clash."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != "text"]
    return df.select(F.struct(*rest).alias("row"), F.col("text").alias("body"))


def unpacked(df: DataFrame, like: DataFrame, text_changed: bool = False) -> DataFrame:
    """The columns of ``like`` again, from ``row`` and ``body``; ``n_chars``, if there, follows a text that was changed."""
    def column(name: str) -> Column:
        if name == "text":
            return F.col("body")
        if name == "n_chars" and text_changed:
            return F.length("body").cast(like.schema[name].dataType)
        return F.col("row").getField(name)

    return df.select(*[column(c).alias(c) for c in like.columns])
