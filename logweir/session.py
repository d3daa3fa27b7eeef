"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the library's plans rely on.  Partition counts are left to AQE: a cluster sets
# spark.sql.shuffle.partitions high and AQE coalesces, a laptop sets it to its cores.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_local_root: dict[str, str] = {}


def build_session(app: str = "logweir", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables and checkpoints a job writes on the way.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session without that
    setting gets a temporary folder, because there driver and executors share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="logweir-")
    return _local_root[app]


@contextlib.contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Run a block under other SQL settings, then put them back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def path_exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(_path(spark, path))


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    if paths:
        fs, make = _filesystem(spark, paths[0]), spark._jvm.org.apache.hadoop.fs.Path
        for path in paths:
            fs.delete(make(path), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced whole: written beside and renamed over the old one in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    part, target = hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp"), hadoop.Path(path)
    out = _filesystem(spark, path).create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(part, target, over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    if not path_exists(spark, path):
        return None
    stream = _filesystem(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    return sorted(f.getPath().getName() for f in _filesystem(spark, path).listStatus(_path(spark, path)))


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
