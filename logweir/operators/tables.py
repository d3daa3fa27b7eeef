"""Log tables: partitioned Parquet tables in the session catalog, one per log type.

Beside the business columns every table has ``_ingestion_timestamp``, ``_ingestion_date`` and
``_batch_id``, and a last partition column ``_commit`` that names the write a file came from: an even
number, twice the batch, for an appended batch, and an odd one of its own for a compaction.  A batch is
numbered by its ingestion time in milliseconds, which a stream repeats when it replays the batch.  A
batch written again first drops what its earlier attempt left, so a replay adds and keeps nothing else.

Which rows a compaction replaces is never told from numbers: each job notes the partitions it merges in a
small file under ``_notes`` before it writes and once more when it has written.  What a note of an
unfinished job names is not shown twice, and the next run drops exactly that.  Each compaction also keeps
a record of the batches it holds; a batch written again is first taken out of those that hold it.  Drops are
noted too, so files whose deletion was interrupted do not come back.  ``_notes/table.json`` keeps the schema, layout and
codec, from which a new session takes the table back.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from logweir.functions.envelope import with_ingestion_time
from logweir.functions.types import FIELD_TYPES, WIDENINGS, record_schema, table_ddl, widens
from logweir.session import delete_paths, list_names, path_exists, read_text, session_conf, write_text
from logweir.sources.configs import LogConfig

COMMIT = "_commit"
NOTES = "_notes"
SYSTEM_FIELDS = [
    T.StructField("_ingestion_timestamp", T.TimestampType()),
    T.StructField("_ingestion_date", T.DateType()),
    T.StructField("_batch_id", T.LongType()),
]
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# A low floor for joined tasks keeps all cores writing; the number of files does not change with
# it, because rows of one table partition are only spread over tasks when they are many.
WRITE_SETTINGS = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
}
# Catalog statements name at most this many partitions each.
_DDL_CHUNK = 500


def quoted(table: str) -> str:
    return ".".join(f"`{p}`" for p in table.split("."))


# --- creation and evolution -------------------------------------------------------------


def ensure_database(spark: SparkSession, name: str, warehouse: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{warehouse}/{name}'")


def table_schema(config: LogConfig) -> T.StructType:
    return T.StructType([*record_schema(config.fields), *SYSTEM_FIELDS])


def create_table(spark: SparkSession, config: LogConfig, warehouse: str, table: str | None = None,
                 schema: T.StructType | None = None, codec: str = "snappy") -> None:
    """Define the table over ``warehouse/db/name``; files already there are picked up."""
    table = table or config.table
    path = f"{warehouse}/{config.table.replace('.', '/')}"
    schema = schema or table_schema(config)
    columns = T.StructType([*schema, T.StructField(COMMIT, T.LongType())])
    parts = ", ".join(f"`{c}`" for c in [*config.partition_by, COMMIT])
    spark.sql(
        f"CREATE TABLE {quoted(table)} ({table_ddl(columns)}) USING parquet "
        f"OPTIONS ('compression' = '{codec}') PARTITIONED BY ({parts}) LOCATION '{path}' "
        f"TBLPROPERTIES ('sort_by' = '{','.join(config.sort_by)}')"
    )
    if table == config.table:
        if path_exists(spark, path):
            _delete_leftovers(spark, path)
            spark.sql(f"ALTER TABLE {quoted(table)} RECOVER PARTITIONS")
        _remember(spark, path, schema, config.partition_by, codec)


def _remember(spark: SparkSession, path: str, schema: T.StructType, layout: tuple[str, ...], codec: str) -> None:
    """Keep a table's definition with its files."""
    names = {COMMIT}
    kept = T.StructType([f for f in schema if f.name not in names])
    write_text(spark, f"{path}/{NOTES}/table.json",
               json.dumps({"schema": kept.jsonValue(), "partition_by": list(layout), "codec": codec}))


def _remembered(spark: SparkSession, path: str) -> tuple[T.StructType, tuple[str, ...], str] | None:
    text = read_text(spark, f"{path}/{NOTES}/table.json")
    if text is None:
        return None
    kept = json.loads(text)
    return T.StructType.fromJson(kept["schema"]), tuple(kept["partition_by"]), kept["codec"]


def schema_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    rows = [(table, f.name, f.dataType.simpleString()) for f in schema]
    return spark.createDataFrame(rows, "table_name string, field string, type string")


def schema_diff(current: DataFrame, desired: DataFrame) -> DataFrame:
    """Compare two field lists ``(table_name, field, type)`` and say what evolution does.

    ``add``: new column.  ``widen``: int to long or float to double.  ``keep_current``: a type
    change that is not applied.  ``removed``: gone from the config, stays in the table.
    """
    cur = current.select("table_name", "field", F.col("type").alias("current"))
    des = desired.select("table_name", "field", F.col("type").alias("desired"))
    action = (
        F.when(F.col("current").isNull(), "add")
        .when(F.col("desired").isNull(), "removed")
        .when(F.col("current") == F.col("desired"), "unchanged")
        .when(widens(F.col("current"), F.col("desired")), "widen")
        .otherwise("keep_current")
    )
    both = cur.join(des, ["table_name", "field"], "full_outer")
    return both.where(~F.col("field").startswith("_")).withColumn("action", action)


def ensure_table(spark: SparkSession, config: LogConfig, warehouse: str,
                 codec: str = "snappy") -> tuple[LogConfig, list[T.Row]]:
    """Create the table or evolve it to the config.

    Returns the config to ingest with (types and layout are the table's where a change was
    refused) and the differences found.  Columns are only ever added, and types only widened;
    another layout takes a new table and ``backfill``.
    """
    if config.table.count(".") != 1:
        raise ValueError(f"table name must be database.table: {config.table}")
    ensure_database(spark, config.table.split(".")[0], warehouse)
    path = f"{warehouse}/{config.table.replace('.', '/')}"
    if not spark.catalog.tableExists(config.table):
        known = _remembered(spark, path)
        if known is None:
            create_table(spark, config, warehouse, codec=codec)
            return config, []
        # Another session made the table: take it back as it was, then evolve it.
        create_table(spark, dataclasses.replace(config, partition_by=known[1]), warehouse, schema=known[0], codec=known[2])
    current = business_schema(spark, config.table)
    desired = record_schema(config.fields)
    diff = _differences(config.table, current, desired)
    by_action = {a: [r["field"] for r in diff if r["action"] == a] for a in ("add", "widen", "keep_current")}
    layout = partition_columns(spark, config.table)
    if by_action["widen"]:
        _widen(spark, dataclasses.replace(config, partition_by=layout), warehouse, by_action["widen"])
    if by_action["add"]:
        new = T.StructType([f for f in desired if f.name in by_action["add"]])
        spark.sql(f"ALTER TABLE {quoted(config.table)} ADD COLUMNS ({table_ddl(new)})")
    if by_action["widen"] or by_action["add"]:
        known = _remembered(spark, path)
        _remember(spark, path, spark.table(config.table).schema, layout, known[2] if known else codec)
    if layout != config.partition_by:
        diff.append(T.Row(table_name=config.table, field="partition_by", current=",".join(layout),
                          desired=",".join(config.partition_by), action="keep_current"))
    names = {t.simpleString(): n for n, t in FIELD_TYPES.items()}
    fields = tuple(
        dataclasses.replace(f, type=names[current[f.name].dataType.simpleString()])
        if f.name in by_action["keep_current"] else f
        for f in config.fields
    )
    return dataclasses.replace(config, fields=fields, partition_by=layout), diff


def _differences(table: str, current: T.StructType, desired: T.StructType) -> list[T.Row]:
    """What ``schema_diff`` says of one table whose two field lists the driver holds, without the unchanged."""
    have, want = ({f.name: f.dataType.simpleString() for f in schema} for schema in (current, desired))
    out = []
    for name in [*have, *[n for n in want if n not in have]]:
        old, new = have.get(name), want.get(name)
        action = ("add" if old is None else "removed" if new is None else "unchanged" if old == new
                  else "widen" if (old, new) in WIDENINGS else "keep_current")
        if action != "unchanged" and not name.startswith("_"):
            out.append(T.Row(table_name=table, field=name, current=old, desired=new, action=action))
    return out


def partition_columns(spark: SparkSession, table: str) -> tuple[str, ...]:
    columns = spark.catalog.listColumns(table)
    return tuple(c.name for c in columns if c.isPartition and c.name != COMMIT)


def business_schema(spark: SparkSession, table: str) -> T.StructType:
    return T.StructType([f for f in spark.table(table).schema if not f.name.startswith("_")])


def _widen(spark: SparkSession, config: LogConfig, warehouse: str, names: list[str]) -> None:
    """Give columns their wider type.  Old files stay: Parquet reads them as the wider type.

    A second definition over the same files takes the place of the first; layout and codec stay.  Between
    the two a reader may find no table; the definition kept with the files brings it back after a crash.
    """
    desired = record_schema(config.fields)
    schema = T.StructType(
        [T.StructField(f.name, desired[f.name].dataType if f.name in names else f.dataType)
         for f in spark.table(config.table).schema if f.name != COMMIT]
    )
    wider = f"{config.table}__wider"
    known = _remembered(spark, f"{warehouse}/{config.table.replace('.', '/')}")
    spark.sql(f"DROP TABLE IF EXISTS {quoted(wider)}")
    create_table(spark, config, warehouse, wider, schema, known[2] if known else "snappy")
    for chunk in _chunks(list_partitions(spark, config.table)):
        specs = " ".join(p.spec for p in chunk)
        spark.sql(f"ALTER TABLE {quoted(wider)} ADD IF NOT EXISTS {specs}")
    spark.sql(f"DROP TABLE {quoted(config.table)}")
    spark.sql(f"ALTER TABLE {quoted(wider)} RENAME TO {quoted(config.table)}")


def drop_tables(spark: SparkSession, database: str) -> list[str]:
    """Forget every table of a database and delete its files."""
    names = [f"{database}.{t.name}" for t in spark.catalog.listTables(database) if not t.isTemporary]
    for name in names:
        path = table_path(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
        delete_paths(spark, [path])
    return names


# --- partitions as metadata -------------------------------------------------------------


def table_path(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} AS JSON").first()[0]
    return json.loads(described)["location"]


@dataclasses.dataclass(frozen=True)
class Partition:
    """One partition as the catalog lists it: its folder and its values as text."""

    path: str
    values: tuple[tuple[str, str | None], ...]

    @property
    def commit(self) -> int:
        return int(dict(self.values)[COMMIT])

    @property
    def group(self) -> tuple[tuple[str, str | None], ...]:
        """The table partition it belongs to, without the commit."""
        return tuple((k, v) for k, v in self.values if k != COMMIT)

    @property
    def spec(self) -> str:
        return "PARTITION (" + ", ".join(f"`{k}`={_literal(v)}" for k, v in self.values) + ")"


def list_partitions(spark: SparkSession, table: str, commit: int | None = None) -> list[Partition]:
    """Partitions in the catalog, all or those of one commit.  Metadata only; no file is opened."""
    out = []
    only = "" if commit is None else f" PARTITION (`{COMMIT}`='{commit}')"
    for row in spark.sql(f"SHOW PARTITIONS {quoted(table)}{only}").collect():
        pairs = [part.split("=", 1) for part in row[0].split("/")]
        values = [(unquote(k), None if v == _NULL_PARTITION else unquote(v)) for k, v in pairs]
        out.append(Partition(row[0], tuple(values)))
    return out


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chunks(items: list, size: int = _DDL_CHUNK) -> list[list]:
    return [items[i : i + size] for i in range(0, len(items), size)]


def drop_partitions(spark: SparkSession, table: str, partitions: list[Partition]) -> int:
    """Take partitions out of the catalog, then delete their files.

    In this order a reader that plans in between finds them gone rather than half there.  A note
    of the folders is kept until they are deleted, so a crash in between brings nothing back.
    """
    root = table_path(spark, table)
    for chunk in _chunks(partitions):
        note = f"{root}/{NOTES}/drop-{uuid.uuid4().hex}.json"
        write_text(spark, note, json.dumps([p.path for p in chunk]))
        specs = ", ".join(p.spec for p in chunk)
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {specs}")
        delete_paths(spark, [f"{root}/{p.path}" for p in chunk])
        delete_paths(spark, [note])
    return len(partitions)


def _delete_leftovers(spark: SparkSession, root: str) -> None:
    """Delete folders whose drop was noted but not finished."""
    for name in list_names(spark, f"{root}/{NOTES}"):
        if name.startswith("drop-") and name.endswith(".json"):
            paths = json.loads(read_text(spark, f"{root}/{NOTES}/{name}"))
            delete_paths(spark, [*[f"{root}/{p}" for p in paths], f"{root}/{NOTES}/{name}"])


@dataclasses.dataclass(frozen=True)
class MergeNote:
    """What one compaction job merges, and the commits it writes; ``written`` once that is complete."""

    path: str
    commits: tuple[int, ...]
    merged: tuple[Partition, ...]
    written: bool


def merge_notes(spark: SparkSession, table: str) -> list[MergeNote]:
    """Notes of compaction jobs that are running or were interrupted; one at a time is usual."""
    folder = f"{table_path(spark, table)}/{NOTES}"
    names = list_names(spark, folder)
    out = []
    for name in names:
        if name.startswith("merge-") and name.endswith(".json"):
            note = json.loads(read_text(spark, f"{folder}/{name}"))
            merged = tuple(Partition(p["path"], tuple((k, v) for k, v in p["values"])) for p in note["merged"])
            out.append(MergeNote(f"{folder}/{name}", tuple(note["commits"]), merged, f"{name}.written" in names))
    return out


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, each row once while a compaction runs.

    Streams write through sessions of their own, so what this session remembers of the files
    is dropped first.  The rows to hide are those the notes of unfinished jobs name: the merged
    partitions if the new ones are complete, the new ones if not.  No partitions are listed.
    """
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    for note in merge_notes(spark, table):
        if note.written:
            rows = rows.where(~_any_of(rows, [p.values for p in note.merged]))
        else:
            rows = rows.where(~F.col(COMMIT).isin(*note.commits))
    return rows


def _any_of(rows: DataFrame, groups: list[tuple]) -> Column:
    """Rows lying in one of the partitions, as a predicate on partition columns only."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def same(values: tuple) -> str:
        tests = (f"`{k}` <=> CAST({_literal(v)} AS {types[k]})" for k, v in values)
        return "(" + (" AND ".join(tests) if values else "true") + ")"

    return F.expr(" OR ".join(same(g) for g in groups))


# --- writing ----------------------------------------------------------------------------


def append_batch(df: DataFrame, config: LogConfig, batch_id: int | None = None, cluster: bool = True,
                 max_records_per_file: int = 0, figures: dict[str, Column] | None = None) -> dict[str, int]:
    """Write one batch of rows to the table; the same batch again replaces itself.

    The batch number is the rows' ingestion time unless given.  With a number given, whatever an earlier
    attempt of the batch left is dropped first, also in partitions that this attempt does not write and
    in compactions that have merged it since.  ``figures``: see ``write_rows``.
    """
    number = F.unix_millis("_ingestion_timestamp") if batch_id is None else F.lit(batch_id).cast("long")
    if batch_id is not None:
        spark = df.sparkSession
        drop_partitions(spark, config.table, list_partitions(spark, config.table, 2 * batch_id))
        _take_out(spark, config, batch_id)
    rows = df.withColumn("_batch_id", number).withColumn(COMMIT, F.col("_batch_id") * 2)
    return write_rows(rows, config, cluster, max_records_per_file, figures)


def write_rows(df: DataFrame, config: LogConfig, cluster: bool = True, max_records_per_file: int = 0,
               figures: dict[str, Column] | None = None) -> dict[str, int]:
    """Overwrite the partitions the rows belong to, ``_commit`` included.

    ``cluster`` gathers rows of a table partition into few files; the rebalance hint lets AQE
    cut a hot partition into several tasks and join small ones.  Without it each task writes
    its own file per partition and nothing is shuffled.  Rows are sorted inside each file.

    ``figures`` are aggregates of the rows, observed by the writing tasks themselves, and returned.
    """
    spark = df.sparkSession
    target = spark.table(config.table).schema
    have = set(df.columns)
    rows = df.select(
        [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
    )
    parts = [f"`{c}`" for c in config.partition_by]
    if cluster:
        rows = rows.hint("rebalance", *[F.col(c) for c in parts]) if parts else rows.hint("rebalance")
    watch = Observation() if figures else None
    if watch:
        rows = rows.observe(watch, *[c.alias(name) for name, c in figures.items()])
    order = [*parts, f"`{COMMIT}`", *[f"`{c}`" for c in config.sort_by if c in have]]
    rows = rows.sortWithinPartitions(*order)
    settings = {**WRITE_SETTINGS, "spark.sql.files.maxRecordsPerFile": str(max_records_per_file)}
    with session_conf(spark, settings):
        rows.write.mode("overwrite").insertInto(config.table)
    return dict(watch.get) if watch else {}


# --- upkeep -----------------------------------------------------------------------------


def recover(spark: SparkSession, table: str) -> int:
    """Finish or undo compactions that were interrupted; returns the partitions dropped.

    If the new partitions were complete, exactly the merged ones are dropped, else the new ones.
    """
    _delete_leftovers(spark, table_path(spark, table))
    dropped = 0
    for note in merge_notes(spark, table):
        gone = list(note.merged) if note.written else [p for c in note.commits for p in list_partitions(spark, table, c)]
        dropped += drop_partitions(spark, table, gone)
        delete_paths(spark, [f"{note.path}.written", note.path])
    return dropped


def merged_batches(spark: SparkSession, table: str) -> dict[int, list[int]]:
    """For each compaction's commit the batches it holds.

    A compaction keeps one file of them under ``_notes`` as long as it has partitions; its name tells the
    first and last batch, so a replay opens only those that may hold its batch.
    """
    return {commit: _held(spark, path) for commit, _, _, path in _holdings(spark, table)}


def _holdings(spark: SparkSession, table: str) -> list[tuple[int, int, int, str]]:
    """Commit, first and last batch, and file of every compaction's record."""
    folder = f"{table_path(spark, table)}/{NOTES}"
    names = [n.removesuffix(".json").split("_") for n in list_names(spark, folder) if n.startswith("holds_") and n.endswith(".json")]
    return [(int(commit), int(first), int(last), f"{folder}/holds_{commit}_{first}_{last}.json") for _, commit, first, last in names]


def _held(spark: SparkSession, path: str) -> list[int]:
    return json.loads(read_text(spark, path) or "[]")


def _take_out(spark: SparkSession, config: LogConfig, batch_id: int) -> None:
    """Write the merged partitions that hold rows of a batch again, without them."""
    table = config.table
    if not any(first <= batch_id <= last for _, first, last, _ in _holdings(spark, table)):
        return
    recover(spark, table)
    commits = [c for c, first, last, path in _holdings(spark, table) if first <= batch_id <= last and batch_id in _held(spark, path)]
    if not commits:
        return
    spark.catalog.refreshTable(table)
    keys = [*config.partition_by, COMMIT]
    found = (spark.table(table).where(F.col(COMMIT).isin(commits) & (F.col("_batch_id") == batch_id))
             .select([F.col(f"`{c}`").cast("string").alias(f"k{i}") for i, c in enumerate(keys)]).distinct().collect())
    holding = {tuple(r) for r in found}
    listed = [p for c in commits for p in list_partitions(spark, table, c)]
    for chunk in _chunks([p for p in listed if tuple(dict(p.values)[k] for k in keys) in holding], 200):
        _rewrite(spark, config, chunk, F.col("_batch_id") != batch_id, without=lambda b: b == batch_id)
    _forget_batches(spark, table, commits, lambda b: b == batch_id)


def _forget_batches(spark: SparkSession, table: str, commits: list[int], gone: Callable[[int], bool]) -> None:
    """Take batches out of the records of compactions."""
    for commit, _, _, path in _holdings(spark, table):
        if commit in commits:
            stay = [b for b in _held(spark, path) if not gone(b)]
            _note_batches(spark, table, commit, stay)
            if not stay or path != _holding_path(spark, table, commit, stay):
                delete_paths(spark, [path])


def _holding_path(spark: SparkSession, table: str, commit: int, batches: list[int]) -> str:
    return f"{table_path(spark, table)}/{NOTES}/holds_{commit}_{min(batches)}_{max(batches)}.json"


def _note_batches(spark: SparkSession, table: str, commit: int, batches: list[int]) -> None:
    if batches:
        write_text(spark, _holding_path(spark, table, commit, batches), json.dumps(sorted(batches)))


def _rewrite(spark: SparkSession, config: LogConfig, old: list[Partition], keep: Column | None = None,
             max_records_per_file: int = 0, without: Callable[[int], bool] = lambda b: False,
             packed: list[Packing] | None = None) -> None:
    """One job: write the rows of partitions (those to keep) under a commit of their own, then drop the partitions.

    ``without`` names the batches whose rows are not kept.  The batches that stay are recorded before
    anything is written: a record may name a batch that is not there, never the other way round.
    ``packed`` gives the files of each table partition; a remainder gets a second commit, so that the next
    compaction need not touch the full files beside it.
    """
    table = config.table
    commit = 2 * int(time.time() * 1000) + 1
    while list_partitions(spark, table, commit) or list_partitions(spark, table, commit + 2):
        commit += 2
    commits = [commit] if packed is None else [commit, commit + 2]
    before = {p.commit for p in old if p.commit % 2}
    held = {p.commit // 2 for p in old if p.commit % 2 == 0}
    held |= {b for c, _, _, path in _holdings(spark, table) if c in before for b in _held(spark, path)}
    for c in commits:
        _note_batches(spark, table, c, [b for b in held if not without(b)])
    note = f"{table_path(spark, table)}/{NOTES}/merge-{commit}.json"
    write_text(spark, note, json.dumps({"commits": commits, "merged": [{"path": p.path, "values": p.values} for p in old]}))
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    rows = rows.where(_any_of(rows, [p.values for p in old]))
    if keep is not None:
        rows = rows.where(keep)
    if packed is None:
        write_rows(rows.withColumn(COMMIT, F.lit(commit)), config, max_records_per_file=max_records_per_file)
    else:
        _write_packed(rows, config, packed, commit)
    write_text(spark, f"{note}.written", "")
    drop_partitions(spark, table, old)
    delete_paths(spark, [f"{note}.written", note])


def _drop_old_records(spark: SparkSession, table: str, live: set[int]) -> None:
    """Records of compactions that have no partitions any more."""
    delete_paths(spark, [path for commit, _, _, path in _holdings(spark, table) if commit not in live])


@dataclasses.dataclass(frozen=True)
class Packing:
    """The files the rows of one table partition are dealt over.

    ``full`` files hold ``share`` of the rows each; what is left is a remainder file of its own.
    """

    group: tuple[tuple[str, str | None], ...]
    full: int
    share: float

    @property
    def files(self) -> int:
        return self.full + (self.full * self.share < 1 - 1e-9)


def pack(group: tuple, total: int, target: int) -> Packing:
    """Files of about ``target`` bytes for ``total`` bytes: all within a quarter of it but one remainder at most."""
    full, rest = divmod(total, target)
    if rest >= 0.75 * target:
        full, rest = full + 1, 0
    elif full and rest <= 0.2 * target * full:
        rest = 0
    return Packing(group, full, (target / total if rest else 1 / full) if full else 0.0)


def file_sizes(spark: SparkSession, table: str) -> DataFrame:
    """folder (of the partition, as the catalog lists it), bytes: one row per data file, from file status alone."""
    root = table_path(spark, table)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    place = F.expr("substring_index(path, '/', -1)")
    folder = F.expr(f"substring(path, length(path) - length(substring_index(path, '{_after_root(root)}', -1)) + 1)")
    return files.select(F.substring(folder, F.lit(1), F.length(folder) - F.length(place) - 1).alias("folder"), F.col("length").alias("bytes"))


def _after_root(root: str) -> str:
    """The end of the table's folder by which paths of its files are cut."""
    return "/" + "/".join(root.rstrip("/").split("/")[-2:]).replace("'", "''") + "/"


def _is_good(target: int) -> Column:
    return F.col("bytes").between(int(0.75 * target), int(1.25 * target))


def compact(spark: SparkSession, config: LogConfig, include_latest: bool = False, groups_per_job: int = 200,
            max_records_per_file: int = 0, target_bytes: int | None = None) -> int:
    """Merge the commits of each table partition into one, sorted; returns table partitions merged.

    With ``target_bytes`` files are packed by size: partitions whose files are all within a quarter of the
    target stay untouched, and the rows of the others are dealt over files of the target's size, with at
    most one smaller remainder per table partition, which the next compaction takes up again.  Only file
    sizes are looked at; rows are dealt at random, so sizes are met where rows are many, and where what is
    merged are tiny files, whose footers weigh, the new files come out smaller.

    The newest batch is left out unless ``include_latest``: a stream may be about to write it
    again (that is noticed, and costs a rewrite).  Works through the table in jobs of a bounded number
    of partitions, so a lost driver costs one job; what is done stays done.  A job drops exactly the
    partitions it has read: batches that come in meanwhile, whatever their number, are not touched.
    """
    table = config.table
    recover(spark, table)
    parts = list_partitions(spark, table)
    _drop_old_records(spark, table, {p.commit for p in parts})
    newest = max((p.commit for p in parts if p.commit % 2 == 0), default=None)
    groups: dict[tuple, list[Partition]] = {}
    for p in parts:
        if include_latest or p.commit != newest:
            groups.setdefault(p.group, []).append(p)
    if target_bytes is None:
        merge = [ps for ps in groups.values() if len(ps) > 1]
        for chunk in _chunks(merge, groups_per_job):
            _rewrite(spark, config, [p for ps in chunk for p in ps], max_records_per_file=max_records_per_file)
        return len(merge)

    stats = file_sizes(spark, table).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.count_if(~_is_good(target_bytes)).alias("odd")).collect()
    sizes = {unquote(r.folder): r for r in stats}
    work: list[tuple[list[Partition], Packing]] = []
    for group, listed in groups.items():
        known = [(p, sizes[unquote(p.path)]) for p in listed if unquote(p.path) in sizes]
        odd = [(p, s) for p, s in known if s.odd]
        if sum(s.files for _, s in odd) > 1 or any(s.bytes > 1.25 * target_bytes for _, s in odd):
            work.append(([p for p, _ in odd], pack(group, sum(s.bytes for _, s in odd), target_bytes)))
    for chunk in _chunks(work, groups_per_job):
        _rewrite(spark, config, [p for ps, _ in chunk for p in ps], packed=[p for _, p in chunk])
    return len(work)


def _write_packed(rows: DataFrame, config: LogConfig, packed: list[Packing], commit: int) -> None:
    """One task and one file for each file of the packings: full ones under ``commit``, remainders under ``commit + 2``."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    cases, first = [], 0
    for p in packed:
        test = " AND ".join(f"`{k}` <=> CAST({_literal(v)} AS {types[k]})" for k, v in p.group) or "true"
        number = f"least(CAST(floor(_u / {p.share!r}D) AS INT), {p.full})" if p.full else "0"
        if p.files == p.full:
            number = f"least({number}, {p.full - 1})"
        cases.append(f"WHEN {test} THEN named_struct('file', {first} + {number}, 'commit', "
                     f"IF({number} < {p.full}, {commit}L, {commit + 2}L))")
        first += p.files
    # The seed is fixed: a task that is run again deals its rows alike.
    dealt = rows.withColumn("_u", F.rand(7)).withColumn("_to", F.expr(f"CASE {' '.join(cases)} END"))
    target = rows.sparkSession.table(config.table).schema
    placed = dealt.withColumn(COMMIT, F.col("_to.commit")).withColumn("_file", F.col("_to.file")).repartitionById(first, "_file")
    order = [*[f"`{c}`" for c in config.partition_by], f"`{COMMIT}`", *[f"`{c}`" for c in config.sort_by if c in types]]
    out = placed.sortWithinPartitions(*order).select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target])
    with session_conf(rows.sparkSession, WRITE_SETTINGS):
        out.write.mode("overwrite").insertInto(config.table)


def date_column(config: LogConfig) -> str | None:
    """The partition column retention goes by: the first that is a date."""
    dates = {f.name for f in config.fields if f.type == "date"} | {"_ingestion_date"}
    return next((c for c in config.partition_by if c in dates), None)


def expired(spark: SparkSession, config: LogConfig, as_of: dt.date) -> list[Partition]:
    """Partitions whose date lies before ``as_of - retention_days``."""
    column = date_column(config)
    if column is None or config.retention_days is None:
        return []
    cutoff = (as_of - dt.timedelta(days=config.retention_days)).isoformat()
    return [p for p in list_partitions(spark, config.table) if (dict(p.values)[column] or cutoff) < cutoff]


def apply_retention(spark: SparkSession, config: LogConfig, as_of: dt.date) -> int:
    """Drop whole date partitions older than ``retention_days``; no rows are read."""
    return drop_partitions(spark, config.table, expired(spark, config, as_of))


def rollback(spark: SparkSession, config: LogConfig, version: int) -> None:
    """Take back every batch after ``version``.

    Later batches are dropped as partitions.  Compactions, which may hold rows of both sides, are
    written again without the later rows.
    """
    table = config.table
    recover(spark, table)
    listed = list_partitions(spark, table)
    drop_partitions(spark, table, [p for p in listed if p.commit % 2 == 0 and p.commit > 2 * version])
    later = {c for c, _, last, _ in _holdings(spark, table) if last > version}
    for chunk in _chunks([p for p in listed if p.commit in later], 200):
        _rewrite(spark, config, chunk, F.col("_batch_id") <= version, without=lambda b: b > version)
    _forget_batches(spark, table, [*later], lambda b: b > version)


def backfill(spark: SparkSession, source: DataFrame, config: LogConfig) -> None:
    """Fill a table from another one, by column name; missing columns become NULL.

    The rows count as one batch, ingested now.
    """
    append_batch(with_ingestion_time(source.drop(COMMIT)), config)


def merge_renamed(df: DataFrame, old: str, new: str) -> DataFrame:
    """Dual-field migration: the new column, filled from the old one where it is empty."""
    return df.withColumn(new, F.coalesce(F.col(new), F.col(old).cast(df.schema[new].dataType)))


def add_bucket(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """Partition by ``bucket(n, column)``: a stable hash of the text, 0 … n-1."""
    digest = F.conv(F.substring(F.md5(F.col(column).cast("string")), 1, 8), 16, 10).cast("long")
    return df.withColumn(name, F.pmod(digest, F.lit(buckets)).cast("int"))


def add_day(df: DataFrame, column: str, name: str) -> DataFrame:
    """Partition by ``days(column)``."""
    return df.withColumn(name, F.to_date(column))
