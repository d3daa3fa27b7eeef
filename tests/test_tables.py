import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from logweir.functions.envelope import with_ingestion_time
from logweir.operators import history, tables
from logweir.operators.quality import count_delta
from logweir.session import read_text, write_text
from logweir.sources.configs import Field

DAY0 = dt.date(2024, 1, 1)


def rows(spark, n, start=0, days=3, extra=()):
    """n demo events over some days."""
    base = spark.range(start, start + n).select(
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id") % days, mins=F.col("id"))).alias("timestamp"),
        F.date_add(F.lit(DAY0), (F.col("id") % days).cast("int")).alias("event_date"),
        F.concat(F.lit("user_"), F.col("id").cast("string")).alias("user_id"),
        F.lit("click").alias("event_type"),
        *extra,
    )
    return with_ingestion_time(base)


@pytest.fixture
def demo(spark, config, database, tmp_path):
    c = config("demo_events", database)
    tables.ensure_table(spark, c, str(tmp_path))
    yield c
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def files_of(tmp_path, config):
    return sorted((tmp_path / config.table.replace(".", "/")).rglob("*.parquet"))


def test_create_describe_and_drop(spark, demo, tmp_path):
    db, name = demo.table.split(".")
    assert spark.catalog.tableExists(demo.table)
    assert name in [r.tableName for r in history.tables(spark, db).collect()]
    described = {r.col_name: r.data_type for r in history.describe(spark, demo.table).collect()}
    assert described["timestamp"] == "timestamp" and described["_batch_id"] == "bigint"
    assert db in [r.namespace for r in history.databases(spark).collect()]
    assert history.catalogs(spark).count() >= 1
    tables.append_batch(rows(spark, 9), demo, 0)
    assert files_of(tmp_path, demo)
    assert tables.drop_tables(spark, db) == [demo.table]
    assert not files_of(tmp_path, demo) and not spark.catalog.tableExists(demo.table)


def test_table_name_must_have_two_parts(spark, config, tmp_path):
    with pytest.raises(ValueError):
        tables.ensure_table(spark, config("demo_events", "a.b"), str(tmp_path))


def test_same_batch_twice_is_one_copy(spark, demo):
    for batch in (0, 1, 1, 0):
        tables.append_batch(rows(spark, 10, start=10 * batch), demo, batch)
    table = tables.read_table(spark, demo.table)
    assert table.count() == 20 and table.select("user_id").distinct().count() == 20


def test_batches_are_numbered_by_ingestion_time(spark, demo):
    at = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    for _ in range(2):
        tables.append_batch(rows(spark, 10).withColumn("_ingestion_timestamp", F.lit(at)), demo)
    tables.backfill(spark, rows(spark, 10, 10), demo)
    table = tables.read_table(spark, demo.table)
    assert table.count() == 20
    first, second = sorted(r[0] for r in table.select("_batch_id").distinct().collect())
    assert first == int(at.timestamp() * 1000) < second


def test_partitions_merged_in_one_job_keep_their_own_commits(spark, demo):
    """Day 1 ends with batch 1, day 2 with batch 2; a replay of batch 2 may still write day 1."""
    day1, day2 = [rows(spark, 30).where(F.col("event_date") == F.date_add(F.lit(DAY0), i)) for i in (0, 1)]
    for batch, part in ((0, day1.unionByName(day2)), (1, day1), (2, day2)):
        tables.append_batch(part, demo, batch)
    assert tables.compact(spark, demo, include_latest=True) == 2
    assert [p.commit % 2 for p in tables.list_partitions(spark, demo.table)] == [1, 1]
    tables.append_batch(day1.unionByName(day2), demo, 2)  # takes the place of batch 2, merged or not
    assert tables.read_table(spark, demo.table).count() == 50


def test_late_batch_below_a_compaction_stays(spark, demo):
    for batch in (10, 30, 40):
        tables.append_batch(rows(spark, 10, batch), demo, batch)
    assert tables.compact(spark, demo) > 0
    tables.append_batch(rows(spark, 10, 20), demo, 20)
    assert tables.read_table(spark, demo.table).count() == 40
    assert tables.recover(spark, demo.table) == 0
    tables.compact(spark, demo, include_latest=True)
    assert tables.read_table(spark, demo.table).count() == 40
    assert sorted(r[0] for r in tables.read_table(spark, demo.table).select("_batch_id").distinct().collect()) == [10, 20, 30, 40]


def test_merged_batch_that_is_written_again_replaces_its_merged_rows(spark, demo):
    for batch in (10, 20, 30):
        tables.append_batch(rows(spark, 10, batch), demo, batch)
    tables.compact(spark, demo)
    assert {b for held in tables.merged_batches(spark, demo.table).values() for b in held} == {10, 20}
    before = tables.list_partitions(spark, demo.table)
    tables.append_batch(rows(spark, 10, 20), demo, 20)
    table = tables.read_table(spark, demo.table)
    assert table.count() == 30 and table.select("user_id").distinct().count() == 30
    tables.append_batch(rows(spark, 10, 20), demo, 20)  # and once more
    tables.compact(spark, demo, include_latest=True)  # 10 (merged), 20 and 30
    tables.append_batch(rows(spark, 4, 20), demo, 20)
    tables.append_batch(rows(spark, 10, 30), demo, 30)
    assert tables.read_table(spark, demo.table).groupBy("_batch_id").count().orderBy("_batch_id").collect() == [(10, 10), (20, 4), (30, 10)]
    assert before and tables.recover(spark, demo.table) == 0


def test_any_order_of_batches_compactions_and_replays(spark, demo):
    import random

    rng = random.Random(4)
    want = {}
    for step in range(12):
        if step % 4 == 3:
            tables.compact(spark, demo, include_latest=rng.random() < 0.5)
        else:
            batch = rng.choice([1, 2, 3, 4])
            want[batch] = rng.randint(1, 9)
            tables.append_batch(rows(spark, want[batch], 100 * batch), demo, batch)
        assert dict(tables.read_table(spark, demo.table).groupBy("_batch_id").count().collect()) == want
    tables.compact(spark, demo, include_latest=True)
    tables.compact(spark, demo, include_latest=True)
    live = {p.commit for p in tables.list_partitions(spark, demo.table)}
    assert set(tables.merged_batches(spark, demo.table)) <= live  # records go with their partitions


def test_replay_after_a_compaction_rewrites_only_partitions_that_hold_the_batch(spark, demo):
    one_day = rows(spark, 30, 50).where(F.col("event_date") == F.lit(DAY0))
    tables.append_batch(rows(spark, 30), demo, 1)
    tables.append_batch(rows(spark, 30, 100), demo, 2)
    tables.append_batch(one_day, demo, 3)
    tables.compact(spark, demo, include_latest=True)
    merged = {p.path for p in tables.list_partitions(spark, demo.table)}
    tables.append_batch(one_day, demo, 3)
    after = {p.path for p in tables.list_partitions(spark, demo.table)}
    assert len(merged - after) == 1
    assert tables.read_table(spark, demo.table).count() == 60 + one_day.count()


def test_replay_with_fewer_partitions_replaces_all(spark, demo):
    tables.append_batch(rows(spark, 30), demo, 1)
    one_day = rows(spark, 30).where(F.col("event_date") == F.lit(DAY0))
    tables.append_batch(one_day, demo, 1)
    assert tables.read_table(spark, demo.table).count() == one_day.count() == 10
    tables.append_batch(one_day.limit(0), demo, 1)
    assert tables.read_table(spark, demo.table).count() == 0


def sizes_of(tmp_path, config):
    """File sizes by table partition."""
    out = {}
    for f in files_of(tmp_path, config):
        folder = "/".join(x for x in f.parent.parts if "=" in x and not x.startswith("_commit"))
        out.setdefault(folder, []).append(f.stat().st_size)
    return out


def wide_rows(spark, n, start=0, days=2):
    """Rows that take about as many bytes in any order; the first day has most of them."""
    i = F.col("id")
    return spark.range(start, start + n).repartition(3).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + i).alias("timestamp"),
        F.date_add(F.lit(DAY0), F.when(i % 10 == 0, i % days).otherwise(0).cast("int")).alias("event_date"),
        F.sha2(i.cast("string"), 512).alias("user_id"), F.lit("view").alias("event_type"))


@pytest.mark.parametrize("partition_by", [(), ("event_date",)])
def test_files_are_packed_by_size(spark, config, database, tmp_path, partition_by):
    c = config("demo_events", database, partition_by=partition_by)
    tables.ensure_table(spark, c, str(tmp_path))
    for batch in range(6):
        tables.append_batch(with_ingestion_time(wide_rows(spark, 2_000, 2_000 * batch)), c, batch, cluster=False)
    target = 256 << 10
    assert tables.compact(spark, c, include_latest=True, target_bytes=target) > 0
    table = tables.read_table(spark, c.table)
    assert table.count() == table.select("user_id").distinct().count() == 12_000
    for sizes in sizes_of(tmp_path, c).values():
        assert sum(not 0.75 * target <= s <= 1.25 * target for s in sizes) <= 1
    assert max(map(len, sizes_of(tmp_path, c).values())) >= 5
    before = {f: f.stat().st_mtime_ns for f in files_of(tmp_path, c)}
    assert tables.compact(spark, c, include_latest=True, target_bytes=target) == 0
    assert {f: f.stat().st_mtime_ns for f in files_of(tmp_path, c)} == before

    tables.append_batch(with_ingestion_time(wide_rows(spark, 1_500, 50_000)), c, 9, cluster=False)
    assert tables.compact(spark, c, include_latest=True, target_bytes=target) > 0
    good = {f for f in before if 0.75 * target <= f.stat().st_size <= 1.25 * target} if all(f.exists() for f in before) else {
        f for f in before if f.exists()}
    assert len(good) >= len(before) - len(sizes_of(tmp_path, c))  # only remainders were taken up again
    for sizes in sizes_of(tmp_path, c).values():
        assert sum(not 0.75 * target <= s <= 1.25 * target for s in sizes) <= 1
    tables.append_batch(with_ingestion_time(wide_rows(spark, 1_500, 50_000)), c, 9)  # a packed batch again
    assert tables.read_table(spark, c.table).count() == 13_500


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    path = f"{tmp_path}/notes/table.json"
    for scheme in ("", "file://"):
        for text in ("one", "", "zwei é" * 1000):
            write_text(spark, scheme + path, text)
            assert read_text(spark, scheme + path) == text
    assert [f.name for f in (tmp_path / "notes").iterdir() if not f.name.startswith(".")] == ["table.json"]


def test_packing_of_any_total():
    for total in range(1, 6_000, 7):
        p = tables.pack((), total, 1_000)
        sizes = [total * p.share] * p.full + [total * (1 - p.full * p.share)] * (p.files - p.full)
        assert abs(sum(sizes) - total) < 1e-6 and sum(not 750 <= round(s, 6) <= 1_250 for s in sizes) <= 1
        assert all(750 <= round(s, 6) <= 1_250 for s in sizes[:p.full])


def test_packing_stopped_while_writing(spark, demo, monkeypatch):
    for batch in (0, 1):
        tables.append_batch(rows(spark, 30, 30 * batch), demo, batch)

    def failing(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "drop_partitions", failing)
    with pytest.raises(RuntimeError):
        tables.compact(spark, demo, include_latest=True, target_bytes=1 << 20)
    monkeypatch.undo()
    assert tables.read_table(spark, demo.table).count() == 60
    tables.recover(spark, demo.table)
    assert tables.read_table(spark, demo.table).count() == 60 and len(tables.list_partitions(spark, demo.table)) == 3


def test_unpartitioned_table(spark, config, database, tmp_path):
    c = config("demo_events", database, partition_by=())
    tables.ensure_table(spark, c, str(tmp_path))
    tables.append_batch(rows(spark, 5), c, 0)
    tables.append_batch(rows(spark, 5, start=5), c, 1)
    assert tables.compact(spark, c, include_latest=True) == 1
    assert tables.read_table(spark, c.table).count() == 10


def test_null_and_odd_partition_values(spark, config, database, tmp_path):
    c = config("demo_events", database, partition_by=("event_type",))
    tables.ensure_table(spark, c, str(tmp_path))
    odd = F.element_at(F.array(F.lit(None), F.lit("a'b/c=d"), F.lit("x\\y z%")), (F.col("_i") % 3 + 1).cast("int"))
    data = rows(spark, 9).withColumn("_i", F.monotonically_increasing_id()).withColumn("event_type", odd)
    for batch in (0, 1):
        tables.append_batch(data, c, batch)
    assert tables.compact(spark, c, include_latest=True) == tables.read_table(spark, c.table).select(
        "event_type").distinct().count()
    assert tables.read_table(spark, c.table).count() == 18
    assert len({p.commit for p in tables.list_partitions(spark, c.table)}) == 1
    tables.append_batch(data, c, 2)
    n = tables.read_table(spark, c.table).select("event_type").distinct().count()
    assert tables.compact(spark, c, include_latest=True, target_bytes=1 << 20) == n == len(tables.list_partitions(spark, c.table))
    assert tables.read_table(spark, c.table).count() == 27


# --- evolution --------------------------------------------------------------------------


def test_added_columns_read_null_in_old_rows(spark, demo, config, database, tmp_path):
    tables.append_batch(rows(spark, 10), demo, 0)
    v2 = config("demo_events", database, ("country_code string?", "session_id string?"))
    _, diff = tables.ensure_table(spark, v2, str(tmp_path))
    assert sorted((r["field"], r["action"]) for r in diff) == [("country_code", "add"), ("session_id", "add")]
    tables.append_batch(rows(spark, 10, 10, extra=(F.lit("US").alias("country_code"), F.lit("s").alias("session_id"))), v2, 1)
    table = tables.read_table(spark, demo.table)
    assert table.count() == 20
    assert table.where("country_code IS NULL AND session_id IS NULL").count() == 10
    _, again = tables.ensure_table(spark, v2, str(tmp_path))
    assert again == []


def evolve(spark, config, database, tmp_path, before, after):
    c1 = config("demo_events", database, (f"x {before}",))
    tables.ensure_table(spark, c1, str(tmp_path))
    tables.append_batch(rows(spark, 6, extra=(F.lit(7).cast(before).alias("x"),)), c1, 0)
    c2 = config("demo_events", database, (f"x {after}",))
    return c2, *tables.ensure_table(spark, c2, str(tmp_path))


@pytest.mark.parametrize("before, after, value", [("int", "long", 2**40), ("float", "double", 1 / 3)])
def test_widening(spark, config, database, tmp_path, before, after, value):
    c2, effective, diff = evolve(spark, config, database, tmp_path, before, after)
    assert [(r["field"], r["action"]) for r in diff] == [("x", "widen")] and effective == c2
    tables.append_batch(rows(spark, 6, 6, extra=(F.lit(value).alias("x"),)), effective, 1)
    got = [r.x for r in tables.read_table(spark, c2.table).orderBy("user_id").collect()]
    assert sorted(got) == sorted([7] * 6 + [value] * 6)
    assert not spark.catalog.tableExists(c2.table + "__wider")


@pytest.mark.parametrize("before, after", [("int", "string"), ("long", "int"), ("string", "int")])
def test_other_type_changes_keep_the_current_type(spark, config, database, tmp_path, before, after):
    _, effective, diff = evolve(spark, config, database, tmp_path, before, after)
    assert [(r["field"], r["action"]) for r in diff] == [("x", "keep_current")]
    assert {f.name: f.type for f in effective.fields}["x"] == before


def test_removed_field_stays(spark, demo, tmp_path):
    less = dataclasses.replace(demo, fields=tuple(f for f in demo.fields if f.name != "event_type"))
    tables.append_batch(rows(spark, 3), demo, 0)
    _, diff = tables.ensure_table(spark, less, str(tmp_path))
    assert [(r["field"], r["action"]) for r in diff] == [("event_type", "removed")]
    tables.append_batch(rows(spark, 3, 3).drop("event_type"), less, 1)
    assert tables.read_table(spark, demo.table).where("event_type IS NULL").count() == 3


def test_required_field_may_become_optional(spark, demo, tmp_path):
    fields = tuple(Field(f.name, f.type, required=False) for f in demo.fields)
    _, diff = tables.ensure_table(spark, dataclasses.replace(demo, fields=fields), str(tmp_path))
    assert diff == []


def test_another_layout_is_reported_and_the_old_one_kept(spark, demo, tmp_path):
    other = dataclasses.replace(demo, partition_by=("event_type",))
    effective, diff = tables.ensure_table(spark, other, str(tmp_path))
    assert effective.partition_by == ("event_date",)
    assert [(r["field"], r["action"]) for r in diff] == [("partition_by", "keep_current")]


def test_table_defined_over_files_that_are_there(spark, demo, tmp_path):
    tables.append_batch(rows(spark, 10), demo, 0)
    spark.sql(f"DROP TABLE {demo.table}")
    tables.ensure_table(spark, demo, str(tmp_path))
    assert tables.read_table(spark, demo.table).count() == 10


# --- upkeep -----------------------------------------------------------------------------


def three_batches(spark, demo):
    for batch in range(3):
        tables.append_batch(rows(spark, 30, 30 * batch), demo, batch)


def test_compaction_keeps_rows_and_leaves_the_newest_batch(spark, demo, tmp_path):
    three_batches(spark, demo)
    before = tables.read_table(spark, demo.table).select("user_id", "_batch_id").collect()
    n = len(files_of(tmp_path, demo))
    assert tables.compact(spark, demo) == 3
    assert sorted(tables.read_table(spark, demo.table).select("user_id", "_batch_id").collect()) == sorted(before)
    assert len(files_of(tmp_path, demo)) < n
    commits = {p.commit for p in tables.list_partitions(spark, demo.table)}
    assert len(commits) == 2 and 4 in commits
    assert tables.compact(spark, demo) == 0
    tables.append_batch(rows(spark, 30, 60), demo, 2)  # replay of the newest batch
    assert tables.read_table(spark, demo.table).count() == 90


def test_compaction_in_small_jobs(spark, demo):
    three_batches(spark, demo)
    assert tables.compact(spark, demo, include_latest=True, groups_per_job=1) == 3
    assert tables.read_table(spark, demo.table).count() == 90
    assert len(tables.list_partitions(spark, demo.table)) == 3


def test_compaction_stopped_before_the_drop(spark, demo, monkeypatch):
    three_batches(spark, demo)

    def stop(_spark, _table, partitions):
        if partitions:
            raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "drop_partitions", stop)
    with pytest.raises(RuntimeError):
        tables.compact(spark, demo, include_latest=True)
    monkeypatch.undo()
    assert spark.table(demo.table).count() == 180
    assert tables.read_table(spark, demo.table).count() == 90
    assert tables.recover(spark, demo.table) == 9
    assert spark.table(demo.table).count() == 90


def test_compaction_stopped_while_writing(spark, demo, monkeypatch):
    three_batches(spark, demo)
    write = tables.write_rows

    def stop(rows, config, **how):
        write(rows.where("user_id < 'user_2'"), config, **how)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "write_rows", stop)
    with pytest.raises(RuntimeError):
        tables.compact(spark, demo, include_latest=True)
    monkeypatch.undo()
    assert tables.read_table(spark, demo.table).count() == 90
    tables.append_batch(rows(spark, 30, 90), demo, 1_000)
    tables.recover(spark, demo.table)
    assert spark.table(demo.table).count() == 120
    assert tables.merge_notes(spark, demo.table) == []


def forget(spark, table):
    """What a new process knows of a table: nothing.  The files stay."""
    spark.sql(f"DROP TABLE {table}")


def test_restart_keeps_schema_codec_and_drops(spark, demo, tmp_path, monkeypatch):
    three_batches(spark, demo)
    names = {f.name: f for f in demo.fields}
    refused = dataclasses.replace(demo, fields=tuple(
        dataclasses.replace(f, type="long") if f.name == "user_id" else f for f in demo.fields if f.name != "event_type"))
    forget(spark, demo.table)
    effective, diff = tables.ensure_table(spark, refused, str(tmp_path))
    assert {(d["field"], d["action"]) for d in diff} == {("user_id", "keep_current"), ("event_type", "removed")}
    assert {f.name: f.type for f in effective.fields}["user_id"] == names["user_id"].type
    assert tables.read_table(spark, demo.table).select("user_id", "event_type").distinct().count() == 90

    monkeypatch.setattr(tables, "delete_paths", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    dropped = [p for p in tables.list_partitions(spark, demo.table) if p.commit == 0]
    with pytest.raises(RuntimeError):
        tables.drop_partitions(spark, demo.table, dropped)
    monkeypatch.undo()
    assert spark.table(demo.table).count() == 60
    forget(spark, demo.table)
    tables.ensure_table(spark, demo, str(tmp_path))
    assert tables.read_table(spark, demo.table).count() == 60


def test_widening_keeps_codec_and_layout(spark, config, database, tmp_path):
    c = config("demo_events", database)
    fields = (*c.fields, Field("n", "int", required=False))
    c = dataclasses.replace(c, fields=fields)
    tables.ensure_table(spark, c, str(tmp_path), codec="zstd")
    tables.append_batch(rows(spark, 10).withColumn("n", F.lit(1)), c, 0)
    wider = dataclasses.replace(c, fields=(*c.fields[:-1], Field("n", "long", required=False)), partition_by=("event_type",))
    effective, diff = tables.ensure_table(spark, wider, str(tmp_path))
    assert {(d["field"], d["action"]) for d in diff} == {("n", "widen"), ("partition_by", "keep_current")}
    assert effective.partition_by == c.partition_by
    tables.append_batch(rows(spark, 10, 10).withColumn("n", F.lit(1 << 40)), effective, 1)
    assert all("zstd" in f.name for f in files_of(tmp_path, c))
    assert tables.read_table(spark, c.table).agg(F.sum("n")).first()[0] == 10 + 10 * (1 << 40)


def test_versions_and_rollback(spark, demo):
    three_batches(spark, demo)
    tables.compact(spark, demo)
    assert [history.as_of(spark, demo.table, version=v).count() for v in (0, 1, 2)] == [30, 60, 90]
    snaps = history.snapshots(tables.read_table(spark, demo.table)).collect()
    assert [(s["_batch_id"], s["added_records"]) for s in snaps] == [(2, 30), (1, 30), (0, 30)]
    tables.rollback(spark, demo, version=0)
    left = tables.read_table(spark, demo.table)
    assert left.count() == 30 and [r[0] for r in left.select("_batch_id").distinct().collect()] == [0]


def test_moments(spark, demo):
    early, late = dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)
    for batch, at in enumerate((early, late)):
        tables.append_batch(rows(spark, 5, 5 * batch).withColumn("_ingestion_timestamp", F.lit(at)), demo, batch)
    assert history.as_of(spark, demo.table, timestamp=early).count() == 5
    assert history.as_of(spark, demo.table, timestamp=late).count() == 10
    delta = count_delta(history.as_of(spark, demo.table, version=0), tables.read_table(spark, demo.table), 5).first()
    assert (delta.rows_before, delta.rows_after, delta.gained, delta.as_expected) == (5, 10, 5, True)


def test_retention_is_strict_and_deletes_files(spark, demo, tmp_path):
    tables.append_batch(rows(spark, 30), demo, 0)  # 2024-01-01 .. 03, kept 7 days
    assert tables.apply_retention(spark, demo, dt.date(2024, 1, 9)) == 1
    left = [r[0] for r in tables.read_table(spark, demo.table).select("event_date").distinct().collect()]
    assert min(left) == dt.date(2024, 1, 2)
    assert not any("event_date=2024-01-01" in str(f) for f in files_of(tmp_path, demo))


def test_retention_needs_a_date_partition(spark, config, database, tmp_path):
    c = config("demo_events", database, partition_by=("event_type",))
    tables.ensure_table(spark, c, str(tmp_path))
    tables.append_batch(rows(spark, 5), c, 0)
    assert tables.date_column(c) is None
    assert tables.apply_retention(spark, c, dt.date(2030, 1, 1)) == 0


# --- layout -----------------------------------------------------------------------------


def test_hot_partition_is_cut_into_several_files(spark, demo, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        wide = rows(spark, 40_000, days=1).withColumn("user_id", F.sha2(F.col("user_id"), 256))
        tables.append_batch(wide.repartition(16), demo, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files_of(tmp_path, demo)) > 4
    assert tables.read_table(spark, demo.table).count() == 40_000


def test_clustered_write_gives_one_small_file_per_partition(spark, demo, tmp_path):
    tables.append_batch(rows(spark, 300).repartition(8), demo, 0)
    assert len(files_of(tmp_path, demo)) == 3
    tables.append_batch(rows(spark, 300).repartition(8), demo, 1, cluster=False)
    assert len(files_of(tmp_path, demo)) == 3 + 24
    per_file = history.files(tables.read_table(spark, demo.table), ["event_date"])
    assert per_file.agg(F.sum("record_count")).first()[0] == 600
    parts = history.partitions(tables.read_table(spark, demo.table), ["event_date"]).collect()
    assert {(p.record_count, p.file_count) for p in parts} == {(200, 9)}


def test_record_limit_and_codec(spark, config, database, tmp_path):
    c = config("demo_events", database)
    tables.ensure_table(spark, c, str(tmp_path), codec="zstd")
    tables.append_batch(rows(spark, 300), c, 0, max_records_per_file=40)
    names = [f.name for f in files_of(tmp_path, c)]
    assert len(names) == 9 and all("zstd" in n for n in names)


def test_partition_filter_and_columns_reach_the_scan(spark, demo):
    tables.append_batch(rows(spark, 30), demo, 0)
    plan = tables.read_table(spark, demo.table).where(F.col("event_date") == DAY0).select("user_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text and "ReadSchema: struct<user_id:string>" in text
    at = history.as_of(spark, demo.table, version=0)
    assert "_commit" in at._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
