"""Batch records against the tables they describe; figures without a scan."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from logweir.functions.envelope import with_ingestion_time
from logweir.operators import tables
from logweir.operators.quality import health
from logweir.plans import all_queries, staging as S
from logweir.plans.views import view
from logweir.session import path_exists
from logweir.sources.topics import FileTopics, totals
from logweir.streaming import ledger as L
from logweir.streaming.progress import recorded_totals

DDL = "query string, run string, batch_id long, at string, input_rows long, duration_ms long, end_offsets string, latest_offsets string"


def test_records_equal_tables(spark, sf_dir):
    stage = S.warehouse(spark, sf_dir)
    stored = stage.ledger.batches(spark)
    for log_type, config in stage.configs.items():
        got = {r._batch_id: r.added_records for r in L.snapshots(stored, config.table).collect()}
        want = {r._batch_id: r["count"] for r in stage.table(log_type).groupBy("_batch_id").count().collect()}
        assert got == want and sum(got.values()) > 0
    got = {(r.source, r.reason): r.messages for r in L.reject_counts(stored).collect()}
    want = {(r.source, r.reason): r["count"] for r in stage.quarantine.groupBy("source", "reason").count().collect()}
    assert got == want and len(got) == 5


def test_health_reads_no_message_and_no_table(spark, sf_dir):
    stage = S.warehouse(spark, sf_dir)
    out = health(totals(stage.topics.ends(spark, "user-events")), L.loaded(stage.ledger.batches(spark).where("topic = 'user-events'")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and "ReadSchema: struct<>" in scans[0]
    assert [r.lag for r in out.collect()] == [0]


def test_a_topic_is_staged_when_it_is_asked_for(spark, sf_dir):
    folder = f"{sf_dir}/."  # a stage of its own
    all_queries()["prj6_flatten_unrouted"](spark, folder).collect()
    assert not path_exists(spark, S.prepared(spark, folder).topics.root)
    assert [r.added_records > 0 for r in all_queries()["met1_snapshots"](spark, folder).collect()] == [True, True]
    stage = S.prepared(spark, folder)
    assert stage.ingested == {"api-metrics"} and not path_exists(spark, stage.topics.path("user-events"))
    alone = S.topic(spark, folder, "user-events")
    assert alone.root != stage.topics.root and S.topic(spark, folder, "api-metrics") == stage.topics
    both = S.warehouse(spark, folder)
    assert both is stage and {r.source for r in both.ledger.batches(spark).collect()} == {"api-metrics", "user-events"}
    assert alone.read(spark, "user-events").count() == both.topics.read(spark, "user-events").count()


def test_a_stage_that_failed_is_built_anew(spark, sf_dir, monkeypatch):
    folder = f"{sf_dir}/./."
    with monkeypatch.context() as broken:
        broken.setattr(S, "start_ingest", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            S.warehouse(spark, folder, "api-metrics")
    stage = S.warehouse(spark, folder, "api-metrics")
    assert stage.table("api_metrics").count() == view(spark, sf_dir, "api_metrics").count()


def put(ledger, spark, number, rows, name="db.t"):
    ledger.record(spark, "q", "topic", number, [{"table_name": name, "log_type": "t", "rows": rows},
                                                {"table_name": "db.quarantine", "log_type": "quarantine", "rows": 2, "rejects": {"malformed": 2}}])


def test_replay_replaces_and_days_fold(spark, tmp_path):
    book = L.Ledger(str(tmp_path / "batches"))
    assert book.batches(spark).count() == 0
    day = 86_400_000
    for number, rows in ((1, 5), (day + 1, 7), (1, 6)):
        put(book, spark, number, rows)
    want = {1: 6, day + 1: 7}

    def seen():
        return {r._batch_id: r.added_records for r in L.snapshots(book.batches(spark), "db.t").collect()}

    assert seen() == want
    assert book.fold(spark, dt.date(1970, 1, 2)) == 1 and seen() == want
    put(book, spark, 1, 4)  # replayed after its day was folded
    assert seen() == want | {1: 4}
    assert book.fold(spark, dt.date(1970, 1, 9)) == 2 and seen() == want | {1: 4}
    assert book.fold(spark, dt.date(1970, 1, 9)) == 0
    assert [(r.topic, r.rows) for r in L.loaded(book.batches(spark)).collect()] == [("topic", 15)]
    assert [(r.reason, r.messages) for r in L.reject_counts(book.batches(spark)).collect()] == [("malformed", 4)]


def test_fold_stopped_before_the_files_are_deleted(spark, tmp_path):
    book = L.Ledger(str(tmp_path / "batches"))
    put(book, spark, 1, 5)
    spark.read.schema(L._DDL).json(f"{book.folder}/new/1970-01-01").write.parquet(f"{book.folder}/folded")
    assert [r.added_records for r in L.snapshots(book.batches(spark), "db.t").collect()] == [5]
    book.fold(spark, dt.date(1971, 1, 1))
    assert [r.added_records for r in L.snapshots(book.batches(spark), "db.t").collect()] == [5]


def test_empty_write_is_counted_as_none(spark, sf_dir, tmp_path, config, database):
    made = config("api_metrics", database)
    tables.ensure_table(spark, made, str(tmp_path))
    rows = with_ingestion_time(view(spark, sf_dir, "api_metrics").where("status_code = 0"))
    for cluster in (True, False):
        got = tables.append_batch(rows, made, 3, cluster=cluster, figures={"rows": F.count(F.lit(1))})
        assert got == {"rows": 0}
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_totals_of_numbered_offsets_and_reruns(spark):
    kafka = [json.dumps([json.dumps({"calls": {"0": n, "1": 5}})]) for n in (10, 20, 30)]
    rows = [
        ("calls", "a", 0, "1", 15, 1, kafka[0], kafka[1]),
        ("calls", "a", 1, "2", 10, 1, kafka[1], kafka[2]),
        ("files", "a", 0, "1", 4, 1, json.dumps(['{"logOffset":0}']), json.dumps([None])),
        ("files", "a", 1, "2", 9, 1, json.dumps(['{"logOffset":1}']), None),
        ("files", "b", 1, "3", 6, 1, None, None),  # batch 1 again, after a restart
    ]
    got = {r.topic: (r.total_messages, r.read_messages) for r in recorded_totals(spark.createDataFrame(rows, DDL)).collect()}
    assert got == {"calls": (35, 25), "files": (10, 10)}


def test_ends_of_text_topics(spark, tmp_path):
    topics = FileTopics(str(tmp_path), format="text")
    topics.publish(spark.createDataFrame([("a",), ("b",), (None,)], "value string").coalesce(1), "lines")
    assert [r.total_messages for r in totals(topics.ends(spark, "lines")).collect()] == [3]
