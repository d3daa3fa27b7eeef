import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from logweir.functions.envelope import encode
from logweir.operators import tables
from logweir.operators.quality import null_audit
from logweir.plans import staging as S
from logweir.plans.views import view
from logweir.sources.topics import FileTopics, KafkaTopics, end_offsets, peek, replay, topic_totals
from logweir.streaming.ingest import quarantine_config, start_ingest
from logweir.streaming.progress import ProgressLog, progress

NOW = {"availableNow": True}

# Accepted and rejected messages of the shared topic, by scale.
EXPECTED = {
    "sf0.001": dict(no_envelope=15, malformed=10, missing_required=11, unknown_type=11, bad_type=11,
                    user_events=756, user_activity=385),
    "sf0.01": dict(no_envelope=123, malformed=125, missing_required=113, unknown_type=110, bad_type=104,
                   user_events=7604, user_activity=3838),
}


class Pipe:
    """Topics, tables and checkpoints of one test."""

    def __init__(self, spark, root, configs):
        self.spark, self.root, self.configs = spark, str(root), configs
        self.topics = FileTopics(f"{root}/topics")
        self.checkpoint = f"{root}/checkpoint"

    def run(self, **how):
        run = start_ingest(self.spark, list(self.configs.values()), self.topics, f"{self.root}/warehouse",
                           self.checkpoint, trigger=NOW, **how)
        run.finish()
        return run

    def rows(self, log_type):
        return tables.read_table(self.spark, self.configs[log_type].table)

    def rejected(self):
        database = next(iter(self.configs.values())).table.split(".")[0]
        return tables.read_table(self.spark, f"{database}.quarantine")


@pytest.fixture
def pipe(spark, tmp_path, config, database):
    def made(*types):
        # By day only: writing many small local folders is what takes the time.
        configs = {t: config(t, database) for t in types}
        by_day = {t: dataclasses.replace(c, partition_by=c.partition_by[:1]) for t, c in configs.items()}
        return Pipe(spark, tmp_path, by_day)

    yield made
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def demo_rows(spark, n, start=0):
    return spark.range(start, start + n).selectExpr(
        "timestamp'2024-01-01 10:00:00' AS timestamp", "date'2024-01-01' AS event_date",
        "concat('user_', id) AS user_id", "'click' AS event_type",
    )


@pytest.mark.parametrize("sf, fan_out", [("sf0.001", "topic"), ("sf0.01", "topic"), ("sf0.01", "type")])
def test_every_message_is_in_a_table_or_quarantined(spark, pipe, sf, fan_out):
    p = pipe("user_events", "user_activity")
    p.topics.publish(S.shared_topic_messages(spark, f"/root/testdata/{sf}", p.configs), "user-events")
    p.run(fan_out=fan_out)
    got = {t: p.rows(t).count() for t in p.configs}
    got |= {r.reason: r["count"] for r in p.rejected().groupBy("reason").count().collect()}
    assert got == EXPECTED[sf]
    assert sum(got.values()) == topic_totals(p.topics.read(spark, "user-events")).first().total_messages


def test_restart_adds_nothing_and_goes_on(spark, pipe, tmp_path):
    p = pipe("demo_events")
    c = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 5), c), c.topic)
    p.run()
    p.run()
    assert p.rows("demo_events").count() == 5
    p.topics.publish(encode(demo_rows(spark, 5, 5), c), c.topic)
    log = ProgressLog(spark, f"{tmp_path}/progress")
    run = p.run()
    log.wait_for(run.queries)
    log.close()
    assert p.rows("demo_events").count() == 10
    assert progress(spark, f"{tmp_path}/progress").agg(F.sum("input_rows")).first()[0] == 5


def test_batch_that_failed_half_way_is_replayed_whole(spark, pipe, sf_dir, monkeypatch):
    p = pipe("user_events", "user_activity")
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, p.configs), "user-events")
    write, written = tables.append_batch, []

    def failing(df, config, **how):
        if written:
            raise RuntimeError("driver lost")
        written.append(config.table)
        write(df, config, **how)

    monkeypatch.setattr(tables, "append_batch", failing)
    with pytest.raises(Exception):
        p.run()
    monkeypatch.undo()
    first = spark.table(written[0]).agg(F.min("_ingestion_timestamp")).first()[0]
    p.run()
    assert p.rows("user_events").count() == EXPECTED["sf0.001"]["user_events"]
    assert p.rows("user_activity").count() == EXPECTED["sf0.001"]["user_activity"]
    assert p.rejected().count() == 58
    stamps = [r[0] for t in p.configs for r in p.rows(t).select("_ingestion_timestamp").distinct().collect()]
    assert set(stamps) == {first}


def test_all_tasks_parse_a_batch_before_its_first_write(spark, pipe, sf_dir, monkeypatch):
    p = pipe("api_metrics")
    p.topics.publish(encode(view(spark, sf_dir, "api_metrics"), p.configs["api_metrics"]), "api-metrics")
    write, kept = tables.append_batch, []

    def append(df, *args, **how):
        kept.append(sum(i.numCachedPartitions() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()))
        return write(df, *args, **how)

    before = sum(i.numCachedPartitions() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    monkeypatch.setattr(tables, "append_batch", append)
    p.run(repartition=4)
    assert kept[0] - before == 4 and len(kept) == 2 and p.rows("api_metrics").count() == 1000


def test_new_checkpoint_reads_again_but_overwrites_nothing(spark, pipe):
    p = pipe("demo_events")
    c = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 5), c), c.topic)
    p.run()
    p.checkpoint += "-new"
    p.run()
    assert p.rows("demo_events").select("_batch_id").distinct().count() == 2
    assert p.rows("demo_events").count() == 10


def test_several_batches_per_run(spark, pipe):
    p = pipe("demo_events")
    p.topics = FileTopics(p.topics.root, max_files_per_trigger=1)
    c = p.configs["demo_events"]
    for i in range(3):
        p.topics.publish(encode(demo_rows(spark, 4, 4 * i), c).coalesce(1), c.topic)
    p.run()
    assert sorted(r["count"] for r in p.rows("demo_events").groupBy("_batch_id").count().collect()) == [4, 4, 4]


def test_new_fields_on_the_same_checkpoint(spark, pipe, config, database):
    p = pipe("demo_events")
    v1 = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 10), v1), v1.topic)
    p.run()
    v2 = config("demo_events", database, ("country_code string?", "session_id string?"))
    p.configs["demo_events"] = v2
    more = demo_rows(spark, 10, 10).withColumn("country_code", F.lit("US")).withColumn("session_id", F.lit("s"))
    p.topics.publish(encode(more, v2), v2.topic)
    p.run()
    assert p.rows("demo_events").count() == 20
    audit = null_audit(p.rows("demo_events"), ["country_code", "session_id"]).first()
    assert (audit.all_null_rows, audit.null_country_code) == (10, 10)


def test_incompatible_type_goes_on_with_the_old_one(spark, pipe, config, database):
    p = pipe("demo_events")
    p.configs["demo_events"] = config("demo_events", database, ("code int?",))
    c = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 3).withColumn("code", F.lit(7)), c), c.topic)
    p.run()
    p.configs["demo_events"] = config("demo_events", database, ("code string?",))
    p.topics.publish(encode(demo_rows(spark, 3, 3).withColumn("code", F.lit(8)), c), c.topic)
    p.run()
    assert dict(p.rows("demo_events").dtypes)["code"] == "int"
    assert sorted(r.code for r in p.rows("demo_events").collect()) == [7, 7, 7, 8, 8, 8]


def test_one_bad_type_does_not_stop_the_others(spark, pipe):
    p = pipe("demo_events", "api_metrics")
    bad = dataclasses.replace(p.configs["api_metrics"], table="one.two.three")
    c = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 5), c), c.topic)
    p.configs["api_metrics"] = bad
    run = p.run()
    assert list(run.failures) == ["api_metrics"] and p.rows("demo_events").count() == 5


def test_a_topic_that_is_not_there_does_not_stop_the_others(spark, pipe):
    p = pipe("demo_events", "api_metrics")
    c = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 5), c), c.topic)
    run = p.run(cluster=False)
    assert list(run.failures) == ["api_metrics"] and p.rows("demo_events").count() == 5


def test_rejects_can_be_sent_again(spark, pipe, sf_dir):
    """Messages of a type nobody knew yet are quarantined whole and can be published anew."""
    p = pipe("user_events")
    both = pipe("user_events", "user_activity").configs
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, both), "user-events")
    p.run()
    assert p.rows("user_events").count() == EXPECTED["sf0.001"]["user_events"]
    p.configs = both
    again = p.rejected().where("_log_type = 'user_activity'").select("key", "value")
    p.topics.publish(again, "user-events")
    p.run()
    assert p.rows("user_activity").count() == EXPECTED["sf0.001"]["user_activity"]
    assert p.rows("user_events").count() == EXPECTED["sf0.001"]["user_events"]


def test_a_table_belongs_to_one_type(spark, pipe):
    p = pipe("user_events", "user_activity")
    p.configs["user_activity"] = dataclasses.replace(p.configs["user_activity"], table=p.configs["user_events"].table)
    p.topics.publish(encode(demo_rows(spark, 1), p.configs["user_events"]), "user-events")
    failures = p.run().failures
    assert "already belongs" in failures["user_activity"] and "waits for user_activity" in failures["user_events"]


@pytest.mark.parametrize("fan_out, on_invalid", [("topic", "quarantine"), ("topic", "drop"), ("type", "quarantine"), ("type", "drop")])
def test_messages_of_a_type_that_failed_are_kept_for_it(spark, pipe, sf_dir, fan_out, on_invalid):
    p = pipe("user_events", "user_activity")
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, p.configs), "user-events")
    right = p.configs["user_activity"]
    for wrong in (dataclasses.replace(right, table="one.two.three"), dataclasses.replace(right, fields=())):
        p.configs["user_activity"] = wrong
        assert "user_activity" in p.run(fan_out=fan_out, on_invalid=on_invalid).failures
    p.configs["user_activity"] = right
    assert not p.run(fan_out=fan_out, on_invalid=on_invalid).failures
    for log_type in ("user_events", "user_activity"):
        assert p.rows(log_type).count() == EXPECTED["sf0.001"][log_type]
    if on_invalid == "quarantine":
        assert p.rejected().count() == 58


def test_a_type_declared_twice_is_refused(spark, pipe):
    p = pipe("user_events")
    c = p.configs["user_events"]
    p.topics.publish(encode(demo_rows(spark, 1), c), "user-events")
    p.configs["again"] = dataclasses.replace(c, table=c.table + "_2")
    assert "more than once" in p.run().failures["user_events"]


def test_progress_is_complete_over_many_batches(spark, tmp_path):
    for i in range(105):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i:03d}.txt").write_text("x\n")
    log = ProgressLog(spark, f"{tmp_path}/progress")
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in")
    query = (stream.writeStream.queryName("many").format("noop").option("checkpointLocation", f"{tmp_path}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    log.wait_for([query])
    log.close()
    assert len(query.recentProgress) <= 100
    seen = progress(spark, f"{tmp_path}/progress")
    assert seen.agg(F.sum("input_rows")).first()[0] == 105 and seen.select("batch_id").distinct().count() == 105


def test_drop_and_null_row(spark, pipe, sf_dir):
    p = pipe("user_events", "user_activity")
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, p.configs), "user-events")
    p.run(on_invalid="null_row")
    e = EXPECTED["sf0.001"]
    stray = e["no_envelope"] + e["malformed"] + e["unknown_type"]
    total = sum(e.values())
    both = p.rows("user_events").count() + p.rows("user_activity").count()
    assert both == total + stray  # messages of no type are in both tables
    assert p.rows("user_events").where("event_type IS NULL AND user_id IS NULL").count() == stray
    with pytest.raises(ValueError):
        p.run(on_invalid="nothing")


def test_dropped_messages_leave_no_quarantine(spark, pipe, sf_dir):
    p = pipe("user_events", "user_activity")
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, p.configs), "user-events")
    p.run(on_invalid="drop")
    assert p.rows("user_events").count() == EXPECTED["sf0.001"]["user_events"]
    assert not spark.catalog.tableExists(quarantine_config(p.configs["user_events"].table.split(".")[0]).table)


def test_hot_partition_is_split_in_a_stream(spark, pipe, tmp_path):
    p = pipe("demo_events")
    c = p.configs["demo_events"]
    hot = demo_rows(spark, 30_000).withColumn("user_id", F.sha2(F.col("user_id"), 256))
    p.topics.publish(encode(hot, c).repartition(8), c.topic)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        p.run()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    folder = tmp_path / "warehouse" / c.table.replace(".", "/") / "event_date=2024-01-01"
    assert len(list(folder.rglob("*.parquet"))) > 1  # as many as the tasks that read the topic
    assert p.rows("demo_events").count() == 30_000


def test_topic_of_text_lines(spark, pipe, sf_dir):
    p = pipe("api_metrics")
    p.topics = FileTopics(p.topics.root, format="text")
    c = p.configs["api_metrics"]
    p.topics.publish(encode(view(spark, sf_dir, "api_metrics"), c), c.topic)
    p.topics.publish(spark.createDataFrame([("not json",)], "value string"), c.topic)
    assert p.topics.read(spark, c.topic).count() == 1001
    p.run()
    assert p.rows("api_metrics").count() == 1000 and p.rejected().first().reason == "malformed"


def test_offsets_replay_and_peek(spark, pipe, sf_dir):
    p = pipe("api_metrics")
    c = p.configs["api_metrics"]
    p.topics.publish(encode(view(spark, sf_dir, "api_metrics"), c).repartition(3), c.topic)
    messages = p.topics.read(spark, c.topic)
    ends = {r.partition: r.end_offset for r in end_offsets(messages).collect()}
    assert sum(ends.values()) == 1000 and len(ends) == 3
    one = sorted(ends)[0]
    late = replay(messages, {one: 100})
    assert late.count() == ends[one] - 100
    assert [r.offset for r in peek(late, 5).collect()] == [100, 101, 102, 103, 104]
    assert peek(messages, 1, newest=True).first().offset == max(ends.values()) - 1
    assert replay(messages).count() == 1000


def test_file_topics_start_at_the_first_file(spark, tmp_path):
    with pytest.raises(ValueError):
        FileTopics(str(tmp_path)).stream(spark, "t", starting="latest")


def test_kafka_without_its_package_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        KafkaTopics("nowhere:9092").stream(spark, "t")


def test_totals_of_a_text_topic_count_its_messages(spark, tmp_path):
    topics = FileTopics(str(tmp_path), format="text")
    topics.publish(spark.range(7).select(F.col("id").cast("string").alias("value")), "lines")
    assert [tuple(r) for r in topic_totals(topics.read(spark, "lines")).collect()] == [("lines", 7)]


def test_bounded_kafka_reads_name_every_partition_they_read():
    topics = KafkaTopics("broker:9092")
    whole = topics.read_options("t")
    assert whole["subscribe"] == "t" and "assign" not in whole
    some = topics.read_options("t", {0: 5, 2: 7}, {2: 9, 3: 4})
    assert "subscribe" not in some and json.loads(some["assign"]) == {"t": [0, 2, 3]}
    assert json.loads(some["startingOffsets"]) == {"t": {"0": 5, "2": 7, "3": -2}}
    assert json.loads(some["endingOffsets"]) == {"t": {"0": -1, "2": 9, "3": 4}}


def test_compaction_between_failure_and_replay_loses_nothing(spark, pipe, sf_dir, monkeypatch):
    p = pipe("user_events", "user_activity")
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, p.configs, 0), "user-events")
    p.run()
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, p.configs, 1), "user-events")
    write, written = tables.append_batch, []

    def failing(df, config, **how):
        if written:
            raise RuntimeError("driver lost")
        written.append(config.table)
        write(df, config, **how)

    monkeypatch.setattr(tables, "append_batch", failing)
    with pytest.raises(Exception):
        p.run()
    monkeypatch.undo()
    for c in p.configs.values():
        tables.compact(spark, c, include_latest=True)
    p.run()
    for t in p.configs:
        assert p.rows(t).count() == EXPECTED["sf0.001"][t]


def test_backfill_and_compaction_between_failure_and_replay(spark, pipe, monkeypatch):
    """The failed batch is no longer the newest when it is merged; its stream then writes it again."""
    p = pipe("demo_events")
    c = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 5), c), c.topic)
    p.run()
    p.topics.publish(encode(demo_rows(spark, 5, 5), c), c.topic)
    write = tables.append_batch

    def lost_after_writing(df, config, **how):
        write(df, config, **how)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "append_batch", lost_after_writing)
    with pytest.raises(Exception):
        p.run()
    monkeypatch.undo()
    assert p.rows("demo_events").count() == 10
    tables.backfill(spark, demo_rows(spark, 3, 20), c)
    tables.compact(spark, c)
    p.run()
    assert p.rows("demo_events").count() == 13


def test_timed_trigger_and_watch(spark, pipe, monkeypatch):
    p = pipe("demo_events")
    c = p.configs["demo_events"]
    p.topics.publish(encode(demo_rows(spark, 5), c), c.topic)
    run = start_ingest(spark, [c], p.topics, f"{p.root}/warehouse", p.checkpoint, trigger={"processingTime": "1 second"})
    run.queries[0].processAllAvailable()
    assert p.rows("demo_events").count() == 5

    def failing(*_, **__):
        raise RuntimeError("disk full")

    monkeypatch.setattr(tables, "append_batch", failing)
    p.topics.publish(encode(demo_rows(spark, 5, 5), c), c.topic)
    with pytest.raises(Exception, match="disk full"):
        run.watch()
    monkeypatch.undo()
    p.run()
    assert p.rows("demo_events").count() == 10


def test_tables_of_one_topic_share_batch_numbers(spark, pipe, sf_dir):
    p = pipe("user_events", "user_activity")
    p.topics.publish(S.shared_topic_messages(spark, sf_dir, p.configs), "user-events")
    p.run()
    numbers = [r[0] for t in p.configs for r in p.rows(t).select("_batch_id").distinct().collect()]
    assert len(numbers) == 2 and len(set(numbers)) == 1
