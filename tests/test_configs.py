import json

import pytest

from logweir.functions.types import FIELD_TYPES, ddl_type, record_schema, spark_type
from logweir.operators.quality import shared_tables, validate_configs
from logweir.plans import log_types
from logweir.sources.configs import collect_configs, enabled_configs, load_configs, unreadable_configs, with_defaults
from logweir.sources.topics import topic_plan, topic_types
from pyspark.sql import functions as F


def write(folder, name, doc):
    (folder / name).write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=2))


def test_folder_and_single_file(spark, tmp_path):
    write(tmp_path, "a.json", log_types.document("user_events"))
    write(tmp_path, "b.json", log_types.document("api_metrics"))
    write(tmp_path, "c.json.disabled", log_types.document("user_activity"))
    found = load_configs(spark, str(tmp_path))
    assert sorted(r.name for r in found.collect()) == ["ApiMetrics", "UserEvents"]
    assert [r.name for r in load_configs(spark, str(tmp_path / "b.json")).collect()] == ["ApiMetrics"]


def test_unreadable_file_aborts_or_is_skipped(spark, tmp_path):
    write(tmp_path, "a.json", log_types.document("user_events"))
    write(tmp_path, "b.json", '{"name": "Broken", ')
    with pytest.raises(Exception):
        load_configs(spark, str(tmp_path)).collect()
    assert [r.name for r in load_configs(spark, str(tmp_path), on_error="skip").collect()] == ["UserEvents"]
    assert [r.file for r in unreadable_configs(spark, str(tmp_path)).collect()] == ["b.json"]


def test_switched_off_types(spark, tmp_path):
    write(tmp_path, "a.json", log_types.document("user_events", iceberg={"enabled": False}))
    write(tmp_path, "b.json", log_types.document("api_metrics", iceberg={}))
    write(tmp_path, "c.json", log_types.document("user_activity"))
    names = [r.name for r in enabled_configs(load_configs(spark, str(tmp_path))).collect()]
    assert sorted(names) == ["ApiMetrics", "UserActivity"]


def test_defaults_and_names(spark, tmp_path):
    doc = log_types.document("demo_events")
    del doc["log_type"], doc["version"]
    doc["warehouse"] = {"table_name": None}
    write(tmp_path, "a.json", doc)
    rows = load_configs(spark, str(tmp_path))
    (own,), (moved,) = collect_configs(rows), collect_configs(rows, namespace="db")
    assert (own.log_type, own.version, own.table) == ("demoevents", "1.0.0", "analytics_logs.demoevents")
    assert moved.table == "db.demoevents"
    row = with_defaults(rows).first()
    assert (row.partitions, row.replication_factor, row.retention_ms) == (3, 1, 604800000)


def test_key_field(config):
    assert config("user_events", "d").key_field == "user_id"
    assert config("database_metrics", "d").key_field == "timestamp"


VIOLATIONS = [
    ({"version": None}, "missing_version"),
    ({"version": "1.0"}, "bad_version"),
    ({"name": "9bad"}, "bad_name"),
    ({"fields": [{"name": "bad-name", "type": "string"}]}, "bad_field_name"),
    ({"fields": [{"name": "x", "type": "decimal"}]}, "bad_field_type"),
    ({"fields": []}, "no_fields"),
    ({"kafka": {"topic": "t", "partitions": 0}}, "partitions_below_1"),
    ({"kafka": {"topic": "t", "replication_factor": 0}}, "replication_below_1"),
    ({"kafka": {"partitions": 1}}, "missing_topic"),
    ({"kafka": None}, "missing_kafka"),
    ({"warehouse": {"table_name": "a.b", "retention_days": 0}}, "retention_below_1"),
    ({"warehouse": {"table_name": "a.b.c"}}, "table_name_not_two_parts"),
    ({"warehouse": {"tableName": "a.b"}}, "missing_table_name"),
    ({"warehouse": {"table_name": "a.b", "partition_by": ["log_date"]}}, "partition_by_not_a_field"),
    ({"warehouse": {"table_name": "a.b", "sort_by": ["nothing"]}}, "sort_by_not_a_field"),
]


@pytest.mark.parametrize("change, rule", VIOLATIONS, ids=[r for _, r in VIOLATIONS])
def test_each_violation_is_found_alone(spark, tmp_path, change, rule):
    doc = log_types.document("demo_events")
    doc["warehouse"] = {"table_name": "logs.demo", "partition_by": []}
    write(tmp_path, "a.json", {**doc, **change})
    found = validate_configs(load_configs(spark, str(tmp_path))).collect()
    assert [r["rule"] for r in found] == [rule]


def test_known_types_are_valid(spark, tmp_path):
    docs = [log_types.document(t) for t in log_types.LOG_TYPES]
    found = load_configs(spark, log_types.write_configs(spark, docs, str(tmp_path / "c")))
    assert found.count() == len(docs)
    assert validate_configs(found).count() == 0


def test_topic_plan_takes_the_largest_wish(spark, tmp_path):
    docs = [log_types.document(t) for t in ("user_events", "user_activity", "api_metrics")]
    rows = load_configs(spark, log_types.write_configs(spark, docs, str(tmp_path / "c")))
    plan = {r.topic: r for r in topic_plan(with_defaults(rows)).collect()}
    shared = plan["user-events"]
    assert (shared.partitions, shared.replication_factor, shared.retention_ms) == (6, 3, 2592000000)
    assert shared.log_types == 2 and topic_types(with_defaults(rows)).count() == 3
    assert plan["api-metrics"].partitions == 4


def test_two_types_on_one_table(spark, tmp_path):
    a = log_types.document("user_events")
    b = {**log_types.document("user_activity"), "warehouse": a["warehouse"]}
    rows = load_configs(spark, log_types.write_configs(spark, [a, b], str(tmp_path / "c")))
    (clash,) = shared_tables(with_defaults(rows)).collect()
    assert clash.log_types == 2


def test_types_and_ddl(spark, config):
    schema = record_schema(config("all_types", "d").fields)
    assert schema["c_map"].dataType.simpleString() == "map<string,string>"
    assert not schema["c_int"].nullable and record_schema(config("user_events", "d").fields)["page_url"].nullable
    with pytest.raises(ValueError):
        spark_type("decimal")
    names = spark.createDataFrame([(n,) for n in [*FIELD_TYPES, "decimal"]], "t string")
    got = {r.t: r.ddl for r in names.select("t", ddl_type(F.col("t")).alias("ddl")).collect()}
    assert got["long"] == "bigint" and got["array<long>"] == "array<bigint>" and got["decimal"] is None
