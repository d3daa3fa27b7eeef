"""Catalog operators at the size of a table: one config, or one field, per row of ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logweir.functions.types import ddl_type
from logweir.operators import quality, tables
from logweir.plans.registry import query
from logweir.plans.views import read
from logweir.sources.configs import CONFIG_DDL, with_defaults
from logweir.sources.topics import topic_plan, topic_types

# Columns of a catalog derived from customers, as SQL both engines read.
CATALOG = {
    "name": "CASE WHEN c_acctbal < 0 THEN c_name ELSE replace(c_name, '#', '_') END",
    "log_type": "CASE WHEN c_nationkey < 10 THEN NULL ELSE concat('lt_', c_custkey) END",
    "version": "CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 4 THEN '1.0' ELSE '2.1.0' END",
    "topic": "concat('topic-', c_nationkey)",
    "partitions": "CASE WHEN c_nationkey = 5 THEN NULL ELSE CAST(c_custkey % 7 AS INT) END",
    "replication_factor": "CASE WHEN c_nationkey = 6 THEN NULL ELSE 2 END",
    "retention_ms": "CASE WHEN c_nationkey = 7 THEN NULL ELSE c_custkey * 1000 END",
    "table_name": "CASE WHEN c_nationkey = 8 THEN NULL WHEN c_nationkey = 9 THEN concat('a.b.t', c_custkey) "
                  "ELSE concat('logs.t', c_custkey) END",
    "retention_days": "CAST(c_custkey % 5 AS INT)",
    "field_type": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'decimal' ELSE 'long' END",
}
CATALOG_SQL = "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in CATALOG.items()) + " FROM customer)"


def catalog(spark, sf) -> DataFrame:
    """A config per customer, in the shape ``load_configs`` gives."""
    rows = read(spark, sf, "customer").selectExpr(*[f"{e} AS {n}" for n, e in CATALOG.items()])
    text = F.to_json(
        F.struct(
            "name", "log_type", "version",
            F.struct("topic", "partitions", "replication_factor", "retention_ms").alias("kafka"),
            F.struct(
                "table_name", "retention_days", F.array(F.lit("day"), F.lit("region")).alias("partition_by")
            ).alias("warehouse"),
            F.array(
                F.struct(F.lit("day").alias("name"), F.lit("date").alias("type")),
                F.struct(F.lit("amount").alias("name"), F.col("field_type").alias("type")),
            ).alias("fields"),
        )
    )
    return rows.select(F.from_json(text, CONFIG_DDL).alias("c")).select("c.*")


@query("prj12_log_type_default", f"""
    SELECT name, coalesce(log_type, lower(name)) AS log_type FROM {CATALOG_SQL}""")
def _(spark, sf):
    return with_defaults(catalog(spark, sf)).select("name", "log_type")


@query("prj13_config_defaults", f"""
    SELECT name, coalesce(version, '1.0.0') AS version, coalesce(partitions, 3) AS partitions,
           coalesce(replication_factor, 1) AS replication_factor,
           CAST(coalesce(retention_ms, 604800000) AS BIGINT) AS retention_ms
    FROM {CATALOG_SQL}""")
def _(spark, sf):
    return with_defaults(catalog(spark, sf)).select(
        "name", "version", "partitions", "replication_factor", "retention_ms"
    )


@query("prj15_table_names", f"""
    SELECT name, 'own' AS names, coalesce(table_name, concat('analytics_logs.', lower(name))) AS table_name
    FROM {CATALOG_SQL}
    UNION ALL SELECT name, 'moved', concat('other.', coalesce(split_part(table_name, '.', -1), lower(name)))
    FROM {CATALOG_SQL}""")
def _(spark, sf):
    """The name a config gives its table, and the one it gets in another namespace."""
    rows = catalog(spark, sf)
    own = with_defaults(rows).select("name", F.lit("own").alias("names"), "table_name")
    moved = with_defaults(rows, namespace="other").select("name", F.lit("moved").alias("names"), "table_name")
    return own.unionAll(moved)


@query("prj2_field_types", f"""
    SELECT name, 'day' AS field, 'date' AS ddl FROM {CATALOG_SQL}
    UNION ALL SELECT name, 'amount', CASE field_type WHEN 'long' THEN 'bigint' END FROM {CATALOG_SQL}""")
def _(spark, sf):
    """Column type of every declared field; NULL where the declared type is unknown."""
    fields = catalog(spark, sf).select("name", F.explode("fields").alias("f"))
    return fields.select("name", F.col("f.name").alias("field"), ddl_type(F.col("f.type")).alias("ddl"))


@query("rte4_topic_plan", f"""
    SELECT topic, max(coalesce(partitions, 3)) AS partitions,
           max(coalesce(replication_factor, 1)) AS replication_factor,
           CAST(max(coalesce(retention_ms, 604800000)) AS BIGINT) AS retention_ms,
           count(DISTINCT coalesce(log_type, lower(name))) AS log_types
    FROM {CATALOG_SQL} GROUP BY topic""")
def _(spark, sf):
    return topic_plan(with_defaults(catalog(spark, sf)))


@query("rte4_topic_types", f"SELECT DISTINCT topic, coalesce(log_type, lower(name)) AS log_type FROM {CATALOG_SQL}")
def _(spark, sf):
    return topic_types(with_defaults(catalog(spark, sf)))


@query("chk2_config_violations", f"""
    , c AS {CATALOG_SQL}
    SELECT name, 'missing_version' AS rule, NULL AS detail FROM c WHERE version IS NULL
    UNION ALL SELECT name, 'missing_table_name', NULL FROM c WHERE table_name IS NULL
    UNION ALL SELECT name, 'bad_name', name FROM c WHERE NOT regexp_full_match(name, '[a-zA-Z][a-zA-Z0-9_]*')
    UNION ALL SELECT name, 'bad_version', version FROM c WHERE version = '1.0'
    UNION ALL SELECT name, 'partitions_below_1', CAST(partitions AS VARCHAR) FROM c WHERE partitions < 1
    UNION ALL SELECT name, 'retention_below_1', CAST(retention_days AS VARCHAR) FROM c WHERE retention_days < 1
    UNION ALL SELECT name, 'table_name_not_two_parts', table_name FROM c WHERE len(split(table_name, '.')) <> 2
    UNION ALL SELECT name, 'bad_field_type', 'amount:decimal' FROM c WHERE field_type = 'decimal'
    UNION ALL SELECT name, 'partition_by_not_a_field', 'region' FROM c""")
def _(spark, sf):
    return quality.validate_configs(catalog(spark, sf))


@query("chk3_table_name_parts", f"""
    SELECT name, table_name AS detail FROM {CATALOG_SQL} WHERE len(split(table_name, '.')) <> 2""")
def _(spark, sf):
    found = quality.validate_configs(catalog(spark, sf))
    return found.where(F.col("rule") == "table_name_not_two_parts").select("name", "detail")


# Field lists of the tables "t<nation>", before and after.
CURRENT = """SELECT concat('t', c_nationkey) AS table_name, concat('f', c_custkey) AS field,
    CASE c_custkey % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'float' WHEN 2 THEN 'string' ELSE 'bigint' END AS type
    FROM customer WHERE c_acctbal > 0"""
DESIRED = """SELECT concat('t', c_nationkey) AS table_name, concat('f', c_custkey) AS field,
    CASE WHEN c_custkey % 4 = 1 THEN 'double' ELSE 'bigint' END AS type
    FROM customer WHERE c_mktsegment <> 'BUILDING'"""


@query("tbl4_schema_diff", f"""
    SELECT coalesce(c.table_name, d.table_name) AS table_name, coalesce(c.field, d.field) AS field,
           c.type AS current, d.type AS desired,
           CASE WHEN c.type IS NULL THEN 'add' WHEN d.type IS NULL THEN 'removed' WHEN c.type = d.type THEN 'unchanged'
                WHEN c.type = 'int' AND d.type = 'bigint' OR c.type = 'float' AND d.type = 'double' THEN 'widen'
                ELSE 'keep_current' END AS action
    FROM ({CURRENT}) c FULL JOIN ({DESIRED}) d ON c.table_name = d.table_name AND c.field = d.field""")
def _(spark, sf):
    customers = read(spark, sf, "customer")
    columns = ["concat('t', c_nationkey) AS table_name", "concat('f', c_custkey) AS field"]
    current = customers.where("c_acctbal > 0").selectExpr(
        *columns, "CASE c_custkey % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'float' WHEN 2 THEN 'string' ELSE 'bigint' END AS type"
    )
    desired = customers.where("c_mktsegment <> 'BUILDING'").selectExpr(
        *columns, "CASE WHEN c_custkey % 4 = 1 THEN 'double' ELSE 'bigint' END AS type"
    )
    return tables.schema_diff(current, desired)
