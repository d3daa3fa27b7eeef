"""Field types a log config may declare, and the Spark schemas built from them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The closed set of config field types.
FIELD_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<int>": T.ArrayType(T.IntegerType()),
    "array<long>": T.ArrayType(T.LongType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}

# Type changes a table accepts without rewriting its files.
WIDENINGS = [("int", "bigint"), ("float", "double")]


def spark_type(name: str) -> T.DataType:
    try:
        return FIELD_TYPES[name]
    except KeyError:
        raise ValueError(f"unsupported field type: {name}") from None


def record_schema(fields) -> T.StructType:
    """Business columns of a log type; nullable exactly where the field is optional."""
    return T.StructType(
        [T.StructField(f.name, spark_type(f.type), nullable=not f.required) for f in fields]
    )


def ddl_type(config_type: Column) -> Column:
    """DDL text of a config type held in a column; an unknown type gives NULL."""
    pairs = [F.lit(x) for name, t in FIELD_TYPES.items() for x in (name, t.simpleString())]
    return F.try_element_at(F.create_map(*pairs), config_type)


def table_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def widens(current: Column, desired: Column) -> Column:
    rules = [(current == a) & (desired == b) for a, b in WIDENINGS]
    return rules[0] | rules[1]
