"""Message encoding, decoding and classification, all as Column expressions.

A message is ``{"_log_type", "_log_class", "_version", "data": {business fields}}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from logweir.functions.types import record_schema, spark_type

CORRUPT = "_corrupt_record"
META = ["_log_type", "_log_class", "_version"]

# Why a message is not accepted, in the order the rules are tried.
REASONS = [
    "null_payload",
    "malformed",
    "no_envelope",
    "unknown_type",
    "bad_type",
    "missing_required",
]

# Microseconds must survive the trip; to_json's own format stops at milliseconds.
JSON_OUT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Why a message is not accepted, in the order the reasons are tried.
REASONS = ("null_payload", "malformed", "no_envelope", "unknown_type", "bad_type", "missing_required")
JSON_IN = {"columnNameOfCorruptRecord": CORRUPT}

# The envelope alone.  `data` keeps one unused child, so the parser skips the business fields
# but still tells an object from anything else.
_PROBE = T.StructType(
    [T.StructField(n, T.StringType()) for n in META]
    + [
        T.StructField("data", T.StructType([T.StructField("_", T.StringType())])),
        T.StructField(CORRUPT, T.StringType()),
    ]
)


def envelope_schema(config) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.StringType(), False) for n in META]
        + [
            T.StructField("data", record_schema(config.fields), False),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )


def encode(df: DataFrame, config, keep_nulls: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a log type -> ``(key, value)`` messages.  Map-side only, no shuffle.

    Values are cast to the declared types first; a declared column the rows lack is NULL.
    NULL fields are left out unless ``keep_nulls``, which writes them as JSON null.
    """
    have = set(df.columns)

    def value_of(name: str) -> Column:
        return F.col(f"`{name}`") if name in have else F.lit(None)

    data = [value_of(f.name).cast(spark_type(f.type)).alias(f.name) for f in config.fields]
    message = F.struct(
        F.lit(config.log_type).alias("_log_type"),
        F.lit(config.name).alias("_log_class"),
        F.lit(config.version).alias("_version"),
        F.struct(*data).alias("data"),
    )
    options = {**JSON_OUT, "ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(
        value_of(config.key_field).cast("string").alias("key"),
        F.to_json(message, options).alias("value"),
        *keep,
    )


def _default(field) -> Column:
    target = spark_type(field.type)
    if isinstance(target, (T.ArrayType, T.MapType)):
        return F.from_json(F.lit(field.default), target)
    return F.lit(field.default).cast(target)


def _business(data: Column, config) -> list[Column]:
    """Business columns of a decoded ``data`` struct, with declared defaults filled in."""
    out = []
    for f in config.fields:
        value = data.getField(f.name)
        if f.default is not None:
            value = F.coalesce(value, _default(f))
        out.append(value.alias(f.name))
    return out


def decode(raw: DataFrame, config, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode every message with one config's schema, whatever its type says.

    What does not fit becomes NULL: extra keys vanish, absent keys, wrong types, broken JSON
    and missing envelopes read as NULL.  No row is lost.
    """
    env = F.from_json(F.col("value").cast("string"), envelope_schema(config), JSON_IN)
    parsed = raw.select(env.alias("_env"), *keep)
    return parsed.select(*_business(F.col("_env.data"), config), *keep)


def record_column(config) -> str:
    return f"_rec_{config.log_type}"


def classify(raw: DataFrame, configs) -> DataFrame:
    """Decode a topic that carries the types of ``configs`` in one pass over its messages.

    Adds the envelope columns, ``_reason`` (NULL when the message is good) and one struct
    column per type, filled only for messages of that type.  Each message is parsed twice: once
    for the envelope, once with the schema of its own type.

    The parsed values pass through ``inline``: a filter on them is not moved below it, where
    the optimizer would parse the message again for every place the filter mentions.
    """
    probed = raw.withColumn("value", F.col("value").cast("string")).withColumn(
        "_env", F.from_json("value", _PROBE, JSON_IN)
    )
    has_data = F.col("_env.data").isNotNull()
    parsed = [
        F.when(
            (F.col("_env._log_type") == c.log_type) & has_data,
            F.from_json("value", envelope_schema(c), JSON_IN),
        ).alias(record_column(c))
        for c in configs
    ]
    once = F.struct(
        *[F.col(f"_env.{m}").alias(m) for m in META],
        F.col("_env").isNull().alias("_no_payload"),
        has_data.alias("_has_data"),
        F.col(f"_env.{CORRUPT}").isNotNull().alias("_broken"),
        *parsed,
    )
    decoded = probed.select(*raw.columns, F.inline(F.array(once)))

    wrong_type = F.lit(False)
    incomplete = F.lit(False)
    for c in configs:
        rec = F.col(f"`{record_column(c)}`")
        wrong_type |= rec.getField(CORRUPT).isNotNull()
        for f in c.fields:
            if f.required and f.default is None:
                incomplete |= rec.isNotNull() & rec.getField("data").getField(f.name).isNull()
    log_type, has_data = F.col("_log_type"), F.col("_has_data")
    not_json = (log_type.isNull() & ~has_data) | F.try_parse_json("value").isNull()
    reason = (
        F.when(F.col("_no_payload"), "null_payload")
        .when(F.col("_broken") & not_json, "malformed")
        .when(log_type.isNull() | ~has_data, "no_envelope")
        .when(~log_type.isin([c.log_type for c in configs]), "unknown_type")
        .when(wrong_type, "bad_type")
        .when(incomplete, "missing_required")
    )
    return decoded.select(
        *raw.columns,
        *META,
        *[F.col(f"`{record_column(c)}`.data").alias(record_column(c)) for c in configs],
        reason.alias("_reason"),
    )


def records(classified: DataFrame, config, keep: tuple[str, ...] = ()) -> DataFrame:
    """Good messages of one type, flattened to its business columns."""
    mine = classified.where((F.col("_log_type") == config.log_type) & F.col("_reason").isNull())
    return mine.select(*_business(F.col(f"`{record_column(config)}`"), config), *keep)


def null_rows(classified: DataFrame, config, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages that are not good, as rows of the type: what decodes, and NULL elsewhere.

    Takes the type's own messages and those that belong to no known type.
    """
    own = F.col("_log_type") == config.log_type
    stray = F.col("_log_type").isNull() | (F.col("_reason") == "unknown_type")
    bad = classified.where(F.col("_reason").isNotNull() & (own | stray))
    return bad.select(*_business(F.col(f"`{record_column(config)}`"), config), *keep)


def rejects(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages not accepted, whole, with the reason."""
    return classified.where(F.col("_reason").isNotNull()).select(
        "key", "value", "_log_type", "_version", F.col("_reason").alias("reason"), *keep
    )


def with_ingestion_time(df: DataFrame) -> DataFrame:
    """Ingestion columns; in a stream both are fixed per micro-batch and survive a replay."""
    return df.withColumn("_ingestion_timestamp", F.current_timestamp()).withColumn(
        "_ingestion_date", F.current_date()
    )


def normalise_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp-like column as ``timestamp``: a no-op on columns that already are."""
    kinds = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        [F.to_timestamp(f"`{s.name}`").cast("timestamp").alias(s.name)
         if isinstance(s.dataType, kinds) else F.col(f"`{s.name}`") for s in df.schema]
    )
