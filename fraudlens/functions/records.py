"""JSON records: lenient and strict decoding, keyed encoding, record assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fraudlens.functions.times import second_id, second_text, time_text
from fraudlens.schemas import TIME_PATTERN

_CORRUPT = "_corrupt_record"


def _value(text: Column, dtype: T.DataType, pattern: str) -> Column:
    """The text as ``dtype``, or NULL where it is none."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.TimestampType):
        return F.date_trunc("millisecond", F.try_to_timestamp(text, F.lit(pattern)))
    if isinstance(dtype, T.IntegralType):
        # A cast that fails costs ten times one that succeeds, so text without digits is not cast.
        return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast(dtype))
    raise ValueError(f"no record field is of type {dtype.simpleString()}")


def _text_schema(schema: T.StructType) -> T.StructType:
    # All fields are read as text: a typed field would turn the text "12000000" into NULL, and
    # would mark the whole record as corrupt for one bad field.
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def decode_lenient(
    df: DataFrame, schema: T.StructType, value: str = "value", carry: Sequence[str] = (), pattern: str = TIME_PATTERN
) -> DataFrame:
    """Records of ``schema`` from JSON text: bad or missing fields are NULL, unreadable records are dropped."""
    text = _text_schema(schema).add(_CORRUPT, T.StringType())
    record = F.from_json(F.col(value).cast("string"), text, {"columnNameOfCorruptRecord": _CORRUPT})
    # The record is parsed once: a filter on a plain projection would be pushed below it, and parse again.
    return (
        df.select(*carry, F.explode(F.array(record)).alias("_r"))
        .where(F.col("_r").isNotNull() & F.col(f"_r.{_CORRUPT}").isNull())
        .select(*carry, *[_value(F.col(f"_r.{f.name}"), f.dataType, pattern).alias(f.name) for f in schema])
    )


def decode_strict(
    df: DataFrame, schema: T.StructType, value: str = "value", carry: Sequence[str] = (), pattern: str = TIME_PATTERN
) -> DataFrame:
    """Records of ``schema`` from JSON text; an unreadable record or field fails the job."""
    record = F.from_json(F.col(value).cast("string"), _text_schema(schema), {"mode": "FAILFAST"})
    empty = F.col(value).isNotNull() & F.col("_r").isNull()
    parsed = df.select(*carry, value, F.explode(F.array(record)).alias("_r")).withColumn(
        "_r", F.when(empty, F.raise_error(F.lit("not a JSON record"))).otherwise(F.col("_r"))
    )

    def field(f: T.StructField) -> Column:
        text = F.col(f"_r.{f.name}")
        typed = _value(text, f.dataType, pattern)
        problem = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), text)
        return F.when(text.isNotNull() & typed.isNull(), F.raise_error(problem)).otherwise(typed).alias(f.name)

    return parsed.select(*carry, *[field(f) for f in schema])


def _as_text(df: DataFrame, name: str) -> Column:
    is_time = isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))
    return (time_text(F.col(name)) if is_time else F.col(name)).alias(name)


def encode(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Message ``value`` with all columns as JSON, and ``key`` with the key columns unless there are none."""

    def to_json(names: Sequence[str], alias: str) -> Column:
        return F.to_json(F.struct(*[_as_text(df, n) for n in names]), {"ignoreNullFields": "false"}).alias(alias)

    return df.select(*([to_json(keys, "key")] if keys else []), to_json(df.columns, "value"))


def assemble(df: DataFrame, time: str) -> DataFrame:
    """Producer records: id and time text cut to the second of ``time``, the amount as text."""
    return df.select(
        second_id(F.col(time)).alias("transaction_id"),
        "customer_id",
        F.col("amount").cast("string").alias("amount"),
        "merchant", "location", "payment_method", "device_id",
        second_text(F.col(time)).alias("timestamp"),
    )


def with_event_time(df: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Event time computed from a text column; NULL where the text does not follow ``pattern``."""
    return df.withColumn(name, F.try_to_timestamp(F.col(text), F.lit(pattern)))
