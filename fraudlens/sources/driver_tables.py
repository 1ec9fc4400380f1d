"""Transactions and dictionaries derived from the test tables.

The thirty days of ``events`` are pressed into one hour, so that short windows hold several rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens import schemas as s
from fraudlens.functions.times import second_text, time_text

_BASE = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
# 720 times faster, cut to milliseconds: 0.72 s of the table are one millisecond.
_PRESSED = f"{_BASE} + ((ts - {_BASE}) div INTERVAL '0.72' SECOND) * INTERVAL '0.001' SECOND"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), int({index} + 1))"


def to_transactions(events: DataFrame) -> DataFrame:
    """The transaction columns, and ``event_id`` as the sequence in which they were written."""
    k = "int(get_json_object(props, '$.k'))"
    return events.selectExpr(
        "event_id",
        "concat('TX', event_id) AS transaction_id",
        "concat('C', user_id) AS customer_id",
        "bigint(round(value * 100000)) AS amount",
        f"{_pick(s.LOCATIONS, f'{k} % 9')} AS location",
        f"{_pick(s.MERCHANTS, 'event_id % 5')} AS merchant",
        f"{_pick(s.PAYMENT_METHODS, 'event_id % 4')} AS payment_method",
        f"concat('dev-', {k}) AS device_id",
        f"{_PRESSED} AS timestamp",
    )


def transactions(spark: SparkSession, sf_dir: str, above: int | None = None) -> DataFrame:
    """All transactions; with ``above`` at least those of a greater amount.

    The amount is computed, and a filter on it does not reach the scan: one on the stored value,
    with room for rounding, does.
    """
    events = table(spark, sf_dir, "events")
    return to_transactions(events if above is None else events.where(F.col("value") > above / 100000 - 1))


def transactions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a stream, with the event time as an instant that a watermark can follow."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return to_transactions(events).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def to_blacklist_customers(customer: DataFrame) -> DataFrame:
    return customer.where("c_acctbal < 0").selectExpr("concat('C', c_custkey) AS customer_id", "c_mktsegment AS description")


def to_blacklist_devices(part: DataFrame) -> DataFrame:
    return part.where("p_size <= 5").selectExpr("concat('dev-', p_partkey) AS device_id", "p_brand AS description")


def to_dictionary_feed(orders: DataFrame) -> DataFrame:
    """Dictionary messages as they come in, many of them repeated; ``o_orderkey`` is their sequence."""
    return orders.where("o_orderstatus = 'F'").selectExpr(
        "concat('C', o_custkey) AS customer_id", "o_orderpriority AS description", "o_orderkey"
    )


def blacklist_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_blacklist_customers(table(spark, sf_dir, "customer"))


def blacklist_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_blacklist_devices(table(spark, sf_dir, "part"))


def dictionary_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_dictionary_feed(table(spark, sf_dir, "orders"))


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def payloads(tx: DataFrame, time: Column | None = None) -> DataFrame:
    """One JSON message per transaction, in nine shapes by turns: whole, partly bad and unreadable."""
    time = F.col("timestamp") if time is None else time
    plain = [F.col(c) for c in ("customer_id", "location", "merchant", "payment_method", "device_id")]

    def record(amount: Column, when: Column, tx_id: Column = F.col("transaction_id")) -> Column:
        return F.to_json(F.struct(tx_id.alias("transaction_id"), *plain, amount.alias("amount"), when.alias("timestamp")))

    amount, text = F.col("amount"), time_text(time)
    shapes = [
        record(amount, text),
        record(amount.cast("string"), text),
        record(F.lit("abc"), F.lit("bad")),
        F.to_json(F.struct("transaction_id")),
        F.lit("not json"),
        record(amount + F.lit(0.5), text),
        record(amount, F.translate(text, " ", "T"), F.col("event_id")),
        F.lit("[1]"),
        F.lit(""),
    ]
    value = F.coalesce(*[F.when(F.col("event_id") % len(shapes) == i, shape) for i, shape in enumerate(shapes)])
    return tx.select("event_id", value.alias("value"))


def form_payloads(tx: DataFrame) -> DataFrame:
    """Well-formed messages as the entry form sends them: amounts as text, times cut to the second."""
    record = F.struct(
        "transaction_id", "customer_id", F.col("amount").cast("string").alias("amount"), "merchant", "location",
        "payment_method", "device_id", second_text(F.col("timestamp")).alias("timestamp"),
    )
    return tx.select("event_id", F.to_json(record).alias("value"))
