"""Message sources: rows with a ``value`` column of JSON text, from a Kafka topic or JSON-line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fraudlens import schemas as s
from fraudlens.functions.records import decode_lenient, decode_strict

# The topics of the relations; earlier dictionary topics lack the suffix.
TOPICS = {
    "transactions": "transactions-stream",
    "blacklist_customers": "blacklist_customers_list",
    "blacklist_devices": "blacklist_devices_list",
    "big_amount": "big_amount",
    "blacklist": "blacklist",
    "velocity_alerts": "velocity_alerts",
    "geolocation_alerts": "geolocation_alerts",
    "device_alerts": "device_alerts",
    "velocity_fraud": "velocity_fraud",
}
SCHEMAS = {
    "transactions": s.TRANSACTIONS,
    "blacklist_customers": s.BLACKLIST_CUSTOMERS,
    "blacklist_devices": s.BLACKLIST_DEVICES,
    "big_amount": s.TRANSACTIONS,
    "blacklist": s.BLACKLIST,
    "velocity_alerts": s.VELOCITY_ALERTS,
    "geolocation_alerts": s.GEOLOCATION_ALERTS,
    "device_alerts": s.DEVICE_ALERTS,
    "velocity_fraud": s.VELOCITY_FRAUD,
}


def kafka_read_options(
    servers: str, topic: str, group: str | None = None, starting: str = "earliest", max_offsets: int | None = None
) -> dict[str, str]:
    """``starting`` counts for the first run only: later ones go on from the checkpoint."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def from_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Messages with their place in the topic, which orders the rows of one key."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load().select(
        F.col("value").cast("string").alias("value"), "partition", "offset", F.col("timestamp").alias("arrival")
    )


def from_files(spark: SparkSession, path: str, streaming: bool = True, max_files: int | None = None) -> DataFrame:
    """One JSON record per line."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(T.StructType([T.StructField("value", T.StringType())])).text(path)


def decoded(messages: DataFrame, relation: str, strict: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """The messages as rows of a known relation."""
    decode = decode_strict if strict else decode_lenient
    return decode(messages, SCHEMAS[relation], carry=carry)
