"""Sinks: keyed messages, date-partitioned landing tables, the console."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from fraudlens.functions.records import encode
from fraudlens.schemas import OUTPUT_KEYS


def kafka_write_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def messages(df: DataFrame, relation: str) -> DataFrame:
    """The rows of a relation as messages, with its record key unless it has none."""
    return encode(df, OUTPUT_KEYS[relation])


def to_kafka(df: DataFrame, relation: str, servers: str, topic: str | None = None) -> DataStreamWriter:
    return messages(df, relation).writeStream.format("kafka").options(**kafka_write_options(servers, topic or relation))


def batch_to_kafka(df: DataFrame, relation: str, servers: str, topic: str | None = None) -> None:
    """Writes a micro-batch; one that is run again writes its messages again."""
    messages(df, relation).write.format("kafka").options(**kafka_write_options(servers, topic or relation)).save()


def with_date(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn("date", F.to_date(time))


def land(df: DataFrame, path: str, time: str, mode: str = "append", files: int | None = None) -> DataStreamWriter | None:
    """Appends to a Parquet table partitioned by the date of ``time``.

    A batch is written at once. For a stream the writer is returned, to be started with a checkpoint;
    its micro-batches add a file per task and date, or with ``files`` at most that many per date, for a shuffle.
    """
    dated = with_date(df, time)
    if df.isStreaming:
        if files:
            dated = dated.repartition("date", F.pmod(F.xxhash64(*df.columns), F.lit(files)))
        return dated.writeStream.format("parquet").partitionBy("date").option("path", path).outputMode("append")
    # Rows of one date are brought together, or else every task adds a file per date it holds;
    # adaptive execution splits busy dates over several tasks and joins quiet ones.
    dated.hint("rebalance", "date").write.mode(mode).partitionBy("date").parquet(path)
    return None


def landed(spark: SparkSession, path: str, time: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A landing table, read from the dates ``first`` to ``last`` only."""
    df = spark.read.parquet(path)
    if first:
        df = df.where(F.col("date") >= F.lit(first).cast("date"))
    if last:
        df = df.where(F.col("date") <= F.lit(last).cast("date"))
    return df.drop("date")


def to_console(df: DataFrame) -> DataStreamWriter:
    return df.writeStream.format("console").option("truncate", False).outputMode("append")
