"""Session settings, shared folders and temporary views."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Event times carry no zone, so sessions run in UTC. Join and window state without a bound
# belongs on disk; its changes are uploaded per micro-batch, and snapshots in the background.
# The Bloom filter lets a large dictionary thin out the transactions before they are shuffled.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


# What a shuffle partition should hold at most when a batch reads all its input.
PARTITION_BYTES = 128 << 20


def _apply_settings(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """What was given to spark-submit or to the builder stays."""
    given = dict(spark.sparkContext.getConf().getAll())
    # Adaptive execution joins small partitions, but never makes more of them than it began with.
    partitions = max(4 * spark.sparkContext.defaultParallelism, -(-input_bytes // PARTITION_BYTES))
    begin = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)}
    for key, value in {**SETTINGS, **begin}.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def create_session(name: str = "fraudlens", input_bytes: int = 0, **settings: str) -> SparkSession:
    """``input_bytes`` is the size of what batches read; the cores present at the start say little about it
    where executors come and go."""
    builder = SparkSession.builder.appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return _apply_settings(builder.getOrCreate(), input_bytes)


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application for streams; the settings of ``spark`` stay as they are.

    The number of state partitions is fixed by a stream's first run: the one asked for, or the
    one the application was started with, or else one per core of the cluster.
    """
    session = _apply_settings(spark.newSession())
    default = spark.sparkContext.getConf().get("spark.sql.shuffle.partitions") or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or default))
    return session


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in {"UTC", "Etc/UTC", "Z", "+00:00"}:
        raise ValueError(f"event times have no zone and are read as UTC, but the session zone is {zone}")


def require_least_watermark(spark: SparkSession) -> None:
    policy = spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min")
    if policy != "min":
        raise ValueError(f"lanes need the least of their watermarks, but spark.sql.streaming.multipleWatermarkPolicy is {policy}")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares; below a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def register_if_absent(df: DataFrame, name: str) -> bool:
    """Registers ``df`` as a temporary view unless the name is taken; says whether it did."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.createTempView(name)
    return True


def drop_if_present(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)
