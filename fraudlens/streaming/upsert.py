"""Tables keyed by a primary key, fed by streams.

``UpsertLog`` is an append log and a view of the last row per key. A micro-batch that is run again
replaces its own part of the log, so nothing is written twice. ``RelationalTable`` upserts into a
database through a staging table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.operators.latest import latest_by_key


@dataclass(frozen=True)
class UpsertLog:
    """``order`` names the columns that say which row of a key was written last. Where they tie, the
    greater ``writer``, then the later micro-batch, then a hash of the row decides, so that the last row is defined.

    With ``compact_every``, the parts of that many micro-batches become one as the stream goes on, so
    that the log has the size of its table and of the latest batches.

    Several streams can write one log: each with a ``writer`` number and a checkpoint of its own.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    writer: int = 0
    compact_every: int | None = None

    @property
    def _own(self) -> str:
        return f"{self.path}/writer={self.writer}"

    def _latest(self, df: DataFrame, *ties: str) -> DataFrame:
        rest = [f.name for f in df.schema if f.name not in ties]
        return latest_by_key(df, list(self.keys), [*[F.col(c) for c in (*self.order, *ties)], F.xxhash64(*rest)])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``. A batch that is run again replaces its own part, also by no rows. The
        log goes with the checkpoint of the stream: begin both anew together."""
        self._latest(batch).write.mode("overwrite").parquet(f"{self._own}/batch={batch_id}")
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact_in_place(batch.sparkSession)

    def compact_in_place(self, spark: SparkSession) -> None:
        """Makes one part of all parts of this writer but the latest, which the stream may run again.

        The new part stands before all micro-batches, and the old ones go after it is whole: whatever
        remains after a failure gives the same view. A view that has listed the old parts already
        fails on reading them, and is to be asked again.
        """
        folder = spark._jvm.org.apache.hadoop.fs.Path(self._own)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        batches = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
        old = batches[:-1]
        if len(old) < 2:
            return
        paths = [f"{self._own}/batch={b}" for b in old]
        parts = spark.read.option("basePath", self._own).parquet(*paths)
        self._latest(parts, "batch").drop("batch").write.mode("error").parquet(f"{self._own}/batch={min(*old, 0) - 1}")
        for path in paths:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def view(self, spark: SparkSession) -> DataFrame:
        return self._latest(spark.read.parquet(self.path), "writer", "batch").drop("batch", "writer")

    def compact(self, spark: SparkSession, target: str) -> UpsertLog:
        """The log reduced to the last row per key, in a new folder, as a batch before all others."""
        last = self._latest(spark.read.parquet(self.path), "writer", "batch").drop("batch", "writer")
        last.write.mode("error").parquet(f"{target}/writer={self.writer}/batch=-1")
        return UpsertLog(target, self.keys, self.order, self.writer, self.compact_every)


def merge_sql(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Statement that moves a staging table into a PostgreSQL table by primary key."""

    def quoted(names: Sequence[str]) -> str:
        return ", ".join(f'"{n}"' for n in names)

    rest = [c for c in columns if c not in keys]
    updates = ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in rest)
    action = f"DO UPDATE SET {updates}" if rest else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({quoted(columns)}) SELECT {quoted(columns)} FROM {staging} "
        f"ON CONFLICT ({quoted(keys)}) {action}"
    )


@dataclass(frozen=True)
class Database:
    """A database reached by JDBC: ``stage`` overwrites a table with rows, ``execute`` runs a statement there."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    driver: str = "org.postgresql.Driver"
    connections: int = 16

    def stage(self, rows: DataFrame, table: str) -> None:
        options = {**self.properties, "url": self.url, "driver": self.driver, "dbtable": table}
        writer = rows.write.format("jdbc").options(truncate="true", numPartitions=str(self.connections), **options)
        writer.mode("overwrite").save()

    def execute(self, spark: SparkSession, statement: str) -> None:
        jvm = spark._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        connection = reduce(getattr, self.driver.split("."), jvm)().connect(self.url, properties)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()


@dataclass(frozen=True)
class RelationalTable:
    """A table of ``database`` keyed by ``keys``; of several rows of a key the last by ``order`` counts,
    and where these tie, that of the greatest hash."""

    database: Database
    table: str
    columns: Sequence[str]
    keys: Sequence[str]
    order: Sequence[str]

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``; running a batch again gives the same table."""
        order = [*[F.col(c) for c in self.order], F.xxhash64(*self.columns)]
        self.database.stage(latest_by_key(batch, list(self.keys), order).select(*self.columns), self.staging)
        self.database.execute(batch.sparkSession, merge_sql(self.table, self.staging, self.columns, self.keys))
