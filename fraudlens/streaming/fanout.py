"""One reading of the transactions for all rules.

A topic is read and decoded once. Each micro-batch is stored as decoded rows, in a folder that appears whole
or not at all. The rules that need no state run over that folder inside the micro-batch; the windowed rules
are streams that read the stored folders, with watermarks and checkpoints of their own.

A micro-batch that is run again finds its folder, and goes on with the first rule that was not done: each
rule has a file with its last micro-batch. Between a rule's write and that file lies the only
moment after which a rule writes again, so writes are to replace or skip a micro-batch they know.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from fraudlens.streaming import files

Rule = Callable[[DataFrame], DataFrame]
Write = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class FanOut:
    """``rules`` has a rule and where its rows go, by name; all is kept below ``folder``."""

    folder: str
    schema: T.StructType
    rules: Mapping[str, tuple[Rule, Write]]

    def _stored(self, batch_id: int) -> str:
        return f"{self.folder}/decoded/{batch_id:012}"

    def done(self, spark: SparkSession, rule: str) -> int:
        """The last micro-batch of a rule, -1 before the first."""
        if rule not in files.list_names(spark, f"{self.folder}/done"):
            return -1
        return int(files.read_text(spark, f"{self.folder}/done/{rule}"))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        spark = batch.sparkSession
        path = self._stored(batch_id)
        if path.rsplit("/", 1)[1] not in files.list_names(spark, f"{self.folder}/decoded"):
            hidden = f"{self.folder}/writing/{batch_id:012}"
            batch.select(*self.schema.names).write.mode("overwrite").parquet(hidden)
            files.move(spark, hidden, path)
        rows = spark.read.schema(self.schema).parquet(path)
        for name, (rule, write) in self.rules.items():
            if self.done(spark, name) < batch_id:
                write(rule(rows), batch_id)
                files.write_text(spark, f"{self.folder}/done/{name}", str(batch_id))

    def stream(self, spark: SparkSession, max_files: int | None = None) -> DataFrame:
        """The stored rows, for a rule with state."""
        reader = spark.readStream.schema(self.schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(f"{self.folder}/decoded/*")

    def forget(self, spark: SparkSession, before: int) -> None:
        """Deletes the rows of micro-batches before a number, which all streams over them must have read."""
        for name in files.list_names(spark, f"{self.folder}/decoded"):
            if int(name) < before:
                files.delete(spark, f"{self.folder}/decoded/{name}")
