"""Stream tables whose upkeep follows what changes: keyed (last row per key) and appended (by date).

Both are parts under a manifest. Where ``fanout`` parts of about one size have come together, and only
then, they become one: a row is rewritten once for each power of ``fanout`` that the table grows by,
and the number of parts grows with the logarithm of the table. A micro-batch that is run again, or that
was committed before the stream could note it, is in the table once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.operators.latest import latest_by_key
from fraudlens.streaming.manifest import KEEP, Manifest, Part, State, full_tiers

WRITER, BATCH, BUCKET = "_writer", "_batch", "_bucket"
# The number of a batch that comes before all micro-batches.
BACKFILL = -1
ROWS_PER_FILE = 4_000_000


@dataclass(frozen=True)
class TieredLog:
    """The last row per key, by ``order``; where these tie the greater ``writer``, the later micro-batch,
    then a hash of the row decides. Several streams write one log, each with its number and checkpoint.

    Parts are divided into ``buckets`` by a hash of the key, so that rows of some keys are found by reading their buckets.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    writer: int = 0
    fanout: int = 8
    buckets: int = 16
    keep: int = KEEP

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.path, self.keep)

    def _latest(self, df: DataFrame) -> DataFrame:
        own = (WRITER, BATCH, BUCKET)
        rest = [c for c in df.columns if c not in own]
        return latest_by_key(df, list(self.keys), [*[F.col(c) for c in (*self.order, WRITER, BATCH)], F.xxhash64(*rest)])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _save(self, rows: DataFrame, batch: int) -> tuple[Part, str]:
        """Writes a part; its name and rows, and the schema."""
        spark, name = rows.sparkSession, self.manifest.new_name(self.writer, batch)
        bucketed = rows.withColumn(BUCKET, self._bucket())
        bucketed.repartition(BUCKET).write.partitionBy(BUCKET).parquet(self.manifest.part_path(name))
        schema = bucketed.schema.json()
        return Part(name, self.manifest.rows(spark, schema, [name]).count()), schema

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``. The log goes with the checkpoints of its streams: begin them anew together."""
        spark, writer = batch.sparkSession, str(self.writer)
        if batch_id <= self.manifest.read(spark).batches.get(writer, BACKFILL - 1):
            return
        part, schema = self._save(self._latest(batch.withColumns({WRITER: F.lit(self.writer), BATCH: F.lit(batch_id).cast("bigint")})), batch_id)

        def added(state: State) -> State:
            parts = (*state.parts, part) if part.rows else state.parts
            return replace(state, parts=parts, batches={**state.batches, writer: batch_id}, schema=state.schema or schema, written=state.written + part.rows)

        self.manifest.commit(spark, added)
        while self._merge(spark, batch_id):
            pass
        self.manifest.clean(spark, self.writer)

    def _merge(self, spark: SparkSession, batch_id: int) -> bool:
        """Makes one part of a full tier, if there is one. If another writer has merged some of it meanwhile, the work is dropped."""
        state = self.manifest.read(spark)
        old = full_tiers(state.parts, self.fanout)
        if not old:
            return False
        part, _ = self._save(self._latest(self.manifest.frame(spark, state, old).drop(BUCKET)), batch_id)

        def merged(now: State) -> State | None:
            if not set(old) <= set(now.parts):
                return None
            return replace(now, parts=(*[p for p in now.parts if p not in old], part), rewritten=now.rewritten + part.rows)

        self.manifest.commit(spark, merged)
        return True

    def view(self, spark: SparkSession, version: State | None = None) -> DataFrame:
        """The table as the last manifest has it, or as ``version`` had it."""
        state = version or self.manifest.read(spark)
        return self._latest(self.manifest.frame(spark, state)).drop(WRITER, BATCH, BUCKET)

    def rows_of(self, spark: SparkSession, keys: Sequence[tuple]) -> DataFrame:
        """The last rows of some keys, for which only their buckets are read."""
        state = self.manifest.read(spark)
        frame = self.manifest.frame(spark, state)
        chosen = spark.createDataFrame(list(keys), frame.select(*self.keys).schema)
        buckets = [r[0] for r in chosen.select(self._bucket()).distinct().collect()]
        rows = frame.where(F.col(BUCKET).isin(buckets)).join(F.broadcast(chosen.distinct()), list(self.keys), "left_semi")
        return self._latest(rows).drop(WRITER, BATCH, BUCKET)


@dataclass(frozen=True)
class LandedTable:
    """Rows appended as they come, in parts of one date of ``time``, of which each date has few.

    A micro-batch writes at most ``files`` files per date, and the one that fills a tier of a date merges it. Rows without a time are of the date ``none``.
    With ``sorted_by``, files are sorted by a column, so that a filter on it skips most of each. With ``combine``, rows are put
    together when they are written and merged: a function of rows to fewer rows of the same columns, that of sums for instance.
    """

    path: str
    time: str
    writer: int = 0
    fanout: int = 8
    files: int = 4
    keep: int = KEEP
    sorted_by: str | None = None
    combine: Callable[[DataFrame], DataFrame] | None = None

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.path, self.keep)

    def _save(self, rows: DataFrame, batch: int, files: int) -> list[Part]:
        """Writes rows by date, a part each, of ``files`` files: names, rows and dates."""
        rows = self.combine(rows) if self.combine else rows
        spark, name = rows.sparkSession, self.manifest.new_name(self.writer, batch)
        dated = rows.withColumn("_date", F.coalesce(F.to_date(self.time).cast("string"), F.lit("none")))
        # A micro-batch is mostly of one date, which is spread over as many tasks as it gets files.
        spread = dated.repartition("_date", F.pmod(F.xxhash64(*rows.columns), F.lit(files)))
        ordered = spread.sortWithinPartitions("_date", self.sorted_by) if self.sorted_by else spread
        ordered.write.partitionBy("_date").parquet(self.manifest.part_path(name))
        counts = self.manifest.rows(spark, dated.schema.json(), [name]).groupBy("_date").count().collect()
        return [Part(f"{name}/_date={day}", n, day) for day, n in counts]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        spark, writer = batch.sparkSession, str(self.writer)
        if batch_id <= self.manifest.read(spark).batches.get(writer, BACKFILL - 1):
            return
        parts = self._save(batch, batch_id, self.files)

        def added(state: State) -> State:
            return replace(
                state, parts=(*state.parts, *parts), batches={**state.batches, writer: batch_id}, schema=state.schema or batch.schema.json(),
                written=state.written + sum(p.rows for p in parts),
            )

        self.manifest.commit(spark, added)
        while self._merge(spark, batch_id):
            pass
        self.manifest.clean(spark, self.writer)

    def _merge(self, spark: SparkSession, batch_id: int) -> bool:
        state = self.manifest.read(spark)
        old = full_tiers(state.parts, self.fanout)
        if not old:
            return False
        parts = self._save(self.manifest.frame(spark, state, old), batch_id, -(-sum(p.rows for p in old) // ROWS_PER_FILE))

        def merged(now: State) -> State | None:
            if not set(old) <= set(now.parts):
                return None
            return replace(now, parts=(*[p for p in now.parts if p not in old], *parts), rewritten=now.rewritten + sum(p.rows for p in parts))

        self.manifest.commit(spark, merged)
        return True

    def read(self, spark: SparkSession, first: date | None = None, last: date | None = None) -> DataFrame:
        """All rows, or those of the dates from ``first`` to ``last``, whose parts alone are read."""
        state = self.manifest.read(spark)
        parts = [
            p for p in state.parts
            if (first is None and last is None) or p.group != "none" and (first is None or p.group >= first.isoformat()) and (last is None or p.group <= last.isoformat())
        ]
        return self.manifest.frame(spark, state, parts)
