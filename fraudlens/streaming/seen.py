"""Rows once, however often a stream brings them, without state in the stream.

A table holds the rows that were seen, in parts under a manifest and in buckets of a hash. Beside each part
and bucket stands a bitmap with a bit per row, 16 times as many bits as rows. A micro-batch asks the bitmaps first:
only buckets of parts that have a bit of one of its rows are read, and the rows found there are left
out by comparing all columns. So new rows are told mostly from the bitmaps, repeated ones by reading where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.streaming import files
from fraudlens.streaming.manifest import KEEP, PART, Manifest, Part, State, full_tiers

BUCKET, HASH = "_bucket", "_hash"
# Bits of a bitmap as Spark makes them, and bits for each row of a bucket.
BITS, BITS_PER_ROW = 32_768, 16


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _page() -> Column:
    return F.floor(F.col("at") / BITS).cast("bigint")


@dataclass(frozen=True)
class SeenRows:
    """The distinct rows of ``columns``, nulls being equal. One stream at a time writes a table."""

    path: str
    columns: tuple[str, ...]
    fanout: int = 8
    buckets: int = 16
    keep: int = KEEP

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.path, self.keep)

    def _pages(self, rows: int) -> int:
        """Bitmaps of a bucket of a part."""
        return max(1, -(-rows * BITS_PER_ROW // (self.buckets * BITS)))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """With the hash, which also says the bucket. Nulls are hashed with their place."""
        told = [x for c in self.columns for x in (F.col(c), F.col(c).isNull())]
        hashed = rows.select(*self.columns).withColumn(HASH, F.xxhash64(*told))
        return hashed.withColumn(BUCKET, F.pmod(HASH, F.lit(self.buckets)).cast("int"))

    def _place(self, pages: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(7), HASH), pages * F.lit(BITS).cast("bigint"))

    def _bitmaps(self, name: str) -> str:
        return f"{self.path}/bitmaps/{PART}={name}"

    def _save(self, rows: DataFrame, batch_id: int) -> tuple[Part, str]:
        spark, name = rows.sparkSession, self.manifest.new_name(0, batch_id)
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(self.manifest.part_path(name))
        schema = rows.schema.json()
        saved = self.manifest.rows(spark, schema, [name])
        part = Part(name, saved.count())
        placed = saved.withColumn("at", self._place(F.lit(self._pages(part.rows))))
        bits = placed.groupBy(BUCKET, _page().alias("page")).agg(F.bitmap_construct_agg(F.col("at") % BITS).alias("bits"))
        bits.write.parquet(self._bitmaps(name))
        return part, schema

    def _met(self, spark: SparkSession, rows: DataFrame, state: State) -> list[tuple[str, int]]:
        """Parts and buckets whose bitmaps have a bit of one of the rows."""
        parts = [p for p in state.parts if p.rows]
        if not parts:
            return []
        each = F.array(*[F.struct(F.lit(p.name).alias("part"), F.lit(self._pages(p.rows)).alias("pages")) for p in parts])
        asked = rows.select(BUCKET, HASH, F.explode(each).alias("p")).select(BUCKET, F.col("p.part").alias(PART), self._place(F.col("p.pages")).alias("at"))
        asked = asked.withColumn("page", _page()).distinct()
        reader = spark.read.option("basePath", f"{self.path}/bitmaps").schema(f"{BUCKET} int, page bigint, bits binary, {PART} string")
        bitmaps = reader.parquet(*[self._bitmaps(p.name) for p in parts])
        bit = F.col("at") % BITS
        byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        found = asked.join(bitmaps, [BUCKET, PART, "page"]).where(byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0)
        return [tuple(r) for r in found.select(PART, BUCKET).distinct().collect()]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        spark = batch.sparkSession
        state = self.manifest.read(spark)
        if batch_id <= state.batches.get("0", -1):
            return
        folder = f"{self.path}/incoming"
        self._placed(batch.select(*self.columns).distinct()).write.mode("overwrite").parquet(folder)
        rows = new = spark.read.schema(self._placed(batch).schema).parquet(folder)
        if met := self._met(spark, rows, state):
            paths = [f"{self.manifest.part_path(name)}/{BUCKET}={bucket}" for name, bucket in met]
            known = spark.read.schema(rows.drop(BUCKET).schema).parquet(*paths)
            new = rows.join(known, (rows[HASH] == known[HASH]) & _same(rows, known, list(self.columns)), "left_anti")
        part, schema = self._save(new, batch_id)

        def added(now: State) -> State:
            parts = (*now.parts, part) if part.rows else now.parts
            return replace(now, parts=parts, batches={"0": batch_id}, schema=now.schema or schema, written=now.written + part.rows)

        self.manifest.commit(spark, added)
        while self._merge(spark, batch_id):
            pass
        self._clean(spark)

    def _merge(self, spark: SparkSession, batch_id: int) -> bool:
        state = self.manifest.read(spark)
        old = full_tiers(state.parts, self.fanout)
        if not old:
            return False
        part, _ = self._save(self.manifest.frame(spark, state, old), batch_id)

        def merged(now: State) -> State:
            return replace(now, parts=(*[p for p in now.parts if p not in old], part), rewritten=now.rewritten + part.rows)

        self.manifest.commit(spark, merged)
        return True

    def _clean(self, spark: SparkSession) -> None:
        self.manifest.clean(spark, 0)
        parts = set(files.list_names(spark, f"{self.path}/parts"))
        for name in files.list_names(spark, f"{self.path}/bitmaps"):
            if name not in parts:
                files.delete(spark, f"{self.path}/bitmaps/{name}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows that were seen, once each."""
        return self.manifest.frame(spark, self.manifest.read(spark)).select(*self.columns)
