"""Panels over a table that grows, from sums that a stream keeps.

Per minute, series and cell of the measure there is a row with the number of events and their sum. Cells are
ranges of values, a sixteenth of a doubling wide, in the order of the values. Rows of equal minute, series and cell add up, in
whatever order they come: a late event is one more row of its minute. Counts and means read these rows only.

A quantile is exact: the cells' counts tell the cell that holds it and its rank there, and the
events of just these cells are read, from files sorted by cell. Both tables are divided by date, and panels read
the dates of their time range.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fraudlens.functions.times import seconds
from fraudlens.plans.monitor import bucket, in_time
from fraudlens.streaming.tiered import LandedTable

CELLS_PER_DOUBLING, MIDDLE, BEYOND = 16, 20_000, 1_000_000


def cell(value: Column) -> Column:
    """The number of a value's cell; greater values have no smaller one. Null for null."""
    size = F.floor(F.log2(F.abs(value)) * CELLS_PER_DOUBLING).cast("int") + MIDDLE
    infinite = F.isnan(value) | (F.abs(value) == float("inf"))
    outside = F.when(F.isnan(value) | (value > 0), BEYOND).otherwise(-BEYOND)
    return F.when(infinite, outside).when(value > 0, size).when(value < 0, -size).when(value == 0, 0)


@dataclass(frozen=True)
class Rollup:
    """Events of ``measure`` over ``time``, by ``series``, below ``folder``. A panel's buckets are whole numbers of ``step``."""

    folder: str
    series: str
    time: str
    measure: str
    step: str = "1 minute"
    fanout: int = 8
    files: int = 4

    @property
    def sums(self) -> LandedTable:
        return LandedTable(f"{self.folder}/sums", "at", fanout=self.fanout, files=self.files, combine=self._added)

    @property
    def events(self) -> LandedTable:
        return LandedTable(f"{self.folder}/events", self.time, fanout=self.fanout, files=self.files, sorted_by="_cell")

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("at", self.series, "_cell").agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("total").alias("total"))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``: events that come at any time, in any order. Each table takes a micro-batch once."""
        value = F.col(self.measure).cast("double")
        placed = batch.select(self.time, self.series, self.measure, cell(value).alias("_cell"))
        self.events.write(placed, batch_id)
        at = bucket(self.time, self.step).alias("at")
        self.sums.write(placed.select(at, self.series, "_cell", F.lit(1).cast("bigint").alias("n"), value.isNotNull().cast("bigint").alias("known"), value.alias("total")), batch_id)

    def _sums(self, spark: SparkSession, first: datetime | None, last: datetime | None) -> DataFrame:
        return in_time(self.sums.read(spark, first and first.date(), last and last.date()), "at", first, last)

    def _per(self, spark: SparkSession, step: str, first: datetime | None, last: datetime | None) -> tuple[DataFrame, Column]:
        if seconds(step) % seconds(self.step):
            raise ValueError(f"buckets of {step} are not made of {self.step}")
        return self._sums(spark, first, last), bucket("at", step).alias("time")

    def counts(self, spark: SparkSession, step: str, first: datetime | None = None, last: datetime | None = None) -> DataFrame:
        """Events per bucket and series; ``first`` and ``last`` are the first and last minutes of the range."""
        sums, time = self._per(spark, step, first, last)
        return sums.groupBy(time, self.series).agg(F.sum("n").alias("n"))

    def averages(self, spark: SparkSession, step: str, first: datetime | None = None, last: datetime | None = None) -> DataFrame:
        """Mean of the measure per bucket and series."""
        sums, time = self._per(spark, step, first, last)
        return sums.groupBy(time, self.series).agg((F.sum("total") / F.sum("known")).alias(f"avg_{self.measure}"))

    def quantiles(self, spark: SparkSession, step: str, q: float = 0.99, scale: float = 1.0, name: str = "p99", first: datetime | None = None, last: datetime | None = None) -> DataFrame:
        """The exact quantile of the measure per bucket and series: the least value that a share ``q`` of its values do not exceed."""
        sums, time = self._per(spark, step, first, last)
        cells = sums.groupBy(time, self.series, "_cell").agg(F.sum("known").alias("n"))
        group = Window.partitionBy("time", self.series)
        running = F.sum("n").over(group.orderBy(F.asc_nulls_first("_cell")).rowsBetween(Window.unboundedPreceding, 0))
        ranked = cells.withColumns({"_until": running, "_rank": F.greatest(F.ceil(F.lit(q) * F.sum("n").over(group)), F.lit(1))})
        held = ranked.where("_until >= _rank AND _until - n < _rank").select(
            F.col("time").alias("_time"), F.col(self.series).alias("_series"), F.col("_cell").alias("_held"), (F.col("_rank") - F.col("_until") + F.col("n")).alias("_within"))
        # The range of the cells that are looked for reaches the scan as plain values; most groups hold the quantile in a few cells.
        chosen = self.events.read(spark, first and first.date(), last and last.date())
        low, high = held.select(F.min("_held")).scalar(), held.select(F.max("_held")).scalar()
        until = None if last is None else datetime.fromtimestamp(last.timestamp() + seconds(self.step) - 1e-6)
        timed = in_time(chosen, self.time, first, until).where((F.col("_cell") >= low) & (F.col("_cell") <= high)).select(bucket(self.time, step).alias("time"), self.series, "_cell", F.col(self.measure).alias("_value"))
        same = F.col("time").eqNullSafe(F.col("_time")) & F.col(self.series).eqNullSafe(F.col("_series")) & (F.col("_cell") == F.col("_held"))
        counted = timed.join(held, same).groupBy("time", self.series, "_value", "_within").agg(F.count("*").alias("_n"))
        reached = F.sum("_n").over(group.orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)) >= F.col("_within")
        return counted.withColumn("_reached", reached).where("_reached").groupBy("time", self.series).agg((F.min("_value") / scale).alias(name))
