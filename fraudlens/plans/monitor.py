"""Monitoring queries over landed tables: series per time bucket, top lists, details, value lists.

Filters are parameters. Leaving one out selects everything, and adds no predicate to the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

SERIES_LIMIT = 100_000
PAGE_LIMIT = 1000
TOP_LIMIT = 100
VALUES_LIMIT = 100


def in_values(df: DataFrame, column: str, values: Sequence | None, excluded: Sequence | None = None) -> DataFrame:
    if values is not None:
        df = df.where(F.col(column).isin(list(values)))
    if excluded is not None:
        df = df.where(~F.col(column).isin(list(excluded)))
    return df


def in_time(df: DataFrame, time: str, first: datetime | None = None, last: datetime | None = None) -> DataFrame:
    """Rows from ``first`` to ``last``, both included; the limits have the type of the column."""
    dtype = df.schema[time].dataType
    if first is not None:
        df = df.where(F.col(time) >= F.lit(str(first)).cast(dtype))
    if last is not None:
        df = df.where(F.col(time) <= F.lit(str(last)).cast(dtype))
    return df


def in_dates(df: DataFrame, time: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Rows of the days ``first`` to ``last``; compared as times, so that the scan can skip files."""
    dtype = df.schema[time].dataType
    if first is not None:
        df = df.where(F.col(time) >= F.lit(str(first)).cast(dtype))
    if last is not None:
        df = df.where(F.col(time) < F.date_add(F.lit(str(last)), 1).cast(dtype))
    return df


def in_date_time(df: DataFrame, day: str, time: str, first: datetime | None = None, last: datetime | None = None) -> DataFrame:
    """Rows from ``first`` to ``last`` of a table with a column for the date too, whose limits skip whole partitions."""
    if first is not None:
        df = df.where(F.col(day) >= F.lit(first.date()))
    if last is not None:
        df = df.where(F.col(day) <= F.lit(last.date()))
    return in_time(df, time, first, last)


def bucket(time: str, step: str) -> Column:
    return F.window(time, step).start


def _first(df: DataFrame, order: Sequence[str], limit: int | None) -> DataFrame:
    """The first rows by ``order`` with a limit, else all rows as they come."""
    return df.orderBy(*order).limit(limit) if limit else df


def counts(df: DataFrame, time: str, series: str, step: str, limit: int | None = None) -> DataFrame:
    """Rows per bucket and series; with a limit the earliest buckets."""
    counted = df.groupBy(bucket(time, step).alias("time"), series).agg(F.count("*").alias("n"))
    return _first(counted, ["time", series], limit)


def quantiles(
    df: DataFrame, time: str, series: str, measure: str, step: str, q: float = 0.99, scale: float = 1.0, name: str = "p99",
    accuracy: int = 10_000, limit: int | None = None,
) -> DataFrame:
    """The exact quantile of the measure per bucket and series: the least value that a share ``q`` of
    the group's rows do not exceed. Groups without a value give NULL.

    A sketch per group, combined before the shuffle, gives two values between which the quantile
    lies. Rows are then counted per group and value between them, and all others as below or above,
    so that only about ``10 / accuracy`` of a group's rows meet in one task, however large it is.
    """
    timed = df.select(bucket(time, step).alias("time"), F.col(series), F.col(measure).alias("_value"))
    margin = 4 / accuracy
    ends = F.percentile_approx("_value", [max(q - margin, 0.0), min(q + margin, 1.0)], accuracy)
    around = timed.groupBy("time", F.col(series).alias("_series")).agg(ends.alias("_ends")).withColumnRenamed("time", "_time")
    same = F.col("time").eqNullSafe(F.col("_time")) & F.col(series).eqNullSafe(F.col("_series"))
    value, low, high = F.col("_value"), F.col("_ends")[0], F.col("_ends")[1]
    place = F.when(value < low, -1).when(value > high, 1).otherwise(0)
    placed = timed.join(around, same).withColumn("_place", place).withColumn("_value", F.when(F.col("_place") == 0, value))
    counted = placed.groupBy("time", series, "_place", "_value").agg(F.count(F.when(value.isNotNull() | (F.col("_place") != 0), 1)).alias("_n"))
    group = Window.partitionBy("time", series)
    running = F.sum("_n").over(group.orderBy("_place", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("_running", running).withColumn("_rank", F.ceil(F.lit(q) * F.sum("_n").over(group)))
    reached = F.when((F.col("_running") >= F.greatest("_rank", F.lit(1))) & (F.col("_place") == 0), value)
    found = ranked.groupBy("time", series).agg((F.min(reached) / scale).alias(name))
    return _first(found, ["time", series], limit)


def averages(df: DataFrame, time: str, group: str, measure: str, step: str | None = None, as_text: bool = False) -> DataFrame:
    """Mean of the measure per group and time, or per bucket of ``step``, in order of time."""
    mean = F.avg(measure)
    when = bucket(time, step) if step else F.col(time)
    return (
        df.groupBy(when.alias("time"), group)
        .agg((mean.cast("string") if as_text else mean).alias(f"avg_{measure}"))
        .orderBy("time", group)
    )


def summaries(
    df: DataFrame, ident: str, time: str, label: str, measure: str, tie: str, scale: float = 1.0, limit: int = TOP_LIMIT
) -> DataFrame:
    """Per id its first time, the label at that time and its greatest measure; the greatest first."""
    first = F.min_by(F.struct(F.col(time).alias("t"), F.col(label).alias("l")), F.struct(time, tie))
    return (
        df.groupBy(ident)
        .agg(first.alias("_first"), (F.max(measure) / scale).alias("duration"))
        .select(F.col("_first.t").alias("first_time"), ident, F.col("_first.l").alias("first_label"), "duration")
        .orderBy(F.desc("duration"), ident)
        .limit(limit)
    )


def json_tags(column: str) -> Column:
    """A JSON object as a list of maps with ``key`` and ``value``."""
    entries = F.map_entries(F.from_json(column, "map<string,string>"))
    return F.transform(entries, lambda e: F.create_map(F.lit("key"), e["key"], F.lit("value"), e["value"]))


def detail(
    df: DataFrame, spans: DataFrame, ident: str, time: str, measure: str, tie: str, chosen: Column, limit: int = PAGE_LIMIT,
    slack: str = "1 second",
) -> DataFrame:
    """Rows of one id within its span, the latest first; ``tie`` is a column that tells all rows apart.
    ``spans`` holds ``span_start`` and ``span_end`` per id; ends may be cut to the second, and ``slack`` makes up for it.

    Both limits are scalar subqueries, whose results Spark hands to the scan as plain values.
    """
    own = spans.where(F.col(ident) == chosen)
    start, end = own.select(F.min("span_start")).scalar(), own.select(F.max("span_end") + F.expr(f"INTERVAL {slack}")).scalar()
    return (
        df.where((F.col(ident) == chosen) & (F.col(time) >= start) & (F.col(time) <= end) & (F.col(measure) > 0))
        .orderBy(F.desc(time), F.desc(measure), F.desc(tie))
        .limit(limit)
    )


def page(df: DataFrame, columns: Sequence[str], order: Sequence[Column] = (), limit: int = PAGE_LIMIT) -> DataFrame:
    """Any ``limit`` rows, or the first ones by ``order``."""
    return (df.orderBy(*order) if order else df).select(*columns).limit(limit)


def values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct values; with a limit the least ones."""
    distinct = df.select(column).distinct()
    return distinct.orderBy(column).limit(limit) if limit else distinct


def status(df: DataFrame, column: str, errors: Sequence, name: str = "status_code") -> DataFrame:
    return df.withColumn(name, F.when(F.col(column).isin(list(errors)), 2).otherwise(0))


def alert_rollup(alerts: dict[str, tuple[DataFrame, str]], step: str) -> DataFrame:
    """Alerts per rule and bucket, from a table and its time column per rule."""
    parts = [df.select(F.lit(rule).alias("rule"), F.col(time).alias("at")) for rule, (df, time) in alerts.items()]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything.groupBy("rule", bucket("at", step).alias("time")).agg(F.count("*").alias("alerts"))
