"""Exact distinct counts per key and hopping window on streams, where Spark has no COUNT(DISTINCT).

``hop_distinct_stream`` counts inside the stream. ``hop_values`` and ``count_values`` do so in two steps:
the stream keeps a state row per key, window and value, and gives all of a window in the micro-batch that
closes it; that micro-batch's ``foreachBatch`` counts them. So one stateful operator is enough for values
spread over all partitions, and rows behind the watermark can be dropped at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fraudlens.operators.windows import panes_per_window

ALLOW_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"


def hop_distinct_stream(
    df: DataFrame, keys: list[str], value: str, time: str, size: str, slide: str, name: str, strategy: str
) -> DataFrame:
    """Strategy ``set`` keeps the values of a window in one state row: for values of a bounded number.
    Strategy ``two_stage`` spreads them over the state partitions: for keys that many values share.

    Spark accepts rows up to one micro-batch later than the watermark says. Switching off
    ``allowMultiple`` drops them at once, but then a chain of two stages silently yields nothing,
    so that pairing is refused; ``hop_values`` has both.
    """
    panes_per_window(size, slide)
    window = F.window(time, size, slide).alias("window")
    if strategy == "set":
        counted = df.groupBy(*keys, window).agg(F.size(F.collect_set(value)).cast("long").alias(name))
    elif strategy == "two_stage":
        if df.sparkSession.conf.get(ALLOW_MULTIPLE, "true").lower() == "false":
            raise ValueError(f"strategy two_stage needs {ALLOW_MULTIPLE}=true; strict lateness needs strategy set")
        counted = df.groupBy(*keys, window, value).count().groupBy(*keys, "window").agg(F.count(value).alias(name))
    else:
        raise ValueError(f"strategy must be set or two_stage, not {strategy}")
    return counted.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), name)


def hop_values(df: DataFrame, keys: list[str], value: str, time: str, size: str, slide: str) -> DataFrame:
    """Each value of each key and window, null among them, once. A stream with a watermark gives a window's values together."""
    panes_per_window(size, slide)
    window = F.window(time, size, slide).alias("window")
    # Null values are left to the count: a filter here would be moved below the watermark, which follows all rows.
    each = df.groupBy(*keys, window, value).agg(F.count("*"))
    return each.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), value)


def count_values(values: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Distinct non-null values per key and window, of rows of :func:`hop_values` that have their windows whole."""
    return values.groupBy(*keys, "window_start", "window_end").agg(F.count(value).alias(name))
