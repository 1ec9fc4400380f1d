"""Hopping event-time windows: ``[start, end)``, aligned to 1970-01-01, only where there are rows.

Two forms give the same rows.

* ``hop`` is Spark's own ``window``: each row is copied into ``size / slide`` windows. It is
  the form for streams, where Spark keeps the state per window.
* ``hop_count`` and ``hop_distinct`` are for batch. A window of ``size`` spans the panes (slices
  of one slide) of at most two neighbouring chunks, so a row is copied at most twice instead of
  5 or 6 times. Per chunk the panes are counters, or bits of a mask, that Spark combines before
  the shuffle: a key that holds a third of all rows still sends one row per chunk and task. The
  windows are formed from the panes after the shuffle, and only where the threshold is met.
  For windows of more than ``MOST_PANES`` panes, what a pane adds is a change at the first window that
  reaches it and another behind the last one; the changes are summed along the time of each key. So the
  work does not grow with the number of panes per window, but with that of windows in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fraudlens.functions.times import seconds


# Counters, or bits of a mask, that a chunk holds at most.
MOST_PANES = 63


def _chunk_windows(panes: int, windows: int | None) -> int:
    """Windows that a chunk begins: those asked for, as far as its panes fit; 0 if not even one does."""
    return max(0, min(windows or 2 * panes, MOST_PANES - panes + 1))


def _interval(slide: str, panes: int) -> str:
    return f"INTERVAL '{seconds(slide) * panes}' SECOND"


def _summed_changes(changes: DataFrame, keys: list[str], name: str, size: str, slide: str, minimum: int) -> DataFrame:
    """From changes (``window_start``, ``_change``) that end at nothing, the windows in which their sum so far is at least ``minimum``.
    A key has as many rows here as there are window starts at which something changes."""
    steps = changes.groupBy(*keys, "window_start").agg(F.sum("_change").alias("_change")).where("_change <> 0")
    along = Window.partitionBy(*keys).orderBy("window_start")
    summed = steps.select(
        *keys, "window_start", F.sum("_change").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(name),
        F.lead("window_start").over(along).alias("_next"),
    )
    starts = F.explode(F.expr(f"sequence(window_start, _next - {_interval(slide, 1)}, {_interval(slide, 1)})")).alias("window_start")
    windows = summed.where(F.col(name) >= minimum).select(*keys, starts, name)
    return windows.select(*keys, "window_start", F.expr(f"window_start + INTERVAL '{seconds(size)}' SECOND AS window_end"), name)


def _changes(panes: DataFrame, keys: list[str], amount: str, slide: str, count: int, begins: str = "true", ends: str = "true") -> DataFrame:
    """What rows of panes change: ``amount`` from the first window of ``count`` panes that reaches ``_pane``, where ``begins``,
    and its negative behind the last, where ``ends``."""
    first = f"struct(_pane - {_interval(slide, count - 1)} AS at, bigint({amount}) AS by)"
    behind = f"struct(_pane + {_interval(slide, 1)} AS at, -bigint({amount}) AS by)"
    both = f"filter(array(CASE WHEN {begins} THEN {first} END, CASE WHEN {ends} THEN {behind} END), c -> c IS NOT NULL)"
    return panes.selectExpr(*map(_quoted, keys), f"inline({both}) AS (window_start, _change)")


def panes_per_window(size: str, slide: str) -> int:
    if seconds(size) % seconds(slide):
        raise ValueError(f"window size {size} is not a multiple of its slide {slide}")
    return seconds(size) // seconds(slide)


def hop(df: DataFrame, time: str, size: str, slide: str) -> DataFrame:
    """Adds ``window_start`` and ``window_end``; one output row per row and window."""
    panes_per_window(size, slide)
    return df.withColumn("window", F.window(time, size, slide)).select(
        *df.columns, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")
    )


def _chunked(df: DataFrame, columns: list[str], time: str, slide: str, panes: int, windows: int) -> DataFrame:
    """Copies each row to the chunks whose windows reach it, with the number of its pane there.

    A chunk starts ``windows`` windows and holds ``windows + panes - 1`` panes, the last
    ``panes - 1`` of them shared with the chunks that follow.
    """
    step = seconds(slide)
    length = windows * step
    back = -(-(panes - 1) // windows)
    located = df.select(*columns, F.col(time).alias("_time"), F.window(time, f"{length} seconds").start.alias("_start"))
    copies = ", ".join(
        f"struct(_start - INTERVAL '{b * length}' SECOND AS chunk, _pane + {b * windows} AS pane)" for b in range(back + 1)
    )
    return (
        located.selectExpr(*map(_quoted, columns), "_start", f"int((_time - _start) div INTERVAL '{step}' SECOND) AS _pane")
        .selectExpr(*map(_quoted, columns), f"inline(array({copies})) AS (_chunk, _pane)")
        .where(f"_pane < {windows + panes - 1}")
    )


def _quoted(column: str) -> str:
    return f"`{column}`"


def _emit(chunks: DataFrame, keys: list[str], values: list[str], minimum: int, name: str, size: str, slide: str) -> DataFrame:
    """One row per chunk with a value per window, to one row per window that reaches ``minimum``."""
    step = seconds(slide)
    windows = ", ".join(
        f"struct(_chunk + INTERVAL '{i * step}' SECOND AS start, {value} AS n)" for i, value in enumerate(values)
    )
    # Chunks without any such window are dropped before their windows are formed.
    return (
        chunks.where(" OR ".join(f"{value} >= {minimum}" for value in values))
        .selectExpr(*map(_quoted, keys), f"inline(array({windows})) AS (window_start, _n)")
        .where(f"_n >= {minimum}")
        .selectExpr(
            *map(_quoted, keys), "window_start", f"window_start + INTERVAL '{seconds(size)}' SECOND AS window_end", f"_n AS {_quoted(name)}"
        )
    )


def hop_count(
    df: DataFrame, keys: list[str], time: str, size: str, slide: str, name: str, minimum: int = 1, windows: int | None = None
) -> DataFrame:
    """Rows per key and hopping window, where there are at least ``minimum``; ``windows`` is the length of a chunk."""
    panes = panes_per_window(size, slide)
    windows = _chunk_windows(panes, windows)
    if not windows:
        rows = df.groupBy(*keys, F.window(time, slide).start.alias("_pane")).agg(F.count("*").alias("_n"))
        return _summed_changes(_changes(rows, keys, "_n", slide, panes), keys, name, size, slide, max(minimum, 1))
    chunked = _chunked(df, keys, time, slide, panes, windows)
    counters = chunked.groupBy(*keys, "_chunk").agg(*[
        F.expr(f"count(CASE WHEN _pane = {p} THEN 1 END) AS _p{p}") for p in range(windows + panes - 1)
    ])
    totals = ["(" + " + ".join(f"_p{p}" for p in range(i, i + panes)) + ")" for i in range(windows)]
    return _emit(counters, keys, totals, max(minimum, 1), name, size, slide)


def hop_distinct(
    df: DataFrame, keys: list[str], value: str, time: str, size: str, slide: str, name: str, minimum: int = 1, windows: int | None = None
) -> DataFrame:
    """Exact number of distinct non-null ``value`` per key and hopping window, where at least ``minimum``."""
    panes = panes_per_window(size, slide)
    windows = _chunk_windows(panes, windows)
    if minimum < 1:
        raise ValueError("windows without a non-null value are not formed: minimum must be at least 1")
    known = df.where(F.col(value).isNotNull())
    if not windows:
        rows = known.select(*keys, value, F.window(time, slide).start.alias("_pane")).distinct()
        # The panes of a value that are less than a window apart are one stretch, in which it counts once.
        along = Window.partitionBy(*keys, value).orderBy("_pane")
        near = rows.withColumns({"_before": F.lag("_pane").over(along), "_after": F.lead("_pane").over(along)})
        far = _interval(slide, panes)
        changes = _changes(
            near, keys, "1", slide, panes, f"_before IS NULL OR _before + {far} < _pane", f"_after IS NULL OR _pane + {far} < _after")
        return _summed_changes(changes, keys, name, size, slide, minimum)
    chunked = _chunked(known, [*keys, value], time, slide, panes, windows)
    # One row per key, chunk and value; bit p says that the value occurs in pane p.
    masks = chunked.groupBy(*keys, "_chunk", value).agg(F.expr("bit_or(shiftleft(1L, _pane)) AS _mask"))
    window_bits = (1 << panes) - 1
    counters = masks.groupBy(*keys, "_chunk").agg(*[
        F.expr(f"count(CASE WHEN _mask & {window_bits << i}L <> 0 THEN 1 END) AS _n{i}") for i in range(windows)
    ])
    return _emit(counters, keys, [f"_n{i}" for i in range(windows)], minimum, name, size, slide)
