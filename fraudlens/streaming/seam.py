"""A backlog as a batch, and a stream that goes on where it ends.

The batch reads up to a seam in the input that is fixed first, and gives the windows that end up to a
cut: the latest event time before the seam, less the watermark's delay, on a boundary of windows. The
stream reads from the seam on, begins with those rows of the past that windows beyond the cut
reach back to, and gives the windows beyond the cut. So every window comes from one side and
has all its rows, also where a burst lies across the seam. Rows behind the seam that belong to
windows before the cut are late, as they would be for a stream that had read the past.

The seam is kept beside the stream's checkpoint: a job that is started again keeps it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens import schemas as s
from fraudlens.functions.times import seconds
from fraudlens.operators.windows import panes_per_window
from fraudlens.streaming import files

CHANGED, FILE = "_metadata.file_modification_time", "_metadata.file_path"


@dataclass(frozen=True)
class FileSeam:
    """Files changed until ``changed`` are the past, and of those changed just then only ``ties``.

    Files must not come with a time of change that is older than that of files already there.
    """

    changed: str | None
    ties: tuple[str, ...] = ()

    def _is_past(self) -> Column:
        if self.changed is None:
            return F.lit(False)
        at = F.lit(self.changed).cast("timestamp")
        return (F.col(CHANGED) < at) | (F.col(CHANGED) == at) & F.col(FILE).isin(list(self.ties))

    def past(self, raw: DataFrame) -> DataFrame:
        """Those rows of a table read from files; whole files are left out when it is planned."""
        return raw.where(self._is_past())

    def follow(self, raw: DataFrame) -> DataFrame:
        """The other rows, of a stream that reads the same folder from its beginning."""
        return raw.where(~self._is_past())


def file_seam(spark: SparkSession, path: str, suffix: str = "*") -> FileSeam:
    """The seam behind the files that are in the folder now; their content is not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", suffix).option("recursiveFileLookup", "true").load(path)
    last = listed.agg(F.max("modificationTime").alias("at")).first()["at"]
    if last is None:
        return FileSeam(None)
    at = F.lit(last)
    ties = listed.where(F.col("modificationTime") == at).select(F.col(FILE).alias("path")).distinct().collect()
    return FileSeam(listed.select(at.cast("string")).first()[0], tuple(sorted(r["path"] for r in ties)))


def kafka_offsets(messages: DataFrame, topic: str, partitions: int | None = None) -> str:
    """The offsets behind all ``messages`` (with ``partition`` and ``offset``), as the ``endingOffsets`` of a batch and the
    ``startingOffsets`` of the stream that follows. With ``partitions``, partitions without messages are
    among them; without, each must have some."""
    found = {r["partition"]: r["next"] for r in messages.groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()}
    return json.dumps({topic: {str(p): found.get(p, 0) for p in (sorted(found) if partitions is None else range(partitions))}})


def cut_of(past: DataFrame, time: str, slide: str, delay: str = s.WATERMARK_DELAY) -> str | None:
    """The cut behind rows of the past; None if there are none."""
    step = seconds(slide)
    latest = F.unix_micros(F.max(F.col(time).cast("timestamp")))
    cut = F.floor((latest / 1_000_000 - seconds(delay)) / step) * step
    return past.agg(F.timestamp_seconds(cut).cast("string").alias("cut")).first()["cut"]


@dataclass(frozen=True)
class Cut:
    """Windows up to ``at`` and beyond it, for windows of a size and slide."""

    at: str
    size: str
    slide: str

    @property
    def _time(self) -> Column:
        return F.lit(self.at).cast("timestamp")

    def before(self, windows: DataFrame) -> DataFrame:
        return windows.where(F.col("window_end") <= self._time)

    def beyond(self, windows: DataFrame) -> DataFrame:
        return windows.where(F.col("window_end") > self._time)

    def reaching(self, past: DataFrame, time: str) -> DataFrame:
        """The rows of the past that windows beyond the cut hold."""
        panes_per_window(self.size, self.slide)
        back = seconds(self.size) - seconds(self.slide)
        return past.where(F.col(time) >= self._time - F.expr(f"INTERVAL '{back}' SECOND"))


def kept(spark: SparkSession, path: str, find: Callable[[], dict]) -> dict:
    """What ``find`` gave when it was first asked, from a file."""
    if path.rsplit("/", 1)[1] not in files.list_names(spark, path.rsplit("/", 1)[0]):
        files.create_text(spark, path, json.dumps(find()))
    return json.loads(files.read_text(spark, path))


def follow_on(
    past: DataFrame, follow: DataFrame, rule: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None], folder: str,
    time: str, size: str, slide: str, delay: str = s.WATERMARK_DELAY, backfill_id: int = -1,
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Writes the windows of the past as batch ``backfill_id``, and gives the rows the stream is to read,
    still without a watermark, and what its windows go through.

    ``past`` and ``follow`` are the two sides of a seam that was :func:`kept`. The cut, the rows that
    the stream begins with, and that the batch was written, are kept below ``folder``. ``write`` may see the batch
    again if the job ends before that is noted, and is to replace it.
    """
    spark = past.sparkSession
    told = kept(spark, f"{folder}/cut.json", lambda: {"at": cut_of(past, time, slide, delay)})
    if told["at"] is None:
        return follow, lambda windows: windows
    cut = Cut(told["at"], size, slide)
    done = files.list_names(spark, folder)
    if "first.done" not in done:
        cut.reaching(past, time).write.mode("overwrite").parquet(f"{folder}/first")
        files.write_text(spark, f"{folder}/first.done", "")
    if "batch.done" not in done:
        write(cut.before(rule(past)), backfill_id)
        files.write_text(spark, f"{folder}/batch.done", "")
    first = follow.sparkSession.readStream.schema(past.schema).parquet(f"{folder}/first")
    return first.unionByName(follow), cut.beyond


def kept_file_seam(spark: SparkSession, folder: str, path: str) -> FileSeam:
    told = kept(spark, f"{folder}/files.json", lambda: asdict(file_seam(spark, path)))
    return FileSeam(told["changed"], tuple(told["ties"]))
