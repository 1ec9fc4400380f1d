"""Sources in partitions that are each in event order, though they differ among each other.

Spark's watermark follows the latest event time of a stream, so that a partition that is read ahead
makes the rows of the others late. Here every partition is a stream with a watermark of its own, a
lane; their union follows the least of them (``spark.sql.streaming.multipleWatermarkPolicy``), and
how far each micro-batch reads changes nothing.

A lane that has delivered nothing since the start of the job holds all windows back. With
``Heartbeats`` a silent lane counts, after a stated time, as being where the latest row of all is;
what it brings later can then be too late. A heartbeat is a line in a file that the lane reads
beside its messages, and is left out behind its watermark.

Every lane is read by each micro-batch: this is for tens of partitions, as a topic of such
transactions has, not for thousands.
"""

from __future__ import annotations

import json
import re
import time as clock
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fraudlens import schemas as s
from fraudlens.session import require_least_watermark
from fraudlens.sources.messages import from_files, from_kafka, kafka_read_options
from fraudlens.streaming.files import list_names, write_text

HEARTBEAT = "_heartbeat"
ANY_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"


def file_lanes(spark: SparkSession, path: str, max_files: int | None = None) -> list[DataFrame]:
    """The subfolders ``partition=...`` of JSON lines, as they are now; the same ones at every start of a job."""
    names = sorted(n for n in list_names(spark, path) if n.startswith("partition="))
    if not names:
        raise ValueError(f"{path} has no folders partition=...")
    return [from_files(spark, f"{path}/{n}", max_files=max_files) for n in names]


def kafka_lanes(spark: SparkSession, servers: str, topic: str, partitions: int, group: str | None = None, max_offsets: int | None = None) -> list[DataFrame]:
    """A stream for each partition of the topic; ``max_offsets`` is shared among them."""
    options = kafka_read_options(servers, topic, group, max_offsets=max_offsets and -(-max_offsets // partitions))
    del options["subscribe"]
    return [from_kafka(spark, {**options, "assign": json.dumps({topic: [p]})}) for p in range(partitions)]


def timed(lanes: Sequence[DataFrame], time: str = "timestamp", delay: str = s.WATERMARK_DELAY, heartbeats: Heartbeats | None = None) -> DataFrame:
    """The union of the lanes with the least of their watermarks."""
    require_least_watermark(lanes[0].sparkSession)
    each = [lane.withWatermark(time, delay) if heartbeats is None else heartbeats.beside(i, lane, time, delay) for i, lane in enumerate(lanes)]
    return reduce(DataFrame.unionByName, each)


@dataclass(frozen=True)
class Heartbeats:
    """Files ``lane=<number>/<name>`` of a line of event time, below ``folder``, which belongs to the job's checkpoint."""

    folder: str

    def lane(self, number: int) -> str:
        return f"{self.folder}/lane={number}"

    def open(self, spark: SparkSession, lanes: int) -> None:
        """Folders that the lanes can read, before there is any heartbeat."""
        for number in range(lanes):
            write_text(spark, f"{self.lane(number)}/_begin", "")

    def send(self, spark: SparkSession, number: int, time: str) -> None:
        write_text(spark, f"{self.lane(number)}/{uuid.uuid4().hex}.txt", f"{time}\n")

    def beside(self, number: int, lane: DataFrame, time: str, delay: str) -> DataFrame:
        lines = from_files(lane.sparkSession, self.lane(number))
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in lane.schema if f.name != time]
        beats = lines.select(F.try_to_timestamp("value", F.lit(ANY_TIME)).alias(time), *others).withColumn(HEARTBEAT, F.lit(True))
        both = lane.withColumn(HEARTBEAT, F.lit(False)).unionByName(beats).withWatermark(time, delay)
        # With the event time in it, the filter stays behind the watermark.
        return both.where(~F.col(HEARTBEAT) | F.col(time).isNull()).drop(HEARTBEAT)


class IdleLanes(StreamingQueryListener):
    """Sends the heartbeats of lanes that were silent for ``after`` seconds, up to the latest event time of all lanes.

    ``paths`` are parts of the sources' descriptions, by which Spark reports how much each of them read.
    """

    def __init__(self, session: SparkSession, heartbeats: Heartbeats, paths: Sequence[str], after: float, now: Callable[[], float] = clock.monotonic) -> None:
        self.session, self.heartbeats, self.paths, self.after, self.now = session, heartbeats, paths, after, now
        self.heard: dict[int, float] = {}
        self.sent: dict[int, str] = {}
        self.latest: str | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        self.look([])

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        latest = (progress.eventTime or {}).get("max")
        if latest:
            self.latest = max(self.latest or "", re.sub(r"[TZ]", lambda m: " " if m[0] == "T" else "", latest))
        self.look([source.description for source in progress.sources if source.numInputRows])

    def look(self, delivered: Sequence[str]) -> None:
        for number, path in enumerate(self.paths):
            self.heard.setdefault(number, self.now())
            if any(path in d for d in delivered):
                self.heard[number] = self.now()
            elif self.latest and self.now() - self.heard[number] >= self.after and self.sent.get(number, "") < self.latest:
                self.heartbeats.send(self.session, number, self.latest)
                self.sent[number] = self.latest



def idle_lanes(spark: SparkSession, lanes: Sequence[DataFrame], heartbeats: Heartbeats, after: float, source: str) -> IdleLanes:
    """The listener for lanes of a topic, or of a folder, named ``source``."""
    files = [f"{source}/{n}" for n in sorted(list_names(spark, source)) if n.startswith("partition=")] if "/" in source else []
    return IdleLanes(spark, heartbeats, files or [f"Assign[{source}-{p}]" for p in range(len(lanes))], after)
