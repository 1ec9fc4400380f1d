"""The rules as continuous jobs: one stream per rule, each with its own checkpoint.

``spark-submit fraudlens/streaming/jobs.py velocity_alerts --files /in --land /out``
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fraudlens import schemas as s
from fraudlens.functions.records import decode_lenient, decode_strict, with_event_time
from fraudlens.operators.distinct import ALLOW_MULTIPLE
from fraudlens.plans import rules
from fraudlens.session import create_session, require_utc, stream_session
from fraudlens.sources import messages as m
from fraudlens.operators.joins import heavy_keys
from fraudlens.streaming import lanes, seam, sinks, watch
from fraudlens.streaming.tiered import BACKFILL, LandedTable, TieredLog
from fraudlens.streaming.upsert import Database, RelationalTable, UpsertLog

# The messages of an input; of transactions it may be a list, of a stream for each partition.
Read = Callable[[str], DataFrame | list[DataFrame]]
Write = Callable[[DataFrame, int], None]
# The place of a message in its topic, and when it came, where the source tells that: the write order of a key.
PLACE, ARRIVAL = ("partition", "offset"), "arrival"


@dataclass(frozen=True)
class Options:
    """``delay``: how far behind the latest event time a row may come; ``strategy``: of distinct counts
    (none: that of the rule); ``salts``: parts that a key of a two-stream join is spread over, or with ``heavy`` the
    parts of the heavy keys of each column; ``place``: rows carry the place of their message, where the source has one;
    ``heartbeats``: of the partitions that are read as lanes."""

    delay: str = s.WATERMARK_DELAY
    strategy: str | None = None
    salts: int | None = None
    place: bool = False
    heavy: dict[str, dict[str, int]] | None = None
    heartbeats: lanes.Heartbeats | None = None

    def timed(self, tx: DataFrame | list[DataFrame], time: str = "timestamp") -> DataFrame:
        if isinstance(tx, list):
            return lanes.timed(tx, time, self.delay, self.heartbeats)
        return rules.with_watermark(tx, time, self.delay) if tx.isStreaming else tx

    @property
    def distinct(self) -> dict[str, str]:
        return {"strategy": self.strategy} if self.strategy else {}

    def carried(self, messages: DataFrame) -> tuple[str, ...]:
        if not self.place or not set(PLACE) <= set(messages.columns):
            return ()
        return (*[c for c in (ARRIVAL,) if c in messages.columns], *PLACE)


Rule = Callable[[Read, Options], DataFrame]


def _rows(read: Read, relation: str, options: Options) -> DataFrame | list[DataFrame]:
    messages = read(relation)
    if isinstance(messages, list):
        return [m.decoded(part, relation) for part in messages]
    return m.decoded(messages, relation, carry=options.carried(messages))


def _big_amount(read: Read, options: Options) -> DataFrame:
    tx = _rows(read, "transactions", options)
    return rules.big_amount(tx, carry=options.carried(tx))


def _blacklisted(key: str, dictionary: str) -> Rule:
    def rule(read: Read, options: Options) -> DataFrame:
        tx, entries = _rows(read, "transactions", options), m.decoded(read(dictionary), dictionary)
        return rules.blacklisted(tx, entries, key, carry=options.carried(tx), salts=options.salts, heavy=(options.heavy or {}).get(key))

    return rule


def _both_blacklists(read: Read, options: Options) -> DataFrame:
    tx = _rows(read, "transactions", options)
    entries = [m.decoded(read(d), d) for d in ("blacklist_customers", "blacklist_devices")]
    return rules.blacklist_hits(tx, *entries, carry=options.carried(tx), salts=options.salts, heavy=options.heavy).drop("_writer")


def _relational_transactions(read: Read, options: Options) -> DataFrame:
    messages = read("transactions")
    carry = options.carried(messages)
    rows = decode_strict(messages, s.TRANSACTIONS_RELATIONAL, carry=carry)
    return rules.copy(rows, [*carry, *s.TRANSACTIONS_RELATIONAL.fieldNames()])


@dataclass(frozen=True)
class Windowed:
    """A rule over windows of transactions: how these are decoded, their time, the windows, and the rule in one step
    or, for ``by_value``, in two: what the stream gives, and what its micro-batches make of that."""

    decode: Callable[[DataFrame], DataFrame]
    time: str
    size: str
    slide: str
    rule: Callable[..., DataFrame]
    values: Callable[[DataFrame], DataFrame] | None = None
    of_values: Callable[[DataFrame], DataFrame] | None = None

    def rows(self, read: Read) -> DataFrame | list[DataFrame]:
        messages = read("transactions")
        return [self.decode(part) for part in messages] if isinstance(messages, list) else self.decode(messages)

    def windows(self, timed: DataFrame, options: Options) -> DataFrame:
        if options.strategy == BY_VALUE and timed.isStreaming:
            return self.values(timed)
        return self.rule(timed, **(options.distinct if self.values and timed.isStreaming else {}))

    def __call__(self, read: Read, options: Options) -> DataFrame:
        return self.windows(options.timed(self.rows(read), self.time), options)

    def finish(self, options: Options) -> Callable[[DataFrame], DataFrame]:
        return self.of_values if options.strategy == BY_VALUE else lambda windows: windows


BY_VALUE = "by_value"


def _transactions(messages: DataFrame) -> DataFrame:
    return m.decoded(messages, "transactions")


def _text_time(messages: DataFrame) -> DataFrame:
    return with_event_time(decode_lenient(messages, s.TRANSACTIONS_TEXT_TIME), "timestamp", "event_time", s.TIME_PATTERN_SECONDS)


# The jobs over windows.
WINDOWED = {
    "velocity_alerts": Windowed(_transactions, "timestamp", s.VELOCITY_SIZE, s.VELOCITY_SLIDE, rules.velocity),
    "geolocation_alerts": Windowed(
        _transactions, "timestamp", s.GEO_SIZE, s.GEO_SLIDE, rules.geolocation, rules.geolocation_values, rules.geolocation_of_values),
    "device_alerts": Windowed(
        _transactions, "timestamp", s.DEVICE_SIZE, s.DEVICE_SLIDE, rules.device_sharing, rules.device_sharing_values, rules.device_sharing_of_values),
    "velocity_fraud": Windowed(_text_time, "event_time", s.VELOCITY_SIZE, s.VELOCITY_SLIDE, rules.velocity_by_window),
}


def _landed(relation: str) -> tuple[str, str | None, Rule]:
    time = "window_start" if "window_start" in m.SCHEMAS[relation].fieldNames() else "timestamp"
    return relation, time, lambda read, options: _rows(read, relation, options)


# Relation written, its event time for landing, and the rule over the message streams.
JOBS: dict[str, tuple[str, str | None, Rule]] = {
    "big_amount": ("big_amount", "timestamp", _big_amount),
    "blacklist_customers": ("blacklist", "timestamp", _blacklisted("customer_id", "blacklist_customers")),
    "blacklist_devices": ("blacklist", "timestamp", _blacklisted("device_id", "blacklist_devices")),
    # The same without keys: every hit is kept.
    "blacklist_append": ("blacklist_append", "timestamp", _both_blacklists),
    "blacklist_customers_append": ("blacklist_customers_append", "timestamp", _blacklisted("customer_id", "blacklist_customers")),
    **{name: (name, "window_start", rule) for name, rule in WINDOWED.items()},
    "relational_transactions": ("transactions", "timestamp", _relational_transactions),
    "customer_entries": ("blacklist_customers", None, lambda r, _: rules.distinct_entries(
        m.decoded(r("blacklist_customers"), "blacklist_customers", strict=True))),
    "device_entries": ("blacklist_devices", None, lambda r, _: rules.distinct_entries(
        m.decoded(r("blacklist_devices"), "blacklist_devices", strict=True))),
    # The topics of transactions and alerts as they are, for the analytical store.
    **{f"land_{relation}": _landed(relation) for relation in (
        "transactions", "big_amount", "blacklist", "geolocation_alerts", "device_alerts", "velocity_alerts")},
}


def checkpoint_folder(spark: SparkSession, job: str) -> str:
    """The job's folder below ``spark.checkpoint.dir``: the same at every start, so that it goes on."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("name a checkpoint folder, or set spark.checkpoint.dir to one that all executors share")
    return f"{base.rstrip('/')}/{job}"


def strict_lateness(spark: SparkSession) -> None:
    """Drops rows behind the watermark at once, not one micro-batch later; see ``hop_distinct_stream``."""
    spark.conf.set(ALLOW_MULTIPLE, "false")


def rule_stream(spark: SparkSession, job: str, read: Read, options: Options = Options()) -> DataFrame:
    require_utc(spark)
    return JOBS[job][2](read, options)


# Jobs whose relation is a table by key; of two writers of one table, the later wins a tie.
KEYED = {"big_amount": 0, "blacklist_customers": 0, "blacklist_devices": 1, "velocity_fraud": 0, "relational_transactions": 0}


def _order(columns: Sequence[str], otherwise: list[str]) -> list[str]:
    """By arrival, and by offset in a partition. Without the time of arrival there is no order across partitions, but a defined one."""
    if not set(PLACE) <= set(columns):
        return otherwise
    return [*[c for c in (ARRIVAL,) if c in columns], "offset", "partition"]


def upsert_log(job: str, path: str, columns: Sequence[str] = (), compact_every: int | None = None) -> UpsertLog:
    """The log of a job whose rows have ``columns``: the last write is by place in the topic, or else by event time."""
    relation, time, _ = JOBS[job]
    return UpsertLog(path, s.OUTPUT_KEYS[relation], _order(columns, [time]), KEYED[job], compact_every)


def tiered_log(job: str, path: str, columns: Sequence[str] = (), fanout: int = TieredLog.fanout) -> TieredLog:
    """The same as a log that is kept small as it grows."""
    relation, time, _ = JOBS[job]
    return TieredLog(path, s.OUTPUT_KEYS[relation], _order(columns, [time]), KEYED[job], fanout)


# The columns of transactions that jobs join a dictionary by.
JOINED = {
    "blacklist_customers": ["customer_id"], "blacklist_devices": ["device_id"], "blacklist_append": ["customer_id", "device_id"],
    "blacklist_customers_append": ["customer_id"],
}


def heavy_keys_of(spark: SparkSession, job: str, folder: str, head: Callable[[], DataFrame], partitions: int) -> dict[str, dict[str, int]]:
    """The heavy keys of a job's joins, found once in ``head`` (messages of transactions) and kept in ``folder`` for good."""

    def find() -> dict[str, dict[str, int]]:
        tx = _transactions(head())
        return {key: heavy_keys(tx, key, partitions) for key in JOINED[job]}

    return seam.kept(spark, f"{folder}/heavy.json", find)


def backfilled(
    job: str, past: DataFrame, follow: DataFrame, options: Options, write: Write, folder: str
) -> tuple[DataFrame, Write]:
    """A windowed job whose messages before a seam are a batch, which this writes first, and the stream of the others.
    The stream's micro-batches go through the second result."""
    rule, spark = WINDOWED[job], follow.sparkSession
    whole = Options(options.delay)
    rows, beyond = seam.follow_on(
        rule.decode(past), rule.decode(follow), lambda tx: rule.windows(tx, whole), write, folder, rule.time, rule.size, rule.slide, options.delay, BACKFILL,
    )
    require_utc(spark)
    finish = rule.finish(options)
    return beyond(rule.windows(options.timed(rows, rule.time), options)), lambda batch, batch_id: write(finish(batch), batch_id)


# Jobs whose relation is a database table, with its columns and what tells the last row of a key in files.
RELATIONAL = {
    "relational_transactions": (s.TRANSACTIONS_RELATIONAL, ["timestamp"]),
    "customer_entries": (s.BLACKLIST_CUSTOMERS, ["description"]),
    "device_entries": (s.BLACKLIST_DEVICES, ["description"]),
}


def relational_table(job: str, database: Database, table: str, columns: Sequence[str] = ()) -> RelationalTable:
    schema, otherwise = RELATIONAL[job]
    return RelationalTable(database, table, schema.fieldNames(), s.OUTPUT_KEYS[JOBS[job][0]], _order(columns, otherwise))


def start(writer: DataStreamWriter, checkpoint: str, available_now: bool = False, interval: str = "10 seconds") -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def for_each_batch(df: DataFrame, write: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return df.writeStream.foreachBatch(write).outputMode("append")


def match_per_batch(
    tx: DataFrame, entries: Callable[[], DataFrame], key: str, write: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    """Blacklist rule against a dictionary table that is read anew for every micro-batch.

    It keeps no state, but an entry flags only the transactions that come after it. Two streams
    (``JOBS``) flag the earlier ones too, and keep every transaction for that.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(rules.blacklisted(batch, entries(), key), batch_id)

    return for_each_batch(tx, run)


def _properties(path: str | None) -> dict[str, str]:
    if not path:
        return {}
    with open(path) as lines:
        return dict(line.strip().split("=", 1) for line in lines if line.strip())


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one detection rule as a stream.")
    parser.add_argument("job", choices=sorted(JOBS))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--files", help="folder with one subfolder of JSON lines per input")
    source.add_argument("--servers", help="Kafka bootstrap servers, read and written")
    parser.add_argument("--group", help="Kafka consumer group")
    parser.add_argument("--source-topic", action="append", default=[], metavar="INPUT=TOPIC", help="read an input from another topic")
    sink = parser.add_mutually_exclusive_group()
    sink.add_argument("--upsert", help="folder of a log of the last row per key; both blacklist jobs can write one")
    parser.add_argument("--compact-every", type=int, help="micro-batches whose parts of the --upsert log become one")
    parser.add_argument("--tiers", type=int, metavar="PARTS", help="keep the --upsert log in tiers: so many parts of about one size become one")
    sink.add_argument("--land", help="folder of the Parquet table to append to")
    sink.add_argument("--append", help="folder of a table to append to, whose dates keep few files; read it by LandedTable")
    sink.add_argument("--topic", help="Kafka topic to write; default: the relation's name")
    sink.add_argument("--relational", metavar="URL", help="JDBC address of a database, whose table --table is upserted")
    sink.add_argument("--console", action="store_true")
    parser.add_argument("--table", help="of --relational; rows go through a table of this name and _staging")
    parser.add_argument("--driver", default=Database.driver, help="class of the JDBC driver")
    parser.add_argument("--properties", help="file with a line KEY=VALUE for each property of the JDBC connection, such as user and password")
    parser.add_argument("--files-per-date", type=int, help="at most as many files per date and micro-batch when landing, for a shuffle")
    parser.add_argument("--checkpoint", help="default: below spark.checkpoint.dir")
    parser.add_argument("--max-files", type=int, default=1_000, help="files per micro-batch")
    parser.add_argument("--max-offsets", type=int, default=20_000_000, help="Kafka messages per micro-batch")
    parser.add_argument("--interval", default="10 seconds", help="time between micro-batches; longer ones land fewer, larger files")
    parser.add_argument("--partitions", type=int, help="state partitions, fixed by the first run; default: one per core")
    parser.add_argument("--available-now", action="store_true", help="process what is there and stop")
    parser.add_argument("--watermark-delay", default=s.WATERMARK_DELAY, help="how late rows may come; as long as a micro-batch spans, or more")
    parser.add_argument("--strategy", choices=["set", "two_stage", BY_VALUE], help="of distinct counts; set: for few values per key; by_value: counted by the micro-batch that closes a window")
    parser.add_argument("--salts", type=int, help="parts that a key is spread over in a join of two streams; fixed by the first run")
    parser.add_argument("--heavy-keys", type=int, metavar="MESSAGES", help="spread only the keys that are heavy among so many messages; fixed by the first run")
    parser.add_argument("--strict-lateness", action="store_true")
    parser.add_argument("--by-partition", type=int, nargs="?", const=0, metavar="N", help="follow the least watermark of the topic's N partitions, or of the subfolders partition=... of files")
    parser.add_argument("--idle-after", type=float, metavar="SECONDS", help="with --by-partition: a partition silent for so long holds nothing back")
    parser.add_argument("--backfill", action="store_true", help="of a windowed job: what is there at its first start is a batch")
    a = parser.parse_args(arguments)
    windowed = a.job in WINDOWED
    if a.strict_lateness and windowed and WINDOWED[a.job].values and not a.strategy:
        a.strategy = BY_VALUE
    in_batches = a.strategy == BY_VALUE or a.backfill
    table_or_screen = a.land or a.append or a.upsert or a.relational or a.console
    if a.files and not table_or_screen:
        parser.error("reading files needs --land, --append, --upsert, --relational or --console")
    if (a.by_partition is not None or a.backfill) and not windowed:
        parser.error(f"--by-partition and --backfill are for {', '.join(sorted(WINDOWED))}")
    if a.by_partition is not None and a.backfill:
        parser.error("--by-partition and --backfill exclude each other: a batch needs no watermark")
    if a.by_partition == 0 and a.servers:
        parser.error("--by-partition needs the number of the topic's partitions")
    if a.idle_after and a.by_partition is None:
        parser.error("--idle-after needs --by-partition")
    if in_batches and a.land:
        parser.error("--backfill, --strategy by_value and --strict-lateness of distinct counts need --append instead of --land")
    if a.strategy == BY_VALUE and not (windowed and WINDOWED[a.job].values):
        parser.error("--strategy by_value is for geolocation_alerts and device_alerts")
    if a.heavy_keys and a.job not in JOINED:
        parser.error(f"--heavy-keys is for {', '.join(sorted(JOINED))}")
    if a.append and not JOBS[a.job][1]:
        parser.error("--append needs a job whose rows have a time")
    if bool(a.relational) != bool(a.table):
        parser.error("--relational and --table go together")
    if a.relational and a.job not in RELATIONAL:
        parser.error(f"--relational is for {', '.join(sorted(RELATIONAL))}")
    if a.job.startswith("land_") and not (a.land or a.console):
        parser.error("landing a topic needs --land")
    if a.upsert and a.job not in KEYED:
        parser.error(f"--upsert is for {', '.join(sorted(KEYED))}")

    topics = {**m.TOPICS, **dict(pair.split("=", 1) for pair in a.source_topic)}
    written = None if a.files or table_or_screen else a.topic or JOBS[a.job][0]
    spark = stream_session(create_session(a.job), a.partitions)
    if a.strict_lateness:
        strict_lateness(spark)
    watch.attach(spark, watch.DroppedRows())
    checkpoint = (a.checkpoint or checkpoint_folder(spark, a.job)).rstrip("/")
    beside = f"{checkpoint}-job"

    def topic_of(relation: str) -> str:
        if topics[relation] == written:
            parser.error(f"{a.job} would read the topic {written} that it writes")
        return topics[relation]

    def read(relation: str, streaming: bool = True, **offsets: str) -> DataFrame:
        if a.files:
            return m.from_files(spark, f"{a.files}/{relation}", streaming, max_files=a.max_files)
        options = m.kafka_read_options(a.servers, topic_of(relation), a.group, max_offsets=a.max_offsets if streaming else None)
        return m.from_kafka(spark, {**options, **offsets}, streaming)

    def read_lanes(relation: str) -> list[DataFrame]:
        if a.files:
            return lanes.file_lanes(spark, f"{a.files}/{relation}", a.max_files)
        return lanes.kafka_lanes(spark, a.servers, topic_of(relation), a.by_partition, a.group, a.max_offsets)

    relation, time, _ = JOBS[a.job]
    heavy = heartbeats = None
    if a.heavy_keys:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        heavy = heavy_keys_of(spark, a.job, beside, lambda: read("transactions", streaming=False).limit(a.heavy_keys), partitions)
    if a.idle_after:
        heartbeats = lanes.Heartbeats(f"{beside}/heartbeats")
    options = Options(
        a.watermark_delay, a.strategy, a.salts, place=bool(a.land or a.append or a.upsert or a.relational), heavy=heavy, heartbeats=heartbeats)

    def batch_writer(columns: Sequence[str]) -> Write:
        if a.upsert:
            return (tiered_log(a.job, a.upsert, columns, a.tiers) if a.tiers else upsert_log(a.job, a.upsert, columns, a.compact_every)).write
        if a.relational:
            return relational_table(a.job, Database(a.relational, _properties(a.properties), a.driver), a.table, columns).write
        if a.append:
            return LandedTable(a.append, time).write
        if a.console:
            return lambda batch, _: batch.show(truncate=False)
        return lambda batch, _: sinks.batch_to_kafka(batch, relation, a.servers, a.topic)

    if a.backfill:
        columns = m.SCHEMAS[relation].fieldNames()
        if a.files:
            past, follow = _sides_of_files(spark, beside, f"{a.files}/transactions", a.max_files)
        else:
            past, follow = _sides_of_topic(spark, beside, topics["transactions"], read)
        df, write = backfilled(a.job, past, follow, options, batch_writer(columns), beside)
        writer = for_each_batch(df, write)
    elif a.by_partition is not None:
        found = read_lanes("transactions")
        if heartbeats:
            heartbeats.open(spark, len(found))
            watch.attach(spark, lanes.idle_lanes(spark, found, heartbeats, a.idle_after, topics["transactions"] if a.servers else f"{a.files}/transactions"))
        df = rule_stream(spark, a.job, lambda _: found, options)
    else:
        df = rule_stream(spark, a.job, read, options)
    if a.backfill:
        pass
    elif a.strategy == BY_VALUE:
        finish, write = WINDOWED[a.job].finish(options), batch_writer(m.SCHEMAS[relation].fieldNames())
        writer = for_each_batch(df, lambda batch, batch_id: write(finish(batch), batch_id))
    elif a.upsert or a.relational or a.append:
        writer = for_each_batch(df, batch_writer(df.columns))
    elif a.land:
        writer = sinks.land(df, a.land, time, files=a.files_per_date) if time else df.writeStream.format("parquet").option("path", a.land)
    elif a.console:
        writer = sinks.to_console(df)
    else:
        writer = sinks.to_kafka(df, relation, a.servers, a.topic)
    query = start(writer, checkpoint, a.available_now, a.interval)
    query.awaitTermination()
    watch.settle(spark)


def _sides_of_files(spark: SparkSession, folder: str, path: str, max_files: int) -> tuple[DataFrame, DataFrame]:
    """What was in a folder at the job's first start, and the stream of what came later."""
    told = seam.kept_file_seam(spark, folder, path)
    return told.past(m.from_files(spark, path, streaming=False)), told.follow(m.from_files(spark, path, max_files=max_files))


def _sides_of_topic(spark: SparkSession, folder: str, topic: str, read: Callable[..., DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The messages of a topic up to the job's first start, and the stream from exactly there."""
    told = seam.kept(spark, f"{folder}/offsets.json", lambda: {"at": seam.kafka_offsets(read("transactions", streaming=False), topic)})["at"]
    return read("transactions", streaming=False, endingOffsets=told), read("transactions", startingOffsets=told)


if __name__ == "__main__":
    main()
