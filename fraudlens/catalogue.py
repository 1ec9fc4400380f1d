"""Named queries over the test tables: every rule, operator and panel, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens import schemas as s
from fraudlens.functions.records import assemble, decode_lenient, decode_strict, with_event_time
from fraudlens.functions.times import second_id, second_text
from fraudlens.operators.joins import heavy_keys
from fraudlens.operators.latest import latest_by_key
from fraudlens.operators.windows import hop_distinct
from fraudlens.plans import monitor, rules
from fraudlens.session import shared_folder, stream_session
from fraudlens.sources import driver_tables as t
from fraudlens.sources.messages import decoded
from fraudlens.streaming import jobs, lanes, seam, sinks
from fraudlens.streaming.fanout import FanOut
from fraudlens.streaming.rollup import Rollup
from fraudlens.streaming.seen import SeenRows
from fraudlens.streaming.tiered import LandedTable, TieredLog
from fraudlens.streaming.upsert import UpsertLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _by_second(tx: DataFrame) -> DataFrame:
    return tx.withColumn("transaction_id", second_id(F.col("timestamp")))


def _wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- filters and keyed tables ---


@query
def big_amount(spark, sf_dir):
    return rules.big_amount(t.transactions(spark, sf_dir, above=s.BIG_AMOUNT))


@query
def big_amount_latest(spark, sf_dir):
    tx = _by_second(t.transactions(spark, sf_dir, above=s.BIG_AMOUNT)).where(F.col("amount") > s.BIG_AMOUNT)
    return rules.latest_transactions(tx, F.col("event_id"))


@query
def tx_latest_by_id(spark, sf_dir):
    return rules.latest_transactions(_by_second(t.transactions(spark, sf_dir)), F.col("event_id"))


@query
def tx_copy(spark, sf_dir):
    return rules.copy(t.transactions(spark, sf_dir), s.TRANSACTION_COLUMNS)


# --- blacklists ---


@query
def blacklist_customers(spark, sf_dir):
    return rules.blacklisted_customers(t.transactions(spark, sf_dir), t.blacklist_customers(spark, sf_dir))


@query
def blacklist_devices(spark, sf_dir):
    return rules.blacklisted_devices(t.transactions(spark, sf_dir), t.blacklist_devices(spark, sf_dir))


@query
def blacklist_append(spark, sf_dir):
    tx, customers, devices = t.transactions(spark, sf_dir), t.blacklist_customers(spark, sf_dir), t.blacklist_devices(spark, sf_dir)
    return rules.blacklist_hits(tx, customers, devices).select(*s.BLACKLIST_COLUMNS)


@query
def blacklist_latest(spark, sf_dir):
    tx, customers, devices = t.transactions(spark, sf_dir), t.blacklist_customers(spark, sf_dir), t.blacklist_devices(spark, sf_dir)
    return rules.blacklist_latest(tx, customers, devices, "event_id")


@query
def blacklist_repeated_entries(spark, sf_dir):
    return rules.blacklisted_customers(t.transactions(spark, sf_dir), t.dictionary_feed(spark, sf_dir))


@query
def blacklist_by_shuffle(spark, sf_dir):
    return rules.blacklisted_customers(
        t.transactions(spark, sf_dir), t.dictionary_feed(spark, sf_dir), broadcast_bytes=0, salts=4
    )


@query
def tx_left_blacklist(spark, sf_dir):
    return rules.blacklisted_customers(t.transactions(spark, sf_dir), t.blacklist_customers(spark, sf_dir), how="left")


@query
def dictionary_distinct(spark, sf_dir):
    return rules.distinct_entries(t.dictionary_feed(spark, sf_dir).drop("o_orderkey"))


@query
def dictionary_latest(spark, sf_dir):
    return latest_by_key(t.dictionary_feed(spark, sf_dir), ["customer_id"], [F.col("o_orderkey")]).drop("o_orderkey")


# --- windows ---


@query
def velocity_windows(spark, sf_dir):
    return rules.velocity_windows(t.transactions(spark, sf_dir))


@query
def velocity_alerts(spark, sf_dir):
    return rules.velocity(t.transactions(spark, sf_dir))


@query
def velocity_alerts_direct(spark, sf_dir):
    return rules.velocity_direct(t.transactions(spark, sf_dir))


@query
def velocity_computed_time(spark, sf_dir):
    tx = t.transactions(spark, sf_dir).withColumn("timestamp", second_text(F.col("timestamp")))
    timed = with_event_time(tx, "timestamp", "event_time", s.TIME_PATTERN_SECONDS)
    return _wall_clock(rules.velocity_by_window(timed), "window_start", "window_end")


@query
def geolocation_alerts(spark, sf_dir):
    return rules.geolocation(t.transactions(spark, sf_dir))


@query
def device_alerts(spark, sf_dir):
    return rules.device_sharing(t.transactions(spark, sf_dir))


@query
def users_per_week(spark, sf_dir):
    """Users of each kind of event in a week, every hour: windows of 168 panes."""
    return hop_distinct(t.table(spark, sf_dir, "events"), ["event_type"], "user_id", "ts", "7 days", "1 hour", "users")


# --- records ---


@query
def decode_lenient_records(spark, sf_dir):
    decoded = decode_lenient(t.payloads(t.transactions(spark, sf_dir)), s.TRANSACTIONS, carry=("event_id",))
    return _wall_clock(decoded, "timestamp")


@query
def decode_strict_records(spark, sf_dir):
    decoded = decode_strict(t.form_payloads(t.transactions(spark, sf_dir)), s.TRANSACTIONS)
    return _wall_clock(decoded, "timestamp")


@query
def decode_strict_dictionary(spark, sf_dir):
    """Dictionary messages of a strict source, each entry once."""
    feed = t.dictionary_feed(spark, sf_dir).select(F.to_json(F.struct("customer_id", "description")).alias("value"))
    return rules.distinct_entries(decoded(feed, "blacklist_customers", strict=True))


@query
def decode_narrow_records(spark, sf_dir):
    decoded = decode_lenient(t.payloads(t.transactions(spark, sf_dir)), s.TRANSACTIONS_NARROW, carry=("event_id",))
    return _wall_clock(decoded, "timestamp")


@query
def relational_copy(spark, sf_dir):
    messages = t.form_payloads(_by_second(t.transactions(spark, sf_dir)))
    decoded = decode_strict(messages, s.TRANSACTIONS_RELATIONAL, carry=("event_id",))
    latest = rules.latest_transactions(decoded, F.col("event_id"), s.TRANSACTIONS_RELATIONAL.fieldNames())
    return _wall_clock(latest, "timestamp")


@query
def assemble_records(spark, sf_dir):
    return assemble(t.transactions(spark, sf_dir), "timestamp")


@query
def encode_alerts(spark, sf_dir):
    return sinks.messages(rules.velocity(t.transactions(spark, sf_dir)), "velocity_alerts")


@query
def encode_geolocation(spark, sf_dir):
    return sinks.messages(rules.geolocation(t.transactions(spark, sf_dir)), "geolocation_alerts")


@query
def encode_blacklist(spark, sf_dir):
    """Hits of both lists as messages without keys."""
    return sinks.messages(blacklist_append(spark, sf_dir), "blacklist_append")


@query
def encode_blacklist_customers(spark, sf_dir):
    return sinks.messages(blacklist_customers(spark, sf_dir), "blacklist_customers_append")


@query
def encode_window_keys(spark, sf_dir):
    tx = t.transactions(spark, sf_dir)
    return sinks.messages(rules.velocity_by_window(tx, "timestamp"), "velocity_fraud")


@query
def encode_unkeyed(spark, sf_dir):
    return sinks.messages(rules.device_sharing(t.transactions(spark, sf_dir)), "device_alerts_append")


@query
def alerts_from_messages(spark, sf_dir):
    """Device alerts written as messages and read back, as the landing jobs do."""
    alerts = sinks.messages(rules.device_sharing(t.transactions(spark, sf_dir)), "device_alerts")
    return _wall_clock(decoded(alerts, "device_alerts"), "window_start", "window_end")


@query
def normalised_places(spark, sf_dir):
    tx = t.transactions(spark, sf_dir).withColumn("location", F.concat(F.lit(" "), F.when(F.col("event_id") % 2 == 0, F.initcap("location")).otherwise(F.upper("location"))))
    return rules.geolocation(rules.normalise_places(tx, "location"))


# --- monitoring ---


@query
def panel_counts(spark, sf_dir):
    return monitor.counts(t.table(spark, sf_dir, "events"), "ts", "event_type", "1 hour", limit=monitor.SERIES_LIMIT)


@query
def panel_p99(spark, sf_dir):
    events = monitor.in_values(t.table(spark, sf_dir, "events"), "event_type", None, excluded=["signup"])
    return monitor.quantiles(events, "ts", "event_type", "value", "1 day", scale=1000, limit=monitor.SERIES_LIMIT)


@query
def panel_errors(spark, sf_dir):
    events = monitor.in_values(t.table(spark, sf_dir, "events"), "event_type", ["error", "signup"], excluded=["signup"])
    return monitor.counts(events, "ts", "event_type", "1 hour", limit=monitor.SERIES_LIMIT)


@query
def panel_top(spark, sf_dir):
    return monitor.summaries(t.table(spark, sf_dir, "events"), "user_id", "ts", "event_type", "value", "event_id", scale=1000)


@query
def panel_detail(spark, sf_dir):
    """The events of the user with the greatest value, between the user's first and last purchase."""
    events = t.table(spark, sf_dir, "events")
    spans = events.where("event_type = 'purchase'").groupBy("user_id").agg(
        F.min("ts").alias("span_start"), F.max("ts").alias("span_end")
    )
    chosen = events.agg(F.max(F.struct("value", F.col("user_id").alias("id"))).alias("top")).select("top.id").scalar()
    rows = monitor.detail(events, spans, "user_id", "ts", "value", "event_id", chosen)
    tags = F.transform(monitor.json_tags("props"), lambda m: F.concat_ws("=", m["key"], m["value"]))
    return rows.select(
        "user_id", "event_id", "event_type", "ts", (F.col("value") * 0.001).alias("duration"), F.array_join(tags, ",").alias("tags")
    )


@query
def panel_page(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    return monitor.page(events, ["ts", "props", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query
def panel_distinct(spark, sf_dir):
    return monitor.values(t.table(spark, sf_dir, "events"), "event_type")


@query
def panel_distinct_ids(spark, sf_dir):
    return monitor.values(t.table(spark, sf_dir, "events").where("event_type = 'error'"), "user_id", monitor.VALUES_LIMIT)


@query
def panel_avg(spark, sf_dir):
    averages = monitor.averages(t.table(spark, sf_dir, "events"), "ts", "event_type", "value", "1 hour")
    return averages.withColumn("avg_value", F.round("avg_value", 10))


@query
def panel_avg_text(spark, sf_dir):
    return monitor.averages(t.table(spark, sf_dir, "events"), "ts", "event_type", "value", as_text=True)


@query
def panel_status(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").select("event_id", "event_type")
    return monitor.status(events, "event_type", ["error"])


@query
def panel_time_range(spark, sf_dir):
    events = monitor.in_time(
        t.table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 10, 6, 0), datetime(2024, 1, 20, 18, 30)
    )
    return monitor.counts(events, "ts", "event_type", "90 seconds")


@query
def panel_date_range(spark, sf_dir):
    events = monitor.in_dates(t.table(spark, sf_dir, "events"), "ts", date(2024, 1, 10), date(2024, 1, 20))
    return monitor.counts(events, "ts", "event_type", "500 milliseconds")


@query
def panel_date_time(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    chosen = monitor.in_date_time(events, "day", "ts", datetime(2024, 1, 10, 6, 0), datetime(2024, 1, 20, 18, 30))
    return monitor.counts(chosen, "ts", "event_type", "1 hour")


def _landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, which several rules can read."""
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


@query
def alert_rollup(spark, sf_dir):
    """The events are read and decoded once, and every rule reads the columns it needs of the transactions."""
    columns = [c for c in s.TRANSACTION_COLUMNS if c not in ("transaction_id", "merchant", "payment_method")]
    nulls = {c: F.lit(None).cast("string") for c in s.TRANSACTION_COLUMNS if c not in columns}
    tx = _landed(spark, t.transactions(spark, sf_dir).select(*columns), "transactions").withColumns(nulls)
    hits = rules.blacklist_hits(tx, t.blacklist_customers(spark, sf_dir), t.blacklist_devices(spark, sf_dir))
    return monitor.alert_rollup(
        {
            "big_amount": (rules.big_amount(tx), "timestamp"),
            "blacklist": (hits, "timestamp"),
            "velocity_alerts": (rules.velocity(tx), "window_start"),
            "geolocation_alerts": (rules.geolocation(tx), "window_start"),
            "device_alerts": (rules.device_sharing(tx), "window_start"),
        },
        "5 minutes",
    )


# --- streams: the same rules, run to the end of the tables ---


def _run(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Runs a stream over what is there into a Parquet table, and reads that."""
    folder = shared_folder(spark, name)
    times = [f.name for f in df.schema if f.dataType == s.TS]
    writer = _wall_clock(df, *times).writeStream.format("parquet").option("path", f"{folder}/rows").outputMode("append")
    jobs.start(writer, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(_wall_clock(df, *times).schema).parquet(f"{folder}/rows")


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.transactions_stream(stream_session(spark), sf_dir)


def _closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of transactions, and one a day later that moves the watermark past all their windows."""
    tx = _stream(spark, sf_dir)
    session = tx.sparkSession
    later = F.expr("max(timestamp) + INTERVAL 1 DAY").cast("timestamp").alias("timestamp")
    last = t.transactions(session, sf_dir).agg(later)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in tx.schema if f.name != "timestamp"]
    folder = shared_folder(session, "closing")
    last.select(*empty, "timestamp").write.parquet(folder)
    return tx.unionByName(session.readStream.schema(tx.schema).parquet(folder))


def _in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions written in four slices of time, one after the other, with the closing row behind them,
    as a stream of several micro-batches. Rows are out of order by a slice at most."""
    session = stream_session(spark)
    folder = shared_folder(session, "slices")
    events = t.table(session, sf_dir, "events")
    limits = [datetime(2024, 1, 1) + i * SLICE for i in range(1, 4)]
    since = [F.lit(True), *[F.col("ts") >= x for x in limits]]
    until = [*[F.col("ts") < x for x in limits], F.lit(True)]
    for first, last in zip(since, until, strict=True):
        part = t.to_transactions(events.where(first & last))
        part.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.mode("append").parquet(folder)
    rows = session.read.parquet(folder)
    per_batch = max(1, len(rows.inputFiles()) // 4)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != "timestamp"]
    rows.agg(F.expr("max(timestamp) + INTERVAL 1 DAY").alias("timestamp")).select(*empty, "timestamp").write.mode("append").parquet(folder)
    return session.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


# A quarter of the table's thirty days, and of the hour that they are pressed into.
SLICE, SLICE_PRESSED = timedelta(days=7, hours=12), "15 minutes"


@query
def stream_velocity_in_batches(spark, sf_dir):
    return _run(spark, rules.velocity(rules.with_watermark(_in_slices(spark, sf_dir), delay=SLICE_PRESSED)), "velocity")


@query
def stream_device_in_batches(spark, sf_dir):
    return _run(spark, rules.device_sharing(rules.with_watermark(_in_slices(spark, sf_dir), delay=SLICE_PRESSED)), "device")


@query
def stream_big_amount(spark, sf_dir):
    return _run(spark, rules.big_amount(_stream(spark, sf_dir)), "big_amount")


@query
def stream_velocity_alerts(spark, sf_dir):
    return _run(spark, rules.velocity(rules.with_watermark(_closed(spark, sf_dir))), "velocity")


@query
def stream_geolocation_alerts(spark, sf_dir):
    return _run(spark, rules.geolocation(rules.with_watermark(_closed(spark, sf_dir))), "geolocation")


@query
def stream_device_alerts(spark, sf_dir):
    return _run(spark, rules.device_sharing(rules.with_watermark(_closed(spark, sf_dir))), "device")


@query
def stream_blacklist_customers(spark, sf_dir):
    tx = _stream(spark, sf_dir)
    customers = t.to_blacklist_customers(t.stream_of(tx.sparkSession, sf_dir, "customer"))
    return _run(spark, rules.blacklisted_customers(tx, customers), "customers")


@query
def stream_blacklist_devices(spark, sf_dir):
    """Against the dictionary table as it is at each micro-batch."""
    tx = _stream(spark, sf_dir)
    folder = shared_folder(spark, "devices")
    log = UpsertLog(f"{folder}/log", ["transaction_id"], ["timestamp"])
    writer = jobs.match_per_batch(tx, lambda: t.blacklist_devices(tx.sparkSession, sf_dir), "device_id", log.write)
    jobs.start(writer, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return _wall_clock(log.view(tx.sparkSession), "timestamp")


@query
def stream_blacklist_devices_joined(spark, sf_dir):
    """Against the dictionary as a stream."""
    tx = _stream(spark, sf_dir)
    return _run(spark, rules.blacklisted_devices(tx, t.to_blacklist_devices(t.stream_of(tx.sparkSession, sf_dir, "part"))), "devices")


def _keyed(spark: SparkSession, writers: list[DataFrame], name: str) -> DataFrame:
    """The table that streams write by transaction id, the later one winning ties."""
    folder = shared_folder(spark, name)
    for number, df in enumerate(writers):
        log = UpsertLog(f"{folder}/log", ["transaction_id"], ["event_id"], number)
        jobs.start(jobs.for_each_batch(df, log.write), f"{folder}/checkpoint{number}", available_now=True).awaitTermination()
    return _wall_clock(log.view(writers[0].sparkSession), "timestamp").drop("event_id")


@query
def stream_blacklist_latest(spark, sf_dir):
    tx = _stream(spark, sf_dir)
    customers = t.to_blacklist_customers(t.stream_of(tx.sparkSession, sf_dir, "customer"))
    devices = t.to_blacklist_devices(t.stream_of(tx.sparkSession, sf_dir, "part"))
    carry = ("event_id",)
    return _keyed(spark, [rules.blacklisted_customers(tx, customers, carry=carry), rules.blacklisted_devices(tx, devices, carry=carry)], "blacklist")


@query
def stream_big_amount_latest(spark, sf_dir):
    return _keyed(spark, [rules.big_amount(_by_second(_stream(spark, sf_dir)), carry=("event_id",))], "big")


@query
def stream_dictionary_distinct(spark, sf_dir):
    orders = t.stream_of(stream_session(spark), sf_dir, "orders")
    return _run(spark, rules.distinct_entries(t.to_dictionary_feed(orders).drop("o_orderkey")), "entries")


@query
def stream_tx_latest(spark, sf_dir):
    tx = t.transactions_stream(stream_session(spark), sf_dir)
    keyed = tx.withColumn("transaction_id", second_id(F.col("timestamp")))
    folder = shared_folder(spark, "latest")
    log = UpsertLog(f"{folder}/log", ["transaction_id"], ["event_id"])
    jobs.start(jobs.for_each_batch(keyed, log.write), f"{folder}/checkpoint", available_now=True).awaitTermination()
    return _wall_clock(log.view(tx.sparkSession), "timestamp").select(*s.TRANSACTION_COLUMNS)


@query
def stream_landed_transactions(spark, sf_dir):
    tx = t.transactions_stream(stream_session(spark), sf_dir).select(*s.TRANSACTION_COLUMNS)
    folder = shared_folder(spark, "landed")
    jobs.start(sinks.land(tx, f"{folder}/rows", "timestamp"), f"{folder}/checkpoint", available_now=True).awaitTermination()
    return _wall_clock(sinks.landed(tx.sparkSession, f"{folder}/rows", "timestamp"), "timestamp")


# --- streams that go on: partitions, seams, tables that are kept small ---


def _instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.transactions(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _a_day_later(rows: DataFrame, *columns: str) -> DataFrame:
    """A row that moves the watermark past all windows, with nulls but for its time and ``columns``."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in ("timestamp", *columns)]
    return rows.agg(F.expr("max(timestamp) + INTERVAL 1 DAY").alias("timestamp")).select(*empty, "timestamp")


LANES = 7


def _in_lanes(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The transactions in seven folders, each in the order of events, but cut into one to seven files, and read by one file
    at a time: after the first, one folder is at its end and another at the seventh of its way."""
    session = stream_session(spark)
    folder, tx = shared_folder(session, "lanes"), _instants(session, sf_dir).withColumn("lane", F.expr(f"int(event_id % {LANES})"))
    begin = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    file = F.floor((F.unix_micros("timestamp") - F.unix_micros(begin)) * (F.col("lane") + 1) / 3_600_000_000)
    rows = _landed(session, tx.withColumn("file", F.least(F.greatest(file, F.lit(0)), F.col("lane"))), "ordered")
    for number in range(LANES):
        rows.where(F.col("file") == number).drop("file").repartition(LANES, "lane").write.mode("append").partitionBy("lane").parquet(folder)
    every = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane")
    _a_day_later(rows.drop("file"), "lane").select("*", every).write.mode("append").partitionBy("lane").parquet(folder)
    schema = rows.drop("lane", "file").schema
    return [session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/lane={i}") for i in range(LANES)]


@query
def stream_velocity_out_of_order(spark, sf_dir):
    """Partitions that differ by up to an hour, at a delay of five seconds."""
    return _run(spark, rules.velocity(lanes.timed(_in_lanes(spark, sf_dir))), "velocity")


def _by_batch(spark: SparkSession, df: DataFrame, write: jobs.Write, name: str) -> None:
    jobs.start(jobs.for_each_batch(df, write), shared_folder(spark, name), available_now=True).awaitTermination()


@query
def stream_device_strict(spark, sf_dir):
    """Late rows dropped at once, and the values of a window spread over all state partitions."""
    tx = _closed(spark, sf_dir)
    jobs.strict_lateness(tx.sparkSession)
    table = LandedTable(shared_folder(spark, "alerts"), "window_start")
    values = rules.device_sharing_values(rules.with_watermark(tx))
    _by_batch(spark, values, lambda batch, i: table.write(rules.device_sharing_of_values(batch), i), "strict")
    return _wall_clock(table.read(tx.sparkSession), "window_start", "window_end")


@query
def stream_velocity_backfilled(spark, sf_dir):
    """The first half of the transactions as a batch, the second as the stream that goes on from there."""
    session, folder = stream_session(spark), shared_folder(spark, "backfill")
    files, rows = f"{folder}/in", _instants(session, sf_dir)
    middle = F.lit(datetime(2024, 1, 1, 0, 30)).cast("timestamp")
    rows.where(F.col("timestamp") < middle).write.parquet(files)
    between = seam.file_seam(session, files)
    rows.where(F.col("timestamp") >= middle).unionByName(_a_day_later(rows)).write.mode("append").parquet(files)
    table = LandedTable(f"{folder}/alerts", "window_start")
    past, follow = (reader.schema(rows.schema).parquet(files) for reader in (session.read, session.readStream))
    tx, beyond = seam.follow_on(
        between.past(past), between.follow(follow), rules.velocity, table.write, folder, "timestamp", s.VELOCITY_SIZE, s.VELOCITY_SLIDE)
    _by_batch(spark, beyond(rules.velocity(rules.with_watermark(tx))), table.write, "follow")
    return _wall_clock(table.read(session), "window_start", "window_end")


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_slices(spark, sf_dir).where("event_id IS NOT NULL")


@query
def stream_tx_latest_tiered(spark, sf_dir):
    """Four micro-batches, of which every two parts of about one size become one."""
    tx = _by_second(_sliced(spark, sf_dir))
    log = TieredLog(shared_folder(spark, "tiers"), ["transaction_id"], ["event_id"], fanout=2)
    _by_batch(spark, tx, log.write, "tiered")
    return _wall_clock(log.view(tx.sparkSession), "timestamp").select(*s.TRANSACTION_COLUMNS)


@query
def stream_blacklist_latest_tiered(spark, sf_dir):
    """Two streams that write one log."""
    folder = shared_folder(spark, "tiers")
    for number, (rule, dictionary) in enumerate([
        (rules.blacklisted_customers, t.blacklist_customers), (rules.blacklisted_devices, t.blacklist_devices),
    ]):
        tx = _sliced(spark, sf_dir)
        log = TieredLog(folder, ["transaction_id"], ["event_id"], number, fanout=2)
        _by_batch(spark, rule(tx, dictionary(tx.sparkSession, sf_dir), carry=("event_id",)), log.write, f"writer{number}")
    return _wall_clock(log.view(tx.sparkSession), "timestamp").drop("event_id")


@query
def stream_landed_tiered(spark, sf_dir):
    tx = _sliced(spark, sf_dir).select(*s.TRANSACTION_COLUMNS)
    table = LandedTable(shared_folder(spark, "landed"), "timestamp", fanout=2)
    _by_batch(spark, tx, table.write, "landing")
    return _wall_clock(table.read(tx.sparkSession), "timestamp")


@query
def stream_blacklist_devices_heavy(spark, sf_dir):
    """Two streams, of which only the heavy keys are spread."""
    tx = _stream(spark, sf_dir)
    devices = t.to_blacklist_devices(t.stream_of(tx.sparkSession, sf_dir, "part"))
    partitions = int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(t.transactions(spark, sf_dir), "device_id", partitions)
    return _run(spark, rules.blacklisted_devices(tx, devices, heavy=heavy), "devices")


@query
def stream_all_rules(spark, sf_dir):
    """Every rule over one reading of the stream: alerts per rule and five minutes."""
    tx = _closed(spark, sf_dir).select(*s.TRANSACTION_COLUMNS)
    session, folder = tx.sparkSession, shared_folder(spark, "rules")
    customers, devices = t.blacklist_customers(session, sf_dir), t.blacklist_devices(session, sf_dir)
    tables = {name: LandedTable(f"{folder}/{name}", "timestamp") for name in ("big_amount", "blacklist")}
    fan = FanOut(folder, tx.schema, {
        "big_amount": (rules.big_amount, tables["big_amount"].write),
        "blacklist": (lambda rows: rules.blacklist_hits(rows, customers, devices), tables["blacklist"].write),
    })
    _by_batch(spark, tx, fan.write, "fan-out")
    alerts = {name: (_wall_clock(table.read(session), "timestamp"), "timestamp") for name, table in tables.items()}
    for name in ("velocity_alerts", "geolocation_alerts", "device_alerts"):
        alerts[name] = (_run(spark, jobs.WINDOWED[name].rule(rules.with_watermark(fan.stream(session))), name), "window_start")
    return monitor.alert_rollup(alerts, "5 minutes")


def _rolled_up(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, Rollup]:
    """Sums that a stream kept of the events in six files, of which each has events of all times."""
    session, folder = stream_session(spark), shared_folder(spark, "rollup")
    events = t.table(session, sf_dir, "events")
    events.repartition(6, "event_id").write.parquet(f"{folder}/in")
    rollup = Rollup(folder, "event_type", "ts", "value", fanout=3, files=1)
    stream = session.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    _by_batch(spark, stream, rollup.write, "rolling-up")
    return session, rollup


@query
def panel_counts_rolled_up(spark, sf_dir):
    session, rollup = _rolled_up(spark, sf_dir)
    return rollup.counts(session, "1 hour")


@query
def panel_avg_rolled_up(spark, sf_dir):
    session, rollup = _rolled_up(spark, sf_dir)
    return rollup.averages(session, "1 hour").withColumn("avg_value", F.round("avg_value", 10))


@query
def panel_p99_rolled_up(spark, sf_dir):
    session, rollup = _rolled_up(spark, sf_dir)
    return monitor.in_values(rollup.quantiles(session, "1 day", scale=1000), "event_type", None, excluded=["signup"])


@query
def stream_dictionary_distinct_table(spark, sf_dir):
    """Entries once, told apart by a table of those that were seen; the stream itself keeps no state."""
    session, folder = stream_session(spark), shared_folder(spark, "seen")
    t.dictionary_feed(session, sf_dir).drop("o_orderkey").repartition(4).write.parquet(f"{folder}/in")
    schema = session.read.parquet(f"{folder}/in").schema
    feed = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    seen = SeenRows(folder, ("customer_id", "description"), fanout=3, buckets=4)
    _by_batch(spark, feed, seen.write, "seeing")
    return seen.read(session)
