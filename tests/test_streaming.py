from __future__ import annotations

import json
import os
from datetime import timedelta

import pytest

from conftest import DATA, at, rows
from fraudlens import schemas as s
from fraudlens.operators.distinct import ALLOW_MULTIPLE
from fraudlens.plans import rules
from fraudlens.session import stream_session
from fraudlens.sources import driver_tables
from fraudlens.sources.messages import decoded, from_files
from fraudlens.streaming import jobs, sinks
from fraudlens.streaming.upsert import Database, UpsertLog


class Feed:
    """Folder of JSON-line files, one per micro-batch, in the order they are added."""

    def __init__(self, folder):
        folder.mkdir()
        self.folder, self.number = folder, 0

    def add(self, *records):
        path = self.folder / f"{self.number:04}.json"
        path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
        self.number += 1
        # The file source orders files by time of change.
        stamp = 1_700_000_000 + self.number
        os.utime(path, (stamp, stamp))


def record(i, time, customer="a", location="x", device="d", **more):
    return {"transaction_id": f"TX{i}", "customer_id": customer, "amount": 1, "location": location, "device_id": device, "timestamp": f"2024-01-01 {time}", **more}


@pytest.fixture
def session(spark):
    return stream_session(spark)


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "in")


def drain(spark, df, tmp_path, name="out"):
    """Runs the stream to the end of its input, again from its checkpoint if it has one."""
    writer = df.writeStream.format("parquet").option("path", str(tmp_path / name)).outputMode("append")
    jobs.start(writer, str(tmp_path / f"{name}-checkpoint"), available_now=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


def transactions(session, feed, max_files=1):
    return decoded(from_files(session, str(feed.folder), max_files=max_files), "transactions")


def late_case(feed):
    feed.add(record(1, "00:00:30", location="x"), record(2, "00:01:10", location="y"))
    feed.add(record(3, "00:10:00", customer="z"))
    feed.add(record(4, "00:00:31", location="q"))
    feed.add(record(5, "00:30:00", customer="z"))


@pytest.mark.parametrize("strategy", ["set", "two_stage"])
def test_rows_one_batch_behind_the_watermark_count_by_default(session, feed, tmp_path, strategy):
    late_case(feed)
    alerts = drain(session, rules.geolocation(rules.with_watermark(transactions(session, feed)), strategy=strategy), tmp_path)
    found = rows(alerts.where("customer_id = 'a' AND window_end BETWEEN '2024-01-01 00:02:00' AND '2024-01-01 00:05:00'"), "distinct_locations")
    assert found == [(3,)] * 4


def test_strict_lateness_drops_them(session, feed, tmp_path):
    late_case(feed)
    jobs.strict_lateness(session)
    alerts = drain(session, rules.geolocation(rules.with_watermark(transactions(session, feed)), strategy="set"), tmp_path)
    found = rows(alerts.where("customer_id = 'a' AND window_end BETWEEN '2024-01-01 00:02:00' AND '2024-01-01 00:05:00'"), "distinct_locations")
    assert found == [(2,)] * 4


def test_strict_lateness_refuses_two_stages(session, feed):
    jobs.strict_lateness(session)
    tx = rules.with_watermark(transactions(session, feed))
    with pytest.raises(ValueError, match="two_stage"):
        rules.device_sharing(tx, strategy="two_stage")
    rules.device_sharing(tx, strategy="set")
    with pytest.raises(ValueError, match="strategy"):
        rules.device_sharing(tx, strategy="guess")
    assert session.conf.get(ALLOW_MULTIPLE) == "false"


def mixed_records():
    records = []
    for i in range(400):
        time = (at("00:00:00") + timedelta(seconds=i * 2)).strftime("%H:%M:%S")
        customer = "hot" if i % 3 == 0 else f"c{i % 7}"
        records.append(record(i, time, customer, location=f"l{i % 5}", device="dev" if i % 2 else f"dev{i % 11}"))
    return records


@pytest.mark.parametrize("rule", [rules.velocity, rules.geolocation, rules.device_sharing])
def test_stream_equals_batch_once_all_windows_are_closed(spark, session, feed, tmp_path, rule):
    records = mixed_records()
    for i in range(0, 400, 100):
        feed.add(*records[i:i + 100], "not json", "")
    feed.add(record(999, "05:00:00", customer="closing", device="closing"))
    feed.add(record(1000, "06:00:00", customer="closing", device="closing"))
    streamed = drain(session, rule(rules.with_watermark(transactions(session, feed))), tmp_path)
    batch = rule(decoded(from_files(spark, str(feed.folder), streaming=False), "transactions"))
    assert rows(streamed) == rows(batch) and batch.count() > 10


def test_a_stream_goes_on_from_its_checkpoint(session, feed, tmp_path):
    feed.add(*[record(i, f"00:00:0{i}") for i in range(3)])
    drain(session, rules.velocity(rules.with_watermark(transactions(session, feed))), tmp_path)
    feed.add(*[record(i, f"00:00:0{i}") for i in range(3, 5)])
    feed.add(record(9, "00:10:00", customer="z"))
    alerts = drain(session, rules.velocity(rules.with_watermark(transactions(session, feed))), tmp_path)
    assert rows(alerts, "txn_count") == [(5,)] * 6
    again = drain(session, rules.velocity(rules.with_watermark(transactions(session, feed))), tmp_path)
    assert again.count() == 6


@pytest.mark.parametrize("dictionary_first", [True, False])
def test_an_entry_flags_transactions_before_and_after_it(session, feed, tmp_path, dictionary_first):
    entries = Feed(tmp_path / "entries")
    run = lambda: drain(
        session,
        rules.blacklisted_customers(transactions(session, feed), decoded(from_files(session, str(entries.folder)), "blacklist_customers"), salts=3),
        tmp_path,
    )
    parts = [
        lambda: entries.add({"customer_id": "a", "description": "one"}, {"customer_id": "a", "description": "two"}, {"description": "no key"}),
        lambda: feed.add(record(1, "00:00:01"), record(2, "00:00:02"), record(3, "00:00:03", customer="b"), record(4, "00:00:04", customer=None)),
    ]
    for part in parts if dictionary_first else parts[::-1]:
        part()
        run()
    assert rows(run(), "transaction_id", "description") == [("TX1", "one"), ("TX1", "two"), ("TX2", "one"), ("TX2", "two")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_large_dictionary_table_is_joined_by_shuffle(spark, session, feed, tmp_path, how):
    feed.add(record(1, "00:00:01"), record(2, "00:00:02", customer="b"))
    feed.add(record(3, "00:00:03"), record(4, "00:00:04", customer=None))
    entries = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], s.BLACKLIST_CUSTOMERS)
    entries.write.parquet(str(tmp_path / "entries"))
    listed = session.read.parquet(str(tmp_path / "entries"))
    df = rules.blacklisted_customers(transactions(session, feed), listed, how=how, broadcast_bytes=0)
    matched = [("TX1", "x"), ("TX1", "y"), ("TX3", "x"), ("TX3", "y")]
    unmatched = [("TX2", None), ("TX4", None)] if how == "left" else []
    assert set(rows(drain(session, df, tmp_path), "transaction_id", "description")) == {*matched, *unmatched}


def test_settings_given_by_the_user_stay(spark, session):
    assert session.conf.get("spark.sql.shuffle.partitions") == "4"
    assert stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_left_join_of_two_streams_is_refused(session, feed):
    feed.add(record(1, "00:00:01"))
    tx = transactions(session, feed)
    with pytest.raises(ValueError, match="two streams"):
        rules.blacklisted_customers(tx, tx.selectExpr("customer_id", "merchant AS description"), how="left")


def test_a_dictionary_table_is_read_anew_per_micro_batch(session, feed, tmp_path):
    table, hits = str(tmp_path / "entries"), str(tmp_path / "hits")
    entry = lambda k: session.createDataFrame([(k, "x")], s.BLACKLIST_CUSTOMERS)
    entry("a").write.parquet(table)

    def write(batch, batch_id):
        batch.write.mode("append").parquet(hits)
        if batch_id == 0:
            entry("b").write.mode("append").parquet(table)

    feed.add(record(1, "00:00:01"), record(2, "00:00:02", customer="b"))
    feed.add(record(3, "00:00:03"), record(4, "00:00:04", customer="b"))
    writer = jobs.match_per_batch(transactions(session, feed), lambda: session.read.parquet(table), "customer_id", write)
    jobs.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert rows(session.read.parquet(hits), "transaction_id") == [("TX1",), ("TX3",), ("TX4",)]


def test_distinct_entries_over_micro_batches(session, tmp_path):
    entries = Feed(tmp_path / "entries")
    for _ in range(2):
        entries.add({"customer_id": "a", "description": "x"}, {"customer_id": "a", "description": "x"}, {"customer_id": "a"})
    df = decoded(from_files(session, str(entries.folder), max_files=1), "blacklist_customers", strict=True)
    assert rows(drain(session, rules.distinct_entries(df), tmp_path)) == [("a", None), ("a", "x")]


def test_distinct_entries_within_a_bound(session, feed, tmp_path):
    feed.add(record(1, "00:00:01"), record(1, "00:00:01"), record(2, "00:00:02"))
    feed.add(record(1, "00:00:01"))
    df = rules.distinct_entries(rules.with_watermark(transactions(session, feed)), within_watermark=True)
    assert rows(drain(session, df, tmp_path), "transaction_id") == [("TX1",), ("TX2",)]


def test_console(session, feed, tmp_path):
    feed.add(record(1, "00:00:01"))
    query = jobs.start(sinks.to_console(transactions(session, feed)), str(tmp_path / "checkpoint"), available_now=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_the_rules_can_be_asked_in_sql(spark):
    tx = driver_tables.transactions(spark, DATA)
    tx.createOrReplaceTempView("transactions")
    windowed = spark.sql("""
        SELECT customer_id, w.start AS window_start, w.end AS window_end, count(*) AS txn_count
        FROM (SELECT customer_id, window(`timestamp`, '1 minute', '10 seconds') AS w FROM transactions)
        GROUP BY customer_id, w HAVING count(*) >= 5""")
    assert rows(windowed) == rows(rules.velocity(tx).drop("alert_message"))


def test_upserts_over_micro_batches(session, feed, tmp_path):
    feed.add(record(1, "00:00:01", location="old"), record(1, "00:00:02", location="newer"))
    feed.add(record(1, "00:00:03", location="newest"), record(2, "00:00:01", location="other"))
    log = UpsertLog(str(tmp_path / "log"), ["transaction_id"], ["timestamp"])
    writer = jobs.for_each_batch(transactions(session, feed), log.write)
    jobs.start(writer, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert rows(log.view(session), "transaction_id", "location") == [("TX1", "newest"), ("TX2", "other")]


def test_landing_a_stream(session, feed, tmp_path):
    feed.add(record(1, "00:00:01"), record(2, "00:00:02", timestamp="2024-01-02 00:00:00"))
    path = str(tmp_path / "landed")
    jobs.start(sinks.land(transactions(session, feed), path, "timestamp"), str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert rows(sinks.landed(session, path, "timestamp", first="2024-01-02"), "transaction_id") == [("TX2",)]


@pytest.mark.parametrize("job", sorted(jobs.JOBS))
def test_every_job_runs_from_the_command_line(spark, tmp_path, job):
    inputs = {
        "transactions": [record(i, f"00:00:0{i}", customer="abcde"[i % 5] if job == "device_alerts" else "a", location=f"l{i}", amount=20_000_000) for i in range(6)]
        + [record(9, "00:20:00", customer="z", device="z"), record(10, "00:40:00", customer="z", device="z")],
        "blacklist_customers": [{"customer_id": "a", "description": "x"}],
        "blacklist_devices": [{"device_id": "d", "description": "x"}],
        "big_amount": [record(1, "00:00:01")],
        "blacklist": [record(1, "00:00:01", label="l", description="x"), "not json"],
    }
    for alerts, key in (("velocity_alerts", "customer_id"), ("geolocation_alerts", "customer_id"), ("device_alerts", "device_id")):
        inputs[alerts] = [{key: "a", "window_start": f"2024-01-01 00:0{i}:00", "window_end": "2024-01-01 00:09:00", "alert_message": "m"} for i in range(3)]
    (tmp_path / "in").mkdir()
    for relation, records in inputs.items():
        feed = Feed(tmp_path / "in" / relation)
        feed.add(*records)
    jobs.main([job, "--files", str(tmp_path / "in"), "--land", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "checkpoint"), "--available-now"])
    expected = {
        "land_transactions": 8, "relational_transactions": 8, "land_big_amount": 1, "land_blacklist": 1, "land_velocity_alerts": 3,
        "land_geolocation_alerts": 3, "land_device_alerts": 3, "big_amount": 6, "blacklist_customers": 6, "blacklist_devices": 6, "velocity_alerts": 6, "geolocation_alerts": 5,
        "device_alerts": 5, "velocity_fraud": 6, "customer_entries": 1, "device_entries": 1, "blacklist_append": 12, "blacklist_customers_append": 6,
    }
    assert spark.read.parquet(str(tmp_path / "out")).count() == expected[job]


def test_checkpoints_of_jobs_are_below_the_shared_folder(spark):
    assert jobs.checkpoint_folder(spark, "velocity_alerts") == spark.conf.get("spark.checkpoint.dir") + "/velocity_alerts"


def test_a_streamed_table_holds_the_rows_of_the_batch_one(spark, session):
    assert driver_tables.transactions_stream(session, DATA).isStreaming
    assert not any(f.dataType.simpleString() == "timestamp_ntz" for f in driver_tables.transactions_stream(session, DATA).schema)


def upserted(spark, tmp_path, job, *more):
    jobs.main([job, "--files", str(tmp_path / "in"), "--upsert", str(tmp_path / "log"), "--checkpoint", str(tmp_path / job), "--available-now", *more])
    return jobs.upsert_log(job, str(tmp_path / "log")).view(spark)


def test_two_jobs_write_one_keyed_blacklist(spark, tmp_path):
    (tmp_path / "in").mkdir()
    Feed(tmp_path / "in" / "transactions").add(record(1, "00:00:01"), record(2, "00:00:02", device="other"))
    Feed(tmp_path / "in" / "blacklist_customers").add({"customer_id": "a", "description": "customer"})
    Feed(tmp_path / "in" / "blacklist_devices").add({"device_id": "d", "description": "device"})
    upserted(spark, tmp_path, "blacklist_devices")
    found = upserted(spark, tmp_path, "blacklist_customers", "--salts", "3")
    assert rows(found, "transaction_id", "description") == [("TX1", "device"), ("TX2", "customer")]


def test_a_keyed_table_from_a_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    big = {"amount": 20_000_000}
    Feed(tmp_path / "in" / "transactions").add(record(1, "00:00:03", location="last", **big), record(1, "00:00:01", location="first", **big))
    assert rows(upserted(spark, tmp_path, "big_amount"), "transaction_id", "location") == [("TX1", "last")]


def placed(session, tmp_path, *messages):
    """Messages with partition and offset, as a topic has them."""
    values = [(json.dumps(r), partition, offset) for r, partition, offset in messages]
    df = session.createDataFrame(values, "value string, partition int, offset long")
    df.coalesce(1).write.parquet(str(tmp_path / "topic"))
    return lambda _: session.readStream.schema(df.schema).parquet(str(tmp_path / "topic"))


@pytest.mark.parametrize("job", ["land_transactions", "big_amount", "relational_transactions"])
def test_rows_carry_the_place_of_their_message(session, tmp_path, job):
    big = {"amount": 20_000_000}
    read = placed(session, tmp_path, (record(1, "00:00:09", location="first", **big), 3, 7), (record(1, "00:00:01", location="last", **big), 3, 8))
    df = jobs.rule_stream(session, job, read, jobs.Options(place=True))
    assert set(df.columns) - set(jobs.rule_stream(session, job, read).columns) == {"partition", "offset"}
    if job in jobs.KEYED:
        log = jobs.upsert_log(job, str(tmp_path / "log"), df.columns)
        jobs.start(jobs.for_each_batch(df, log.write), str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
        assert rows(log.view(session), "transaction_id", "location", "offset") == [("TX1", "last", 8)]
    else:
        assert rows(drain(session, df, tmp_path), "partition", "offset") == [(3, 7), (3, 8)]


def test_of_two_partitions_the_later_message_is_the_last_write(session, tmp_path):
    big = {"amount": 20_000_000}
    values = [(json.dumps(record(1, "00:00:05", location=f"p{p}", **big)), p, offset, at(when)) for p, offset, when in ((0, 900, "00:00:01"), (1, 3, "00:00:09"), (2, 50, "00:00:04"))]
    df = session.createDataFrame(values, "value string, partition int, offset long, arrival timestamp")
    df.write.parquet(str(tmp_path / "topic"))
    read = lambda _: session.readStream.schema(df.schema).parquet(str(tmp_path / "topic"))
    rows_of = jobs.rule_stream(session, "big_amount", read, jobs.Options(place=True))
    for log in (jobs.upsert_log("big_amount", str(tmp_path / "log"), rows_of.columns), jobs.tiered_log("big_amount", str(tmp_path / "tiers"), rows_of.columns)):
        jobs.start(jobs.for_each_batch(rows_of, log.write), f"{log.path}-checkpoint", available_now=True).awaitTermination()
        assert rows(log.view(session), "transaction_id", "location") == [("TX1", "p1")]


def test_windowed_rules_and_messages_have_no_place(session, tmp_path):
    read = placed(session, tmp_path, (record(1, "00:00:09"), 3, 7))
    assert "offset" not in jobs.rule_stream(session, "velocity_alerts", read, jobs.Options(place=True)).columns
    assert jobs.rule_stream(session, "big_amount", read).columns == s.TRANSACTION_COLUMNS


def test_a_log_that_compacts_itself_equals_one_that_does_not(session, tmp_path):
    logs = [UpsertLog(str(tmp_path / name), ["k"], ["o"], compact_every=every) for name, every in (("plain", None), ("short", 2))]
    for batch_id in [*range(7), 6, 7, 7]:
        batch = session.range(batch_id + 1).selectExpr("id % 4 AS k", f"{batch_id} % 3 AS o", f"{batch_id} AS v")
        for log in logs:
            log.write(batch, batch_id)
        plain, short = (rows(log.view(session), "k", "o", "v") for log in logs)
        assert plain == short
    parts = [p for p in os.listdir(logs[1].path + "/writer=0") if p.startswith("batch=")]
    assert len(parts) <= 3 < len(os.listdir(logs[0].path + "/writer=0"))


def test_two_writers_compact_their_own_parts(session, tmp_path):
    first, second = (UpsertLog(str(tmp_path / "log"), ["k"], ["o"], writer) for writer in (0, 1))
    df = session.createDataFrame([("a", 1)], "k string, o int")
    for batch_id in range(3):
        second.write(df.selectExpr("*", f"'second{batch_id}' AS v"), batch_id)
        first.write(df.selectExpr("*", f"'first{batch_id}' AS v"), batch_id)
    first.compact_in_place(session)
    second.compact_in_place(session)
    assert rows(first.view(session), "v") == [("second2",)]


def test_relational_tables_from_jobs(spark, tmp_path, monkeypatch):
    done = []
    monkeypatch.setattr(Database, "stage", lambda self, df, table: done.append((self.properties, table, rows(df))))
    monkeypatch.setattr(Database, "execute", lambda self, session, statement: done.append(statement))
    (tmp_path / "in").mkdir()
    Feed(tmp_path / "in" / "transactions").add(record(1, "00:00:03", location="last"), record(1, "00:00:01", location="first"), record(2, "00:00:01"))
    Feed(tmp_path / "in" / "blacklist_customers").add(*[{"customer_id": "a", "description": d} for d in "xyx"])
    (tmp_path / "properties").write_text("user=u\npassword=p=q\n")
    for job, table in (("relational_transactions", "public.tx"), ("customer_entries", "public.listed")):
        jobs.main([job, "--files", str(tmp_path / "in"), "--relational", "jdbc:x", "--table", table, "--properties", str(tmp_path / "properties"),
                   "--checkpoint", str(tmp_path / job), "--available-now"])
    first, merge, second, _ = done
    assert first[:2] == ({"user": "u", "password": "p=q"}, "public.tx_staging")
    assert [(r[0], r[6]) for r in first[2]] == [("TX1", "last"), ("TX2", "x")]
    assert merge.startswith("INSERT INTO public.tx (") and 'ON CONFLICT ("transaction_id")' in merge
    assert second[2] == [("a", "y")]


def test_landing_writes_few_files_per_date(session, feed, tmp_path):
    feed.add(*[record(i, f"00:00:{i:02}") for i in range(40)])
    spread = transactions(session, feed).repartition(4)
    path = str(tmp_path / "landed")
    jobs.start(sinks.land(spread, path, "timestamp", files=2), str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    found = session.read.parquet(path)
    assert found.count() == 40 and len(found.inputFiles()) <= 2


def test_a_batch_without_rows_replaces_its_part(session, tmp_path):
    log = UpsertLog(str(tmp_path / "log"), ["k"], ["o"])
    df = session.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "k string, o int, v string")
    log.write(df, 6)
    log.write(df.selectExpr("'b' AS k", "o", "v"), 7)
    first = rows(log.view(session))
    assert [r[0] for r in first] == ["a", "b"]
    log.write(df.where("false"), 7)
    assert rows(log.view(session)) == first[:1]
    small = log.compact(session, str(tmp_path / "small"))
    assert rows(small.view(session)) == first[:1]
    small.write(df.selectExpr("k", "o", "'later' AS v"), 8)
    assert rows(small.view(session), "v") == [("later",)]


@pytest.mark.parametrize("arguments", [
    ["land_big_amount", "--servers", "x"], ["velocity_alerts", "--servers", "x", "--upsert", "y"], ["velocity_alerts", "--files", "x"],
    ["big_amount", "--servers", "x", "--topic", "transactions-stream"],
    ["customer_entries", "--servers", "x", "--relational", "jdbc:x"], ["velocity_alerts", "--servers", "x", "--relational", "jdbc:x", "--table", "t"],
])
def test_jobs_that_would_feed_themselves_are_refused(spark, arguments, capsys):
    with pytest.raises(SystemExit):
        jobs.main([*arguments, "--checkpoint", "y"])
    assert "error" in capsys.readouterr().err


@pytest.mark.parametrize(("delay", "complete"), [("1 hour", True), ("5 seconds", False)])
def test_results_do_not_depend_on_the_micro_batch_if_the_delay_suffices(spark, tmp_path, capsys, delay, complete):
    (tmp_path / "in").mkdir()
    feed = Feed(tmp_path / "in" / "transactions")
    for n, minute in enumerate((1, 20, 2, 21, 3, 22, 40)):
        feed.add(*[record(10 * n + i, f"00:{minute:02}:0{i}") for i in range(6)])
    feed.add(record(100, "05:00:00", customer="z"))
    feed.add(record(101, "09:00:00", customer="z"))
    counts = []
    for files in ("1", "1000"):
        jobs.main(["velocity_alerts", "--files", str(tmp_path / "in"), "--land", str(tmp_path / f"out{files}"), "--checkpoint", str(tmp_path / f"c{files}"),
                   "--available-now", "--max-files", files, "--watermark-delay", delay])
        counts.append(spark.read.parquet(str(tmp_path / f"out{files}")).count())
    reported = "behind the watermark" in capsys.readouterr().err
    assert (counts == [42, 42] and not reported) if complete else (counts[0] < 42 and reported)
