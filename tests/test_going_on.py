"""Streams that go on: partitions in their own order, strict lateness, seams, tables kept small, heavy keys."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fraudlens.operators.joins import dictionary_join, heavy_keys
from fraudlens.plans import rules
from fraudlens.sources.messages import decoded, from_files
from fraudlens.streaming import files, jobs, lanes, seam, watch
from fraudlens.streaming.manifest import Manifest, full_tiers, size_tier
from fraudlens.streaming.tiered import LandedTable, TieredLog
from test_streaming import Feed, drain, feed, late_case, mixed_records, record, session, transactions  # noqa: F401

CLOSING = [("05:00:00", 100), ("09:00:00", 101)]


def partitioned(folder, minutes_of):
    """A feed per partition: a burst of six rows a minute, and two closing rows."""
    folder.mkdir(parents=True)
    feeds = []
    for number, minutes in enumerate(minutes_of):
        part = Feed(folder / f"partition={number}")
        for minute in minutes:
            part.add(*[record(10 * minute + i, f"00:{minute:02}:0{i}") for i in range(6)])
        for time, i in CLOSING:
            part.add(record(i, time, customer="z"))
        feeds.append(part)
    return feeds


# --- the least watermark ---


@pytest.mark.parametrize("job, alerts", [("velocity_alerts", 42), ("velocity_fraud", 42)])
def test_partitions_out_of_step_lose_nothing_at_any_size_of_micro_batch(spark, tmp_path, capsys, job, alerts):
    partitioned(tmp_path / "in" / "transactions", [(1, 2, 3), (20, 21, 22, 40)])
    found = []
    for number in ("1", "2", "1000"):
        jobs.main([job, "--files", str(tmp_path / "in"), "--land", str(tmp_path / f"out{number}"), "--checkpoint", str(tmp_path / f"c{number}"),
                   "--available-now", "--max-files", number, "--by-partition"])
        found.append(rows(spark.read.parquet(str(tmp_path / f"out{number}")), "customer_id", "window_start"))
    assert found[0] == found[1] == found[2] and len(found[0]) == alerts
    assert "behind the watermark" not in capsys.readouterr().err


def test_a_silent_partition_holds_windows_back_until_its_heartbeat(session, tmp_path):
    first, second = partitioned(tmp_path / "in", [(1, 2), ()])
    for file in second.folder.iterdir():
        file.write_text("")
    beats = lanes.Heartbeats(str(tmp_path / "beats"))
    beats.open(session, 2)

    def run():
        read = [decoded(m, "transactions") for m in lanes.file_lanes(session, str(tmp_path / "in"), 1)]
        return rows(drain(session, rules.velocity(lanes.timed(read, heartbeats=beats)), tmp_path), "customer_id", "txn_count")

    assert run() == []
    # A stream that starts again hears of the first partition again, too.
    beats.send(session, 1, "2024-01-01 05:00:00")
    first.add(record(102, "05:00:01", customer="z"))
    found = run()
    assert len(found) == 12 and found == [("a", 6)] * 12


def test_heartbeats_of_lanes_that_were_silent_long_enough(spark, tmp_path):
    clock = SimpleNamespace(now=0.0)
    sent = []
    beats = SimpleNamespace(send=lambda session, number, time: sent.append((number, time)))
    watcher = lanes.IdleLanes(spark, beats, ["in/partition=0", "in/partition=1"], 10, now=lambda: clock.now)

    def progress(at, latest, *delivered):
        clock.now = at
        sources = [SimpleNamespace(description=f"FileStreamSource[file:/in/partition={i}]", numInputRows=int(i in delivered)) for i in range(2)]
        watcher.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(eventTime={"max": latest} if latest else {}, sources=sources)))

    progress(0, "2024-01-01T00:00:05.000Z", 0)
    progress(9, "2024-01-01T00:00:07.000Z", 0)
    assert sent == []
    progress(11, "2024-01-01T00:00:09.000Z", 0)
    assert sent == [(1, "2024-01-01 00:00:09.000")]
    progress(12, None)
    clock.now = 30
    watcher.onQueryIdle(None)
    assert sent == [(1, "2024-01-01 00:00:09.000"), (0, "2024-01-01 00:00:09.000")]
    progress(31, "2024-01-01T00:00:20.000Z", 1)
    assert sent[2:] == [(0, "2024-01-01 00:00:20.000")]


def test_kafka_lanes_read_a_partition_each(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(lanes, "from_kafka", lambda spark, options: asked.append(options))
    lanes.kafka_lanes(spark, "h:1", "t", 3, "g", 10)
    assert [json.loads(o["assign"]) for o in asked] == [{"t": [0]}, {"t": [1]}, {"t": [2]}]
    assert all("subscribe" not in o and o["maxOffsetsPerTrigger"] == "4" and o["startingOffsets"] == "earliest" for o in asked)


def test_lanes_need_the_least_watermark(session, feed):
    session.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    with pytest.raises(ValueError, match="least"):
        lanes.timed([transactions(session, feed)])
    with pytest.raises(ValueError, match="partition="):
        lanes.file_lanes(session, str(feed.folder))


# --- strict lateness with values spread over partitions ---


def strict_alerts(session, df, tmp_path):
    jobs.strict_lateness(session)
    table = LandedTable(str(tmp_path / "alerts"), "window_start")
    writer = jobs.for_each_batch(rules.geolocation_values(rules.with_watermark(df)), lambda batch, i: table.write(rules.geolocation_of_values(batch), i))
    jobs.start(writer, str(tmp_path / "strict"), available_now=True).awaitTermination()
    return table.read(session)


def test_strict_lateness_by_value(session, feed, tmp_path):
    late_case(feed)
    alerts = strict_alerts(session, transactions(session, feed), tmp_path)
    found = rows(alerts.where("customer_id = 'a' AND window_end BETWEEN '2024-01-01 00:02:00' AND '2024-01-01 00:05:00'"), "distinct_locations")
    assert found == [(2,)] * 4


def test_by_value_equals_batch_and_has_no_large_state_row(spark, session, feed, tmp_path):
    records = mixed_records()
    for i in range(0, 400, 100):
        feed.add(*records[i:i + 100])
    feed.add(record(998, "00:13:30", customer="only null", location=None))
    feed.add(record(999, "05:00:00", customer="closing"), record(1000, "06:00:00", customer="closing"))
    streamed = strict_alerts(session, transactions(session, feed), tmp_path)
    batch = rules.geolocation(decoded(from_files(spark, str(feed.folder), streaming=False), "transactions"))
    assert rows(streamed) == rows(batch) and batch.count() > 10
    plan = rules.device_sharing_values(rules.with_watermark(transactions(session, feed)))._jdf.queryExecution().analyzed().toString()
    assert "collect_set" not in plan


def test_a_strict_job_from_the_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    late_case(Feed(tmp_path / "in" / "transactions"))
    jobs.main(["geolocation_alerts", "--files", str(tmp_path / "in"), "--append", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "c"), "--available-now",
               "--max-files", "1", "--strict-lateness"])
    found = LandedTable(str(tmp_path / "out"), "window_start").read(spark).where("customer_id = 'a' AND window_end BETWEEN '2024-01-01 00:02:00' AND '2024-01-01 00:05:00'")
    assert rows(found, "distinct_locations") == [(2,)] * 4


# --- dropped rows ---


def test_dropped_rows_are_told_while_the_job_runs():
    said = []
    listener = watch.DroppedRows(said.append)
    for batch, dropped in enumerate((0, 3, 0, 4)):
        operators = [SimpleNamespace(numRowsDroppedByWatermark=dropped)]
        listener.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(id="q", batchId=batch, stateOperators=operators)))
    assert listener.total == 7 and len(said) == 2 and "3 so far" in said[0] and "7 so far" in said[1]


# --- a batch and the stream that goes on ---


BURST = [f"00:10:{i:02}" for i in range(0, 50, 5)]


@pytest.mark.parametrize("job, split, more", [
    ("velocity_alerts", 3, []), ("velocity_alerts", 9, []), ("geolocation_alerts", 5, []), ("device_alerts", 5, ["--strict-lateness"]),
])
def test_a_seam_inside_a_burst(spark, tmp_path, job, split, more):
    (tmp_path / "in").mkdir()
    part = Feed(tmp_path / "in" / "transactions")
    told = [record(i, time, customer=f"c{i % 6}" if job == "device_alerts" else "a", location=f"l{i % 4}") for i, time in enumerate(BURST)]
    part.add(record(90, "00:01:00"), *[record(91 + i, f"00:04:0{i}", location=f"l{i}", customer=f"d{i}") for i in range(5)])
    part.add(*told[:split])

    def run():
        jobs.main([job, "--files", str(tmp_path / "in"), "--append", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "c"), "--available-now",
                   "--max-files", "1", "--backfill", *more])

    run()
    batches = Manifest(str(tmp_path / "out")).read(spark).batches
    assert batches["0"] >= -1
    part.add(*told[split:])
    run()
    part.add(record(200, "05:00:00", customer="z", device="z"))
    part.add(record(201, "09:00:00", customer="z", device="z"))
    run()
    table = LandedTable(str(tmp_path / "out"), "window_start").read(spark)
    whole = jobs.WINDOWED[job].rule(decoded(from_files(spark, str(tmp_path / "in" / "transactions"), streaming=False), "transactions"))
    assert rows(table) == rows(whole.where("window_end < '2024-01-01 06:00:00'")) and table.count() >= 5


def test_a_seam_without_a_past(session, tmp_path):
    (tmp_path / "in").mkdir()
    part = Feed(tmp_path / "in" / "transactions")
    told = seam.kept_file_seam(session, str(tmp_path / "kept"), str(part.folder))
    part.add(record(1, "00:00:01"))
    raw = from_files(session, str(part.folder), streaming=False)
    assert told == seam.FileSeam(None) and told.past(raw).count() == 0 and told.follow(raw).count() == 1
    assert seam.kept_file_seam(session, str(tmp_path / "kept"), str(part.folder)) == told


def test_files_of_the_same_moment_are_on_one_side(session, tmp_path):
    (tmp_path / "in").mkdir()
    part = Feed(tmp_path / "in" / "transactions")
    part.add(record(1, "00:00:01"))
    told = seam.file_seam(session, str(part.folder))
    part.number = 0
    part.folder.joinpath("0000.json").rename(part.folder / "kept.json")
    told = seam.file_seam(session, str(part.folder))
    part.add(record(2, "00:00:02"))
    raw = from_files(session, str(part.folder), streaming=False)
    assert told.past(raw).count() == 1 and told.follow(raw).count() == 1


def test_offsets_of_a_seam(spark):
    read = spark.createDataFrame([(0, 5), (0, 6), (2, 1)], "partition int, offset long")
    assert json.loads(seam.kafka_offsets(read, "t")) == {"t": {"0": 7, "2": 2}}
    assert json.loads(seam.kafka_offsets(read, "t", 4)) == {"t": {"0": 7, "1": 0, "2": 2, "3": 0}}


# --- tables that are kept small ---


def test_size_tiers():
    assert [size_tier(n, 4) for n in (1, 3, 4, 15, 16, 64)] == [0, 0, 1, 1, 2, 3]
    assert full_tiers((), 2) == []


def test_a_tiered_log_rewrites_by_the_logarithm(session, tmp_path):
    log = TieredLog(str(tmp_path / "log"), ["k"], ["o"], fanout=2, buckets=2)
    states = []
    for batch_id in range(16):
        batch = session.range(batch_id * 10, batch_id * 10 + 10).selectExpr("id AS k", f"{batch_id} AS o", "id * 2 AS v")
        log.write(batch, batch_id)
        states.append(log.manifest.read(session))
    log.write(batch, batch_id)
    last = states[-1]
    assert rows(log.view(session), "k", "v") == rows(session.range(160).selectExpr("id AS k", "id * 2 AS v"))
    # Each row is rewritten once for each doubling of the table.
    assert last.written == 160 and last.rewritten <= 160 * 5 and max(len(st.parts) for st in states) <= 4
    # The rows of one key are found in its bucket.
    assert rows(log.rows_of(session, [(7,), (100,), (999,)]), "k", "v") == [(100, 200), (7, 14)]
    # A reader that holds an older manifest still finds its parts.
    assert log.view(session, states[-6]).count() == 110


def test_a_tiered_log_is_the_last_row_per_key(session, tmp_path):
    logs = [TieredLog(str(tmp_path / "log"), ["k"], ["o"], writer, fanout=2, buckets=3) for writer in (0, 1)]
    plain = []
    for batch_id in range(6):
        for writer, log in enumerate(logs):
            told = [(f"k{(batch_id * 7 + i + writer) % 5}", batch_id % 3, f"{writer}-{batch_id}-{i}") for i in range(batch_id % 4)]
            plain += [(k, o, writer, batch_id, v) for k, o, v in told]
            log.write(session.createDataFrame(told, "k string, o int, v string"), batch_id)
    best = {}
    for k, o, writer, batch_id, v in plain:
        best.setdefault(k, []).append((o, writer, batch_id, v))
    found = {r.k: r for r in logs[0].view(session).collect()}
    assert set(found) == set(best)
    for k, told in best.items():
        top = max(t[:3] for t in told)
        assert (found[k].o, found[k].v) in {(t[0], t[3]) for t in told if t[:3] == top}
    assert logs[0].manifest.read(session).batches == {"0": 5, "1": 5}


def test_writers_of_one_manifest_wait_for_each_other(session, tmp_path):
    manifest = Manifest(str(tmp_path / "t"))
    tried = []

    def noted(state, writer):
        return replace(state, batches={**state.batches, writer: 5})

    def change(state):
        if not tried:
            tried.append(state.version)
            manifest.commit(session, lambda other: noted(other, "1"))
        return noted(state, "0")

    manifest.commit(session, change)
    assert manifest.read(session).batches == {"0": 5, "1": 5} and manifest.read(session).version == 1


def test_what_no_manifest_names_is_deleted(session, tmp_path):
    log = TieredLog(str(tmp_path / "log"), ["k"], ["o"], fanout=2, buckets=1, keep=4)
    for batch_id in range(12):
        log.write(session.createDataFrame([(batch_id % 3, batch_id)], "k int, o int"), batch_id)
    assert len(files.list_names(session, str(tmp_path / "log" / "_manifests"))) <= log.manifest.keep + 2
    named = {p.name for p in log.manifest.read(session).parts}
    assert len(files.list_names(session, str(tmp_path / "log" / "parts"))) < 10 and len(named) <= 3
    assert rows(log.view(session)) == [(0, 9), (1, 10), (2, 11)]


def test_a_landed_table_has_few_files_per_date(session, tmp_path):
    table = LandedTable(str(tmp_path / "t"), "at", fanout=3, files=2)
    for batch_id in [*range(7), 6, 3]:
        told = [(batch_id * 10 + i, f"2024-01-0{1 + i % 2} 00:00:00" if i else None) for i in range(6)]
        table.write(session.createDataFrame(told, "id long, at string").withColumn("at", F.col("at").cast("timestamp")), batch_id)
    assert rows(table.read(session), "id") == sorted([(b * 10 + i,) for b in range(7) for i in range(6)], key=str)
    state = table.manifest.read(session)
    assert all(sum(p.group == day for p in state.parts) <= 4 for day in ("2024-01-01", "2024-01-02", "none"))
    second = table.read(session, first=date(2024, 1, 2))
    assert second.count() == 21 and all("2024-01-02" in f for f in second.inputFiles())
    assert table.read(session, last=date(2023, 1, 1)).count() == 0


def test_a_tiered_table_from_a_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    part = Feed(tmp_path / "in" / "transactions")
    for i in range(5):
        part.add(record(i % 2, f"00:00:0{i}", location=f"at {i}", amount=20_000_000))
    jobs.main(["big_amount", "--files", str(tmp_path / "in"), "--upsert", str(tmp_path / "log"), "--tiers", "2", "--checkpoint", str(tmp_path / "c"), "--available-now", "--max-files", "1"])
    log = jobs.tiered_log("big_amount", str(tmp_path / "log"), fanout=2)
    assert rows(log.view(spark), "transaction_id", "location") == [("TX0", "at 4"), ("TX1", "at 3")]
    assert len(log.manifest.read(spark).parts) <= 3


# --- heavy keys ---


def test_heavy_keys_are_those_that_fill_a_partition(spark):
    sample = spark.range(1000).select(F.when(F.col("id") < 400, "hot").when(F.col("id") < 500, "warm").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    assert heavy_keys(sample.unionByName(spark.createDataFrame([(None,)] * 500, "k string")), "k", 8) == {"hot": 13}
    assert heavy_keys(sample, "k", 20) == {"hot": 32, "warm": 8}
    assert heavy_keys(sample.limit(0), "k", 8) == {}


def test_only_heavy_keys_are_copied(session, feed, tmp_path):
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "true")
    entries = Feed(tmp_path / "entries")
    entries.add(*[{"customer_id": f"c{i}", "description": "x"} for i in range(40)], {"customer_id": "hot", "description": "y"})
    feed.add(*[record(i, f"00:00:{i % 60:02}", customer="hot" if i % 2 else f"c{i % 50}") for i in range(200)])
    listed = decoded(from_files(session, str(entries.folder)), "blacklist_customers")
    found = {}
    for name, options in (("heavy", {"heavy": {"hot": 8}}), ("all", {"salts": 8}), ("none", {"heavy": {}})):
        df = rules.blacklisted_customers(transactions(session, feed), listed, **options)
        query = df.writeStream.format("memory").queryName(f"joined_{name}").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination()
        state = max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
        found[name] = (rows(session.table(f"joined_{name}"), "transaction_id", "description"), state)
    assert found["heavy"][0] == found["all"][0] == found["none"][0] and len(found["all"][0]) == 180
    assert [found[n][1] for n in ("none", "heavy", "all")] == [241, 248, 528]


def test_heavy_keys_of_a_batch_join(spark):
    tx = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), (None, 2)], "k string, v int")
    listed = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "k string, d string")
    for how in ("inner", "left"):
        found = dictionary_join(tx, listed, ["k"], how, broadcast_bytes=0, heavy={"a": 5})
        assert rows(found, "k", "v", "d") == rows(tx.join(listed, "k", how), "k", "v", "d")
    with pytest.raises(ValueError, match="one column"):
        dictionary_join(tx, listed.withColumn("v", F.lit(1)), ["k", "v"], broadcast_bytes=0, heavy={"a": 5})


def test_heavy_keys_are_found_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    part = Feed(tmp_path / "in" / "transactions")
    part.add(*[record(i, f"00:00:{i:02}", customer="hot") for i in range(30)], record(99, "00:01:00", customer="b"))
    Feed(tmp_path / "in" / "blacklist_customers").add({"customer_id": "hot", "description": "d"}, {"customer_id": "b", "description": "e"})

    def run():
        jobs.main(["blacklist_customers", "--files", str(tmp_path / "in"), "--upsert", str(tmp_path / "log"), "--checkpoint", str(tmp_path / "c"), "--available-now", "--heavy-keys", "1000"])
        return jobs.upsert_log("blacklist_customers", str(tmp_path / "log")).view(spark).count()

    assert run() == 31
    kept = json.loads(files.read_text(spark, f"{tmp_path}/c-job/heavy.json"))
    part.add(*[record(i, f"00:02:{i % 60:02}", customer="b") for i in range(200, 500)], record(501, "00:03:00", customer="hot"))
    assert run() == 332 and set(kept["customer_id"]) == {"hot"}
    assert json.loads(files.read_text(spark, f"{tmp_path}/c-job/heavy.json")) == kept


@pytest.mark.parametrize("arguments", [
    ["velocity_alerts", "--servers", "x", "--by-partition"], ["big_amount", "--files", "x", "--land", "y", "--by-partition"],
    ["velocity_alerts", "--files", "x", "--land", "y", "--backfill"], ["velocity_alerts", "--files", "x", "--land", "y", "--idle-after", "5"],
    ["device_alerts", "--files", "x", "--land", "y", "--strict-lateness"], ["velocity_alerts", "--files", "x", "--append", "y", "--strategy", "by_value"],
    ["big_amount", "--files", "x", "--land", "y", "--heavy-keys", "5"], ["customer_entries", "--files", "x", "--append", "y"],
    ["velocity_alerts", "--files", "x", "--append", "y", "--backfill", "--by-partition"],
])
def test_options_that_do_not_go_together(spark, arguments, capsys):
    with pytest.raises(SystemExit):
        jobs.main([*arguments, "--checkpoint", "y"])
    assert "error" in capsys.readouterr().err
