"""One reading for all rules, and panels from sums that a stream keeps."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from math import ceil

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fraudlens import schemas as s
from fraudlens.plans import monitor, rules
from fraudlens.streaming import files, jobs
from fraudlens.streaming.fanout import FanOut
from fraudlens.streaming.rollup import Rollup, cell
from fraudlens.streaming.tiered import LandedTable
from test_streaming import Feed, drain, feed, mixed_records, record, session, transactions  # noqa: F401


def fan_out(tmp_path, writes, fail=()):
    tables = {name: LandedTable(str(tmp_path / name), "timestamp") for name in ("copy", "big")}

    def write(name):
        def run(df, batch_id):
            if (name, batch_id) in fail:
                fail.remove((name, batch_id))
                raise RuntimeError("this sink is down")
            writes.append((name, batch_id))
            tables[name].write(df, batch_id)

        return run

    found = {"copy": (lambda tx: rules.copy(tx, s.TRANSACTION_COLUMNS), write("copy")), "big": (rules.big_amount, write("big"))}
    return FanOut(str(tmp_path / "fan"), s.TRANSACTIONS, found), tables


def run(session, fan, tx, tmp_path):
    jobs.start(jobs.for_each_batch(tx, fan.write), str(tmp_path / "checkpoint"), available_now=True).awaitTermination()


def test_rules_go_on_where_one_failed(session, feed, tmp_path):
    for i in range(3):
        feed.add(record(i, f"00:00:0{i}", amount=20_000_000))
    writes = []
    fan, tables = fan_out(tmp_path, writes, fail=[("big", 1)])
    with pytest.raises(Exception, match="this sink is down"):
        run(session, fan, transactions(session, feed), tmp_path)
    assert writes == [("copy", 0), ("big", 0), ("copy", 1)]
    stored = files.list_names(session, str(tmp_path / "fan" / "decoded"))
    run(session, fan, transactions(session, feed), tmp_path)
    assert writes[3:] == [("big", 1), ("copy", 2), ("big", 2)] and len(stored) == 2
    for table in tables.values():
        assert rows(table.read(session), "transaction_id") == [("TX0",), ("TX1",), ("TX2",)]
    assert rows(drain(session, fan.stream(session), tmp_path), "transaction_id") == [("TX0",), ("TX1",), ("TX2",)]
    fan.forget(session, 2)
    assert files.list_names(session, str(tmp_path / "fan" / "decoded")) == [f"{2:012}"]


def test_windowed_rules_read_what_was_decoded_once(session, feed, tmp_path):
    records = mixed_records()
    for i in range(0, 400, 100):
        feed.add(*records[i:i + 100], "not json")
    feed.add(record(999, "05:00:00", customer="closing"))
    fan, _ = fan_out(tmp_path, [])
    tx = transactions(session, feed)
    run(session, fan, tx, tmp_path)
    decoded = fan.stream(session, 1)
    assert "from_json" not in decoded._jdf.queryExecution().analyzed().toString()
    alerts = drain(session, rules.velocity(rules.with_watermark(decoded)), tmp_path)
    batch = rules.velocity(session.createDataFrame(session.read.schema(s.TRANSACTIONS).parquet(str(tmp_path / "fan" / "decoded" / "*")).collect(), s.TRANSACTIONS))
    assert rows(alerts) == rows(batch.where("window_end < '2024-01-01 04:00:00'")) and alerts.count() > 5


VALUES = [0.0, -0.0, 1.0, 1.0001, -1.0, -1.0001, 1e-300, 5e-324, -5e-324, 1e300, float("inf"), float("-inf"), float("nan"), 0.1, 0.2, None]


def test_cells_are_in_the_order_of_values(spark):
    draw = random.Random(1)
    values = VALUES + [draw.choice([-1, 1]) * draw.random() * 10 ** draw.randrange(-20, 20) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = df.select("v", cell(F.col("v")).alias("c")).where("v IS NOT NULL").orderBy("v").collect()
    assert all(a.c <= b.c for a, b in zip(found, found[1:], strict=False)) and df.where(F.col("v").isNull()).select(cell(F.col("v"))).first()[0] is None


def plain_panels(events, step):
    groups = defaultdict(list)
    for at, kind, value in events:
        groups[at - (at - datetime(2024, 1, 1)) % step, kind].append(value)
    p99 = {}
    for key, values in groups.items():
        known = sorted(v for v in values if v is not None)
        if known:
            p99[key] = known[max(1, ceil(0.99 * len(known))) - 1]
    return {k: len(v) for k, v in groups.items()}, p99


def test_panels_from_sums_equal_those_from_events(session, tmp_path):
    draw = random.Random(2)
    events = [
        (datetime(2024, 1, 1) + timedelta(seconds=draw.randrange(3 * 86400)), draw.choice(["a", "b", None]), draw.choice([None, 0.0, 3.5, draw.gauss(0, 100)]))
        for _ in range(900)
    ]
    rollup = Rollup(str(tmp_path / "rollup"), "kind", "at_time", "value", fanout=2, files=1)
    for batch_id in [0, 1, 2, 2, 0]:
        part = session.createDataFrame(events[batch_id::3], "at_time timestamp_ntz, kind string, value double")
        rollup.write(part, batch_id)
    counts, p99 = plain_panels(events, timedelta(hours=6))
    assert {(r.time, r.kind): r.n for r in rollup.counts(session, "6 hours").collect()} == counts
    assert {(r.time, r.kind): r.p99 for r in rollup.quantiles(session, "6 hours").collect()} == p99
    whole = session.createDataFrame(events, "at_time timestamp_ntz, kind string, value double")
    means = {(r.time, r.kind): round(r.avg_value, 8) for r in rollup.averages(session, "1 day").collect() if r.avg_value is not None}
    assert means == {(r.time, r.kind): round(r.avg_value, 8) for r in monitor.averages(whole, "at_time", "kind", "value", "1 day").collect() if r.avg_value is not None}
    # A range of one day reads the parts of that day.
    day = {"first": datetime(2024, 1, 2), "last": datetime(2024, 1, 2, 23, 59)}
    one = rollup.counts(session, "6 hours", **day)
    assert all("2024-01-02" in f for f in one.inputFiles()) and {(r.time, r.kind): r.n for r in one.collect()} == {k: n for k, n in counts.items() if k[0].day == 2}
    assert {(r.time, r.kind): r.p99 for r in rollup.quantiles(session, "6 hours", **day).collect()} == {k: v for k, v in p99.items() if k[0].day == 2}
    with pytest.raises(ValueError, match="not made of"):
        rollup.counts(session, "90 seconds")
