"""What the plans must look like for the rules to hold at a thousand times the data."""

from __future__ import annotations

import re

import pytest

from conftest import DATA, plan
from fraudlens.catalogue import QUERIES
from fraudlens.plans import rules

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", text)
    # The greatest value of the whole table, or the ends of a range of cells, are found per task first, and then among those.
    assert ("SinglePartition" in text) == (name in ("panel_detail", "panel_p99_rolled_up"))


def exchanges(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", text))


@pytest.mark.parametrize("name, shuffles", [
    ("big_amount", 0), ("tx_copy", 0), ("decode_lenient_records", 0), ("blacklist_customers", 0),
    # Of the two dictionaries, not of the transactions.
    ("blacklist_append", 2),
    ("velocity_alerts", 1), ("geolocation_alerts", 2), ("device_alerts", 2), ("tx_latest_by_id", 1), ("dictionary_distinct", 1),
    # Sketches, rows per value near the quantile, and these per group.
    ("panel_p99", 3), ("panel_top", 1),
])
def test_number_of_shuffles(spark, name, shuffles):
    assert exchanges(plan(QUERIES[name](spark, DATA))) == shuffles


@pytest.mark.parametrize("name, columns", [
    ("velocity_alerts", {"ts", "user_id"}), ("geolocation_alerts", {"ts", "user_id", "props"}), ("panel_counts", {"ts", "event_type"}),
    ("panel_distinct", {"event_type"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, DATA)))
    assert {c.split(":")[0] for part in read for c in part.split(",")} == columns


def test_the_rollup_reads_the_events_once(spark):
    text = plan(QUERIES["alert_rollup"](spark, DATA))
    assert "events.parquet" not in text and text.count("/transactions-") >= 5
    assert "GreaterThan(amount,10000000)" in text


def test_stored_amounts_are_filtered_in_the_scan(spark, tmp_path):
    QUERIES["tx_copy"](spark, DATA).write.parquet(str(tmp_path / "tx"))
    text = plan(rules.big_amount(spark.read.parquet(str(tmp_path / "tx"))))
    assert "PushedFilters: [IsNotNull(amount), GreaterThan(amount,10000000)]" in text


def test_computed_amounts_are_filtered_in_the_scan_by_the_stored_value(spark):
    assert "GreaterThan(value,99.0)" in plan(QUERIES["big_amount"](spark, DATA))


def test_windows_are_counted_before_the_shuffle(spark):
    for name in ("velocity_alerts", "geolocation_alerts", "device_alerts"):
        text = plan(QUERIES[name](spark, DATA))
        assert text.count("partial_count") >= 1 and "Expand" not in text
