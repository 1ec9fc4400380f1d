from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import at, plan, rows
from pyspark.sql import functions as F

from fraudlens.plans import monitor

SCHEMA = "ts timestamp_ntz, series string, value double, id long"


def sample(spark):
    return spark.createDataFrame(
        [(at("00:00:01"), "a", 1.0, 1), (at("00:00:09"), "a", 3.0, 1), (at("00:00:10"), "b", 5.0, 2), (at("00:00:11").replace(day=2), "c", 7.0, 3)], SCHEMA
    )


def test_left_out_filters_select_everything(spark):
    df = sample(spark)
    assert monitor.in_values(df, "series", None) is df
    assert monitor.in_time(df, "ts") is df and monitor.in_dates(df, "ts") is df
    assert monitor.in_values(df, "series", ["a", "b"], ["b"]).count() == 2


def test_ranges_include_both_ends(spark):
    df = sample(spark)
    assert monitor.in_time(df, "ts", at("00:00:09"), at("00:00:10")).count() == 2
    assert monitor.in_dates(df, "ts", date(2024, 1, 2), date(2024, 1, 2)).count() == 1
    assert monitor.in_dates(df, "ts", last=date(2024, 1, 1)).count() == 3


def test_ranges_reach_the_scan(spark, tmp_path):
    sample(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert "GreaterThanOrEqual(ts" in plan(monitor.in_time(df, "ts", datetime(2024, 1, 1)))
    assert "LessThan(ts" in plan(monitor.in_dates(df, "ts", last=date(2024, 1, 1)))


def test_a_date_column_prunes_and_the_time_decides(spark, tmp_path):
    df = sample(spark).withColumn("day", F.to_date("ts"))
    df.write.partitionBy("day").parquet(str(tmp_path / "days"))
    landed = spark.read.parquet(str(tmp_path / "days"))
    first, last = df.agg(F.min("ts"), F.max("ts")).first()
    chosen = monitor.in_date_time(landed, "day", "ts", first, first)
    assert {r.ts for r in chosen.collect()} == {first} and "PartitionFilters: [isnotnull(day" in plan(chosen)
    assert monitor.in_date_time(landed, "day", "ts", first, last).count() == landed.count()
    assert monitor.in_date_time(landed, "day", "ts").count() == landed.count()


def test_buckets_and_limits(spark):
    found = rows(monitor.counts(sample(spark), "ts", "series", "10 seconds"))
    assert found[0] == (at("00:00:00"), "a", 2) and len(found) == 3
    assert monitor.counts(sample(spark), "ts", "series", "10 seconds", limit=1).count() == 1
    assert monitor.page(sample(spark), ["id"], limit=2).count() == 2
    assert monitor.averages(sample(spark), "ts", "series", "value", "1 minute").first()["avg_value"] == 2.0


@pytest.mark.parametrize("n", [1, 7, 100, 9_000, 1_000_000])
@pytest.mark.parametrize("partitions", [1, 64])
def test_quantiles_are_exact(spark, n, partitions):
    df = spark.range(n, numPartitions=partitions).selectExpr(
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "if(id % 3 = 0, 'a', 'b') AS series", f"cast(pmod(hash(id), 100 * {n}) AS double) AS value"
    )
    none = df.selectExpr("ts", "CAST(NULL AS STRING) AS series", "CAST(NULL AS DOUBLE) AS value").limit(2)
    found = monitor.quantiles(df.union(none), "ts", "series", "value", "1 hour")
    exact = df.groupBy("series").agg(F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY value)"))
    assert rows(found, "series", "p99") == [(None, None), *rows(exact)]


def test_series_are_not_cut(spark):
    df = spark.range(120_000).selectExpr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + id * INTERVAL 1 SECOND AS ts", "'a' AS series")
    assert monitor.counts(df, "ts", "series", "1 second").count() == 120_000


def test_summaries_take_the_label_of_the_first_row(spark):
    df = spark.createDataFrame(
        [(at("00:00:05"), "late", 9.0, 1, 1), (at("00:00:01"), "second", 1.0, 1, 3), (at("00:00:01"), "first", 2.0, 1, 2), (at("00:00:01"), "x", 9.0, 0, 4)],
        SCHEMA + ", tie long",
    )
    assert [tuple(r) for r in monitor.summaries(df, "id", "ts", "series", "value", "tie").collect()] == [
        (at("00:00:01"), 0, "x", 9.0), (at("00:00:01"), 1, "first", 9.0),
    ]


def test_json_tags(spark):
    df = spark.createDataFrame([('{"k": 1, "m": "x"}',)], "props string")
    assert df.select(monitor.json_tags("props").alias("t")).first()["t"] == [{"key": "k", "value": "1"}, {"key": "m", "value": "x"}]


def test_rollup_counts_alerts_per_rule(spark):
    one, two = sample(spark), sample(spark).where("series = 'a'")
    rolled = monitor.alert_rollup({"one": (one, "ts"), "two": (two, "ts")}, "1 day")
    day = at("00:00:00")
    assert rows(rolled) == [("one", day, 3), ("one", day + timedelta(days=1), 1), ("two", day, 2)]
