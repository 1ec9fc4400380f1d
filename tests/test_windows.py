from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import at, rows
from fraudlens.functions.times import seconds
from fraudlens.operators.windows import hop, hop_count, hop_distinct
from fraudlens.plans import rules

EPOCH = datetime(1970, 1, 1)
SCHEMA = "key string, value string, ts timestamp_ntz"


def starts(ts: datetime, size: int, slide: int) -> list[datetime]:
    micros = (ts - EPOCH) // timedelta(microseconds=1)
    last = micros // (slide * 1_000_000) * slide
    return [EPOCH + timedelta(seconds=last - i * slide) for i in range(size // slide)]


def brute_counts(data, size, slide):
    return Counter((k, w) for k, _, ts in data if ts for w in starts(ts, size, slide))


def brute_distinct(data, size, slide):
    seen = defaultdict(set)
    for k, v, ts in data:
        if ts and v is not None:
            for w in starts(ts, size, slide):
                seen[k, w].add(v)
    return {key: len(values) for key, values in seen.items()}


def result(df, name):
    return {(r["key"], r["window_start"]): r[name] for r in df.collect()}


times = st.one_of(
    st.none(),
    st.datetimes(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 12)).map(lambda t: t.replace(microsecond=t.microsecond // 1000 * 1000)),
    st.sampled_from([at("00:01:00"), at("00:00:59.999"), at("00:05:00"), datetime(1969, 12, 31, 23, 59, 55), EPOCH]),
)
records = st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, "x", "y", "z"]), times), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=records, shape=st.sampled_from([("1 minute", "10 seconds"), ("5 minutes", "1 minute"), ("30 seconds", "30 seconds")]), windows=st.sampled_from([None, 1, 4, 58]))
def test_batch_windows_equal_brute_force(spark, data, shape, windows):
    df = spark.createDataFrame(data, SCHEMA)
    size, slide = map(seconds, shape)
    assert result(hop_count(df, ["key"], "ts", *shape, "n", windows=windows), "n") == brute_counts(data, size, slide)
    assert result(hop_distinct(df, ["key"], "value", "ts", *shape, "n", windows=windows), "n") == brute_distinct(data, size, slide)


def test_one_key_with_a_third_of_all_rows_and_many_copies(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(50)}", f"v{rng.randrange(20)}", at("00:00:00") + timedelta(seconds=rng.randrange(900))) for i in range(6000)]
    data += [("hot", "copy", at("00:07:00"))] * 2000
    df = spark.createDataFrame(data, SCHEMA)
    counts = {k: n for k, n in brute_counts(data, 60, 10).items() if n >= 5}
    assert result(hop_count(df, ["key"], "ts", "1 minute", "10 seconds", "n", minimum=5), "n") == counts
    distinct = {k: n for k, n in brute_distinct(data, 300, 60).items() if n >= 4}
    assert result(hop_distinct(df, ["key"], "value", "ts", "5 minutes", "1 minute", "n", minimum=4), "n") == distinct


def test_every_row_is_in_size_over_slide_windows(spark):
    df = spark.range(500).selectExpr("'a' AS key", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + id * INTERVAL '7' SECOND AS ts")
    assert hop_count(df, ["key"], "ts", "1 minute", "10 seconds", "n").agg(F.sum("n")).first()[0] == 6 * 500
    assert hop(df, "ts", "5 minutes", "1 minute").count() == 5 * 500


def test_a_row_at_the_end_of_a_window_is_in_the_next(spark):
    df = spark.createDataFrame([("a", "x", at("00:01:00"))], SCHEMA)
    ends = {r["window_start"] + timedelta(minutes=1) for r in hop_count(df, ["key"], "ts", "1 minute", "10 seconds", "n").collect()}
    assert at("00:01:00") not in ends and at("00:01:10") in ends


def test_first_window_starts_before_the_row(spark):
    df = spark.createDataFrame([("a", "x", at("00:00:30"))], SCHEMA)
    found = sorted(r["window_start"] for r in hop_count(df, ["key"], "ts", "1 minute", "10 seconds", "n").collect())
    assert found[0] == datetime(2023, 12, 31, 23, 59, 40) and found[-1] == at("00:00:30") and len(found) == 6


def test_instants_give_the_same_windows(spark):
    df = spark.createDataFrame([("a", "x", at("00:00:30"))] * 3, SCHEMA)
    as_instant = hop_count(df.withColumn("ts", F.col("ts").cast("timestamp")), ["key"], "ts", "1 minute", "10 seconds", "n")
    assert rows(as_instant) == rows(hop_count(df, ["key"], "ts", "1 minute", "10 seconds", "n"))


def test_size_must_be_a_multiple_of_slide(spark):
    df = spark.createDataFrame([("a", "x", at("00:00:30"))], SCHEMA)
    with pytest.raises(ValueError, match="multiple"):
        hop(df, "ts", "1 minute", "7 seconds")
    with pytest.raises(ValueError, match="multiple"):
        hop_count(df, ["key"], "ts", "1 minute", "7 seconds", "n")
    for wrong in ("1 month", "0 seconds", "soon"):
        with pytest.raises(ValueError, match="duration"):
            seconds(wrong)


TX = "transaction_id string, customer_id string, amount long, location string, device_id string, timestamp timestamp_ntz"


def tx(spark, data):
    return spark.createDataFrame([(f"TX{i}", c, 1, place, device, at(t)) for i, (c, place, device, t) in enumerate(data)], TX)


def test_velocity_threshold(spark):
    four = [("a", "x", "d", f"00:00:0{i}") for i in range(4)]
    assert rules.velocity(tx(spark, four)).count() == 0
    five = four + [("a", "x", "d", "00:00:04")]
    # A burst of five rows within one slide alerts in each of the six windows around it.
    assert rows(rules.velocity(tx(spark, five)), "txn_count") == [(5,)] * 6
    over_a_slide = [("a", "x", "d", f"00:00:{i:02}") for i in range(8, 13)]
    assert rules.velocity(tx(spark, over_a_slide)).count() == 5


def test_velocity_counts_null_customers_as_one_group(spark):
    assert {r["customer_id"] for r in rules.velocity(tx(spark, [(None, "x", "d", "00:00:01")] * 5)).collect()} == {None}


def test_geolocation_threshold(spark):
    assert rules.geolocation(tx(spark, [("a", "x", "d", "00:00:01"), ("a", "x", "d", "00:00:09"), ("a", None, "d", "00:00:05")])).count() == 0
    assert rows(rules.geolocation(tx(spark, [("a", "x", "d", "00:00:01"), ("a", "y", "d", "00:04:59")])), "distinct_locations") == [(2,)]
    assert rules.geolocation(tx(spark, [("a", "x", "d", "00:00:01"), ("a", "y", "d", "00:05:00")])).count() == 0


def test_places_differ_by_case_unless_normalised(spark):
    df = tx(spark, [("a", "Jakarta", "d", "00:00:01"), ("a", "jakarta ", "d", "00:00:02")])
    assert rules.geolocation(df).count() == 5
    assert rules.geolocation(rules.normalise_places(df, "location")).count() == 0


def test_device_threshold(spark):
    three = [(c, "x", "d", "00:00:01") for c in "aab"] + [("c", "x", "d", "00:00:02"), (None, "x", "d", "00:00:03")]
    assert rules.device_sharing(tx(spark, three)).count() == 0
    assert rows(rules.device_sharing(tx(spark, three + [("e", "x", "d", "00:00:04")])), "distinct_customers") == [(4,)] * 5


@pytest.mark.parametrize(("size", "slide"), [("1 hour", "1 minute"), ("90 minutes", "1 minute"), ("64 seconds", "1 second")])
def test_windows_of_many_panes_equal_plain_windows(spark, size, slide):
    df = spark.range(40).selectExpr("concat('k', id % 3) AS key", "concat('v', id % 7) AS value", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + (id * id * 40) * INTERVAL 1 SECOND AS ts")
    plain = hop(df, "ts", size, slide).groupBy("key", "window_start", "window_end")
    counted = plain.agg(F.count("*").alias("n")).where("n >= 2")
    assert rows(hop_count(df, ["key"], "ts", size, slide, "n", 2).select(counted.columns)) == rows(counted)
    distinct = plain.agg(F.count_distinct("value").alias("n")).where("n >= 2")
    assert rows(hop_distinct(df, ["key"], "value", "ts", size, slide, "n", 2).select(distinct.columns)) == rows(distinct)


def test_a_day_of_minutes(spark):
    df = spark.range(50).selectExpr("'k' AS key", "id % 5 AS value", "TIMESTAMP_NTZ'2024-01-01 00:00:30' + id * INTERVAL 1 MINUTE AS ts")
    found = hop_count(df, ["key"], "ts", "1 day", "1 minute", "n")
    assert found.agg(F.sum("n"), F.max("n"), F.min("window_start")).first() == (50 * 1440, 50, datetime(2023, 12, 31, 0, 1))
    assert hop_distinct(df, ["key"], "value", "ts", "1 day", "1 minute", "n").agg(F.max("n"), F.count("*")).first() == (5, 1440 + 49)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=records, shape=st.sampled_from([("70 seconds", "1 second"), ("2 minutes", "1 second"), ("11 minutes", "10 seconds")]), minimum=st.sampled_from([1, 2]))
def test_long_windows_equal_brute_force(spark, data, shape, minimum):
    df = spark.createDataFrame(data, SCHEMA)
    size, slide = map(seconds, shape)

    def enough(found):
        return {k: n for k, n in found.items() if n >= minimum}

    assert result(hop_count(df, ["key"], "ts", *shape, "n", minimum), "n") == enough(brute_counts(data, size, slide))
    assert result(hop_distinct(df, ["key"], "value", "ts", *shape, "n", minimum), "n") == enough(brute_distinct(data, size, slide))


def test_long_windows_change_at_most_twice_per_pane_and_value(spark):
    """A value seen every minute of a day counts in one stretch: one change where it begins, one behind its end."""
    df = spark.range(1440).selectExpr("'a' AS key", "'x' AS value", "TIMESTAMP_NTZ'2024-01-01' + id * INTERVAL '1' MINUTE AS ts")
    for size, first in (("1 day", 1439), ("90 minutes", 89)):
        found = hop_distinct(df, ["key"], "value", "ts", size, "1 minute", "n")
        assert found.agg(F.count("*"), F.min("n"), F.max("n")).first() == (1440 + first, 1, 1)
        text = found._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Generate") == 2 and "sequence" in text.split("Generate")[1]
