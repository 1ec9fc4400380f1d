from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import at, plan, rows
from fraudlens import schemas as s
from fraudlens.operators.joins import dictionary_join, measured_bytes
from fraudlens.operators.latest import latest_by_key
from fraudlens.plans import rules
from fraudlens.session import create_session, drop_if_present, register_if_absent, require_utc, shared_folder
from fraudlens.sources.messages import kafka_read_options
from fraudlens.streaming import sinks
from fraudlens.streaming.upsert import UpsertLog, merge_sql


@pytest.fixture(scope="module")
def tx(spark):
    customers = ["a"] * 40 + ["b", "c", None]
    data = [(f"TX{i}", c, 1, "x", "m", "p", f"d{i % 3}", at("00:00:01"), i) for i, c in enumerate(customers)]
    return spark.createDataFrame(data, s.TRANSACTIONS.simpleString().removeprefix("struct<").removesuffix(">") + ", seq long")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("a", "one"), ("a", "two"), ("a", "two"), ("b", None), (None, "none"), ("z", "z")], s.BLACKLIST_CUSTOMERS)


@pytest.fixture(scope="module")
def devices(spark):
    return spark.createDataFrame([("d0", "dev")], s.BLACKLIST_DEVICES)


def test_each_dictionary_row_gives_a_row_and_null_matches_nothing(tx, customers):
    hits = rules.blacklisted_customers(tx, customers)
    assert hits.columns == s.BLACKLIST_COLUMNS
    assert hits.count() == 40 * 3 + 1
    assert {r["label"] for r in hits.collect()} == {"blacklist customer"}
    assert rules.blacklisted_devices(tx, customers.selectExpr("customer_id AS device_id", "description"), label="x").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("salts", [None, 1, 5])
def test_join_beyond_the_broadcast_size_gives_the_same_rows(spark, tx, customers, how, salts):
    small = dictionary_join(tx, customers, ["customer_id"], how)
    large = dictionary_join(tx, customers, ["customer_id"], how, broadcast_bytes=0, salts=salts)
    assert "Broadcast" in plan(small)
    assert rows(large, *small.columns) == rows(small)
    assert "Broadcast" not in plan(large) and "SortMergeJoin" in plan(large)


def test_a_small_file_does_not_make_a_large_dictionary_a_broadcast(spark, tx, customers, tmp_path):
    customers.write.parquet(str(tmp_path / "entries"))
    stored = spark.read.parquet(str(tmp_path / "entries"))
    for salts in (1, 4):
        assert "Broadcast" not in plan(dictionary_join(tx, stored, ["customer_id"], broadcast_bytes=0, salts=salts))


def test_the_salt_splits_a_group_of_equal_rows(spark):
    copies = spark.range(8000, numPartitions=8).selectExpr("'a' AS customer_id", "1 AS x")
    entries = spark.createDataFrame([("a", "one")], s.BLACKLIST_CUSTOMERS)
    joined = dictionary_join(copies, entries, ["customer_id"], broadcast_bytes=0, salts=8)
    assert joined.count() == 8000
    assert "SPARK_PARTITION_ID()" in plan(joined)


def test_left_join_keeps_every_transaction(tx, customers):
    joined = rules.blacklisted_customers(tx, customers, how="left")
    assert joined.count() == 40 * 3 + 1 + 2
    assert joined.where("description IS NULL").count() == 3


def test_measured_bytes_bounds_the_texts(spark):
    df = spark.createDataFrame([("k" * 100, "é" * 50), (None, None)], "a string, b string")
    assert 200 <= measured_bytes(df) <= 500
    assert measured_bytes(df.limit(0)) == 0
    with pytest.raises(ValueError, match="no size bound"):
        measured_bytes(df.select(F.array("a").alias("a")))


def test_unknown_join(tx, customers):
    with pytest.raises(ValueError, match="inner or left"):
        dictionary_join(tx, customers, ["customer_id"], "full")


def test_both_blacklists_in_one_pass(tx, customers, devices):
    both = rules.blacklist_hits(tx, customers, devices).select(*s.BLACKLIST_COLUMNS)
    apart = rules.blacklisted_customers(tx, customers).unionByName(rules.blacklisted_devices(tx, devices))
    assert rows(both) == rows(apart)
    assert plan(both).count("Scan ExistingRDD[transaction_id") == 1
    large = rules.blacklist_hits(tx, customers, devices, broadcast_bytes=0)
    assert rows(large, *s.BLACKLIST_COLUMNS) == rows(apart)
    assert {r["_writer"] for r in large.where("description = 'dev'").collect()} == {1}


def test_device_hits_win_over_customer_hits_in_the_keyed_table(tx, customers, devices):
    latest = rules.blacklist_latest(tx, customers, devices, "seq")
    found = {r["transaction_id"]: r["description"] for r in latest.collect()}
    assert len(found) == latest.count()
    assert found["TX0"] == "dev" and found["TX1"] == "two" and found["TX40"] is None and found["TX42"] == "dev"
    assert "TX41" not in found


def test_latest_row_per_key(spark):
    df = spark.createDataFrame([("x", 1, "old"), ("x", 3, "new"), ("x", 2, "mid"), ("y", 1, "y"), (None, 5, "n")], "id string, seq int, v string")
    latest = latest_by_key(df, ["id"], [F.col("seq")])
    assert rows(latest, "id", "v") == [(None, "n"), ("x", "new"), ("y", "y")]


def test_only_the_best_row_per_key_and_task_is_shuffled(spark):
    df = spark.range(10).selectExpr("id % 3 AS id", "id AS seq")
    text = plan(latest_by_key(df, ["id"], [F.col("seq")]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_upsert_log_is_the_same_after_a_batch_is_run_again(spark, tmp_path):
    log = UpsertLog(str(tmp_path / "log"), ["id"], ["seq"])
    first = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("y", 1, "c")], "id string, seq int, v string")
    second = spark.createDataFrame([("x", 3, "d"), ("z", 1, "e")], "id string, seq int, v string")
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        log.write(batch, number)
    expected = [("x", 3, "d"), ("y", 1, "c"), ("z", 1, "e")]
    assert rows(log.view(spark)) == expected
    assert spark.read.parquet(log.path).count() == 4
    compacted = log.compact(spark, str(tmp_path / "compacted"))
    assert rows(compacted.view(spark)) == expected
    compacted.write(spark.createDataFrame([("x", 9, "f")], "id string, seq int, v string"), 2)
    assert rows(compacted.view(spark))[0] == ("x", 9, "f")


def test_merge_statement():
    assert merge_sql("public.t", "public.s", ["id", "a", "b"], ["id"]) == (
        'INSERT INTO public.t ("id", "a", "b") SELECT "id", "a", "b" FROM public.s '
        'ON CONFLICT ("id") DO UPDATE SET "a" = EXCLUDED."a", "b" = EXCLUDED."b"'
    )
    assert merge_sql("t", "s", ["id"], ["id"]).endswith("DO NOTHING")


def test_landing_table_is_read_by_date(spark, tmp_path):
    path = str(tmp_path / "landed")
    df = spark.createDataFrame([("a", at("00:00:01")), ("b", at("00:00:01").replace(day=2)), ("c", at("00:00:01").replace(day=3))], "id string, at timestamp_ntz")
    sinks.land(df, path, "at")
    sinks.land(df.where("id = 'a'"), path, "at")
    assert rows(sinks.landed(spark, path, "at"), "id") == [("a",), ("a",), ("b",), ("c",)]
    part = sinks.landed(spark, path, "at", first="2024-01-02", last="2024-01-02")
    assert rows(part, "id") == [("b",)]
    assert "PartitionFilters: [isnotnull(date" in plan(part)


def test_output_keys(spark):
    df = spark.createDataFrame([("d1", 5)], "device_id string, n long")
    assert sinks.messages(df, "device_alerts").first()["key"] == '{"device_id":"d1"}'
    assert sinks.messages(df, "device_alerts_append").columns == ["value"]


def test_kafka_options():
    assert kafka_read_options("h:1", "t", group="g", max_offsets=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "kafka.group.id": "g", "maxOffsetsPerTrigger": "5",
    }
    assert "kafka.group.id" not in kafka_read_options("h:1", "t")
    assert sinks.kafka_write_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_views_are_registered_once(spark, customers):
    assert register_if_absent(customers, "listed_once")
    assert not register_if_absent(customers.limit(0), "listed_once")
    assert spark.table("listed_once").count() == 6
    assert drop_if_present(spark, "listed_once")
    assert not drop_if_present(spark, "listed_once")


def test_shared_folder_follows_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(base + "/x-")
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_batch_partitions_follow_the_size_of_the_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name)
    assert int(before) == 4 * spark.sparkContext.defaultParallelism
    create_session(input_bytes=100 << 40)
    assert int(spark.conf.get(name)) == 100 << 40 >> 27
    spark.conf.set(name, before)


def test_session_zone_is_checked(spark):
    require_utc(spark)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    with pytest.raises(ValueError, match="zone"):
        require_utc(other)
