"""Rows once, by a table of those that were seen."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import rows
from fraudlens.streaming import jobs
from fraudlens.streaming.seen import SeenRows
from test_streaming import session  # noqa: F401


def test_rows_are_seen_once(session, tmp_path):
    draw = random.Random(4)
    table, told = SeenRows(str(tmp_path / "t"), ("a", "b"), fanout=2, buckets=3, keep=3), set()
    for batch_id in [0, 1, 2, 2, 3, 4, 5, 1]:
        batch = [(draw.choice([None, "", "x", "y", f"k{draw.randrange(30)}"]), draw.choice([None, 1, draw.randrange(5)]), "ignored") for _ in range(20 * (batch_id != 4))]
        if batch_id > table.manifest.read(session).batches.get("0", -1):
            told |= {r[:2] for r in batch}
        table.write(session.createDataFrame(batch, "a string, b long, c string"), batch_id)
        assert rows(table.read(session)) == sorted(told, key=lambda r: [(v is not None, str(v)) for v in r])
    state = table.manifest.read(session)
    assert state.written == len(told) and len(state.parts) <= 5
    # Nulls in different places are different rows.
    table.write(session.createDataFrame([("n", None), (None, 9)], "a string, b long"), 6)
    assert table.read(session).where("a = 'n' OR b = 9").count() == 2


def test_new_rows_read_little_of_the_table(session, tmp_path):
    table = SeenRows(str(tmp_path / "t"), ("a",), buckets=4)
    table.write(session.range(2000).select(F.col("id").alias("a")), 0)
    state = table.manifest.read(session)

    def met(first, last):
        return table._met(session, table._placed(session.range(first, last).select(F.col("id").alias("a"))), state)

    found = met(0, 2000)
    assert sorted(b for _, b in found) == [0, 1, 2, 3]
    # Of new rows, a bit in some sixty is set here.
    assert sum(len(met(10_000 + 4 * i, 10_004 + 4 * i)) for i in range(6)) <= 3
    assert len(met(5, 6)) == 1


def test_a_stream_of_repeated_rows_keeps_no_state(session, tmp_path):
    for i in range(3):
        session.range(10 * i, 10 * i + 20).selectExpr("concat('k', id) AS k").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = SeenRows(str(tmp_path / "t"), ("k",), buckets=2)
    stream = session.readStream.schema("k string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = jobs.start(jobs.for_each_batch(stream, table.write), str(tmp_path / "checkpoint"), available_now=True)
    query.awaitTermination()
    assert table.read(session).count() == 40 and all(not p["stateOperators"] for p in query.recentProgress)
