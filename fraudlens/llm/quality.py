"""Quality of texts by ordinal regression: one score, and ordered thresholds between the grades.

A cumulative-link model says that a text reaches grade ``k`` with chance ``sigmoid(s - t_k)``, with
``t_1 < t_2 < ...`` and the same score ``s`` for all grades. The score is a sum of weights of the
text's distinct words, hashed to ``FEATURES`` columns, and of its ``SHAPES``. Weights are fitted by
follow the regularised leader, whose L1 penalty leaves words without evidence at zero, on at most
``SAMPLE`` of the distinct rated texts, those of the smallest hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm import words as w
from fraudlens.llm.ftrl import Leader
from fraudlens.llm.storage import free, schema_with, written

FEATURES, SHAPES = 1 << 20, 8
SAMPLE, EPOCHS = 16_384, 4
RATE, L1, L2 = 0.2, 1.0, 0.02
WORD_HASH = 41
ADDED = ("expected_grade", "p_reach", "kept")

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Model(NamedTuple):
    at: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def _plain(values: pa.Array) -> w.Columns:
    """Marks become spaces, so that words are runs of letters and digits."""
    text = w.columns(values)
    return w.Columns(np.where(_ALNUM[text.data], text.data, np.uint8(32)), text.offsets)


def features(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns of each text's distinct words, where each row's begin, and the rows' shapes."""
    raw = w.columns(values)
    (hashed,), first = w.hashes(_plain(values), WORD_HASH, fold_case=True)
    row = w.rows_of(first)
    key = np.unique(row.astype(np.uint64) * np.uint64(FEATURES) + hashed % np.uint64(FEATURES))
    n = len(first) - 1
    bounds = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) * np.uint64(FEATURES))
    words, distinct = np.diff(first).astype(float), np.diff(bounds).astype(float)
    size = np.diff(raw.offsets).astype(float)
    mark = np.concatenate([[0], np.cumsum(~_ALNUM[raw.data] & ~w.SPACE[raw.data])])
    line = np.concatenate([[0], np.cumsum(raw.data == 10)])
    upper = np.concatenate([[0], np.cumsum((raw.data >= 65) & (raw.data <= 90))])
    marks, lines, uppers = (np.diff(x[raw.offsets]).astype(float) for x in (mark, line, upper))
    some = np.maximum(words, 1)
    shapes = np.stack([
        np.ones(n), marks / np.maximum(size, 1) * 5, np.minimum(marks / some, 3), 1 - distinct / some,
        np.log1p(words) / 8, uppers / np.maximum(size, 1) * 5, (lines + 1) / some, (words < 5).astype(float),
    ], axis=1)
    return (key % np.uint64(FEATURES)).astype(np.int64), bounds, shapes


def _slices(batches, text_column: str):
    """Rows of the batches, about a megabyte of text at a time."""
    for batch in batches:
        for row, end in w.slices(w.columns(batch.column(text_column))):
            yield batch.slice(row, end - row)


def _rated(batches):
    for batch in _slices(batches, "text"):
        at, bounds, shapes = features(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("hash"), batch.column("grade"), w.binary(at.astype(np.int32), bounds), w.binary(shapes.reshape(-1), np.arange(len(shapes) + 1) * SHAPES)],
            names=["hash", "grade", "at", "shapes"],
        )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(docs: DataFrame, ratings: DataFrame, id_column: str = "doc_id", text_column: str = "text", grade_column: str = "grade", grades: int = 3, sample: int = SAMPLE) -> Model | None:
    """A model of the documents that ``ratings`` gives grades from 0 to ``grades - 1``; none if there are none.

    At most ``sample`` pairs of a text and a grade are learned from, those of the smallest hashes, each once,
    however many documents or ratings have them. Only hashes of texts are joined with the ratings; the
    chosen pairs, 12 bytes each, are broadcast, and the columns of their words reach the driver.
    """
    rated = ratings.select(F.col(id_column).alias("_id"), F.col(grade_column).cast("int").alias("grade")).where(f"_id is not null and grade between 0 and {grades - 1}")
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text")).where("text is not null").withColumn("hash", F.xxhash64("text"))
    pairs = texts.select("_id", "hash").join(rated, "_id").select("hash", "grade").distinct()
    chosen = written(pairs.orderBy("hash", "grade").limit(sample), "rated")
    learned = texts.select("text", "hash").join(F.broadcast(chosen), "hash").dropDuplicates(["hash", "grade"])
    rows = learned.mapInArrow(_rated, "hash bigint, grade int, at binary, shapes binary").collect()
    found = sorted((r.grade, bytes(r.at), bytes(r.shapes), r.hash) for r in rows)
    if not found:
        return None
    columns, place = np.unique(np.frombuffer(b"".join(x[1] for x in found), np.int32), return_inverse=True)
    bounds = np.cumsum([0] + [len(x[1]) // 4 for x in found])
    words = Leader(len(columns), 1, RATE, L1, L2)
    shape = Leader(SHAPES, 1, RATE, 0.0, 0.001)
    thresholds = np.arange(grades - 1, dtype=float) - (grades - 2) / 2
    steps = np.zeros(grades - 1)
    every = np.arange(SHAPES)
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(found)):
            grade, at = found[i][0], place[bounds[i] : bounds[i + 1]]
            x = np.frombuffer(found[i][2], np.float64)
            some, shaped = words.weights(at), shape.weights()
            reach = _sigmoid(some.sum() + x @ shaped[:, 0] - thresholds)
            # P(grade) is a difference of two neighbouring chances; this is the slope of -log of it.
            inner = reach * (1 - reach)
            edges, slopes = np.concatenate([[1], reach, [0]]), np.concatenate([[0], inner, [0]])
            chance = max(edges[grade] - edges[grade + 1], 1e-9)
            pull = np.clip(-(slopes[grade] - slopes[grade + 1]) / chance, -1, 1)
            push = np.zeros(grades - 1)
            if grade > 0:
                push[grade - 1] += inner[grade - 1] / chance
            if grade < grades - 1:
                push[grade] -= inner[grade] / chance
            words.learn(at, np.full((len(at), 1), pull), some)
            shape.learn(every, (pull * x)[:, None], shaped)
            push = np.clip(push, -1, 1)
            steps += push**2
            thresholds = np.sort(thresholds - 0.1 * push / np.sqrt(1 + steps))
    weights = words.weights()[:, 0]
    used = np.flatnonzero(weights)
    at = np.concatenate([columns[used].astype(np.int64), np.arange(FEATURES, FEATURES + SHAPES)])
    return Model(at, np.concatenate([weights[used], shape.weights()[:, 0]]), thresholds)


def _grade(model: Model | None, text_column: str, names: list[str], least: float):
    def grade(batches):
        weights = np.zeros(FEATURES + SHAPES, np.float32)
        if model:
            weights[model.at] = model.weights
        for batch in _slices(batches, text_column):
            n = batch.num_rows
            values = batch.column(text_column)
            has = np.zeros(n, bool)
            reach = np.zeros((n, len(model.thresholds) if model else 1))
            if model and n:
                at, bounds, shapes = features(values)
                total = np.concatenate([[0], np.cumsum(weights[at], dtype=np.float64)])
                score = np.diff(total[bounds]) + shapes @ weights[FEATURES:].astype(np.float64)
                has = np.diff(bounds) > 0
                reach = _sigmoid(score[:, None] - model.thresholds[None, :]) * has[:, None]
            lists = pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * reach.shape[1]).astype(np.int32)), pa.array(reach.reshape(-1)))
            added = [pa.array(reach.sum(1)), lists, pa.array(has & (reach[:, -1] >= least))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + added, names=names + list(ADDED))

    return grade


def with_quality(rows: DataFrame, model: Model | None, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """All columns and rows with ``expected_grade``, ``p_reach`` (the chances to reach grades 1, 2, ...)
    and ``kept``, whether the last of these is at least ``least``; columns of these names are replaced.

    Texts that are null or have no words get grade 0 and are not kept; so is every text if there were
    no ratings. Whole texts count, however long.
    """
    kept = free(rows, *ADDED)
    return kept.mapInArrow(
        _grade(model, text_column, kept.columns, least), schema_with(kept, "expected_grade double, p_reach array<double>, kept boolean")
    )
