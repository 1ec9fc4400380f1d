"""Language of texts: multinomial logistic regression on TF-IDF of character n-grams.

Characters are lower-cased, and all but letters count as spaces. Runs of one to three characters are
hashed to ``FEATURES`` columns. Document frequencies are counted over all labelled rows given for
learning; the weights are fitted by follow the regularised leader, with elastic-net penalties, on
at most ``SAMPLE`` pairs of a text and a label, each once, those of the smallest hashes; a temperature,
fitted on the fifth of the sample that the weights have not seen, makes the scores probabilities.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm import words as w
from fraudlens.llm.ftrl import Leader
from fraudlens.llm.storage import free, schema_with, written

ORDERS, FEATURES = 3, 1 << 14
SAMPLE, EPOCHS = 4096, 3
RATE, L1, L2 = 0.5, 0.05, 0.01
ROWS = 256
UNKNOWN = "und"
ADDED = ("lang_pred", "score")


class Model(NamedTuple):
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float


@cache
def _characters() -> np.ndarray:
    """The lower-case form of every letter, a space for all else."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            low = letter.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def _counts(values: pa.Array):
    """Row numbers from and to, a matrix of n-gram counts, and the number of letters, for parts of a column."""
    text = w.columns(values)
    for begin, stop in w.slices(text):
        for row in range(begin, stop, ROWS):
            end = min(stop, row + ROWS)
            data = text.data[text.offsets[row] : text.offsets[end]]
            codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            sizes = np.diff(lead[text.offsets[row : end + 1] - text.offsets[row]])
            codes = _characters()[codes]
            owner = np.repeat(np.arange(end - row), sizes)
            letters = np.bincount(owner[codes != 32], minlength=end - row)
            keys = []
            hashed = np.zeros(len(codes), np.uint64)
            for order in range(ORDERS):
                n = max(0, len(codes) - order)
                hashed = hashed[:n] * np.uint64(0x100000001B3) + codes[order:].astype(np.uint64) + np.uint64(1)
                same = owner[:n] == owner[order:]
                column = (w.mix(hashed[same] + np.uint64(order)) % np.uint64(FEATURES)).astype(np.int64)
                keys.append(owner[:n][same] * FEATURES + column)
            found = np.bincount(np.concatenate(keys), minlength=(end - row) * FEATURES)
            yield row, end, found.reshape(-1, FEATURES), letters


def _tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts.astype(np.float32)) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _frequencies(sample: int):
    """Of each task: rows by feature (-1: all rows), and the smallest hashes of rows with letters."""

    def frequencies(batches):
        total, rows, least = np.zeros(FEATURES, np.int64), 0, np.zeros(0, np.int64)
        for batch in batches:
            hashes = batch.column("hash").to_numpy(zero_copy_only=False)
            for row, end, counts, letters in _counts(batch.column("text")):
                total += (counts > 0).sum(0)
                rows += end - row
                least = np.union1d(least, hashes[row:end][letters > 0])[:sample]
        some = np.flatnonzero(total)
        feature, n = np.append(some, -1).astype(np.int32), np.append(total[some], rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([feature, np.zeros(len(least), np.int32)])), pa.array(np.concatenate([n, np.zeros(len(least), np.int64)])),
                pa.concat_arrays([pa.nulls(len(n), pa.int64()), pa.array(least)]),
            ],
            names=["feature", "n", "hash"],
        )

    return frequencies


def _features(idf: np.ndarray):
    """Each hash once a task."""

    def features(batches):
        seen: set[int] = set()
        for batch in batches:
            fresh = []
            for i, h in enumerate(batch.column("hash").to_pylist()):
                if h not in seen:
                    seen.add(h)
                    fresh.append(i)
            if not fresh:
                continue
            batch = batch.take(pa.array(fresh))
            hashes, labels = batch.column("hash"), batch.column("label")
            for row, end, counts, letters in _counts(batch.column("text")):
                rows = np.flatnonzero(letters > 0)
                matrix = _tfidf(counts[rows], idf)
                at = [np.flatnonzero(x).astype(np.int32) for x in matrix]
                yield pa.RecordBatch.from_arrays(
                    [
                        hashes.slice(row, end - row).take(pa.array(rows)),
                        labels.slice(row, end - row).take(pa.array(rows)).cast(pa.string()),
                        pa.array([a.tobytes() for a in at], pa.binary()),
                        pa.array([x[a].tobytes() for a, x in zip(at, matrix, strict=True)], pa.binary()),
                    ],
                    names=["hash", "label", "at", "x"],
                )

    return features


def _softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(-1, keepdims=True))
    return out / out.sum(-1, keepdims=True)


def fit(rows: DataFrame, text_column: str = "text", label_column: str = "lang", sample: int = SAMPLE) -> Model | None:
    """A model of the rows with a text and a label; none if there are none with letters.

    At most ``sample`` texts with letters reach the driver, as sparse features: those of the smallest
    hashes of text and label, however many rows hold them.
    """
    learn = rows.select(F.col(text_column).cast("string").alias("text"), F.col(label_column).cast("string").alias("label")).where("text is not null and label is not null")
    learn = learn.withColumn("hash", F.xxhash64("text", "label"))
    counted = written(learn.select("text", "hash").mapInArrow(_frequencies(sample), "feature int, n bigint, hash bigint"), "language")
    found = counted.where("hash is null").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    frequency = {r.feature: r.n for r in found}
    total = frequency.pop(-1, 0)
    if not total:
        return None
    counts = np.zeros(FEATURES)
    counts[list(frequency)] = list(frequency.values())
    idf = np.where(counts > 0, np.log((1 + total) / (1 + counts)) + 1, 0).astype(np.float32)
    least = counted.where("hash is not null").select("hash").distinct().orderBy("hash").limit(sample)
    chosen = learn.join(F.broadcast(least), "hash", "left_semi").select("text", "label", "hash")
    examples = chosen.mapInArrow(_features(idf), "hash bigint, label string, at binary, x binary").dropDuplicates(["hash"]).collect()
    if not examples:
        return None
    # In an order that does not depend on tasks.
    examples = sorted((r.label, bytes(r.at), bytes(r.x)) for r in examples)
    labels = sorted({e[0] for e in examples})
    points = [(labels.index(y), np.frombuffer(a, np.int32), np.frombuffer(x, np.float32).astype(float)) for y, a, x in examples]
    order = np.random.default_rng(7).permutation(len(points))
    held, seen = order[: len(points) // 5], order[len(points) // 5 :]
    leader = Leader(FEATURES, len(labels), RATE, L1, L2)
    for _ in range(EPOCHS):
        for i in seen:
            y, at, x = points[i]
            weights = leader.weights(at)
            wrong = _softmax(x @ weights)
            wrong[y] -= 1
            leader.learn(at, x[:, None] * wrong[None, :], weights)
    weights = leader.weights()
    scores = np.array([points[i][2] @ weights[points[i][1]] for i in held]).reshape(len(held), len(labels))
    truth = np.array([points[i][0] for i in held], int)

    def loss(temperature: float) -> float:
        return -float(np.log(_softmax(scores / temperature)[np.arange(len(truth)), truth] + 1e-12).mean())

    temperature = min(np.geomspace(0.05, 5, 60), key=loss) if len(truth) else 1.0
    return Model(labels, idf, weights.astype(np.float32), float(temperature))


def _predict(model: Model | None, text_column: str, names: list[str]):
    def predict(batches):
        for batch in batches:
            labels, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if model:
                for row, end, counts, letters in _counts(batch.column(text_column)):
                    chance = _softmax((_tfidf(counts, model.idf) @ model.weights).astype(float) / model.temperature)
                    best = chance.argmax(1)
                    for r in np.flatnonzero(letters > 0):
                        labels[row + r] = model.labels[best[r]]
                        scores[row + r] = chance[r, best[r]]
            added = [pa.array(labels, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + added, names=names + list(ADDED))

    return predict


def with_language(rows: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """All columns and rows with ``lang_pred``, a label of the model, and ``score``, its probability;
    columns of these names are replaced.

    Texts that are null or have no letters are ``und`` with a score of 0, and so is every text where
    there was nothing to learn from. Whole texts count, however long.
    """
    kept = free(rows, *ADDED)
    return kept.mapInArrow(_predict(model, text_column, kept.columns), schema_with(kept, "lang_pred string, score double"))
