"""What learns from a sample has a hard bound, what deals into shards keeps them even, and models predict as plainly computed."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shipping import shipped  # noqa: F401
from fraudlens.llm import packing, quality, words as w

WORDS = [f"word{i}" for i in range(400)]


def rated_texts(spark, n, seed=1):
    rng = random.Random(seed)
    docs = [(i, " ".join(rng.choices(WORDS[: 200 if i % 3 else 400], k=20)) + (" bad" * (i % 3 == 0))) for i in range(n)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, 0 if i % 3 == 0 else 2) for i in range(n)], "doc_id long, grade int")


@pytest.fixture
def learned(monkeypatch):
    """Numbers of examples that models were fitted on."""
    seen = []
    monkeypatch.setattr(quality.np.random, "default_rng", Counting(quality.np.random.default_rng, seen))
    return seen


class Counting:
    def __init__(self, make, seen):
        self.make, self.seen = make, seen

    def __call__(self, *seed):
        rng, seen = self.make(*seed), self.seen

        class Seen:
            def permutation(self, n):
                seen.append(n)
                return rng.permutation(n)

            def __getattr__(self, name):
                return getattr(rng, name)

        return Seen()


@pytest.mark.parametrize("many", ["documents", "ratings", "both", "copies"])
def test_quality_learns_from_at_most_its_sample(spark, learned, many):
    docs, ratings = rated_texts(spark, 300)
    if many in ("documents", "both"):
        # A third of all documents with one id, of different texts.
        docs = docs.unionByName(spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("again "), "id").alias("text")))
    if many in ("ratings", "both"):
        ratings = ratings.unionByName(spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), (F.col("id") % 3).cast("int").alias("grade")))
    if many == "copies":
        docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
        ratings = docs.select("doc_id", F.lit(1).alias("grade"))
    model = quality.fit(docs, ratings, sample=100)
    assert model is not None and set(learned) == ({1} if many == "copies" else {100})


def test_quality_learns_while_any_rating_matches(spark):
    docs, _ = rated_texts(spark, 2000)
    one = spark.createDataFrame([(1234, 2), (-1, 0), (None, 1)], "doc_id long, grade int")
    assert quality.fit(docs, one, sample=1) is not None
    assert quality.fit(docs, one.where("doc_id < 0"), sample=1) is None


def test_quality_predicts_as_plainly_computed(spark):
    docs, ratings = rated_texts(spark, 200)
    model = quality.fit(docs, ratings)
    weights = dict(zip(model.at.tolist(), model.weights.tolist(), strict=True))
    texts = ["word1 word2 word1 bad", "Hello, WORLD! 12 times?\nnew line", "", None, "!!! ...", "bad " * 300, "é☃ ñandú word3"]
    found = quality.with_quality(spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, kept string"), model)

    def column(word):
        (hashed,), _ = w.hashes(w.columns(pa.array([word])), quality.WORD_HASH, fold_case=True)
        return int(hashed[0] % np.uint64(quality.FEATURES))

    for r in found.collect():
        raw = (texts[r.doc_id] or "").encode()
        bare = re.sub(rb"[^0-9A-Za-z\x80-\xff]", b" ", raw).split()
        distinct = {b.lower() for b in bare}
        marks = len(re.findall(rb"[^0-9A-Za-z\x80-\xff\x20\t\n\v\f\r]", raw))
        uppers, lines, n, size = len(re.findall(rb"[A-Z]", raw)), raw.count(b"\n"), max(len(bare), 1), max(len(raw), 1)
        shapes = [1, marks / size * 5, min(marks / n, 3), 1 - len(distinct) / n, math.log1p(len(bare)) / 8, uppers / size * 5, (lines + 1) / n, float(len(bare) < 5)]
        score = sum(weights.get(c, 0.0) for c in {column(b.decode()) for b in distinct})
        score += sum(x * weights[quality.FEATURES + i] for i, x in enumerate(shapes))
        reach = [1 / (1 + math.exp(t - score)) if bare else 0.0 for t in model.thresholds]
        assert r.p_reach == pytest.approx(reach, abs=1e-5) and r.expected_grade == pytest.approx(sum(reach), abs=1e-5)
        assert r.kept == (bool(bare) and reach[-1] >= 0.5)


@pytest.mark.parametrize("rows", ["without id", "of one id", "copies without id", "long"])
def test_shards_are_even(spark, rows):
    size = packing.SHARD
    text = F.concat(F.lit("text "), "id")
    half = spark.range(5 * size // 2)
    docs = half.select(F.col("id").alias("doc_id"), text.alias("text"), F.concat(F.lit("s"), F.col("id") % 9).alias("source"))
    others = {
        "without id": half.select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("other "), "id").alias("text"), F.lit("s").alias("source")),
        "of one id": half.select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("other "), "id").alias("text"), F.lit("s").alias("source")),
        "copies without id": half.select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same").alias("text"), F.lit("s").alias("source")),
        # Pieces of long documents count as the others do.
        "long": spark.range(20).select((F.col("id") + 10**6).alias("doc_id"), F.repeat(F.concat(F.lit("w"), "id", F.lit(" ")), 2048 * size // 8).alias("text"), F.lit("s").alias("source")),
    }[rows]
    found = packing.packed(docs.unionByName(others))
    shards = Counter(r[0] for r in found.select((F.col("bin_id") / (1 << 24)).cast("long")).collect())
    counts = sorted(shards.values())
    assert len(counts) >= 4 and counts[-1] < 2 * counts[len(counts) // 2]


def test_intermediate_tables_go_once_their_result_is_written(spark, tmp_path):
    import os

    import corpus_pipeline
    from conftest import DATA
    from fraudlens.llm import storage

    before = storage.made()
    result = corpus_pipeline.run(spark, DATA)
    base = spark.conf.get("spark.checkpoint.dir")
    folders = [f.removeprefix(f"{base}/") for f in storage._made[before:]]
    # Of four stages the last one, and what the packing itself has written.
    assert sum(f.startswith("pipeline-") for f in folders) == 1 and folders[0].startswith("pipeline-pii") and len(folders) <= 3
    assert result.count() > 0
    storage.remove(spark, before)
    assert storage.made() == before and not any(os.path.exists(f"{base}/{f}") for f in folders)
