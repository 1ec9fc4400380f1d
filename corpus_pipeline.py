"""A training corpus from documents: known language, no near duplicates, no repeated passages, no personal data, packed."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.llm import language, near_dedup, packing, pii, substring_dedup
from fraudlens.llm.storage import made, remove, ship, written

# Below this many times the probability of chance (1 by the number of languages), a language counts as unknown.
LEAST_LIFT = 1.2


# What the stages read; other columns are carried along under names that no operator uses.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _stage(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that returns the columns of its documents, with ``n_chars`` of the text that is left."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        others = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        done = work(docs.withColumnsRenamed(others))
        size = F.char_length("text").cast("bigint")
        return done.withColumn("n_chars", size).select(*[F.col(others.get(c, c)).alias(c) for c in docs.columns])

    return run


@_stage
def known_language(docs: DataFrame) -> DataFrame:
    """Documents of a known language; a missing one is filled in. The rest goes: null texts, texts
    without letters, and texts of which no language is likely. Where no row has a language to learn
    from, all documents pass as they are; where there is only one, all with letters do."""
    model = language.fit(docs)
    if model is None:
        return docs
    found = language.with_language(docs, model)
    least = min(1.0, LEAST_LIFT / len(model.labels))
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred"))


@_stage
def distinct_documents(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return near_dedup.without_near_duplicates(docs, percent=80)


@_stage
def distinct_passages(docs: DataFrame) -> DataFrame:
    """Documents without the passages that one with a smaller id has; texts that lose nothing stay as they are."""
    return substring_dedup.remove_repeats(docs)


@_stage
def without_personal_data(docs: DataFrame) -> DataFrame:
    """Documents with the kind in place of each piece of personal data."""
    return pii.with_personal_data(docs, redact=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin and place of each piece of each document."""
    ship(spark)
    return packing.packed(docs)


STAGES = [
    ("language", known_language),
    ("near_dedup", distinct_documents),
    ("substring_dedup", distinct_passages),
    ("pii", without_personal_data),
    ("packing", packed),
]

# Trained weights and best fit cannot be expressed in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, first = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), made()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # All that a stage was made from goes once the stage is written, the stage before it too.
        remove(spark, first, made() - 1)
    return STAGES[-1][1](spark, docs, sf_dir)
