"""Named queries of the operators on training data, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.llm import (
    embedding_dedup, html, language, near_dedup, packing, pieces, pii, prefix_trie, quality, structure_repair, substring_dedup, topk, url_filter,
)
from fraudlens.llm.oracles import ORACLES  # noqa: F401
from fraudlens.llm.storage import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

# The rules of op11, and the hosts that its list names, below each of three domains.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_BELOW = ["example.com", "example.net", "example.org"]
LISTED = [f"{name}.{domain}/" for name in LISTED_NAMES for domain in LISTED_BELOW]


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op3_substring_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, keep_text=False).drop("spans")


@query
def op4_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op8_topk(spark, sf_dir):
    """Every fiftieth vector against all."""
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_k(rows.where("vec_id % 50 = 0"), rows)


@query
def op10_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query
def op5_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_personal_data(docs, keep_text=False).drop("found")


@query
def op7_language(spark, sf_dir):
    """A quarter of the documents, by their ids, is never learned from."""
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.fit(docs.where(~fold))
    rows = docs.select("doc_id", "text", F.coalesce(fold, F.lit(False)).alias("held_out"))
    return language.with_language(rows, model).drop("text")


@query
def op2_quality(spark, sf_dir):
    """Grades of the labels: 0 toxic, 1 of low quality, 2 neither."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    model = quality.fit(docs, labels.select("doc_id", grade.alias("grade")))
    return quality.with_quality(docs.select("doc_id", "text"), model).drop("text")


@query
def op6_packing(spark, sf_dir):
    """Near duplicates are those of the pipeline."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return packing.packed(docs, cluster=packing.near_copies(docs, percent=80))


@query
def op9_pieces(spark, sf_dir):
    """Ids of every document, and whether decoding them gives the text back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.with_pieces(docs, pieces.load(VOCABULARY), check=True).drop("text")


@query
def op1_html(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return html.with_main_text(pages, html.fit(pages))


@query
def op11_url_filter(spark, sf_dir):
    listed = spark.createDataFrame([(entry,) for entry in LISTED], "entry string")
    return url_filter.judged(_table(spark, sf_dir, "pages").select("page_id", "url"), listed, RULES).drop("url")


def _remainder(text: Column, of: int) -> Column:
    return (F.crc32(text.cast("binary")) % of).cast("int")


@query
def op12_prefix_trie(spark, sf_dir):
    """Conversations begin with some turns of the first of their hundred; rows without conv_id are left out."""
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    heads = turns.where("conv_id % 100 = 0").select(F.col("conv_id").alias("lender"), F.slice("turns", 1, 5).alias("head"))
    shared = turns.withColumns({"lender": F.expr("conv_id - conv_id % 100"), "h": _remainder(F.col("conv_id").cast("string"), 6)})
    rebuilt = F.concat(
        F.slice(F.coalesce("head", F.array().cast(dict(turns.dtypes)["turns"])), 1, F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))),
    )
    return prefix_trie.trie(shared.join(heads, "lender", "left").select("conv_id", rebuilt.alias("turns")))


def _damaged(rows: DataFrame) -> DataFrame:
    """A twentieth of the turns each is dropped, emptied, robbed of its marks, repeated, or given to the user. ``was``
    orders turns of one number by what they were."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = _remainder(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]), 20)
    was = F.sha2(F.concat(F.char_length(filled["role"]).cast("string"), F.lit(":"), filled["role"], filled["text"]), 256)
    told = rows.select("conv_id", "turn", filled["role"].alias("role"), filled["text"].alias("text"), kind.alias("kind"), was.alias("was"))
    return told.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "was", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )


@query
def op13_structure_repair(spark, sf_dir):
    """A null conv_id is a conversation of its own."""
    rows = _table(spark, sf_dir, "conversations")
    found = structure_repair.with_hashes(_damaged(rows), tie="was").withColumnRenamed("conv_id", "id")
    nothing = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id").withColumns(
        {**nothing, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    )
