"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

Documents of one source, or of one cluster of duplicates (equal or nearly equal texts), never share a bin. Bins are ordered by what
is left in them and carry a bitmap of their sources and clusters; from the tightest bin with enough
room, the search goes on to the next until one has no conflict. Pieces are packed largest first.

Pieces are dealt into shards of about ``SHARD`` by a hash of their document's id, text and source, and rows without an id
evenly, so that neither a large source nor a large cluster meets in one task. A document longer than a bin fills bins of its
own, and only its rest is packed.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm import near_dedup
from fraudlens.llm.storage import written

CAPACITY, SHARD = 2048, 4096
# Words, as everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"


def best_fit(sizes: list[int], marks: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin of each piece, and its place in the bin. ``marks`` are bitmaps of what conflicts."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins, places = [0] * len(sizes), [0] * len(sizes)
    # Bins with room, by what is left in them, and the bitmap of each bin.
    room: list[tuple[int, int]] = []
    taken: list[int] = []
    for i in order:
        size, mark = sizes[i], marks[i]
        at = bisect_left(room, (size, -1))
        while at < len(room) and taken[room[at][1]] & mark:
            at += 1
        if at < len(room):
            left, number = room.pop(at)
            taken[number] |= mark
        else:
            left, number = capacity, len(taken)
            taken.append(mark)
        bins[i], places[i] = number, capacity - left
        if left > size:
            insort(room, (left - size, number))
    return bins, places


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs more than once; none for null."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    numbers = {v: n for n, v in enumerate(v for v, c in seen.items() if c > 1 and v is not None)}
    return [1 << numbers[v] if v in numbers else 0 for v in values]


def _pack(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc", "ascending"), ("piece", "ascending"), ("cluster", "ascending")])
        sources, clusters = (_bits(table[c].to_pylist()) for c in ("source", "cluster"))
        width = max(sources, default=0).bit_length()
        marks = [s | c << width for s, c in zip(sources, clusters, strict=True)]
        bins, places = best_fit(table["n_words"].to_pylist(), marks, capacity)
        shard = table["_shard"].to_numpy().astype(np.int64)
        return table.drop(["_shard", "source", "cluster"]).append_column("bin_id", pa.array(shard * (1 << 24) + np.array(bins, np.int64))).append_column("bin_start", pa.array(places, pa.int32()))

    return pack


def _key(id_column: str, text):
    """The id as near duplicates name it; documents without one go by their text."""
    return F.coalesce(F.col(id_column).cast("bigint"), F.xxhash64(text))


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = near_dedup.PERCENT) -> DataFrame:
    """``key, cluster`` of the documents that are linked with one of a smaller id; the others are
    named by their own id."""
    text = F.col(text_column).cast("string")
    found = near_dedup.near_duplicates(docs.select(_key(id_column, text).alias("key"), text.alias("text")), "key", "text", percent=percent)
    return written(found.where("not kept").select("key", F.col("component_id").alias("cluster")).distinct(), "near-copies")


def packed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str | None = "source", cluster: str | DataFrame | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document: its id, ``piece`` (from 0), ``n_words``, ``bin_id`` and
    ``bin_start``, the place of its first word in the bin. Piece ``i`` begins at word ``i * capacity``.

    ``cluster`` is a column that names a document's duplicates, or the table of :func:`near_copies`;
    by default, documents of equal text are duplicates. Null sources and clusters conflict with nothing. Documents that are null or have
    no words are one piece of no words without a bin. Rows of one id are packed each.
    """
    text = F.col(text_column).cast("string")
    source = F.col(source_column).cast("string") if source_column else F.lit(None).cast("string")
    near = cluster if isinstance(cluster, DataFrame) else None
    if near is not None:
        same = _key(id_column, text)
    elif cluster is None:
        same = F.when(text.isNotNull(), F.xxhash64(text))
    else:
        same = F.when(F.col(cluster).isNotNull(), F.xxhash64(cluster))
    spread = F.xxhash64(F.col(id_column), text, source, F.when(F.col(id_column).isNull(), F.monotonically_increasing_id()))
    sized = docs.select(
        F.col(id_column).alias("doc"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).alias("_n"), source.alias("source"), same.alias("_same"), spread.alias("_spread"))
    if near is None:
        sized = sized.withColumnRenamed("_same", "cluster")
    else:
        # Joined after the words are counted, so that no text is shuffled.
        sized = sized.join(near, sized["_same"] == near["key"], "left").select("doc", "_n", "source", F.coalesce("cluster", "_same").alias("cluster"), "_spread")
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_n") / capacity).cast("int") - 1, F.lit(0)))))
    # Written, since the words of each text are counted once, and rows without an id keep their place.
    pieces = written(pieces.select("doc", "piece", F.least(F.col("_n") - F.col("piece") * capacity, F.lit(capacity)).cast("int").alias("n_words"), "source", "cluster", "_spread"), "pieces")
    empty = pieces.where("n_words = 0").select("doc", "piece", "n_words", F.lit(None).cast("bigint").alias("bin_id"), F.lit(None).cast("int").alias("bin_start"))
    shards = max(1, -(-pieces.count() // SHARD))
    shard = F.pmod(F.xxhash64("_spread", "piece", F.lit(5)), F.lit(shards)).cast("int")
    kind = dict(docs.dtypes)[id_column]
    filled = pieces.where("n_words > 0").withColumn("_shard", shard).drop("_spread").groupBy("_shard").applyInArrow(
        _pack(capacity), f"doc {kind}, piece int, n_words int, bin_id bigint, bin_start int"
    )
    return filled.union(empty).withColumnRenamed("doc", id_column)
