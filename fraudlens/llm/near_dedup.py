"""Near duplicates by HyperMinHash sketches.

A document's set is its distinct shingles of ``WORDS`` words. A sketch has a register for each of
``BANDS * ROWS`` hash functions: the least value over the set, kept as its count of leading zeros and
the next ``MANTISSA`` bits. Documents that share all registers of a band are compared by sketch; the
share of equal registers, corrected for the chance that different minima fall into one register,
estimates the similarity. What may reach the threshold is compared on the full sets.

Nothing is quadratic in what leaves a task: copies are one node from the start, and a group of
documents sends only a spanning forest of its links. Groups above a bound compare every member with
the group's smallest one first; only those that are not linked with it are compared with all others,
in tasks of a bounded number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm import words as w
from fraudlens.llm.graph import components, roots, runs
from fraudlens.llm.storage import written

WORDS, PERCENT = 5, 85
BANDS, ROWS, MANTISSA = 25, 5, 10
REGISTERS = BANDS * ROWS
SHINGLE_HASH, REGISTER_HASH, DIGEST_HASH = 21, 22, 23
# Standard deviations that an estimate may lie below the threshold.
SLACK = 4.5
BAND_ROWS, SET_ROWS, PACK_ROWS, SET_PACK_ROWS = 1024, 256, 20_000, 1_000
# Within a part, the smallest id comes first, so that what is linked with it is paired with it.
PART_ORDER = ("key", "part", "id")
SMALL_IDS = 500_000


def shingles(text: w.Columns, words: int = WORDS, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within a row, and the number of them in each row."""
    (found,), first = w.hashes(text, SHINGLE_HASH, fold_case=fold_case)
    at = w.whole(first, words)
    row = w.rows_of(first)
    value = w.grams(found, words, SHINGLE_HASH)[at] if len(at) else np.zeros(0, np.uint64)
    sizes = np.diff(first)
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    alone = np.array([w.grams(found[first[r] : first[r + 1]], int(sizes[r]), SHINGLE_HASH)[0] + np.uint64(sizes[r]) for r in short], np.uint64)
    value, row = np.concatenate([value, alone]), np.concatenate([row[at], short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[fresh], np.bincount(row[fresh], minlength=len(sizes))


def registers(value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sketch of each row that has shingles."""
    heads = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(heads), REGISTERS), np.uint16)
    if not len(heads):
        return out
    factors, shifts = w.powers(REGISTER_HASH, REGISTERS + 1)[1:], w.powers(REGISTER_HASH + 1, REGISTERS + 1)[1:]
    for j in range(REGISTERS):
        least = np.minimum.reduceat(value * factors[j] + shifts[j], heads) | np.uint64(1)
        zeros = 64 - np.frexp(least.astype(np.float64))[1].clip(1, 64)
        mantissa = (least << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
        out[:, j] = (zeros.astype(np.uint16) << MANTISSA) | mantissa.astype(np.uint16)
    return out


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal registers. Minima of disjoint sets of ``n`` and ``m``
    elements share a register with chance ``n m / (n + m)**2 / 2**MANTISSA / (2 ln 2)``."""
    chance = n * m / (n + m) ** 2 / 2**MANTISSA / (2 * np.log(2))
    return (equal / REGISTERS - chance) / (1 - chance)


def _sketch(id_column: str, text_column: str, words: int, fold_case: bool):
    def sketch(batches):
        for batch in batches:
            ids, text = batch.column(id_column), w.columns(batch.column(text_column))
            for row, end in w.slices(text):
                part = w.Columns(text.data[text.offsets[row] : text.offsets[end]], text.offsets[row : end + 1] - text.offsets[row])
                value, sizes = shingles(part, words, fold_case)
                kept = sizes > 0
                found = registers(value, sizes)
                heads = (np.cumsum(sizes) - sizes)[kept]
                digests = [np.add.reduceat(w.mix(value ^ salt), heads) if len(heads) else value[:0] for salt in w.powers(DIGEST_HASH, 3)[1:]]
                keys = np.zeros((len(found), BANDS), np.uint64)
                for j, p in enumerate(w.powers(DIGEST_HASH + 1, ROWS + 1)[1:]):
                    keys += found[:, j::ROWS] * p
                keys = w.mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                valid = kept.nonzero()[0]

                def placed(values, at=valid, n=end - row):
                    out = np.zeros(n, np.int64)
                    out[at] = values.view(np.int64)
                    return pa.array(out, mask=~kept)

                bounds = np.concatenate([[0], np.cumsum(kept)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row).cast(pa.int64()), pa.array(sizes.astype(np.int64)), placed(digests[0]), placed(digests[1]),
                        w.binary(found.reshape(-1), bounds * REGISTERS),
                        pa.ListArray.from_arrays(pa.array((bounds * BANDS).astype(np.int32)), pa.array(keys.reshape(-1).view(np.int64))),
                    ],
                    names=["id", "n", "d1", "d2", "registers", "bands"],
                )

    return sketch


def _forest(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = roots(linked)
    moved = label != np.arange(len(label))
    return ids[moved], ids[label[moved]]


def _alike(n: np.ndarray, found: np.ndarray, least: float, percent: int) -> np.ndarray:
    """Which pairs of a group may reach the threshold, by size and sketch."""
    equal = np.zeros((len(n), len(n)), np.uint8)
    for j in range(found.shape[1]):
        equal += found[:, j, None] == found[None, :, j]
    a, b = n[:, None], n[None, :]
    return (estimate(equal, a, b) >= least) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def _sketch_links(least: float, percent: int):
    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in PART_ORDER])
        key, part, ids, n, side = (table[c].to_numpy() for c in ("key", "part", "id", "n", "side"))
        found = w.unpack(table["registers"], np.uint16)[0].reshape(-1, REGISTERS)
        ends = [_empty()]
        for a, b in runs(key, part):
            linked = _alike(n[a:b].astype(float), found[a:b], least, percent) & (side[a:b, None] | side[None, a:b])
            ends.append(_forest(ids[a:b], linked))
        return _pairs(ends)

    return links


def _empty() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _pairs(ends) -> pa.Table:
    a, b = (np.concatenate(x) for x in zip(*ends, strict=True))
    pairs = np.unique(np.stack([a, b]), axis=1)
    return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})


def common(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many elements each two of the sets have in common."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    counts = np.diff(np.append(np.flatnonzero(fresh), len(values)))
    shared = np.repeat(counts > 1, counts)
    column = (np.cumsum(fresh) - 1)[shared]
    owner = owner[shared]
    out = np.zeros((n, n), np.float64)
    column = np.unique(column, return_inverse=True)[1]
    width = 4096
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + width, width))
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        block = np.zeros((n, width), np.float32)
        block[owner[a:b], column[a:b] - i * width] = 1
        out += block @ block.T
    return out


def _set_links(percent: int):
    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in PART_ORDER])
        key, part, ids, side = (table[c].to_numpy() for c in ("key", "part", "id", "side"))
        values, sizes = w.unpack(table["elements"], np.uint64)
        heads = np.concatenate([[0], np.cumsum(sizes)])
        ends = [_empty()]
        for a, b in runs(key, part):
            both = common(values[heads[a] : heads[b]], sizes[a:b])
            either = sizes[a:b, None] + sizes[None, a:b] - both
            ends.append(_forest(ids[a:b], (100 * both >= percent * either) & (side[a:b, None] | side[None, a:b])))
        return _pairs(ends)

    return links


def _sets(words: int, fold_case: bool):
    def sets(batches):
        for batch in batches:
            text = w.columns(batch.column("text"))
            for row, end in w.slices(text):
                part = w.Columns(text.data[text.offsets[row] : text.offsets[end]], text.offsets[row : end + 1] - text.offsets[row])
                value, sizes = shingles(part, words, fold_case)
                cells = w.binary(value, np.concatenate([[0], np.cumsum(sizes)]))
                heads = np.append(np.cumsum(sizes) - sizes, len(value))
                digest = np.add.reduceat(np.append(w.mix(value), np.uint64(0)), heads)[:-1] * (sizes > 0).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, end - row), pa.array(digest.view(np.int64)), cells], names=["id", "digest", "elements"]
                )

    return sets


def _packed(parts: DataFrame, payload: DataFrame, links, pack: int) -> DataFrame:
    at = F.pmod(F.xxhash64("key", "part"), F.lit(max(1, -(-parts.count() // pack))))
    dealt = parts.join(payload, "id").withColumn("_pack", at)
    return dealt.groupBy("_pack").applyInArrow(lambda t: links(t.drop(["_pack"])), "a bigint, b bigint")


def _in_groups(rows: DataFrame, payload: DataFrame, links, limit: int, pack: int) -> DataFrame:
    """Links ``a, b`` between the ids of each key: a spanning forest of what ``links`` finds.

    ``rows`` has ``key, id``; ``payload`` has what is compared, by ``id``. Keys of up to ``limit`` rows
    are one part. In larger ones all rows meet the smallest id in chunks; rows that are not linked with
    it there are dealt into chunks that meet chunks of all rows of the key.
    """
    counts = rows.groupBy("key").agg(F.count("*").alias("_c"), F.min("id").alias("_hub"))
    sized = written(rows.join(counts, "key"), "sized")
    parts = sized.where(f"_c <= {limit}").select("key", "id", F.lit(0).alias("part"), F.lit(True).alias("side"))
    small = _packed(parts, payload, links, pack)
    busy = sized.where(f"_c > {limit}").withColumn("_n", F.ceil(F.col("_c") / limit).cast("int"))
    if busy.isEmpty():
        return small
    chunk = F.pmod(F.xxhash64("id"), F.col("_n")).cast("int")
    hubs = busy.where("id = _hub").select("key", "id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("part"), F.lit(True).alias("side"))
    others = busy.where("id != _hub").select("key", "id", chunk.alias("part"), F.lit(False).alias("side"))
    star = written(_packed(hubs.unionByName(others), payload, links, pack), "star")
    # A row linked with the smallest id of one group may be linked with other rows of another one.
    met = star.select(F.col("a").alias("id"), F.col("b").alias("_hub")).distinct()
    rest = written(busy.where("id != _hub").join(met, ["id", "_hub"], "left_anti").select("key", "id"), "rest")
    left = rest.groupBy("key").agg(F.ceil(F.count("*") / limit).cast("int").alias("_m"))
    own = F.pmod(F.xxhash64("id", F.lit(1)), F.col("_m")).cast("int")
    # A part is a chunk of what is left, and a chunk of all.
    at = (F.col("_l") * F.col("_n") + F.col("_k")).alias("part")
    mine = busy.join(rest, ["key", "id"], "left_semi").join(left, "key").withColumn("_l", own)
    mine = mine.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select("key", "id", at, F.lit(True).alias("side"))
    theirs = busy.join(rest.withColumn("_own", F.lit(1)), ["key", "id"], "left").join(left, "key")
    theirs = theirs.withColumn("_k", chunk).withColumn("_l", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    theirs = theirs.where(F.col("_own").isNull() | (F.col("_l") != own)).select("key", "id", at, F.lit(False).alias("side"))
    return small.union(star).union(_packed(theirs.unionByName(mine), payload, links, pack))


def _linked(docs: DataFrame, id_column: str, text_column: str, words: int, percent: int, fold_case: bool) -> tuple[DataFrame, DataFrame]:
    """A row ``id, n`` for each row of ``docs``, and the component of each linked id."""
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    sketches = written(
        source.mapInArrow(_sketch("id", "text", words, fold_case), "id bigint, n bigint, d1 bigint, d2 bigint, registers binary, bands array<bigint>"),
        "sketches",
    )
    usable = sketches.where("n > 0 and id is not null")
    keyed = usable.select("id", "d1", "d2", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("d1").alias("x"), F.max("d1").alias("y")).where("x != y").select("key")
    # Copies are one node: the smallest id of a set.
    inside = written(keyed.join(shared, "key").groupBy("key", "d1", "d2").agg(F.min("id").alias("id")).select("key", "id"), "inside")
    payload = usable.join(inside.select("id").distinct(), "id").select("id", "n", "d1", "registers").dropDuplicates(["id", "d1"]).drop("d1")
    share = 0.01 * percent
    least = share - SLACK * float(np.sqrt(share * (1 - share) / REGISTERS))
    groups = components(_in_groups(inside.distinct(), payload, _sketch_links(least, percent), BAND_ROWS, PACK_ROWS))
    chosen = written(groups.select(F.col("component").alias("key"), F.col("node").alias("id")), "chosen")
    # Ids are broadcast only if they are few: 8 MB at most.
    few = chosen.select("id")
    texts = source.join(F.broadcast(few) if chosen.count() <= SMALL_IDS else few, "id", "left_semi")
    sets = texts.mapInArrow(_sets(words, fold_case), "id bigint, digest bigint, elements binary")
    sets = written(sets.dropDuplicates(["id", "digest"]).drop("digest"), "sets")
    verified = _in_groups(chosen, sets, _set_links(percent), SET_ROWS, SET_PACK_ROWS)
    nodes = usable.groupBy("d1", "d2").agg(F.min("id").alias("node"), F.max("id").alias("last")).where("node != last")
    copies = usable.select("id", "d1", "d2").join(nodes, ["d1", "d2"]).where("id != node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    return sketches.select("id", "n"), components(verified.union(copies))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT, fold_case: bool = True) -> DataFrame:
    """For each row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets; a component is
    what links connect, named by its smallest id, and that document is kept. Texts of fewer than
    ``words`` words are one shingle. Null texts and texts without words have no shingles, are linked
    with nothing and kept. Rows of one id are one node. A row without an id is linked with nothing,
    has no component and is kept. An empty table gives an empty result.
    """
    sketches, found = _linked(docs, id_column, text_column, words, percent, fold_case)
    own = F.coalesce("component", "id")
    return sketches.join(found, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT, fold_case: bool = True) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns."""
    _, found = _linked(docs, id_column, text_column, words, percent, fold_case)
    others = written(found.where("node != component").select(F.col("node").alias(id_column)), "others")
    if others.count() <= SMALL_IDS:
        others = F.broadcast(others)
    return docs.join(others, id_column, "left_anti").select(*docs.columns)
