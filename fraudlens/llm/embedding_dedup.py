"""Near duplicates among vectors, by counting collisions of one-dimensional projections.

Every vector is projected on random lines. Around each vector, on each line, lies a window; the
number of windows in which a second vector lies is their count. Vectors of cosine ``least`` lie as
far apart on a line as a normal variable of deviation ``sqrt(2 - 2 least)``, which gives the count
that all but a given share of them reach. Pairs that reach it are verified by their cosine.

Windows are only looked at among vectors that share a cell of some table: those on the same side of
zero on each of the table's lines. Lines per table grow with the logarithm of the rows, so that cells
keep their size; the number of tables follows from the recall asked for at cosine ``least``, and is
larger for pairs above it. Large cells are dealt into chunks that meet each other, with no limit on
their number. A pair belongs to the first table that it shares, so it is counted once; tasks return
a number of links for each vector and a spanning forest, never the pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fraudlens.llm import words as w
from fraudlens.llm.graph import components, roots, runs
from fraudlens.llm.storage import written
from fraudlens.llm.vectors import matrices

LEAST, RECALL = 0.9, 0.98
LINES, WINDOW, COUNT_RECALL = 32, 1.0, 0.998
CELL_VECTORS, CHUNK_ROWS, PACK_ROWS = 16, 512, 20_000
SEED = 31


def tables_for(rows: int, least: float = LEAST, recall: float = RECALL) -> tuple[int, int]:
    """Lines per table and tables, for a number of vectors."""
    lines = min(31, max(6, math.ceil(math.log2(max(rows, 1) / CELL_VECTORS))))
    same = (1 - math.acos(least) / math.pi) ** lines
    return lines, math.ceil(math.log(1 - recall) / math.log(1 - same))


def least_count(lines: int = LINES, window: float = WINDOW, recall: float = COUNT_RECALL) -> int:
    """The largest count that a share ``recall`` of the pairs at the threshold reaches; a window
    reaches ``window`` deviations to both sides."""
    p = math.erf(window / math.sqrt(2))
    chances = [math.comb(lines, k) * p**k * (1 - p) ** (lines - k) for k in range(lines + 1)]
    return max(k for k in range(lines + 1) if sum(chances[k:]) >= recall)


def _lines(size: int, number: int, salt: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, salt]).standard_normal((size, number))


def _place(kind: type, lines: int, tables: int):
    def place(batches):
        for batch in batches:
            n = batch.num_rows
            digest, raw, cell = [None] * n, [None] * n, [None] * n
            for rows, matrix in matrices(batch.column("vector")):
                nonzero = np.abs(matrix).max(1, initial=0) > 0
                rows, matrix = rows[nonzero], (matrix[nonzero] + 0).astype(kind)
                side = (matrix.astype(np.float64) @ _lines(matrix.shape[1], lines * tables, 0) > 0).reshape(len(rows), tables, lines)
                code = (side @ (1 << np.arange(lines))).astype(np.int32)
                for r, v, c in zip(rows.tolist(), matrix, code, strict=True):
                    raw[r], cell[r] = v.tobytes(), c.tobytes()
                    digest[r] = hashlib.md5(raw[r], usedforsecurity=False).digest()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.int64()), pa.array(digest, pa.binary()), pa.array(raw, pa.binary()), pa.array(cell, pa.binary())],
                names=["id", "digest", "raw", "cells"],
            )

    return place


def _explode(tables: int):
    def explode(batches):
        for batch in batches:
            code, _ = w.unpack(batch.column("cells"), np.int32)
            code = code.reshape(-1, tables).astype(np.uint64)
            size = batch.column("size").to_numpy().astype(np.uint64)
            table = np.arange(tables, dtype=np.uint64)
            key = w.mix(w.mix(code + table[None, :] * np.uint64(0x9E3779B97F4A7C15)) + size[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)), pa.array(np.tile(table.astype(np.int32), len(code))), pa.array(np.repeat(batch.column("node").to_numpy(), tables))],
                names=["key", "t", "node"],
            )

    return explode


def _count(kind: type, tables: int, least: float):
    needed = least_count()
    window = WINDOW * math.sqrt(2 - 2 * least)

    def links(unit: np.ndarray, spot: np.ndarray, code: np.ndarray, table: int, chunk: np.ndarray, two: bool) -> np.ndarray:
        count = np.zeros((len(unit), len(unit)), np.uint8)
        for j in range(LINES):
            count += np.abs(spot[:, j, None] - spot[None, :, j]) <= window
        alike = np.triu(count >= needed, 1)
        if two:
            alike &= chunk[:, None] != chunk[None, :]
        a, b = np.nonzero(alike)
        first = ~(code[a, :table] == code[b, :table]).any(1)
        a, b = a[first], b[first]
        close = np.einsum("ij,ij->i", unit[a], unit[b]) >= least
        out = np.zeros_like(alike)
        out[a[close], b[close]] = True
        return out | out.T

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("part", "ascending")])
        key, part, t, chunk, node, many = (table[c].to_numpy() for c in ("key", "part", "t", "chunk", "node", "many"))
        two = table["two"].to_numpy(zero_copy_only=False)
        values, sizes = w.unpack(table["raw"], kind)
        heads = np.concatenate([[0], np.cumsum(sizes)])
        code = w.unpack(table["cells"], np.int32)[0].reshape(-1, tables)
        ids, tops, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in runs(key, part):
            if b - a < 2:
                continue
            vectors = values[heads[a] : heads[b]].reshape(b - a, -1).astype(np.float64)
            unit = vectors / np.abs(vectors).max(1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            linked = links(unit, unit @ _lines(unit.shape[1], LINES, 1), code[a:b], int(t[a]), chunk[a:b], bool(two[a]))
            some = linked.any(1)
            ids.append(node[a:b][some])
            tops.append(node[a:b][roots(linked)[some]])
            sums.append((linked @ many[a:b])[some])
        ids, tops, sums = (np.concatenate(x) for x in (ids, tops, sums))
        return pa.table({"a": pa.array(ids, pa.int64()), "b": pa.array(tops, pa.int64()), "links": pa.array(sums, pa.int64())})

    return run


def near_duplicates(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", least: float = LEAST, recall: float = RECALL) -> DataFrame:
    """For each row: its id, ``n_links`` (other rows of cosine ``least`` or more that were found),
    ``component_id`` (the smallest id that links reach) and ``kept``.

    Vectors that are null, empty or zero, or hold null or non-finite numbers, are linked with nothing,
    and so are vectors of different lengths. Equal vectors are linked without being compared. A row
    without an id has no links and no component and is kept. An empty table gives an empty result.
    """
    element = rows.schema[vector_column].dataType
    kind = np.float32 if isinstance(element, T.ArrayType) and isinstance(element.elementType, T.FloatType) else np.float64
    source = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("vector"))
    if kind is np.float64:
        source = source.withColumn("vector", F.col("vector").cast("array<double>"))
    lines, tables = tables_for(source.count(), least, recall)
    placed = written(source.mapInArrow(_place(kind, lines, tables), "id bigint, digest binary, raw binary, cells binary"), "placed")
    usable = placed.where("digest is not null and id is not null")
    classes = written(usable.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("many")), "classes")
    payload = usable.join(classes, "digest").where("id = node").select("digest", "node", "many", "raw", "cells").dropDuplicates(["digest"])
    payload = written(payload.withColumn("size", F.length("raw")), "vectors")
    keyed = written(payload.select("node", "size", "cells").mapInArrow(_explode(tables), "key bigint, t int, node bigint"), "keyed")
    counts = keyed.groupBy("key").agg(F.count("*").alias("_c")).where("_c > 1").withColumn("_n", F.ceil(F.col("_c") / CHUNK_ROWS).cast("int"))
    sized = keyed.join(counts, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
    # A part is two chunks, or a chunk with itself.
    part = F.least("chunk", "_o").cast("bigint") * F.col("_n") + F.greatest("chunk", "_o")
    each = sized.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).withColumn("part", part)
    parts = written(each.select("key", "t", "node", "chunk", "part", (F.col("part") % (F.col("_n") + 1) != 0).alias("two")), "parts")
    pack = F.pmod(F.xxhash64("key", "part"), F.lit(max(1, -(-parts.count() // PACK_ROWS))))
    dealt = parts.join(payload.select("node", "many", "raw", "cells"), "node").withColumn("_pack", pack)
    found = written(dealt.groupBy("_pack").applyInArrow(_count(kind, tables, least), "a bigint, b bigint, links bigint"), "found")
    degrees = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("_others"))
    reached = components(found.select("a", "b"))
    named = classes.join(degrees, "node", "left").join(reached, "node", "left").select(
        "digest", (F.coalesce("_others", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    known = F.col("id").isNotNull()
    return placed.select("id", "digest").join(named, "digest", "left").select(
        F.col("id").alias(id_column),
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        F.when(known, F.coalesce("component", "id")).alias("component_id"),
        (~known | (F.col("id") == F.coalesce("component", "id"))).alias("kept"),
    )
