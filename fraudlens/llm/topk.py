"""Exact top-k search by inner product of whole numbers, by branch and bound over dimensions.

Components become ``floor(scale * x)``. Queries and candidates are dealt in blocks; every block of
queries meets every block of candidates in a task of its own. There, vectors lie dimension by
dimension. Scores grow a group of dimensions at a time; what the remaining dimensions can still add
is at most the product of the two remaining norms. The best candidates of the first dimensions are
scored in full, which gives each query a score to reach; pairs that cannot reach it are left out and
the rest is compacted before the next dimensions. Each task returns the ``k`` best of each query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fraudlens.llm import words as w
from fraudlens.llm.storage import written
from fraudlens.llm.vectors import cells, matrices

K, SCALE = 5, 256
QUERY_BLOCK, ROW_BLOCK, DIMENSIONS = 512, 8192, 16
# Sums of products below this are exact in double precision.
EXACT = 2.0**52
# Scores beyond this are refused; the check is made in double precision.
MOST = 2.0**63 * (1 - 1e-9)


def _whole(scale: float):
    def whole(batches):
        for batch in batches:
            n = batch.num_rows
            out: list[bytes | None] = [None] * n
            for rows, matrix in matrices(batch.column("vector")):
                numbers = np.floor(scale * matrix.astype(np.float64))
                small = np.abs(numbers).max(1, initial=0) < 2.0**62
                for r, v in enumerate(cells(rows[small], numbers[small].astype(np.int64), n)):
                    out[r] = v if v is not None else out[r]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(out, pa.binary())], names=["id", "numbers"])

    return whole


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, row number and score of the ``k`` best rows of each query, and of rows that tie."""
    peak = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    kind = np.float64 if peak < EXACT else np.int64
    own = query_ids[:, None] == ids[None, :]
    if kind is np.int64:
        score = queries @ rows.T
        # Sums that wrap on the way are right if the result is in range.
        if np.abs(queries.astype(np.float64) @ rows.T.astype(np.float64)).max(initial=0) > MOST:
            raise ValueError("an inner product does not fit into 64 bits; use a smaller scale")
        least = np.iinfo(np.int64).min
        score = np.where(own, least, score)
        at = max(0, len(ids) - k)
        bound = np.partition(score, at, axis=1)[:, at] if len(ids) else np.zeros(len(query_ids), np.int64)
        q, c = np.nonzero((score >= bound[:, None]) & ~own)
        return q, c, score[q, c]
    left, right = np.ascontiguousarray(queries.T, kind), np.ascontiguousarray(rows.T, kind)
    # What dimensions from each one on can add at most.
    rest = [np.sqrt(np.cumsum((x**2)[::-1], axis=0)[::-1]) for x in (left, right)]
    edges = list(range(0, len(left), DIMENSIONS)) + [len(left)]
    column = np.arange(len(ids))
    partial = left[: edges[1]].T @ right[: edges[1]]
    partial[own] = -np.inf
    probes = min(len(ids), 8 * k)
    near = np.argpartition(partial, len(ids) - probes, axis=1)[:, len(ids) - probes :]
    full = np.einsum("dq,dqp->qp", left, right[:, near])
    full[np.take_along_axis(own, near, 1)] = -np.inf
    goal = np.partition(full, probes - k, axis=1)[:, probes - k] if probes >= k else np.full(len(query_ids), -np.inf)
    for d, e in zip(edges[1:-1], edges[2:], strict=True):
        # The bound is rounded, scores are whole numbers: one is added.
        alive = partial + rest[0][d][:, None] * rest[1][d][None, column] + 1 >= goal[:, None]
        some = alive.any(0)
        if alive.sum() < 0.05 * alive.size:
            q, c = np.nonzero(alive)
            score = partial[q, c] + np.einsum("dn,dn->n", left[d:, q], right[d:, column[c]])
            keep = (score >= goal[q]) & np.isfinite(score)
            return q[keep], column[c[keep]], score[keep]
        column, partial = column[some], partial[:, some]
        partial += left[d:e].T @ right[d:e, column]
    q, c = np.nonzero((partial >= goal[:, None]) & np.isfinite(partial))
    return q, column[c], partial[q, c]


def _search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
        if not len(left) or not len(right):
            return pa.table({n: pa.array([], t) for n, t in names.items()})
        query_ids, ids = left["id"].to_numpy(), right["id"].to_numpy()
        queries, rows = (w.unpack(t["numbers"], np.int64)[0].reshape(len(t), -1) for t in (left, right))
        q, c, score = best(query_ids, queries, ids, rows, k)
        order = np.lexsort((ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        heads = np.searchsorted(q, np.arange(len(query_ids)))
        top = np.arange(len(q)) - heads[q] < k
        q, c, score = q[top], c[top], score[top]
        return pa.table({"query_id": pa.array(query_ids[q]), "vec_id": pa.array(ids[c]), "score": pa.array(score.astype(np.int64))})

    return search


def top_k(queries: DataFrame, rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, scale: float = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` rows of another id with the highest
    inner product of whole numbers, all if there are fewer; ties go to the smaller id.

    Vectors that are null or empty or hold null or non-finite numbers take no part, nor do rows
    without an id; vectors are compared with those of their own length. Repeated equal query rows are
    one query, repeated rows are ranked each. Empty tables give an empty result. Components beyond 2^62 take no
    part; scores that do not fit into 64 bits fail the job.
    """

    def numbers(df: DataFrame) -> DataFrame:
        source = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
        return source.where("id is not null").mapInArrow(_whole(scale), "id bigint, numbers binary").where("numbers is not null")

    asked = written(numbers(queries).dropDuplicates(["id", "numbers"]), "queries")
    there = written(numbers(rows), "rows")
    n_asked, n_there = max(1, -(-asked.count() // QUERY_BLOCK)), max(1, -(-there.count() // ROW_BLOCK))
    size = F.length("numbers").alias("_size")
    mine, theirs = (F.pmod(F.xxhash64("id"), F.lit(n)).cast("bigint") for n in (n_asked, n_there))
    left = asked.select("id", "numbers", size, mine.alias("_q"), F.explode(F.expr(f"sequence(0L, {n_there - 1}L)")).alias("_r"))
    right = there.select("id", "numbers", size, theirs.alias("_r"), F.explode(F.expr(f"sequence(0L, {n_asked - 1}L)")).alias("_q"))
    by = ["_q", "_r", "_size"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
