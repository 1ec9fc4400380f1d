"""Repeated spans of words, by a compacted De Bruijn graph of word k-mers.

Every window of ``k`` words is an edge of the graph, from its first to its last ``k - 1`` words. An
edge is repeated if documents with different ids have it; its source is its first place in the
document with the smallest id. Consecutive edges of a document whose sources are consecutive too form
a path without branches, which is compacted to one span: place, length, source document, source place.

The work is dealt in two ways. Documents lie in blocks of a bounded number of documents and bytes; edges lie
in buckets by their hash, and a block sends a bucket each edge once, so that no edge has more rows
than there are blocks, however many copies it has. Joins by block bring the answers back to the texts:

1. Blocks send the smallest seed (``seed`` words) of each window; about a quarter of the words. A
   window whose seed is in one document only cannot be repeated.
2. For the rest, blocks send the windows themselves, as 96 bits from two independent hashes, with the
   coordinates of their first place. Buckets return the source of edges that more documents have, with all bits.
3. Blocks look their own edges up by all 96 bits, compact them to spans, and remove the words of the spans.

The words of a span are not compared with those of its source, of which only hashes are sent: an edge is trusted if
all 96 bits agree. The chance of one wrong span is below 1e-9 for 1e10 candidate windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm import words as w
from fraudlens.llm.storage import free, schema_with

# What a block holds on average; a longer document takes one block beyond that.
BLOCK_DOCUMENTS, BLOCK_BYTES = 128, 4 << 20
SEED_HASH, EDGE_HASH, CHECK_HASH = 11, 12, 13
ADDED = ("n_words", "n_removed", "kept_sha256", "spans")
SPANS = "array<struct<start:int,words:int,source:bigint,source_start:int>>"


def _spread(count: int, size: int) -> tuple[int, int]:
    blocks = max(1, -(-count // BLOCK_DOCUMENTS), -(-size // BLOCK_BYTES))
    return blocks, max(256, blocks // 8)


def _rows_by_bucket(block: int, buckets: int, by: np.ndarray, **cells: np.ndarray) -> pa.Table:
    bucket = (by % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    bounds = np.append(heads, len(bucket))
    out = {"_block": pa.array(np.full(len(heads), block, np.int32)), "_bucket": pa.array(bucket[heads].astype(np.int32))}
    return pa.table(out | {name: w.binary(values[order], bounds) for name, values in cells.items()})


def _ids(table: pa.Table, id_column: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and which rows have one."""
    column = table[id_column].combine_chunks().cast(pa.int64())
    return column.fill_null(0).to_numpy(zero_copy_only=False), ~column.is_null().to_numpy(zero_copy_only=False)


def _windows(text: w.Columns, k: int, seed: int, *hashes: int):
    """Places of whole windows, their smallest seeds, and the word hashes and row starts."""
    found, first = w.hashes(text, SEED_HASH, *hashes)
    at = w.whole(first, k)
    if not len(at):
        return at, np.zeros(0, np.uint64), found[1:], first
    seeds = w.grams(found[0], seed, SEED_HASH)
    least = seeds[: len(seeds) - (k - seed)].copy()
    for j in range(1, k - seed + 1):
        np.minimum(least, seeds[j : len(least) + j], out=least)
    return at, w.mix(least[at]), found[1:], first


def _send_seeds(id_column: str, text_column: str, k: int, seed: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        block = table["_block"][0].as_py()
        ids, known = _ids(table, id_column)
        at, seeds, _, first = _windows(w.columns(table[text_column]), k, seed)
        row = w.rows_of(first)[at]
        mine = known[row]
        seeds, owner = seeds[mine], ids[row[mine]]
        order = np.lexsort((owner, seeds))
        seeds, owner = seeds[order], owner[order]
        fresh = np.ones(len(seeds), bool)
        fresh[1:] = seeds[1:] != seeds[:-1]
        other = np.zeros(len(seeds), bool)
        other[1:] = ~fresh[1:] & (owner[1:] != owner[:-1])
        # A seed that a second document of the block has is sent twice, and so counts as repeated.
        twice = np.unique(seeds[other])
        sent = np.concatenate([seeds[fresh], twice])
        return _rows_by_bucket(block, buckets, sent, seeds=sent)

    return send


def _repeated_seeds(table: pa.Table) -> pa.Table:
    seeds, sizes = w.unpack(table["seeds"], np.uint64)
    block = np.repeat(table["_block"].to_numpy(), sizes)
    order = np.lexsort((block, seeds))
    seeds, block = seeds[order], block[order]
    fresh = np.ones(len(seeds), bool)
    fresh[1:] = seeds[1:] != seeds[:-1]
    counts = np.diff(np.append(np.flatnonzero(fresh), len(seeds)))
    repeated = np.repeat(counts > 1, counts)
    once = fresh.copy()
    once[1:] |= block[1:] != block[:-1]
    return _by_block(block[repeated & once], seeds=seeds[repeated & once])


def _by_block(block: np.ndarray, **cells: np.ndarray) -> pa.Table:
    order = np.argsort(block, kind="stable")
    block = block[order]
    heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
    bounds = np.append(heads, len(block))
    return pa.table({"_block": pa.array(block[heads].astype(np.int32))} | {n: w.binary(v[order], bounds) for n, v in cells.items()})


def _send_edges(id_column: str, text_column: str, k: int, seed: int, buckets: int):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        repeated = np.sort(w.unpack(answers["seeds"], np.uint64)[0])
        if not len(table) or not len(repeated):
            empty = np.zeros(0, np.uint64)
            return _rows_by_bucket(0, buckets, empty, keys=empty, checks=empty.astype(np.uint32), owners=empty.astype(np.int64), places=empty.astype(np.int32), more=empty.astype(bool))
        block = table["_block"][0].as_py()
        ids, known = _ids(table, id_column)
        at, seeds, (edge, check), first = _windows(w.columns(table[text_column]), k, seed, EDGE_HASH, CHECK_HASH)
        row = w.rows_of(first)[at]
        hit = repeated[np.minimum(np.searchsorted(repeated, seeds), len(repeated) - 1)] == seeds
        at, row = at[hit & known[row]], row[hit & known[row]]
        keys = w.grams(edge, k, EDGE_HASH)[at]
        checks = (w.grams(check, k, CHECK_HASH)[at] >> np.uint64(32)).astype(np.uint32)
        owners, places = ids[row], (at - first[row]).astype(np.int32)
        order = np.lexsort((places, owners, checks, keys))
        keys, checks, owners, places = keys[order], checks[order], owners[order], places[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
        heads = np.flatnonzero(fresh)
        last = np.append(heads[1:], len(keys)) - 1
        more = owners[last] != owners[heads]
        # In the order of the text, so that neighbours compress well.
        again = np.lexsort((places[heads], owners[heads]))
        heads, more = heads[again], more[again]
        return _rows_by_bucket(block, buckets, keys[heads], keys=keys[heads], checks=checks[heads], owners=owners[heads], places=places[heads], more=more)

    return send


def _sources(table: pa.Table) -> pa.Table:
    """The source of each edge that several documents have, for each block that has it."""
    keys, sizes = w.unpack(table["keys"], np.uint64)
    checks, owners = w.unpack(table["checks"], np.uint32)[0], w.unpack(table["owners"], np.int64)[0]
    places, more = w.unpack(table["places"], np.int32)[0], w.unpack(table["more"], np.bool_)[0]
    block = np.repeat(table["_block"].to_numpy(), sizes)
    order = np.lexsort((places, owners, checks, keys))
    keys, checks, owners, places, more, block = (x[order] for x in (keys, checks, owners, places, more, block))
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(keys)))
    source = np.repeat(heads, sizes)
    answer = (owners != owners[source]) | more
    return _by_block(block[answer], keys=keys[answer], checks=checks[answer], sources=owners[source][answer], places=places[source][answer])


def _cut(id_column: str, text_column: str, k: int, keep_text: bool, names: list[str]):
    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, known = _ids(table, id_column)
        text = w.columns(table[text_column])
        (edge, check), first = w.hashes(text, EDGE_HASH, CHECK_HASH)
        at = w.whole(first, k)
        keys = w.grams(edge, k, EDGE_HASH)[at] if len(at) else np.zeros(0, np.uint64)
        checks = (w.grams(check, k, CHECK_HASH)[at] >> np.uint64(32)).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
        row = w.rows_of(first)[at]
        covered = np.zeros(int(first[-1]) + 1, np.int64)
        spans: list[list[dict]] = [[] for _ in range(len(ids))]
        answer = w.unpack(answers["keys"], np.uint64)[0]
        if len(answer) and len(at):
            sources, places = w.unpack(answers["sources"], np.int64)[0], w.unpack(answers["places"], np.int32)[0]
            bits = w.unpack(answers["checks"], np.uint32)[0]
            order = np.lexsort((bits, answer))
            answer, bits, sources, places = answer[order], bits[order], sources[order], places[order]
            found = np.minimum(np.searchsorted(answer, keys), len(answer) - 1)
            # Of edges that agree in 64 bits, that of equal check bits.
            for _ in range(int(np.diff(np.flatnonzero(np.append(np.concatenate([[True], answer[1:] != answer[:-1]]), True))).max()) - 1):
                onward = (found + 1 < len(answer)) & (bits[found] != checks)
                onward[onward] = answer[found[onward] + 1] == keys[onward]
                found = found + onward
            hit = (answer[found] == keys) & (bits[found] == checks) & known[row] & (sources[found] < ids[row])
            at, row, source, place = at[hit], row[hit], sources[found][hit], places[found][hit]
            joins = np.zeros(len(at), bool)
            joins[1:] = (at[1:] == at[:-1] + 1) & (row[1:] == row[:-1]) & (source[1:] == source[:-1]) & (place[1:] == place[:-1] + 1)
            heads = np.flatnonzero(~joins)
            edges = np.diff(np.append(heads, len(at)))
            np.add.at(covered, at[heads], 1)
            np.add.at(covered, at[heads] + edges + k - 1, -1)
            for h, n in zip(heads, edges, strict=True):
                r = int(row[h])
                spans[r].append({"start": int(at[h] - first[r]), "words": int(n + k - 1), "source": int(source[h]), "source_start": int(place[h])})
        gone = np.cumsum(covered)[:-1] > 0
        kept = _kept(text, ~gone, first)
        removed = np.add.reduceat(np.append(gone, False), first[:-1]) * (np.diff(first) > 0) if len(ids) else np.zeros(0)
        out = {n: table[n] for n in names}
        if keep_text:
            old = table[text_column].to_pylist()
            out[text_column] = pa.array([k.decode() if n else t for k, n, t in zip(kept, removed, old, strict=True)], pa.string())
        return pa.table(out | {
            "n_words": pa.array(np.diff(first).astype(np.int64)),
            "n_removed": pa.array(removed.astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())]))),
        })

    return cut


def _kept(text: w.Columns, keep: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The kept words of each row, joined by one space."""
    out: list[bytes] = []
    for row, end in w.slices(text):
        part = w.Columns(text.data[text.offsets[row] : text.offsets[end]], text.offsets[row : end + 1] - text.offsets[row])
        found = w.split(part)
        stays = keep[first[row] : first[end]]
        starts, sizes = found.starts[stays], (found.ends - found.starts)[stays]
        heads = np.cumsum(sizes + 1) - sizes - 1
        joined = np.full(int((sizes + 1).sum()), 32, np.uint8)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        joined[within + np.repeat(heads, sizes)] = part.data[within + np.repeat(starts, sizes)]
        kept_before = np.concatenate([[0], np.cumsum(stays)])[found.first]
        edges = np.append(heads, len(joined))[kept_before]
        flat = joined.tobytes()
        out += [flat[a : max(a, b - 1)] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return out


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 13, seed: int = 7, keep_text: bool = True) -> DataFrame:
    """Removes each word that a window of ``k`` words covers which a document with a smaller id has.

    Returns all columns and rows of ``docs``; in ``text_column`` (left out if ``keep_text`` is false)
    the kept words joined by one space, or the text as it was if it loses nothing; and ``n_words``,
    ``n_removed``, ``kept_sha256`` (of the kept words, joined) and ``spans``; columns of these names
    are replaced. Null and empty texts have no words and stay as
    they are; texts shorter than ``k`` words lose nothing; a row without an id is neither a source nor
    changed; rows of the same id are no sources of each other. An empty table gives an empty result.
    """
    given = free(docs, *ADDED)
    # Other columns go by numbers, so that none has a name that is used here.
    rows = given.toDF(*[c if c in (id_column, text_column) else f"carried_{i}" for i, c in enumerate(given.columns)])
    told = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col(text_column).cast("string"))).alias("bytes")).first()
    blocks, buckets = _spread(told["n"], told["bytes"] or 0)
    block = F.pmod(F.xxhash64(id_column, text_column), F.lit(blocks)).cast("int")
    placed = rows.withColumn("_block", block)
    seeds = placed.groupBy("_block").applyInArrow(
        _send_seeds(id_column, text_column, k, seed, buckets), "_block int, _bucket int, seeds binary"
    )
    repeated = seeds.groupBy("_bucket").applyInArrow(_repeated_seeds, "_block int, seeds binary")
    edges = placed.groupBy("_block").cogroup(repeated.groupBy("_block")).applyInArrow(
        _send_edges(id_column, text_column, k, seed, buckets),
        "_block int, _bucket int, keys binary, checks binary, owners binary, places binary, more binary",
    )
    sources = edges.groupBy("_bucket").applyInArrow(_sources, "_block int, keys binary, checks binary, sources binary, places binary")
    left_out = () if keep_text else (text_column,)
    names = [c for c in rows.columns if c not in left_out]
    schema = schema_with(rows, f"n_words bigint, n_removed bigint, kept_sha256 string, spans {SPANS}", left_out)
    done = placed.groupBy("_block").cogroup(sources.groupBy("_block")).applyInArrow(
        _cut(id_column, text_column, k, keep_text, names), schema
    )
    return done.toDF(*[c for c in given.columns if c not in left_out], *ADDED)
