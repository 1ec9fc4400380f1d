"""The trie of the turns that conversations begin with, by truncation peeling.

A node of depth ``d`` is a sequence of ``d`` turns that some conversation begins with. A turn is 16
bytes of the SHA-256 of its role and text, so that a conversation is a string of bytes, and nodes
are its prefixes. Conversations are sorted by these strings over range partitions, where those of a
node stand side by side, and a large group of copies spreads over as many partitions as it fills.

Each task peels its conversations from the maximum depth on: those that end at a depth join the
nodes that survive from below, neighbours that agree so far become one node, and its last turn is
stripped. Counts, leaves and sums of a subtree are whole when its top is met, so a level is seen
once. Rows are peeled in blocks of bounded size. What can go on in the next block or in another
partition are the prefixes of a block's first and last row only: such open nodes keep what is
closed below them, and are peeled at the end, a row per depth and partition.

A conversation is held as 24 bytes a turn in one task; no text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.llm.storage import text_or_empty, written
from fraudlens.operators.joins import dictionary_join

TURN_BYTES = 16
# Turns that are peeled at a time, and ids of equal conversations that are hashed or sent at a time.
BLOCK_TURNS, BLOCK_IDS = 1 << 20, 1 << 16
# Rows of a batch of results.
BATCH = 8192

NODE, OPEN, IDS = 0, 1, 2
COLUMNS = "kind byte, key string, parent_key string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends string, ids string"
SCHEMA = pa.schema([
    ("kind", pa.int8()), ("key", pa.string()), ("parent_key", pa.string()), *[(n, pa.int64()) for n in (
        "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "size")],
    ("ends", pa.string()), ("ids", pa.string()),
])
NOTHING = hashlib.sha256(b"").hexdigest()
# In place of a hash: the ids stand in rows of their own.
ELSEWHERE = "?"
NEVER = np.iinfo(np.int64).max


def ordered_turns(rows: DataFrame, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id`` and its ``turns`` (``digest`` in hex, ``size`` in code points) by turn, null first;
    turns of one number by their digest. Null roles and texts are empty; rows without an id are left out."""
    role, text = text_or_empty(role), text_or_empty(text)
    digest = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN_BYTES)
    told = F.struct(F.col(turn).cast("bigint").alias("turn"), digest.alias("digest"), F.char_length(text).cast("bigint").alias("size"))
    turns = rows.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("bigint").alias("conv_id"), told.alias("t"))
    each = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return turns.groupBy("conv_id").agg(each.alias("turns"))


class _Rows:
    """Rows of a block by path, each with what it brings to the node where it ends."""

    def __init__(self) -> None:
        self.paths: list[bytes] = []
        self.sizes: list[np.ndarray] = []
        self.n: list[int] = []
        self.least: list[int] = []
        self.ends: list[str] = []
        self.keys: list[str | None] = []
        self.turns = 0

    def add(self, path: bytes, sizes: np.ndarray, n: int, least: int, ends: str, key: str | None) -> None:
        self.paths.append(path)
        self.sizes.append(sizes)
        self.n.append(n)
        self.least.append(least)
        self.ends.append(ends)
        self.keys.append(key)
        self.turns += len(sizes) + 1


def shared_turns(paths: list[bytes]) -> np.ndarray:
    """How many turns each path shares with the one before it; none for the first."""
    depth = np.array([len(p) // TURN_BYTES for p in paths], np.int64)
    flat = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
    begin = np.cumsum(depth) - depth
    out = np.zeros(len(paths), np.int64)
    least = np.minimum(depth[1:], depth[:-1])
    some = np.flatnonzero(least)
    if len(some):
        least = least[some]
        heads = np.cumsum(least) - least
        within = np.arange(least.sum()) - np.repeat(heads, least)
        here, there = np.repeat(begin[1:][some], least) + within, np.repeat(begin[:-1][some], least) + within
        differs = (flat[here] != flat[there]).any(1)
        out[some + 1] = np.minimum(np.minimum.reduceat(np.where(differs, within, NEVER), heads), least)
    return out


def prefix_keys(path: bytes) -> list[str]:
    """A name for each prefix of whole turns, from none to all."""
    so_far, out = hashlib.sha256(), []
    for at in range(0, len(path) + 1, TURN_BYTES):
        so_far.update(path[max(0, at - TURN_BYTES) : at])
        out.append(so_far.hexdigest()[:32])
    return out


def peel(shared: np.ndarray, depth: np.ndarray, own: dict[str, np.ndarray], is_open) -> Iterator[tuple[int, np.ndarray, dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Descends from the maximum depth to none. For each depth: the first row of every node, its sums, the
    nodes of the depth below, by number, and the node here that each of them goes to.

    ``is_open(depth, first rows)`` marks nodes that have parts elsewhere: they are not handed on to their parents.
    """
    by_depth = np.argsort(depth, kind="stable")
    bounds = np.searchsorted(depth[by_depth], np.arange(depth.max(initial=0) + 2))
    row = np.zeros(0, np.int64)
    sums = {k: np.zeros(0, np.int64) for k in own}
    for d in range(depth.max(initial=0), -1, -1):
        ended = by_depth[bounds[d] : bounds[d + 1]]
        met = np.concatenate([row, ended])
        order = np.argsort(met, kind="stable")
        met, survives = met[order], order < len(row)
        head = shared[met] < d
        head[0] = True
        starts = np.flatnonzero(head)
        merged = {}
        for k, brought in sums.items():
            each = np.concatenate([brought, own[k][ended]])[order]
            merged[k] = np.minimum.reduceat(each, starts) if k == "least" else np.add.reduceat(each, starts)
        goes_to = np.empty(len(row), np.int64)
        goes_to[order[survives]] = (np.cumsum(head) - 1)[survives]
        row = met[starts]
        yield d, row, merged, goes_to, starts
        kept = ~is_open(d, row)
        leaf = merged["children"] == 0
        sums = {
            "n": merged["n"] * kept, "least": np.where(kept, merged["least"], NEVER), "children": kept.astype(np.int64),
            "leaves": np.where(leaf, 1, merged["leaves"]) * kept, "saved": merged["saved"] * kept,
        }


class _Partition:
    """The conversations of one range partition, in their order."""

    def __init__(self, block_turns: int = BLOCK_TURNS, block_ids: int = BLOCK_IDS) -> None:
        self.block_turns, self.block_ids = block_turns, block_ids
        self.rows = _Rows()
        self.path: bytes | None = None
        self.first: bytes | None = None
        self.last: bytes | None = None
        self.last_keys: list[str] = []
        # Prefixes of the last block's last row, by depth: what is closed below them.
        self.carried: dict[str, np.ndarray] | None = None
        self.carried_ends: list[str] = []
        self.left = -1
        self.out: list[pa.RecordBatch] = []
        self.held_rows: dict[str, list] = {f.name: [] for f in SCHEMA}

    # --- equal conversations ---

    def _send(self) -> None:
        key = self.key = self.key or prefix_keys(self.path)[-1]
        ids = np.concatenate(self.ids)
        self._row(IDS, key=key, conv_id=int(ids[0]), ids=",".join(map(str, ids.tolist())))
        self.ids, self.held, self.sent = [], 0, True

    def _end_class(self, at_edge: bool) -> None:
        if self.path is None:
            return
        if (at_edge or self.sent or self.path == self.first) and self.held:
            self._send()
        ends = ELSEWHERE if self.sent else hashlib.sha256(",".join(map(str, np.concatenate(self.ids).tolist())).encode()).hexdigest()
        self.rows.add(self.path, self.sizes, self.n, self.least, ends, self.key)
        self.path = None

    def add(self, path: bytes, sizes: np.ndarray, ids: np.ndarray) -> None:
        if path != self.path:
            self._end_class(at_edge=False)
            if self.rows.turns >= self.block_turns:
                self._peel()
            if self.first is None:
                self.first = path
            self.path, self.sizes, self.n, self.least, self.ids, self.held, self.sent, self.key = path, sizes, 0, int(ids[0]), [], 0, False, None
        self.n += len(ids)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            self._send()

    # --- output ---

    def _row(self, kind: int, **values) -> None:
        self._batch(1, kind=[kind], **{k: [v] for k, v in values.items()})

    def _batch(self, n: int, **values) -> None:
        """``n`` rows of some columns, as lists or arrays; the others are null. Few rows, such as a deep
        conversation has at each depth, are gathered first."""
        if n >= BATCH:
            self._flush()
            self.out.append(pa.RecordBatch.from_arrays(
                [pa.array(values[f.name], f.type, from_pandas=False) if f.name in values else pa.nulls(n, f.type) for f in SCHEMA], schema=SCHEMA))
        elif n:
            for name, held in self.held_rows.items():
                given = values.get(name)
                held.extend([None] * n if given is None else given.tolist() if isinstance(given, np.ndarray) else given)
            if len(self.held_rows["kind"]) >= BATCH:
                self._flush()

    def _flush(self) -> None:
        if self.held_rows["kind"]:
            self.out.append(pa.RecordBatch.from_pydict(self.held_rows, SCHEMA))
            self.held_rows = {f.name: [] for f in SCHEMA}

    def take(self) -> Iterator[pa.RecordBatch]:
        self._flush()
        yield from self.out
        self.out = []

    # --- peeling ---

    def _peel(self) -> None:
        """Peels the rows so far; open nodes on the right are carried to the next block."""
        rows = self.rows
        if not rows.paths:
            return
        items = 0 if self.carried is None else len(self.carried["n"])
        paths = [self.last, *rows.paths] if items else rows.paths
        found = shared_turns(paths)
        depth_new = np.array([len(p) // TURN_BYTES for p in rows.paths], np.int64)
        shared = np.concatenate([np.arange(items) - 1, found[1:] if items else found])
        if not items:
            shared[0] = -1
            self.left = int(depth_new[0])
        depth = np.concatenate([np.arange(items), depth_new])
        zeros = np.zeros(len(depth_new), np.int64)
        own = {"n": np.array(rows.n, np.int64), "least": np.array(rows.least, np.int64), "children": zeros, "leaves": zeros, "saved": zeros}
        flat = np.concatenate(rows.sizes) if rows.sizes else np.zeros(0, np.int64)
        begin = np.cumsum(depth_new) - depth_new
        ends, keys = rows.ends, rows.keys
        if items:
            own = {k: np.concatenate([self.carried[k], v]) for k, v in own.items()}
            flat = np.concatenate([self.carried["size"], flat])
            # The size of the last turn of the item of depth d stands at d.
            begin = np.concatenate([np.ones(items, np.int64), begin + items])
            # What was open may have been named as a parent.
            ends, keys = self.carried_ends + ends, self.last_keys + keys
        ends, keys = np.array(ends, object), np.array(keys, object)
        last_depth, left = int(depth_new[-1]), self.left
        last_keys, first_keys = prefix_keys(rows.paths[-1]), prefix_keys(self.first)

        def opens(d: int, row: np.ndarray) -> np.ndarray:
            out = np.zeros(len(row), bool)
            out[0] |= d <= left
            out[-1] |= d <= last_depth
            return out

        carried = {k: np.zeros(last_depth + 1, np.int64) for k in (*own, "size")}
        carried_ends = [""] * (last_depth + 1)
        below = None
        for d, row, sums, goes_to, starts in peel(shared, depth, own, opens):
            size = flat[begin[row] + d - 1] if d else np.zeros(len(row), np.int64)
            leaf = sums["children"] == 0
            opened = opens(d, row)
            here_ends = np.where(depth[row] == d, ends[row], "")
            if below is not None:
                self._closed(d + 1, below, goes_to, sums["least"], opened, last_keys, first_keys)
            closed = ~opened
            sums["saved"] = sums["saved"] + np.where(closed, (sums["n"] - 1) * size, 0)
            for at in np.flatnonzero(opened).tolist():
                if at == len(row) - 1 and d <= last_depth:
                    for k in own:
                        carried[k][d] = sums[k][at]
                    carried["size"][d], carried_ends[d] = size[at], here_ends[at]
                else:
                    self._open(d, first_keys, {k: v[at] for k, v in sums.items()}, int(size[at]), here_ends[at])
            below = {"n": sums["n"], "least": sums["least"], "children": sums["children"], "leaves": np.where(leaf, 1, sums["leaves"]), "saved": sums["saved"], "closed": closed, "ends": here_ends, "key": np.where(depth[row] == d, keys[row], None)}
        self.carried, self.carried_ends, self.last, self.last_keys = carried, carried_ends, rows.paths[-1], last_keys
        new = found[1:]
        self.left = min(left, int(new.min(initial=left)), last_depth)
        self.rows = _Rows()

    def _closed(self, d: int, nodes: dict, goes_to: np.ndarray, parent_least: np.ndarray, parent_open: np.ndarray, last_keys: list[str], first_keys: list[str]) -> None:
        """Rows of whole nodes of depth ``d``, now that their parents are known or known to be open."""
        chosen = np.flatnonzero(nodes["closed"])
        if not len(chosen):
            return
        to = goes_to[chosen]
        opened = parent_open[to]
        parent_key = np.full(len(chosen), None, object)
        # An open parent is a prefix of the last row if it is the last of its depth, and else of the first.
        on_right = opened & (to == len(parent_open) - 1) & (d - 1 < len(last_keys))
        parent_key[on_right] = last_keys[d - 1] if d - 1 < len(last_keys) else None
        parent_key[opened & ~on_right] = first_keys[d - 1] if d - 1 < len(first_keys) else None
        ends = nodes["ends"][chosen]
        parent = parent_least[to].astype(object)
        parent[opened] = None
        self._batch(
            len(chosen), kind=np.full(len(chosen), NODE, np.int8), key=nodes["key"][chosen], parent_key=parent_key, depth=np.full(len(chosen), d),
            conv_id=nodes["least"][chosen], parent_conv_id=parent, n_convs=nodes["n"][chosen], n_children=nodes["children"][chosen],
            n_leaves=nodes["leaves"][chosen], saved_tokens=nodes["saved"][chosen], ends=np.where(ends == "", NOTHING, ends).astype(object),
        )

    def _open(self, d: int, keys: list[str], sums: dict, size: int, ends: str) -> None:
        self._row(
            OPEN, key=keys[d], parent_key=keys[d - 1] if d else None, depth=d, conv_id=int(sums["least"]), n_convs=int(sums["n"]), n_children=int(sums["children"]),
            n_leaves=int(sums["leaves"]), saved_tokens=int(sums["saved"]), size=size, ends=ends,
        )

    def finish(self) -> None:
        self._end_class(at_edge=True)
        self._peel()
        if self.carried is not None:
            for d in range(len(self.carried["n"])):
                self._open(d, self.last_keys, {k: v[d] for k, v in self.carried.items()}, int(self.carried["size"][d]), self.carried_ends[d])


def _peel_partition(block_turns: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Partition(block_turns, block_ids)
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, ids, sizes = batch["path"].to_pylist(), batch["conv_id"].to_numpy(), batch["sizes"]
            flat, offsets = sizes.values.to_numpy(zero_copy_only=False), sizes.offsets.to_numpy()
            change = [0, *(i for i in range(1, len(paths)) if paths[i] != paths[i - 1]), len(paths)]
            for begin, end in zip(change, change[1:], strict=False):
                part.add(paths[begin], flat[offsets[begin] : offsets[begin + 1]], ids[begin:end])
                yield from part.take()
        part.finish()
        yield from part.take()

    return run


def _merge_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes of all partitions, again from the maximum depth on."""
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held).to_pandas()
    met = rows.groupby("key").agg(
        depth=("depth", "first"), parent_key=("parent_key", "first"), least=("conv_id", "min"), n=("n_convs", "sum"), children=("n_children", "sum"),
        leaves=("n_leaves", "sum"), saved=("saved_tokens", "sum"), size=("size", "max"), ends=("ends", "max")).sort_values("depth", ascending=False, kind="stable")
    above = met.index.get_indexer(met["parent_key"])
    depth, least, n, children, leaves, saved, size = (met[c].to_numpy(np.int64).copy() for c in ("depth", "least", "n", "children", "leaves", "saved", "size"))
    edges = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]]))
    for a, b in zip(edges, edges[1:], strict=False):
        leaves[a:b] = np.where(children[a:b] == 0, 1, leaves[a:b])
        saved[a:b] += (n[a:b] - 1) * size[a:b]
        to = above[a:b]
        if to[0] < 0:
            break
        for total, part in ((n, n), (children, None), (leaves, leaves), (saved, saved)):
            np.add.at(total, to, 1 if part is None else part[a:b])
        np.minimum.at(least, to, least[a:b])
    parents = least[above].astype(object)
    parents[above < 0] = None
    ends = met["ends"].to_numpy(object)
    part = _Partition()
    part._batch(
        len(met), kind=np.full(len(met), NODE, np.int8), key=met.index.to_numpy(object), depth=depth, conv_id=least, parent_conv_id=parents, n_convs=n,
        n_children=children, n_leaves=leaves, saved_tokens=saved, ends=np.where(ends == "", NOTHING, ends).astype(object))
    yield from part.take()


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the ids of each key, whose rows come in their order."""
    key, so_far = None, None
    for batch in batches:
        for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    yield pa.RecordBatch.from_pydict({"key": [key], "hash": [so_far.hexdigest()]})
                key, so_far = k, hashlib.sha256()
            else:
                so_far.update(b",")
            so_far.update(ids.encode())
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "hash": [so_far.hexdigest()]})


def _looked_up(rows: DataFrame, table: DataFrame, key: str, value: str, column: str, needed: Column) -> DataFrame:
    """``column`` of the rows where ``needed`` holds, from ``table`` by ``key``; the others are not shuffled."""
    found = dictionary_join(rows.where(needed).drop(column), table.select(F.col("key").alias(key), F.col(value).alias(column)), [key], "left")
    return rows.where(~needed).unionByName(found)


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """A row per node of the conversations' ``conv_id`` and ``turns`` (see :func:`ordered_turns`), ids being unique.

    ``conv_id`` is the smallest of the node's conversations, ``parent_conv_id`` that of its parent (null
    at the root, which has depth 0), ``n_convs`` and ``n_children`` count, ``n_leaves`` counts the
    childless nodes of its subtree, ``saved_tokens`` sums ``(n_convs - 1) * size of the last turn`` over
    it, and ``ends_sha256`` is the hash of the ids of those that end here, ascending and joined by
    commas. Conversations without turns end at the root; without conversations there is no node.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    paths = written(conversations.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "trie-paths")
    dealt = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    peeled = written(dealt.mapInArrow(_peel_partition(block_turns, block_ids), COLUMNS), "trie-nodes")
    merged = written(peeled.where(F.col("kind") == OPEN).repartition(1).mapInArrow(_merge_open, COLUMNS), "trie-open")
    ids = peeled.where(F.col("kind") == IDS).select("key", "conv_id", "ids").repartition("key").sortWithinPartitions("key", "conv_id")
    hashes = written(ids.mapInArrow(_hash_ids, "key string, hash string"), "trie-ends")

    nodes = peeled.where(F.col("kind") == NODE)
    parents = merged.union(nodes.where("key IS NOT NULL")).select("key", "conv_id")
    placed = _looked_up(nodes, parents, "parent_key", "conv_id", "parent_conv_id", F.col("parent_key").isNotNull())
    whole = _looked_up(placed.unionByName(merged), hashes, "key", "hash", "ends", F.col("ends") == ELSEWHERE)
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
