"""Encoding texts to pieces of a vocabulary, and decoding, by the most likely segmentation.

The vocabulary is read from a SentencePiece file: pieces with log scores, and a piece for each byte.
Scores of a vocabulary of merges are ranks there; a piece of rank ``r`` counts as ``-log(r + 2)``. A
space is a marker at the beginning of pieces, and a marker stands before each text. Characters that
are no piece fall back to their bytes, each of which costs ``FALLBACK`` more than the rarest piece;
among these is the marker itself where a text has it, so that decoding gives back every text.

Pieces have markers at their beginning only and hold no line ends, so that texts can be cut before
runs of spaces and around line ends. Each distinct chunk of a part of a column is segmented once, all
together, a byte position at a time, on a double-array trie.

A chunk of any length (text without spaces) is cut into stretches that are also segmented together. What
a stretch needs to know of the text before it are the scores of the last positions, as far as a piece is
long, less their maximum; it guesses them by beginning ``WARM`` bytes early. The guess is compared with
what the stretch before gives, and where they differ the stretch is segmented again from the latter,
unless an equal one was. Scores are whole multiples of ``GRAIN``, so that their sums are exact and
do not depend on where they begin. Of the whole chunk only a byte per position is kept: how far the best piece reaches back.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm import words as w
from fraudlens.llm.storage import free, schema_with

MARKER = "▁"
# Stands for the marker in data; no UTF-8 text has this byte.
SPACE = 0xFF
FALLBACK = 10.0
PART_BYTES, BLOCK = 1 << 21, 1 << 22
# Bytes of a stretch, of what it begins early, and stretches that are segmented together; equal stretches that are remembered.
STRETCH, WARM, GROUP, REMEMBERED = 2048, 256, 512, 4096
# Chunks up to this size are segmented with others as a whole.
LONG = 2 * STRETCH
GRAIN = 2.0**-24
# Ids that are decoded at a time.
DECODED = 1 << 19
ADDED = ("token_ids", "n_tokens")


class Vocabulary(NamedTuple):
    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    single: np.ndarray
    longest: int


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, check, value``: from state ``s``, byte ``b`` leads to ``base[s] + b`` if its check is ``s``."""
    tree: dict = {}
    for key, number in keys.items():
        node = tree
        for b in key:
            node = node.setdefault(b, {})
        node[-1] = number
    size = 1 << 16
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0], free_from = 0, 1
    todo = [(0, tree)]
    while todo:
        state, node = todo.pop()
        value[state] = node.get(-1, -1)
        children = sorted(b for b in node if b >= 0)
        if not children:
            continue
        at = max(1, free_from - children[0])
        while True:
            if at + 256 >= len(check):
                more = len(check)
                base += [0] * more
                check += [-1] * more
                value += [-1] * more
            if all(check[at + b] < 0 for b in children):
                break
            at += 1
        base[state] = at
        for b in children:
            check[at + b] = state
            todo.append((at + b, node[b]))
        while check[free_from] >= 0:
            free_from += 1
        # Do not search a crowded part again and again.
        if at > free_from + 4096:
            free_from = at - 2048
    return np.array(base, np.int32), np.array(check, np.int32), np.array(value, np.int32)


def vocabulary(pieces: list[tuple[str, float]], byte_ids: list[int], usable: list[bool], ranks: bool) -> Vocabulary:
    """``pieces`` by id, with scores; ``usable`` says which of them may occur in a segmentation."""
    raw = [p.encode().replace(MARKER.encode(), bytes([SPACE])) for p, _ in pieces]
    for text, ok in zip(raw, usable, strict=True):
        if ok and (b"\n" in text or not re.fullmatch(rb"\xff*[^\xff]*", text)):
            raise ValueError(f"a piece that holds a line end, or a marker behind other characters: {text!r}")
    given = np.array([s for _, s in pieces])
    scores = -np.log(2 - given.clip(max=0)) if ranks else given
    trie = double_array({t: i for i, (t, ok) in enumerate(zip(raw, usable, strict=True)) if ok and t})
    single = np.zeros(0x110000 + 1, bool)
    for text, ok in zip(raw, usable, strict=True):
        if ok and text == bytes([SPACE]):
            single[-1] = True
        elif ok and SPACE not in text and len(text.decode()) == 1:
            single[ord(text.decode())] = True
    ids = np.array(byte_ids, np.int32)
    raw = [t if ok else b"" for t, ok in zip(raw, usable, strict=True)]
    for b, i in enumerate(byte_ids):
        raw[i] = bytes([b])
    longest = max((len(t) for t, ok in zip(raw, usable, strict=True) if ok), default=1)
    cost = float(scores[np.array(usable)].min()) - FALLBACK
    scores = scores.copy()
    scores[ids] = cost
    scores = np.round(scores / GRAIN) * GRAIN
    if longest > 255:
        raise ValueError(f"a piece of {longest} bytes; at most 255 are possible")
    return Vocabulary(raw, scores, ids, *trie, single, longest)


def load(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(n)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    scores = [model.get_score(i) for i in range(n)]
    normal = [s for s, x in zip(scores, special, strict=True) if not x]
    ranks = all(s == int(s) for s in normal) and min(normal) <= -1000
    return vocabulary([(model.id_to_piece(i), s) for i, s in enumerate(scores)], byte_ids, [not x for x in special], ranks)


def _advance(v: Vocabulary, data: np.ndarray, covered: np.ndarray, begins: np.ndarray, ends: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments stretches of ``data`` together. ``scores`` has those of the ``longest`` positions up to each stretch's
    beginning; the results go on from there: scores, and for each position the bytes of the best piece that ends there."""
    n, k = scores.shape
    width = k + int((ends - begins).max(initial=0))
    best = np.full((n, width), -np.inf)
    best[:, :k] = scores
    back = np.zeros((n, width), np.uint8)
    for c in range(width - 1):
        at = begins + (c - k + 1)
        row = np.flatnonzero((best[:, c] > -np.inf) & (at >= 0) & (at < ends))
        if not len(row):
            continue
        here, at = best[row, c], at[row]
        if c + 1 >= k:
            bare = ~covered[at]
            r = row[bare]
            cost = here[bare] + v.scores[v.byte_ids[data[at[bare]]]]
            better = cost > best[r, c + 1]
            best[r[better], c + 1], back[r[better], c + 1] = cost[better], 1
        state = np.zeros(len(row), np.int32)
        for j in range(k):
            alive = at + j < ends[row]
            if not alive.all():
                row, state, here, at = row[alive], state[alive], here[alive], at[alive]
            step = v.base[state] + data[at + j]
            good = (v.check[step] == state) & (step > 0)
            row, state, here, at = row[good], step[good], here[good], at[good]
            if not len(row):
                break
            to = c + j + 1
            if to < k:
                continue
            number = v.value[state]
            cost = np.where(number >= 0, here + v.scores[number], -np.inf)
            better = cost > best[row, to]
            best[row[better], to], back[row[better], to] = cost[better], j + 1
    return best, back


def _one(v: Vocabulary, text: bytes, covered: bytes, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for one stretch: ``text`` begins ``longest - 1`` bytes before it, ``scores`` are those of the positions there."""
    k = len(scores)
    n = len(text)
    best, back = scores.tolist() + [-np.inf] * (n - k + 1), bytearray(n + 1)
    base, check, value, given, byte_ids = (memoryview(x) for x in (v.base, v.check, v.value, v.scores, v.byte_ids))
    for p in range(n):
        here = best[p]
        if here == -np.inf:
            continue
        if p + 1 >= k and not covered[p] and here + given[byte_ids[text[p]]] > best[p + 1]:
            best[p + 1], back[p + 1] = here + given[byte_ids[text[p]]], 1
        state = 0
        for q in range(p, min(n, p + k)):
            step = base[state] + text[q]
            if check[step] != state or step == 0:
                break
            state = step
            number = value[state]
            if q + 1 >= k and number >= 0 and here + given[number] > best[q + 1]:
                best[q + 1], back[q + 1] = here + given[number], q + 1 - p
    return np.array(best[-k:]), np.frombuffer(bytes(back[k:]), np.uint8)


def _relative(scores: np.ndarray) -> np.ndarray:
    return scores - scores.max(-1, keepdims=True)


def _long(v: Vocabulary, data: np.ndarray, covered_of) -> np.ndarray:
    """Ids of a chunk of any length. ``covered_of(begin, end)`` says which bytes belong to a character that is a piece."""
    n, k = len(data), v.longest
    back = np.zeros(n + 1, np.uint8)
    now = np.full(k, -np.inf)
    now[-1] = 0
    remembered: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray]] = {}
    for begin in range(0, n, STRETCH * GROUP):
        low, high = max(0, begin - WARM - k), min(n, begin + STRETCH * GROUP)
        part, covered = data[low:high], covered_of(low, high)
        starts = np.arange(begin, high, STRETCH)
        stops = np.minimum(starts + STRETCH, high)
        early = np.maximum(starts - WARM, 0)
        guess = np.full((len(starts), k), -np.inf)
        guess[:, -1] = 0
        best, found = _advance(v, part, covered, early - low, stops - low, guess)
        for i, (start, stop) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
            at = k - 1 + start - early[i]
            guessed = best[i, at - k + 1 : at + 1]
            if start == early[i] or (guessed.max() > -np.inf and (_relative(guessed) == _relative(now)).all()):
                end = at + stop - start
                back[start + 1 : stop + 1] = found[i, at + 1 : end + 1]
                now = _relative(best[i, end - k + 1 : end + 1])
                continue
            # The text from the first of the positions that have scores; before the chunk there is none.
            lead = start - k + 1
            text = b"\0" * max(0, -lead) + data[max(0, lead) : stop].tobytes()
            bare = b"\1" * max(0, -lead) + covered[max(0, lead) - low : stop - low].tobytes()
            key = (text + bare, _relative(now).tobytes())
            if key not in remembered:
                if len(remembered) == REMEMBERED:
                    remembered.clear()
                scores, steps = _one(v, text, bare, _relative(now))
                remembered[key] = (_relative(scores), steps)
            now, back[start + 1 : stop + 1] = remembered[key]
    return _ids(v, data, back)


def _ids(v: Vocabulary, data: np.ndarray, back: np.ndarray) -> np.ndarray:
    """The pieces that end at the chunk's end and, again and again, where one begins."""
    held, p, ends = memoryview(back), len(data), bytearray(len(data) + 1)
    while p:
        ends[p] = 1
        p -= held[p]
    stops = np.flatnonzero(np.frombuffer(ends, np.uint8)).astype(np.int32)
    out = np.empty(len(stops), np.int32)
    for a in range(0, len(stops), DECODED):
        stop = stops[a : a + DECODED].astype(np.int64)
        size = back[stop].astype(np.int64)
        begin, state, known = stop - size, np.zeros(len(stop), np.int64), np.ones(len(stop), bool)
        for j in range(int(size.max())):
            on = np.flatnonzero(known & (size > j))
            step = v.base[state[on]] + data[begin[on] + j]
            good = (v.check[step] == state[on]) & (step > 0)
            known[on[~good]] = False
            state[on[good]] = step[good]
        number = np.where(known, v.value[state], -1)
        out[a : a + DECODED] = np.where(number >= 0, number, v.byte_ids[data[begin]])
    return out


def _together(v: Vocabulary, data: np.ndarray, covered: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks, and how many each has."""
    n, longest = len(starts), int(sizes.max())
    best = np.full((n, longest + 1), -np.inf)
    best[:, 0] = 0
    back, ids = np.zeros((n, longest + 1), np.int32), np.zeros((n, longest + 1), np.int32)
    for p in range(longest):
        row = np.flatnonzero((sizes > p) & (best[:, p] > -np.inf))
        if not len(row):
            continue
        here = best[row, p]
        at = starts[row] + p
        bare = ~covered[at]
        if bare.any():
            r = row[bare]
            number = v.byte_ids[data[at[bare]]]
            cost = here[bare] + v.scores[number]
            better = cost > best[r, p + 1]
            r = r[better]
            best[r, p + 1], back[r, p + 1], ids[r, p + 1] = cost[better], p, number[better]
        state = np.zeros(len(row), np.int32)
        for q in range(p, min(longest, p + v.longest)):
            alive = np.flatnonzero(sizes[row] > q) if q > p else np.arange(len(row))
            row, state, here = row[alive], state[alive], here[alive]
            step = v.base[state] + data[starts[row] + q]
            good = (v.check[step] == state) & (step > 0)
            row, state, here = row[good], step[good], here[good]
            if not len(row):
                break
            number = v.value[state]
            cost = np.where(number >= 0, here + v.scores[number], -np.inf)
            better = cost > best[row, q + 1]
            r = row[better]
            best[r, q + 1], back[r, q + 1], ids[r, q + 1] = cost[better], p, number[better]
    counts = np.zeros(n, np.int64)
    out = np.zeros((n, longest), np.int32)
    row, p = np.arange(n), sizes.astype(np.int64)
    while len(row):
        out[row, counts[row]] = ids[row, p]
        counts[row] += 1
        p = back[row, p].astype(np.int64)
        row, p = row[p > 0], p[p > 0]
    # Ids were found from the end on.
    total = int(counts.sum())
    heads = np.cumsum(counts) - counts
    within = np.arange(total) - np.repeat(heads, counts)
    owner = np.repeat(np.arange(n), counts)
    return out[owner, counts[owner] - 1 - within], counts


def _marked(text: w.Columns) -> w.Columns:
    """Texts that are not empty get a marker before them; spaces become markers."""
    some = np.diff(text.offsets) > 0
    ends = np.cumsum(np.diff(text.offsets) + some)
    offsets = np.concatenate([[0], ends])
    out = np.full(int(offsets[-1]), SPACE, np.uint8)
    before = np.repeat(np.cumsum(some), np.diff(text.offsets))
    out[np.arange(len(text.data)) + before] = np.where(text.data == 32, np.uint8(SPACE), text.data)
    return w.Columns(out, offsets)


def _covered(v: Vocabulary, data: np.ndarray) -> np.ndarray:
    """Which bytes of whole characters belong to one that is a piece."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    plain = data[data != SPACE].tobytes().decode("utf-8", "replace").encode("utf-32-le")
    codes = np.full(len(lead), 0x110000, np.int64)
    codes[data[lead] != SPACE] = np.frombuffer(plain, np.uint32)
    return np.repeat(v.single[codes], np.diff(np.append(lead, len(data))))


def _cuts(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a chunk, but for the first."""
    cut = np.zeros(len(data), bool)
    cut[1:] = ((data[1:] == SPACE) & (data[:-1] != SPACE)) | (data[1:] == 10) | (data[:-1] == 10)
    return cut


def _long_row(v: Vocabulary, row: np.ndarray) -> np.ndarray:
    """Ids of one long text, some chunks at a time, or one that is long itself."""
    data = np.empty(len(row) + 1, np.uint8)
    data[0], data[1:] = SPACE, row
    data[1:][row == 32] = SPACE
    n, at, out = len(data), 0, []
    while at < n:
        end = min(n, at + PART_BYTES)
        if end < n:
            last = np.flatnonzero(_cuts(data[at : end + 1]))
            if len(last):
                end = at + int(last[-1])
            else:
                while end < n:
                    more = np.flatnonzero(_cuts(data[end - 1 : min(n, end + PART_BYTES)]))
                    if len(more):
                        end += int(more[0]) - 1
                        break
                    end = min(n, end + PART_BYTES)
        if end - at <= PART_BYTES:
            out.append(_encode(v, w.Columns(data[at:end], np.array([0, end - at])))[0])
        else:
            out.append(_long(v, data[at:end], _covered_in(v, data[at:end])))
        at = end
    return np.concatenate(out)


def _covered_in(v: Vocabulary, data: np.ndarray):
    """``_covered`` of a part of a long chunk, which may begin and end inside characters."""

    def covered(begin: int, end: int) -> np.ndarray:
        low, high = begin, end
        while low > 0 and data[low] & 0xC0 == 0x80:
            low -= 1
        while high < len(data) and data[high] & 0xC0 == 0x80:
            high += 1
        return _covered(v, data[low:high])[begin - low : end - low]

    return covered


def encode(v: Vocabulary, values: pa.Array) -> pa.Array:
    """Ids of each text; null for null."""
    text = w.columns(values)
    ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for row, end in w.slices(text, PART_BYTES):
        raw = text.data[text.offsets[row] : text.offsets[end]]
        if len(raw) > PART_BYTES:
            # Alone, but for empty texts.
            found = _long_row(v, raw)
            counts = np.where(np.diff(text.offsets[row : end + 1]) > 0, len(found), 0)
        else:
            found, counts = _encode(v, _marked(w.Columns(raw, text.offsets[row : end + 1] - text.offsets[row])))
        ids.append(found)
        sizes.append(counts)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(ids)))
    missing = values.is_null()
    return pa.compute.if_else(missing, pa.scalar(None, lists.type), lists) if values.null_count else lists


def _encode(v: Vocabulary, part: w.Columns) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = part
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
    cut = _cuts(data)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    sizes = np.diff(np.append(starts, len(data)))
    covered = _covered(v, data)
    chunk = w.Words(starts, starts + sizes, np.zeros(0, np.int64))
    one, two = (w._hash(data, chunk, w.byte_table(s), s) for s in (51, 52))
    order = np.lexsort((two, one))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    distinct = order[fresh]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(fresh) - 1
    # By size, so that chunks of about the same size are segmented together.
    by_size = np.argsort(sizes[distinct], kind="stable")
    place = np.empty(len(distinct), np.int64)
    place[by_size] = np.arange(len(distinct))
    distinct, which = distinct[by_size], place[which]
    found, counts = [], []
    short = int(np.searchsorted(sizes[distinct], LONG, "right"))
    a = 0
    while a < short:
        # As many as fit, and at most four times as long as the first.
        most = int(np.searchsorted(sizes[distinct[:short]], 4 * max(16, int(sizes[distinct[a]])), "right"))
        b = a + 1
        while b < most and (min(most, 2 * b - a) - a) * int(sizes[distinct[min(most, 2 * b - a) - 1]]) <= BLOCK:
            b = min(most, 2 * b - a)
        some = distinct[a:b]
        ids, n = _together(v, data, covered, starts[some], sizes[some])
        found.append(ids)
        counts.append(n)
        a = b
    for i in distinct[short:]:
        a, b = starts[i], starts[i] + sizes[i]
        ids = _long(v, data[a:b], lambda begin, end, a=a: covered[a + begin : a + end])
        found.append(ids)
        counts.append(np.array([len(ids)]))
    flat, counts = np.concatenate(found), np.concatenate(counts)
    heads = np.cumsum(counts) - counts
    each = counts[which]
    ends = np.cumsum(each)
    at = np.arange(int(ends[-1])) - np.repeat(ends - each, each) + np.repeat(heads[which], each)
    before = np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]
    return flat[at], np.diff(before)


def _text(v: Vocabulary, ids: np.ndarray) -> bytes:
    """The bytes of some ids, with markers."""
    sizes = np.array([len(p) for p in v.pieces], np.int64)
    flat = np.frombuffer(b"".join(v.pieces), np.uint8)
    heads = np.cumsum(sizes) - sizes
    out = []
    for a in range(0, len(ids), DECODED):
        some = ids[a : a + DECODED].astype(np.int64)
        each = sizes[some]
        ends = np.cumsum(each)
        out.append(flat[np.arange(int(each.sum())) - np.repeat(ends - each, each) + np.repeat(heads[some], each)].tobytes())
    return b"".join(out)


def decode(v: Vocabulary, lists: pa.Array) -> pa.Array:
    """The text of each list of ids; null for null. Ids that stand for no text are left out."""
    sizes = np.array([len(p) for p in v.pieces], np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    until = np.concatenate([[0], np.cumsum(counts)])
    data = _text(v, ids)
    bytes_of = np.concatenate([[0], np.cumsum([int(sizes[ids[a:b]].sum()) for a, b in zip(until.tolist(), until[1:].tolist(), strict=False)])]).tolist()
    cells = []
    for a, b in zip(bytes_of, bytes_of[1:], strict=False):
        cell = data[a:b]
        marker = bytes([SPACE])
        cells.append(cell.removeprefix(marker).replace(marker, b" ").decode("utf-8", "replace"))
    return pa.array(cells, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))


def _parts(batch: pa.RecordBatch, text_column: str):
    """Rows of a batch, a few MB of text at a time."""
    text = w.columns(batch.column(text_column))
    for row, end in w.slices(text, PART_BYTES):
        yield batch.slice(row, end - row)


def with_pieces(rows: DataFrame, vocabulary: Vocabulary, text_column: str = "text", check: bool = False) -> DataFrame:
    """All columns and rows with ``token_ids`` and ``n_tokens``, and with ``check`` also ``round_trip``,
    whether decoding gives the text back; columns of these names are replaced.

    Null texts have null ids and no tokens, empty texts no ids; both count as given back. Whole texts
    are encoded, however long. The vocabulary (its size does not depend on the rows) is broadcast.
    """
    kept = free(rows, *ADDED, *(["round_trip"] if check else [])).withColumn(text_column, F.col(text_column).cast("string"))
    names, shared = kept.columns, rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        v = shared.value
        for whole in batches:
            for batch in _parts(whole, text_column):
                ids = encode(v, batch.column(text_column))
                out = {n: batch.column(n) for n in names} | {"token_ids": ids, "n_tokens": ids.value_lengths().fill_null(0).cast(pa.int64())}
                if check:
                    out["round_trip"] = pa.compute.equal(decode(v, ids), batch.column(text_column).cast(pa.string())).fill_null(True)
                yield pa.RecordBatch.from_pydict(out)

    added = "token_ids array<int>, n_tokens bigint" + ", round_trip boolean" * check
    return kept.mapInArrow(run, schema_with(kept, added))


def with_text(rows: DataFrame, vocabulary: Vocabulary, ids_column: str = "token_ids", text_column: str = "text") -> DataFrame:
    """All columns and rows with the text of the ids in ``text_column``, which is replaced; null for null."""
    kept = free(rows, text_column)
    names, shared = kept.columns, rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            texts = decode(shared.value, batch.column(ids_column))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [texts], names=[*names, text_column])

    return kept.mapInArrow(run, schema_with(kept, f"{text_column} string"))
