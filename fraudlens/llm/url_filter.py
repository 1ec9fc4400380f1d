"""Allow and block lists of URLs, answered by a cascade of Bloom filters.

A list has entries ``host/path``: an entry fits its host and all subdomains, if the URL's path is the
entry's or, where that ends with ``/``, begins with it. The keys of a URL are the entries that would fit
it, of as many labels and path segments as listed ones have; a URL is listed if one of its keys is.

The first filter encodes the listed keys. The keys of the whole corpus that it lets through though
they are not listed are the second filter's, the listed ones that this lets through the third's, and so
on until nothing is let through. For every key of the corpus the answer is then exact: it is
listed if an odd number of filters in a row let it through. No URL is shuffled or joined for it: only
distinct false positives of the first filter are shuffled, some 1.4 for each listed key.

Keys are dealt into segments by a hash, each with a small cascade of its own that one task builds.
The size of all filters follows from the numbers of listed keys and of keys in the corpus (a few
bytes per listed key) and is checked before they are sent to the executors; longer lists than
``most_bytes`` allows are joined with the keys instead.
"""

from __future__ import annotations

from math import ceil, log, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.llm.storage import written
from fraudlens.llm.words import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Listed keys of a segment, bytes of filters that are sent to the executors, filters that a cascade can need.
SEGMENT, MOST_BYTES, MOST_LEVELS = 1 << 16, 256 << 20, 64


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of the ``rules`` (``host/path``) that fits, or null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, at = rule.split("/", 1)
        chosen = F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{at}"), rule).otherwise(chosen)
    return chosen


def keys_of(host: Column, path: Column, labels: int, segments: int) -> Column:
    """Entries of at most ``labels`` labels and ``segments`` segments that would fit, from the longest host and path on.
    An empty path is ``/``; without a host there are none."""
    names = F.split(host, r"\.")
    count = F.size(names)
    first = F.greatest(F.lit(1), count - labels + 1)
    hosts = F.transform(F.sequence(first, count), lambda i: F.array_join(F.slice(names, i, count - i + 1), "."))
    whole = F.when(path == "", "/").otherwise(path)
    # The rest of a path of more segments stays in one piece, which is not used.
    pieces = F.split(whole, "/", segments + 2)
    slashes = F.size(pieces) - 1
    inner = F.transform(F.sequence(F.lit(1), F.least(slashes, F.lit(segments))), lambda i: F.concat(F.array_join(F.slice(pieces, 1, i), "/"), F.lit("/")))
    paths = F.reverse(F.when(slashes <= segments, F.array_distinct(F.array_append(inner, whole))).otherwise(inner))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


# --- filters ---


def _places(h1: np.ndarray, h2: np.ndarray, level: int, function: int, sizes: np.ndarray | int) -> np.ndarray:
    odd = np.uint64(2 * (level * 64 + function) + 1)
    return (mix(h1.view(np.uint64) + h2.view(np.uint64) * odd) % np.asarray(sizes, np.uint64)).astype(np.int64)


def _bits(n: int, functions: int) -> int:
    return max(64, ceil(n * functions / log(2)))


def _functions(level: int, first: int) -> int:
    return first if level == 0 else 1


def cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray, first: int) -> list[np.ndarray]:
    """The filters, as arrays of truth values, of keys by their hashes; ``first`` hash functions in the first filter."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[np.ndarray] = []
    while len(inside):
        level = len(levels)
        if level == MOST_LEVELS:
            raise ValueError("a listed key and another one have equal hashes")
        filled = np.zeros(_bits(len(inside), _functions(level, first)), bool)
        through = np.ones(len(outside), bool)
        for j in range(_functions(level, first)):
            filled[_places(h1[inside], h2[inside], level, j, len(filled))] = True
        for j in range(_functions(level, first)):
            through &= filled[_places(h1[outside], h2[outside], level, j, len(filled))]
        levels.append(filled)
        inside, outside = outside[through], inside
    return levels


class Filters:
    """The cascades of all segments, ready to be asked."""

    def __init__(self, segments: int, first: int, rows: list) -> None:
        self.segments, self.first = segments, first
        self.sizes: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.bits: list[np.ndarray] = []
        for level in range(max((len(r["sizes"]) for r in rows), default=0)):
            sizes, begins, parts, at = np.zeros(segments, np.int64), np.zeros(segments, np.int64), [], 0
            for r in rows:
                if level < len(r["sizes"]):
                    sizes[r["segment"]], begins[r["segment"]] = r["sizes"][level], at
                    parts.append(np.frombuffer(r["bits"][level], np.uint8))
                    at += 8 * len(parts[-1])
            self.sizes.append(sizes)
            self.begins.append(begins)
            self.bits.append(np.concatenate(parts))

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        segment, passed = np.mod(h1, self.segments), np.zeros(len(h1), np.int64)
        left = np.arange(len(h1))
        for level, (sizes, begins, bits) in enumerate(zip(self.sizes, self.begins, self.bits, strict=True)):
            left = left[sizes[segment[left]] > 0]
            for j in range(_functions(level, self.first)):
                at = begins[segment[left]] + _places(h1[left], h2[left], level, j, sizes[segment[left]])
                left = left[(bits[at >> 3] >> (7 - (at & 7))) & 1 == 1]
            passed[left] += 1
        return passed % 2 == 1


def _build(first: int):
    def build(table: pa.Table) -> pa.Table:
        levels = cascade(*(table[c].to_numpy() for c in ("h1", "h2", "listed")), first)
        return pa.table({
            "segment": pa.array([table["segment"][0].as_py()], pa.int32()), "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
            "bits": pa.array([[np.packbits(x).tobytes() for x in levels]], pa.list_(pa.binary())),
        })

    return build


def _filters(rows: DataFrame, segments: int, first: int) -> Filters:
    """The cascades of distinct ``h1, h2, listed``."""
    dealt = rows.withColumn("segment", F.pmod("h1", F.lit(segments)).cast("int")).groupBy("segment")
    return Filters(segments, first, dealt.applyInArrow(_build(first), "segment int, sizes array<long>, bits array<binary>").collect())


def _first_listed(filters: Broadcast):
    """The place of the first listed key in each row's hashes, or null."""

    def ask(h1: pa.Array, h2: pa.Array) -> pa.Array:
        found = filters.value.listed(h1.flatten().to_numpy(zero_copy_only=False), h2.flatten().to_numpy(zero_copy_only=False))
        sizes = np.diff(h1.offsets.to_numpy())
        ends = np.cumsum(sizes)
        hits = np.flatnonzero(found)
        rows, first = np.unique(np.searchsorted(ends, hits, "right"), return_index=True)
        out = np.full(len(sizes), -1, np.int32)
        out[rows] = hits[first] - (ends - sizes)[rows]
        return pa.array(out, pa.int32(), mask=out < 0)

    return F.arrow_udf(ask, "int")


def bytes_of_filters(listed: int, keys: int) -> tuple[int, int]:
    """The number of hash functions of the first filter, and a bound on the bytes of all filters.

    The false positives expected of the first are sqrt(2) for a listed key, and each further filter
    encodes half of what the one before the last did; the bound has twice as much.
    """
    first = max(1, ceil(log2(max(2.0, keys / (max(listed, 1) * sqrt(2))))))
    return first, ceil(listed * (first + 8) / log(2) / 8) + 64 * MOST_LEVELS * (1 + listed // SEGMENT)


def with_listed(urls: DataFrame, listed: DataFrame, url: str = "url", entry: str = "entry", most_bytes: int = MOST_BYTES) -> DataFrame:
    """``urls`` with ``host``, ``path`` and ``listed``: the entry of ``listed`` that fits, that of the longest host and
    then of the longest path if there are several, or null.

    Hosts of entries are in lower case; entries without a ``/``, null ones and repetitions are left out.
    A null URL, or one without ``://``, has an empty host and path and is not listed; an empty path is listed as ``/``.
    Columns of ``urls`` by these names are replaced.
    """
    spark = urls.sparkSession
    entries = written(listed.select(F.col(entry).alias("key")).where(F.col("key").contains("/")).distinct(), "listed")
    host, rest = F.substring_index("key", "/", 1), F.col("key")
    shape = entries.agg(
        F.count("*").alias("n"), F.max(F.size(F.split(host, r"\."))).alias("labels"), F.max(F.size(F.split(rest, "/")) - 1).alias("segments")
    ).first()
    address = F.col(url).cast("string")
    parted = urls.drop("host", "path", "listed").withColumns({"host": host_of(address), "path": path_of(address)})
    if not shape["n"]:
        return parted.withColumn("listed", F.lit(None).cast("string"))
    keys = keys_of(F.col("host"), F.col("path"), shape["labels"], shape["segments"])
    corpus = parted.select(keys.alias("keys"))
    first, size = bytes_of_filters(shape["n"], corpus.agg(F.sum(F.size("keys"))).first()[0] or 0)
    if size > most_bytes:
        return _joined(parted, keys, entries)
    segments = 1 + (shape["n"] - 1) // SEGMENT
    inside = written(entries.select(*_hashed(F.col("key")), F.lit(True).alias("listed")), "listed-keys")
    opening = _first_listed(spark.sparkContext.broadcast(_filters(inside, segments, first)))

    def asked(ask, column: str) -> Column:
        return ask(F.transform(column, lambda k: _hashed(k)[0]), F.transform(column, lambda k: _hashed(k)[1]))

    through = corpus.select(F.explode("keys").alias("key")).withColumn("each", F.array("key")).where(asked(opening, "each").isNotNull())
    met = through.select(*_hashed(F.col("key")), F.lit(False).alias("listed")).distinct().union(inside)
    universe = met.groupBy("h1", "h2").agg(F.max("listed").alias("listed"))
    final = _first_listed(spark.sparkContext.broadcast(_filters(universe, segments, first)))
    found = parted.withColumn("_keys", keys).withColumn("_at", asked(final, "_keys"))
    return found.withColumn("listed", F.get("_keys", F.col("_at"))).drop("_keys", "_at")


def _joined(parted: DataFrame, keys: Column, entries: DataFrame) -> DataFrame:
    """The same by a join, for lists whose filters are too large to be sent: rows by a number, the first key that is listed."""
    numbered = written(parted.withColumn("_row", F.monotonically_increasing_id()), "numbered-urls")
    each = numbered.select("_row", F.posexplode(keys).alias("_at", "key"))
    hits = each.join(entries.hint("merge"), "key").groupBy("_row").agg(F.min_by("key", "_at").alias("listed"))
    return numbered.join(hits.hint("merge"), "_row", "left").drop("_row")


def judged(urls: DataFrame, listed: DataFrame, rules: dict[str, str], url: str = "url", entry: str = "entry", most_bytes: int = MOST_BYTES) -> DataFrame:
    """:func:`with_listed`, the longest of the ``rules`` (``host/path`` to ``allow`` or ``block``) that fits as ``rule``, and the
    ``verdict``: the rule's, or else ``block`` for what is listed and ``allow`` for the rest."""
    found = with_listed(urls.drop("rule", "verdict"), listed, url, entry, most_bytes).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    said = F.coalesce(*[F.when(F.col("rule") == rule, verdict) for rule, verdict in rules.items()], F.when(F.col("listed").isNotNull(), "block"), F.lit("allow"))
    return found.withColumn("verdict", said)
