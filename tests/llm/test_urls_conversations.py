"""URL filters, the prefix trie and structure repair, against plain versions and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from fraudlens.llm import prefix_trie, structure_repair, url_filter
from fraudlens.llm.queries import QUERIES
from shipping import shipped  # noqa: F401

# --- URL filters ---

URLS = [
    (1, "http://A.Spam.example.com/x/y?q#f"), (2, "https://spam.example.com"), (3, "//spam.example.com/"), (4, None), (5, ""),
    (6, "ftp://good.example.com/bad/page"), (7, "http://good.example.com/bad/"), (8, "http://good.example.com/badly/"),
    (9, "http://good.example.com/bad/page/deep/er"), (10, "http://xspam.example.com/"), (11, "http://com/://spam.example.com/"),
    (12, "http:///only/path"), (13, "http://good.example.com/exact.html"), (14, "http://good.example.com/exact.html.old"),
    (15, "http://www.good.example.com/bad/x?http://y"), (16, "http://" + "a." * 5000 + "spam.example.com/" + "d/" * 5000), (1, "http://twice.example.net/en/"),
]
ENTRIES = ["spam.example.com/", "good.example.com/bad/", "good.example.com/exact.html", "unseen.example.org/", None, "no-slash", "spam.example.com/"]


def _listed(url, entries):
    if url is None or "://" not in url:
        return None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0] or "/"
    fits = []
    for entry in {e for e in entries if e and "/" in e}:
        name, at = entry.split("/", 1)
        if host and (host == name or host.endswith("." + name)) and (path == "/" + at or at == "" or (at.endswith("/") and path.startswith("/" + at))):
            fits.append((name.count("."), len(at), entry))
    return max(fits)[2] if fits else None


@pytest.mark.parametrize("most_bytes", [url_filter.MOST_BYTES, 0], ids=["cascade", "join"])
def test_listed_urls(spark, most_bytes):
    urls = spark.createDataFrame([(i, u, "old") for i, u in URLS], "page_id long, url string, host string")
    listed = spark.createDataFrame([(e,) for e in ENTRIES], "entry string")
    found = url_filter.with_listed(urls, listed, most_bytes=most_bytes)
    assert found.columns[:2] == ["page_id", "url"] and sorted(found.columns) == ["host", "listed", "page_id", "path", "url"]
    assert sorted((r.page_id, r.url or "", r.listed) for r in found.collect()) == sorted((i, u or "", _listed(u, ENTRIES)) for i, u in URLS)


def test_no_list_and_no_urls(spark):
    urls, entries = spark.createDataFrame(URLS, "page_id long, url string"), spark.createDataFrame([("a.com/",)], "entry string")
    assert url_filter.with_listed(urls, entries.limit(0)).where("listed is not null").count() == 0
    assert url_filter.judged(urls.limit(0), entries, {"com/": "block"}).collect() == []


def test_rules(spark):
    urls = spark.createDataFrame(
        [(1, "http://a.example.net/en/x"), (2, "http://a.example.net/EN/x"), (3, "http://b.net"), (4, "http://b.NET/"), (5, "http://example.com/de"), (6, "x://org/fr/"), (7, "http://bnet/"), (8, None)],
        "page_id long, url string").withColumns({"rule": F.lit("old"), "verdict": F.lit(3), "listed": F.lit(1)})
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    found = url_filter.judged(urls, spark.createDataFrame([("org/",), ("bnet/",)], "entry string"), rules)
    assert rows(found, "page_id", "rule", "verdict", "listed") == [
        (1, "example.net/en/", "allow", None), (2, "net/", "block", None), (3, None, "allow", None), (4, "net/", "block", None),
        (5, None, "allow", None), (6, "org/fr/", "allow", "org/"), (7, None, "block", "bnet/"), (8, None, "allow", None)]


@pytest.mark.parametrize("listed_share", [0.001, 0.3, 0.999])
def test_cascade_is_exact_over_the_universe(listed_share):
    draw = np.random.default_rng(7)
    h1, h2 = (draw.integers(-(2**63), 2**63 - 1, 40_000) for _ in range(2))
    listed = draw.random(len(h1)) < listed_share
    first, bound = url_filter.bytes_of_filters(int(listed.sum()), len(h1))
    segments = 3
    built = []
    for segment in range(segments):
        own = np.mod(h1, segments) == segment
        levels = url_filter.cascade(h1[own], h2[own], listed[own], first)
        built.append({"segment": segment, "sizes": [len(x) for x in levels], "bits": [np.packbits(x).tobytes() for x in levels]})
    filters = url_filter.Filters(segments, first, built)
    assert (filters.listed(h1, h2) == listed).all()
    assert sum(len(b) for x in filters.bits for b in [x]) <= bound


# --- the prefix trie ---


def _trie(convs):
    nodes, kids, sums, out = defaultdict(list), defaultdict(list), {}, []
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)
    for n in sorted(nodes, key=len, reverse=True):
        members = nodes[n]
        own = (len(members) - 1) * len(n[-1][1]) if n else 0
        sums[n] = (sum(sums[k][0] for k in kids[n]) or 1, own + sum(sums[k][1] for k in kids[n]))
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(n)))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(kids[n]), *sums[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _turns(spark, convs):
    told = [(c, [(hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32], len(t)) for r, t in ts]) for c, ts in convs.items()]
    return spark.createDataFrame(told, "conv_id long, turns array<struct<digest string, size long>>").repartition(3)


@pytest.fixture
def spread(spark):
    """Small data in as many partitions as large data."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", range(8))
def test_trie_equals_plain_version(spark, spread, seed):
    draw = random.Random(seed)
    words, depth = draw.choice([1, 2, 30]), draw.choice([1, 4, 9])
    convs = {c: [("u" if i % 2 else "a", "x" * draw.randrange(words)) for i in range(draw.randrange(depth + 1))] for c in draw.sample(range(-500, 1000), draw.choice([1, 40, 300]))}
    for c in range(5000, 5000 + draw.choice([0, 50, 400])):
        convs[c] = [("u", "hot"), ("a", "z")][: draw.choice([2, 2, 1])]
    found = prefix_trie.trie(_turns(spark, convs), block_turns=draw.choice([1, 7, 60, 1 << 20]), block_ids=draw.choice([1, 3, 50, 1 << 16]))
    assert sorted((tuple(r) for r in found.collect()), key=str) == _trie(convs)


def test_trie_of_deep_conversations(spark, spread):
    deep = [("u", str(i % 7)) for i in range(700)]
    convs = {1: deep, 2: deep, 3: deep[:500] + [("a", "other")], 4: [("u", "elsewhere")], 5: []}
    found = prefix_trie.trie(_turns(spark, convs), block_turns=300)
    assert sorted((tuple(r) for r in found.collect()), key=str) == _trie(convs)


def test_turns_in_order(spark):
    odd = [(1, 2, "u", "b"), (1, None, None, None), (1, 1, "u", "a" * 100_000), (1, 2, "u", "b"), (None, 1, "u", "lost"), (2, None, "", "")]
    df = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").withColumns({"turns": F.lit(1), "digest": F.lit(2), "size": F.lit(3)})
    found = {r.conv_id: [t["size"] for t in r.turns] for r in prefix_trie.ordered_turns(df).collect()}
    assert found == {1: [0, 100_000, 1, 1], 2: [0]}
    assert prefix_trie.trie(prefix_trie.ordered_turns(df.limit(0))).collect() == []


# --- structure repair ---


def _plain_repair(turns):
    """All edits of up to two inserts in a row, the cheapest and then the least: ``cost, audit, turns``."""
    seen, faults = set(), []
    for role, text in turns:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserts):
        out = []
        if i == len(turns) and state in ("", "a"):
            out.append((0, "", ()))
        made = after[state][-1]
        if inserts < 2:
            cost, audit, rest = best(i, made, inserts + 1)
            out.append((cost + 5, "I" + audit, ((full[made], ""), *rest)))
        if i < len(turns):
            role, text = turns[i]
            cost, audit, rest = best(i + 1, state, 0)
            out.append((cost + 2, "D" + audit, rest))
            if faults[i] in ("", "truncated"):
                more = 5 * (faults[i] != "")
                if role[:1] and role[0] in after[state]:
                    cost, audit, rest = best(i + 1, role[0], 0)
                    out.append((cost + more, "K" + audit, ((role, text), *rest)))
                cost, audit, rest = best(i + 1, made, 0)
                out.append((cost + more + 1, "R" + audit, ((full[made], text), *rest)))
        return min(out, default=(10**9, "", ()))

    return best(0, "", 0), faults


ROLES, TEXTS = ["system", "user", "assistant", "tool", "", "user2"], ["Yes.", "no", "", " \n", "Why?", "cut off\u2028", "ok! ", "a\n."]


def _conversations(n, seed):
    draw = random.Random(seed)
    return {c: [(draw.choice(ROLES[: draw.choice([3, 6])]), draw.choice(TEXTS) + draw.choice(["", "", str(i) + "."])) for i in range(draw.randrange(14))] for c in range(n)}


def test_repair_equals_plain_version(spark):
    convs = _conversations(300, 5)
    convs[1000] = [("user" if i % 3 else "assistant", f"turn {i}" + "." * (i % 5 > 0)) for i in range(90)]
    df = spark.createDataFrame([(c, i, *t) for c, ts in convs.items() for i, t in enumerate(ts)], "conv_id long, turn long, role string, text string").repartition(5)
    found = {r.conv_id: r for r in structure_repair.with_hashes(df).collect()}
    turns = defaultdict(list)
    for r in sorted(structure_repair.repaired(df).collect(), key=lambda r: (r.conv_id, r.place)):
        turns[r.conv_id].append((r.role, r.text))
    assert set(found) == {c for c, ts in convs.items() if ts}
    for c, r in found.items():
        (cost, audit, told), faults = _plain_repair(tuple(convs[c]))
        assert (r.cost, r.audit) == (cost, audit) and tuple(turns[c]) == told
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in told).encode()).hexdigest()
        assert (r.blank, r.duplicate, r.truncated, r.gaps) == (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), 0)
        assert r.illegal == sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(convs[c]))


def test_cheapest_edits_of_many_turns():
    """Checkpoints give what all vectors together give."""
    draw = random.Random(3)
    for n in (0, 1, 2, 3, 99, 100, 101, 5000):
        codes = bytes(draw.randrange(16) for _ in range(n))
        vectors = [structure_repair.END]
        for code in reversed(codes):
            vectors.append(structure_repair._before(code, vectors[-1]))
        cost, audit = structure_repair.cheapest(codes)
        assert cost == vectors[-1][structure_repair.START] and len(audit.replace("I", "")) == n


def test_repair_of_odd_rows(spark):
    odd = [
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (1, None, None, None), (1, None, "user", "Hi."), (2, 5, "user", "Hi."), (2, 5, "user", "Hi."), (2, 9, "assistant", "x" * 300_000 + "."),
        (3, -3, "system", "Be kind."), (-4, None, "", ""),
    ]
    df = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").withColumns({"found": F.lit(1), "kind": F.lit(2), "tie": F.lit("t"), "code": F.lit(0), "audit": F.lit("")})
    found = rows(structure_repair.audits(df))
    assert found == [
        (None, 0, 0, 0, 0, 0, 0, "KK"), (-4, 0, 1, 0, 0, 0, 2, "D"), (1, 0, 1, 0, 0, 1, 4, "DD"), (2, 3, 0, 1, 0, 1, 2, "KDK"), (3, 0, 0, 0, 0, 0, 2, "D")]
    assert structure_repair.with_hashes(df.limit(0)).collect() == [] and structure_repair.repaired(df.limit(0)).collect() == []


def _table(spark, folder, told):
    df = spark.createDataFrame(told, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{folder}/conversations.parquet")


def test_queries_on_odd_tables(spark, tmp_path):
    _table(spark, tmp_path / "odd", [(None, 0, "user", "lost"), (7, None, None, None), (7, None, None, None), (100, 0, "user", "Hi."), (105, 0, "user", "Hi."), (105, None, "", "")])
    _table(spark, tmp_path / "none", [])
    for name, odd in (("op12_prefix_trie", None), ("op13_structure_repair", 4)):
        assert QUERIES[name](spark, str(tmp_path / "none")).collect() == []
        found = QUERIES[name](spark, str(tmp_path / "odd"))
        assert odd is None or found.count() == odd
    nodes = QUERIES["op12_prefix_trie"](spark, str(tmp_path / "odd")).where("depth = 0").collect()
    assert [(r.conv_id, r.parent_conv_id, r.n_convs) for r in nodes] == [(7, None, 3)]
