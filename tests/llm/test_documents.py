"""Operators on documents against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from shipping import shipped  # noqa: F401
from fraudlens.llm import language, near_dedup, packing, pii, queries, quality, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (None, "a text without an id " * 5, "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n", "en", "s", 3),
    (4, "one", "en", None, 3), (5, "one", "en", "s", 3), (6, LONG, "en", "s", 1), (7, LONG + " end", None, "s", 1), (8, "é ñ ☃ 123", "fr", "s", 9),
    (8, "é ñ ☃ 123", "fr", "s", 9), (9, "One", "en", "s", 3), (10, "%%% 1 2 3 !!!", "de", "s", 13),
]


def odd(spark):
    """Rows with nulls, empty and long texts, copies, and columns named as operators name theirs."""
    names = ["id", "n", "key", "_block", "n_words", "kept", "score", "found", "token_ids", "component_id", "spans"]
    return spark.createDataFrame(ODD, DOCS).withColumns({n: F.lit(7) for n in names})


def random_documents(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.choice([12, 13, 14, 40]))) for _ in range(6)]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([0, 1, 4, 5, 12, 13, 60, 150]))
        if rng.random() < 0.4:
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages).split()
        if rows and rng.random() < 0.4:
            words = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((rng.choice([i, i, i + 10_000]), rng.choice([" ", "\n", "  "]).join(words), "en", f"s{i % 3}", 1))
    return rows


def removed(rows, k=13):
    first: dict = {}
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, words in texts:
        for i in range(len(words) - k + 1) if d is not None else ():
            key = tuple(words[i : i + k])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - k + 1) if d is not None else ():
            if first[tuple(words[i : i + k])] < d:
                gone[i : i + k] = [True] * k
        kept = " ".join(x for x, g in zip(words, gone, strict=True) if not g)
        out.append((d, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(rows, percent):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets:
        for b, r in sets:
            if a is not None and b is not None and a < b and s and r and 100 * len(s & r) >= percent * len(s | r):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return Counter((d, len(s), top(d) if d is not None else None, d is None or top(d) == d) for d, s in sets)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_plain_version(spark, seed):
    rows = random_documents(seed, 300)
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == removed([r[:2] for r in rows])
    texts = {r[0]: WORD.findall(r[1]) for r in rows}
    for r in found:
        for s in r.spans:
            own = WORD.findall(next(t for d, t, *_ in rows if d == r.doc_id))[s.start : s.start + s.words]
            if Counter(x[0] for x in rows)[r.doc_id] == 1 == Counter(x[0] for x in rows)[s.source]:
                assert own == texts[s.source][s.source_start : s.source_start + s.words]


def test_repeats_of_odd_rows(spark):
    found = substring_dedup.remove_repeats(odd(spark))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()) == removed([r[:2] for r in ODD])
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[3].text == " \t\n" and by_id[7].text.split()[-1] == "end"
    assert by_id[6].key == 7


def test_rows_of_large_groups_meet_in_each_of_their_groups(spark):
    """Ids 10 and 11 are linked with the smallest id of one of their groups each, and with each other."""
    true = {(0, 10), (1, 11), (10, 11), (30, 31)}

    def links(table):
        table = table.sort_by([(c, "ascending") for c in near_dedup.PART_ORDER])
        key, part, ids, side = (table[c].to_numpy(zero_copy_only=False) for c in ("key", "part", "id", "side"))
        ends = [near_dedup._empty()]
        for a, b in near_dedup.runs(key, part):
            near = [[(min(x, y), max(x, y)) in true for y in ids[a:b]] for x in ids[a:b]]
            ends.append(near_dedup._forest(ids[a:b], near & (side[a:b, None] | side[None, a:b])))
        return near_dedup._pairs(ends)

    members = [(1, i) for i in (0, 10, 11, *range(30, 36))] + [(2, i) for i in (1, 10, 11, *range(40, 46))]
    rows = spark.createDataFrame(members, "key bigint, id bigint")
    found = near_dedup._in_groups(rows, rows.select("id").distinct(), links, 4, 1000)
    assert {(min(r), max(r)) for r in found.collect()} == true


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_equal_plain_version(spark, seed):
    rows = random_documents(seed, 300)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(tuple(r) for r in found) == components([r[:2] for r in rows], 85)


def test_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BAND_ROWS", 8)
    monkeypatch.setattr(near_dedup, "SET_ROWS", 8)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "s", 1))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(tuple(r) for r in found) == components([r[:2] for r in rows], 85)


def test_near_duplicates_of_odd_rows(spark):
    found = near_dedup.near_duplicates(odd(spark)).collect()
    assert Counter(tuple(r) for r in found) == components([r[:2] for r in ODD], 85)
    assert sorted(r.doc_id or 0 for r in near_dedup.without_near_duplicates(odd(spark)).collect()) == [0, 1, 2, 3, 4, 6, 8, 8, 10]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_personal_data_equals_plain_patterns():
    rng = random.Random(6)
    for _ in range(4000):
        text = "".join(rng.choices("a1b2.@ -+()5_%4é0", k=rng.randrange(60)))
        text += rng.choice(["", " 4111 1111 1111 1111", " 1.2.3.4.5.6.7.8", "x@y.zz_a@b.c", "+49 30 1234567", "300.1.1.1 1.1.1.255"])
        assert [x[:3] for x in pii.find(text) if x[0] in pii.BASE] == spans(text), text


def test_added_kinds_and_redaction():
    text = "IBAN DE89 3704 0044 0532 0130 00, social security 123-45-6789, not 123-45-6780 far away; DE00 3704 0044 0532 0130 00"
    assert [x[0] for x in pii.find(text) if x[0] not in pii.BASE] == ["iban", "ssn", "ssn"]
    assert [x[0] for x in pii.find("number 123-45-6789")] == []
    assert pii.redacted("mail a@b.cc now", pii.find("mail a@b.cc now")) == "mail [EMAIL] now"


def test_ibans_before_words_in_upper_case():
    de, no, be = "DE89370400440532013000", "NO9386011117947", "BE68 5390 0754 7034"
    other = next(x for n in range(100) if pii.mod97(x := f"ZZ{n:02}ABCD0123456789"))
    for text, expected in [
        ("DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["DE89 3704 0044 0532 0130 00"]), (f"{de} EUR 500", [de]), (f"{de} A", [de]),
        (f"{no} {be}", [no, be]), (f"REF AB12 {de}", [de]), (f"{other} EUR 500", [other]), (f"{de}A1", []), (f"x{de}", []), (f"{de} x", [de]),
    ]:
        assert [text[a:b] for a, b in pii._ibans(text)] == expected, text
    assert pii.redacted(f"to {de} EUR 500", pii.find(f"to {de} EUR 500")) == "to [IBAN] EUR 500"


def test_personal_data_of_odd_rows(spark):
    found = pii.with_personal_data(odd(spark), redact=True).collect()
    assert len(found) == len(ODD)
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.spans == "" for r in found)
    assert pii.find("a" * 200_000) == [] and pii.find("1" * 200_000) == []


def test_language_of_held_out_documents(spark):
    rows = queries.QUERIES["op7_language"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in held)


def test_language_of_odd_rows(spark):
    model = language.fit(spark.read.parquet(f"{DATA}/documents.parquet"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.with_language(odd(spark), model).collect()}
    assert [found[i] for i in (1, 2, 3, 10)] == [("und", 0.0)] * 4 and found[8][0] in model.labels
    empty = odd(spark).where("false")
    assert language.fit(empty) is None and language.with_language(empty, model).count() == 0
    assert {r.lang_pred for r in language.with_language(odd(spark), None).collect()} == {"und"}


def test_language_learns_from_each_text_once(spark, monkeypatch):
    shown = []
    monkeypatch.setattr(language, "Leader", lambda *a: (shown.append([]), Shown(shown[-1], *a))[1])
    texts = [(f"only text {'xyz'[i % 3]} {i}", "ab"[i % 2]) for i in range(100)]
    rows = [("a text that most rows share", "a")] * 2000 + [("1 2 3", "a")] * 50 + texts
    docs = spark.createDataFrame(rows, "text string, lang string")
    for sample in (5, 40, 1000):
        language.fit(docs, sample=sample)
        n = min(sample, 101)
        assert len(shown[-1]) == language.EPOCHS * (n - n // 5)
    few = spark.createDataFrame([("ab cd", "a")] * 20_000 + [("12", "b")] * 20_000, "text string, lang string")
    assert language.fit(few, sample=1).labels == ["a"]


class Shown(language.Leader):
    def __init__(self, shown, *rest):
        super().__init__(*rest)
        self.shown = shown

    def learn(self, at, *rest):
        self.shown.append(at)
        super().learn(at, *rest)


def test_quality_orders_grades(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    model = quality.fit(docs, labels.select("doc_id", grade.alias("grade")))
    assert (model.thresholds[1:] >= model.thresholds[:-1]).all()
    found = quality.with_quality(docs, model).join(labels, "doc_id").collect()
    clean = [r for r in found if r.quality == 1 and r.toxic == 0]
    assert sum(r.kept for r in clean) >= 0.95 * len(clean)
    toxic = [r for r in found if r.toxic == 1]
    assert sum(not r.kept for r in toxic) >= 0.8 * len(toxic)
    rest = {r.doc_id: r for r in quality.with_quality(odd(spark), model).collect()}
    assert rest[1].expected_grade == 0 and not rest[2].kept and len(rest[6].p_reach) == 2
    assert quality.fit(docs, labels.where("false").select("doc_id", F.lit(0).alias("grade"))) is None


def test_best_fit_equals_plain_version():
    rng = random.Random(8)
    for _ in range(200):
        sizes = [rng.randint(1, 20) for _ in range(40)]
        marks = [1 << rng.randrange(6) | rng.choice([0, 1 << 7, 1 << 8]) for _ in sizes]
        bins, places = packing.best_fit(sizes, marks, 20)
        left, mask, expected = [], [], {}
        for i in sorted(range(40), key=lambda i: (-sizes[i], i)):
            fits = [(left[b], b) for b in range(len(left)) if left[b] >= sizes[i] and not mask[b] & marks[i]]
            b = min(fits)[1] if fits else len(left)
            if not fits:
                left.append(20)
                mask.append(0)
            expected[i] = (b, 20 - left[b])
            left[b] -= sizes[i]
            mask[b] |= marks[i]
        assert {i: (bins[i], places[i]) for i in range(40)} == expected


def test_packing_keeps_all_and_conflicts_apart(spark):
    docs = odd(spark)
    found = packing.packed(docs, capacity=50).collect()
    words = Counter()
    for r in found:
        words[r.doc_id] += r.n_words
    expected = Counter()
    for d, t, *_ in ODD:
        expected[d] += len(WORD.findall(t or ""))
    assert words == expected
    assert all((r.bin_id is None) == (r.n_words == 0) for r in found)
    load = Counter()
    for r in found:
        load[r.bin_id] += r.n_words
    assert max(n for b, n in load.items() if b is not None) <= 50
    # All but one of these rows are of one source.
    assert max(Counter(r.bin_id for r in found if r.bin_id is not None and r.doc_id != 4).values()) == 1


def test_near_copies_never_share_a_bin(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for i in range(30):
        words = [f"t{i}x{j}" for j in range(60)]
        changed = [*words]
        changed[rng.randrange(60)] = "other"
        for j, text in enumerate([" ".join(words), " ".join(changed), " ".join(words).upper(), "  ".join(words)]):
            rows.append((None if i == 0 and j == 1 else 10 * i + j, text, "en", f"s{i}-{j}", 1))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op6_packing"](spark, str(tmp_path)).collect()
    groups = Counter((r.bin_id, (r.doc_id or 0) // 10) for r in found)
    assert len(found) == len(rows) and len(groups) == len(rows)
    # Of one component each: a bin of 2,048 words has room for all 30.
    assert len({r.bin_id for r in found}) == 4


def test_repeats_keep_columns_of_any_name(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(30)), "x", 5, 7, "b"), (2, "before " + " ".join(f"w{i}" for i in range(30)) + " behind", "y", 6, 8, "c"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _block string, _bucket int, carried_3 long, `a b` string")
    found = substring_dedup.remove_repeats(df)
    assert found.columns[:6] == df.columns
    assert sorted((tuple(r) for r in found.select("doc_id", "_block", "_bucket", "carried_3", "`a b`", "n_removed").collect()), key=str) == [
        (1, "x", 5, 7, "b", 0), (2, "y", 6, 8, "c", 30), (None, None, None, None, None, 0)]
    assert [r.spans for r in found.where("doc_id = 2").collect()] == [[(1, 30, 1, 0)]]


def test_edges_that_agree_in_some_bits_only_are_told_apart():
    """The answers hold an edge of the same 64 bits, and another source, before the right one."""
    import numpy as np
    import pyarrow as pa

    from fraudlens.llm import words as w

    text = " ".join(f"w{i}" for i in range(13))
    (edge, check), _ = w.hashes(w.columns(pa.array([text])), substring_dedup.EDGE_HASH, substring_dedup.CHECK_HASH)
    key = w.grams(edge, 13, substring_dedup.EDGE_HASH)[0]
    bits = np.uint32(w.grams(check, 13, substring_dedup.CHECK_HASH)[0] >> np.uint64(32))
    for given, removed in (([bits - 1, bits, bits + 1], 13), ([bits - 1, bits + 1], 0)):
        answers = pa.table({
            "keys": pa.array([np.full(len(given), key, np.uint64).tobytes()]), "checks": pa.array([np.array(given, np.uint32).tobytes()]),
            "sources": pa.array([np.arange(len(given)).tobytes()]), "places": pa.array([np.zeros(len(given), np.int32).tobytes()]),
        })
        cut = substring_dedup._cut("doc_id", "text", 13, True, ["doc_id"])
        found = cut(pa.table({"doc_id": pa.array([9], pa.int64()), "text": pa.array([text])}), answers)
        assert found["n_removed"].to_pylist() == [removed]


@pytest.mark.parametrize("name", ["op2_quality", "op3_substring_dedup", "op4_near_dedup", "op5_pii", "op6_packing", "op7_language", "op9_pieces"])
def test_empty_tables(spark, tmp_path, name):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{DATA}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
