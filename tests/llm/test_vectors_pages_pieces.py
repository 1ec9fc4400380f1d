"""Operators on vectors, pages and pieces against plain versions, and on odd rows; the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import DATA
from shipping import shipped  # noqa: F401
from fraudlens.llm import embedding_dedup, html, pieces, queries, topk

VECTORS = "vec_id bigint, embedding array<float>, label int"


def vectors(seed: int, n: int, size: int = 24) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(size)
        if rows and i % 3:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.standard_normal(size) * rng.choice([0, 0.1, 0.25, 0.4])
        rows.append((i, [float(x) for x in v.astype(np.float32)], 0))
    odd = [None, [], [0.0] * size, [None] + [1.0] * (size - 1), [math.nan] + [1.0] * (size - 1), [math.inf] + [1.0] * (size - 1), [1.0, 2.0]]
    return rows + [(n + i, v, None) for i, v in enumerate(odd)] + [(None, rows[0][1], 1)]


def usable(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_equals_plain_version(spark):
    rows = vectors(1, 400) + [(1000 + i, [0.5] * 24, 0) for i in range(8)]
    df = spark.createDataFrame(rows, VECTORS)
    found = sorted(tuple(r) for r in topk.top_k(df.where("vec_id % 50 = 0"), df, k=5).collect())
    whole = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows if i is not None and usable(v)}
    expected = []
    for q, a in whole.items():
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole.items() if i != q and len(a) == len(b))
            expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert found == sorted(expected)


def test_scores_do_not_wrap():
    import numpy as np

    from fraudlens.llm import topk

    ids, rows = np.array([1, 2]), np.array([[2, 2], [2**31, 2**31]], np.int64)
    q, c, score = topk.best(np.array([9]), np.array([[2**30, 2**30]], np.int64), ids, rows, 2)
    assert dict(zip(c.tolist(), score.tolist(), strict=True)) == {0: 2**32, 1: 2**62}
    with pytest.raises(ValueError, match="64 bits"):
        topk.best(np.array([9]), np.array([[2**32, 2**32]], np.int64), ids, rows, 2)


@pytest.mark.parametrize("name", ["op8_topk", "op10_embedding_dedup", "op11_url_filter"])
def test_empty_vectors_and_pages(spark, tmp_path, name):
    for table in ("embeddings", "pages"):
        spark.read.parquet(f"{DATA}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_branch_and_bound_equals_full_scores():
    rng = np.random.default_rng(2)
    for size, scale in ((64, 40), (7, 3), (40, 1 << 28)):
        rows = rng.integers(-scale, scale, (500, size))
        queries_ = rows[:20]
        ids = np.arange(500)
        q, c, s = topk.best(ids[:20], queries_, ids, rows, 5)
        for i in range(20):
            score = rows @ queries_[i]
            order = [j for j in np.lexsort((ids, -score)) if j != i][:5]
            mine = sorted(zip(-s[q == i], c[q == i], strict=True))[:5]
            assert [(int(score[j]), j) for j in order] == [(int(-a), int(b)) for a, b in mine]


def test_near_vectors_equal_plain_version(spark):
    rows = vectors(3, 500)
    rows += [(2000 + i, rows[5][1], 0) for i in range(40)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and usable(v) and any(v)]
    links, parent = Counter(), {i: i for i, _ in good}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in good:
        for j, b in good:
            if i < j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9:
                links[i] += 1
                links[j] += 1
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    assert len(found) == len(rows)
    assert all(r.n_links <= links[r.vec_id] for r in found)
    assert sum(r.n_links for r in found) >= 0.97 * sum(links.values())
    odd = {r.vec_id: r for r in found if r.vec_id is None or r.vec_id not in parent}
    assert all(r.n_links == 0 and r.kept and r.component_id == r.vec_id for r in odd.values())


def test_large_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK_ROWS", 8)
    rng = np.random.default_rng(4)
    base = rng.standard_normal(16)
    rows = [(i, [float(x) for x in (base + rng.standard_normal(16) * 0.02).astype(np.float32)], 0) for i in range(60)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(59, 0)}


def test_tables_follow_from_recall():
    lines, tables = embedding_dedup.tables_for(1_000_000)
    same = (1 - math.acos(0.9) / math.pi) ** lines
    assert 1 - (1 - same) ** tables >= embedding_dedup.RECALL
    assert 0 < embedding_dedup.least_count() < embedding_dedup.LINES


MODEL = html.Model({"article": 8.0, "main": 8.0, "content": 8.0, "p": 5.0, "nav": -8.0, "ad": -8.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "comments": -8.0})


def test_main_text():
    page = (
        "<html><head><title>Title</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>menu</ul></nav>"
        "<article><h1>Head &amp; line</h1><p>One  two\n<b>th</b>ree<br>four<p>five<div class='ad'>buy</div><script>var t='</p>';</script>"
        "<!-- <p>no --><ul><li>a<li>b</ul><form>send</form></article><div id=comments><p>Nice</p></div><footer>&copy; all"
    )
    assert html.extract(page, MODEL) == "Head & line\n\nOne two three four\n\nfive\n\na\n\nb"
    for broken in (None, "", "<", "<<<>>>", "<p", "text only", "<!--", "</p></p>", "<script>", "<a href='x" * 2000, "<p>" * 5000):
        assert isinstance(html.extract(broken, MODEL), str)


def test_classes_of_the_whole_page_hide_nothing():
    inner = '<main class="no-sidebar"><article class="post comments-open"><p>One two three.</p></article></main>'
    for frame in ('<html class="no-js cookies"><body class="has-sidebar">', '<body class="right-sidebar"><div class="layout-with-sidebar">'):
        assert html.extract(f'{frame}{inner}<div class="right-sidebar"><p>Beside it all</p></div>', MODEL) == "One two three."
    assert html.extract("<main hidden><p>One two</p></main>", MODEL) == ""


def test_long_insertions_split_nothing():
    links = "<ul>" + "<li><a href=x>four words of link</a></li>" * 30 + "</ul>"
    for begin, end in (("<aside>", "</aside>"), ("<div class=related>", "</div>"), ("<div><nav>", "</nav></div>")):
        inner = f"<h1>Head line</h1><p>Short lead.</p>{begin}{links}{end}<p>Short end.</p>"
        for page in (f"<article>{inner}</article>", f"<main><div>{inner}</div></main>", f"<div class=content>{inner}</div>"):
            page = f"<body class=content><header>Site</header><p>Welcome here</p><nav>{links}</nav>{page}<div class=comments>{links}</div><p>Legal notes</p>"
            assert html.extract(page, MODEL) == "Head line\n\nShort lead.\n\nShort end."


def test_elements_without_an_end_take_no_other_text():
    for odd in (
        "<svg class=i/>", "<svg><title/><path d=x /><g></svg>", "<div><button>b</div>", "<div><object><p>c</div>", "<div><select><option>a<option>b</div>",
        "<noscript><div>n</noscript>", "<template><p>t</p></template>", "<div><svg><path></div><svg></svg>", "<button><b>b</button>",
    ):
        assert html.extract(f"<article><p>one</p>{odd}<p>two</p></article>", MODEL) == "one\n\ntwo", odd
    assert html.extract("<article><p>one <select><option>a<option>b</select> two<object><p>c</p></object></article>", MODEL).replace("\n\n", " ") == "one two"
    formula = "<math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></semantics></math>"
    assert html.extract(f"<head><title>t</title><p>one<article><p>let {formula} be</article>", MODEL).endswith("let x=1 be")
    assert html.extract("<p>one<script>two", MODEL) == "one"


def test_end_tags_of_deep_elements_end_no_other():
    deep = 600
    page = "<article><nav>" + "<div>" * deep + "menu" + "</div>" * deep + "more</nav><p>one</p></article>"
    assert html.extract(page, MODEL) == "one"
    page = "<div class=ad>" + "<font>" * deep + "<div>inner</div>still advert</div><p>one</p>"
    assert html.extract(page, MODEL) == "one"
    found = {p.text: p.names for p in html.parts("<article>" + "<div>" * deep + "<nav>menu</nav><p>two</p></article>") if p.text}
    assert found == {"menu": ("article", "div", "nav"), "two": ("article", "div", "p")}


def test_pages_with_labels_give_their_articles(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    found = queries.QUERIES["op1_html"](spark, DATA).collect()
    source = {r.page_id: r.html for r in pages.collect()}
    assert len(found) == len(source)
    for r in found:
        inner = source[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = html.re.split(r"</?(?:h1|p)>", html.re.sub(r"<br>|\n", " ", inner))
        blocks = [" ".join(html.unescape(html.re.sub("<[^>]+>", "", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (2, "u", "<article><p>" + "word " * 50_000 + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("old")).withColumn("n_chars", F.lit(1))
    found = html.with_main_text(df, html.fit(df)).collect()
    assert sorted(r.n_chars for r in found)[-1] == 5 * 50_000 - 1 and html.with_main_text(df.where("false"), MODEL).count() == 0


def small_vocabulary(seed: int) -> pieces.Vocabulary:
    rng = random.Random(seed)
    found = [("▁", -2.0), ("▁▁", -2.5), ("a", -3.0), ("b", -3.1), ("é", -4.0), ("日", -5.0)]
    found += [(rng.choice(["", "▁"]) + "".join(rng.choices("abé", k=rng.randint(2, 4))), -rng.uniform(2, 9)) for _ in range(40)]
    found = list(dict(found).items())
    n = len(found)
    found += [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    return pieces.vocabulary(found, list(range(n, n + 256)), [True] * n + [False] * 256, False)


def best_score(v: pieces.Vocabulary, text: str) -> float:
    """Of the plain segmentation, position by position."""
    known = {p: i for i, p in enumerate(v.pieces) if p and i not in set(v.byte_ids.tolist())}
    data = b"\xff" + text.encode().replace(b" ", b"\xff")
    best = [0.0] + [-math.inf] * len(data)
    bare = [b for c in [b"\xff", *(x.encode().replace(b" ", b"\xff") for x in text)] for b in [c not in known] * len(c)]
    for p in range(len(data)):
        if bare[p]:
            best[p + 1] = max(best[p + 1], best[p] + v.scores[v.byte_ids[data[p]]])
        for q in range(p + 1, min(len(data), p + 20) + 1):
            if data[p:q] in known:
                best[q] = max(best[q], best[p] + v.scores[known[data[p:q]]])
    return best[-1]


@pytest.mark.parametrize("seed", range(3))
def test_segmentation_is_the_best_one(seed):
    v = small_vocabulary(seed)
    rng = random.Random(seed)
    texts = ["".join(rng.choices("aabbé日 ☃\n▁", k=rng.randrange(30))) for _ in range(200)] + ["ab" * 400, None, ""]
    ids = pieces.encode(v, pa.array(texts))
    assert pieces.decode(v, ids).to_pylist() == texts
    for text, got in zip(texts, ids.to_pylist(), strict=True):
        assert sum(v.scores[i] for i in got) == best_score(v, text) if text else not got


@pytest.mark.parametrize("sizes", [(16, 4, 3), (64, 16, 2), (2048, 256, 512)])
@pytest.mark.parametrize("seed", range(2))
def test_long_chunks_are_segmented_as_plain_ones(monkeypatch, seed, sizes):
    for name, value in zip(("STRETCH", "WARM", "GROUP"), sizes, strict=True):
        monkeypatch.setattr(pieces, name, value)
    monkeypatch.setattr(pieces, "LONG", 20)
    monkeypatch.setattr(pieces, "PART_BYTES", 3000)
    monkeypatch.setattr(pieces, "DECODED", 700)
    v = small_vocabulary(seed)
    rng = random.Random(seed)
    texts = [
        "".join(rng.choices("aabbé日☃", k=1500)), "a" * 900, "abé" * 700, "日" * 400 + "☃" * 300, " " * 500, "x" * 2000 + " " + "ab " * 700,
        "".join(rng.choices("ab é\n", k=4000)), "", None, "é" * 2500 + "\n\n" + "b" * 3500,
    ]
    ids = pieces.encode(v, pa.array(texts))
    assert pieces.decode(v, ids).to_pylist() == texts
    for text, got in zip(texts, ids.to_pylist(), strict=True):
        assert sum(v.scores[i] for i in got) == best_score(v, text) if text else not got


def test_long_text_without_spaces_takes_little_memory():
    import tracemalloc

    v = small_vocabulary(1)
    rng = random.Random(1)
    text = pa.array(["".join(rng.choices("aabbé日☃", k=1_500_000))])
    tracemalloc.start()
    ids = pieces.encode(v, text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces.decode(v, ids).equals(text) and most < 50 * text.nbytes


def test_pieces_on_odd_rows(spark):
    rows = [(1, None, "a"), (None, "", "b"), (1, "x" * 50_000, "c"), (1, "x" * 50_000, "c"), (2, "é ▁ \n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string").withColumns({"n_tokens": F.lit("n"), "round_trip": F.lit(0), "back": F.lit(1)})
    found = pieces.with_pieces(df, small_vocabulary(2), check=True)
    assert sorted((r.n_tokens > 0, r.round_trip, r.token_ids is None, r.back) for r in found.collect()) == [
        (False, True, False, 1), (False, True, True, 1), (True, True, False, 1), (True, True, False, 1), (True, True, False, 1)]
    assert pieces.with_pieces(df.limit(0), small_vocabulary(2)).collect() == []


def test_pieces_of_documents_come_back(spark):
    found = queries.QUERIES["op9_pieces"](spark, DATA)
    assert found.where("not round_trip or n_tokens = 0").count() == 0
    v = pieces.load(queries.VOCABULARY)
    back = pieces.with_text(found, v).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", F.col("text").alias("old")), "doc_id")
    assert back.where("text != old").count() == 0


def test_pipeline_on_odd_rows(spark):
    from test_documents import ODD, odd

    docs = odd(spark).unionByName(spark.read.parquet(f"{DATA}/documents.parquet"), allowMissingColumns=True)
    columns, counts = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    ids = Counter(r.doc_id for r in docs.collect())
    assert counts[1] <= counts[0] < len(ODD) + 200 and counts[1] == counts[2] == counts[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r.doc_id for r in packed.collect()} == set(ids)


def test_languages_are_judged_by_their_number(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two", None, "s", 7), (2, "123", None, "s", 3)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = corpus_pipeline.known_language(spark, docs, DATA)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
    language = corpus_pipeline.language

    def kept(n: int, score: float) -> int:
        model = language.Model([f"l{i}" for i in range(n)], np.ones(1), np.ones((1, n)), 1.0)
        monkeypatch.setattr(language, "fit", lambda docs: model)
        monkeypatch.setattr(language, "with_language", lambda docs, _: docs.withColumns({"lang_pred": F.lit("l0"), "score": F.lit(score)}))
        return corpus_pipeline.known_language(spark, docs, DATA).count()

    assert [kept(n, s) for n, s in ((1, 1.0), (2, 0.55), (2, 0.65), (3, 0.35), (3, 0.45), (4, 0.29), (4, 0.3), (10, 0.11), (10, 0.2))] == [2, 0, 2, 0, 2, 0, 2, 0, 2]


def test_pipeline_of_empty_table(spark, tmp_path):
    spark.read.parquet(f"{DATA}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
