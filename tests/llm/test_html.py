"""The scan of broken markup, names that only seem to say what is beside the text, and the best run."""

from __future__ import annotations

import random
import time

import pytest

from fraudlens.llm import html
from test_vectors_pages_pieces import MODEL


@pytest.mark.parametrize("form", ["<a x=' ", "<a ", "<! ", '<a ">"', "<a<a", "</script ", "<!-- ", "<p ' \">", "<", "'<a \"", "<script></script", "<p x='>'", "</a ' \""])
def test_broken_markup_is_read_in_linear_time(form):
    seconds = []
    for size in (100_000, 400_000):
        page = form * (size // len(form))
        begin = time.process_time()
        html.parts(page)
        html.parts(page + ">")
        seconds.append(time.process_time() - begin)
    assert seconds[1] < 8 * max(seconds[0], 0.05)


def test_tags_end_behind_their_quotes():
    for page, expected in [
        ('<p title="a > b">one</p>', "one"), ("<p title='a > b'>one</p>", "one"), ('<p title="a>one', 'one'), ("<p a=\"'\" b='\"'>one</p>", "one"),
        ("<p>one <b", "one <b"), ("<p>one <!-- two", "one"), ("<p>one < two", "one < two"), ("<p>one</p" + " x" * 400 + ">", "one"),
        ("<p " + 'x="' + ">" * 600 + '">one', "one"),
    ]:
        assert html.extract(f"<article>{page}", MODEL).startswith(expected), page


@pytest.mark.parametrize("element", [
    '<p class="search-results-analysis">', '<div class="social-science">', '<h2 class="related-work">', '<p id="share-price">', '<div class="login-guide">',
    '<p id="hidden-gems">', '<h2 id="comments">',
])
def test_one_word_of_a_name_does_not_take_text_away(element):
    end = element[1:].split()[0]
    assert "Some words of it" in html.extract(f"<article><p>Before it there is text.</p>{element}Some words of it.</{end}><p>And behind.</p></article>", MODEL)


@pytest.mark.parametrize("name", ["related-posts", "social-share-buttons", "comment-list", "ad-300x250", "sidebar-2", "cookie_notice", "newsletter", "comments"])
def test_names_of_what_is_beside_the_text_still_do(name):
    page = f'<article><p>Before it there is text.</p><div class="{name}">Something else.</div><p>And behind.</p></article>'
    assert html.extract(page, MODEL) == "Before it there is text.\n\nAnd behind."


def plain_best(scores):
    best, run = 0.0, (0, 0)
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            total = sum(scores[a:b])
            if total > best + 1e-9:
                best, run = total, (a, b)
    return run


@pytest.mark.parametrize("seed", range(5))
def test_the_run_is_the_best_one(seed):
    rng = random.Random(seed)
    for _ in range(200):
        scores = [rng.choice([-3.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0]) for _ in range(rng.randrange(12))]
        begin, end = html.best_run(scores)
        found, expected = sum(scores[begin:end]), plain_best(scores)
        assert found == pytest.approx(sum(scores[expected[0]:expected[1]]))
