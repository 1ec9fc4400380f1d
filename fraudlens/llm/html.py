"""Main text of web pages, by the maximum-scoring run of words and tags.

A page is a row of words and tags. Words have a score between -1 and 1, by the elements that they
stand in; tags cost something, by their name and classes. Both come from labelled pages: pages with
exactly one ``article`` or ``main`` element, whose words are the content. The run with the largest sum,
found in one scan, is the content; words in it that have no positive score (adverts, forms, scripts)
are left out. Names that mean the same on most sites count as seen before.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.storage import free, schema_with

SAMPLE, MOST_FEATURES, LEAST_WORDS = 4096, 20_000, 20
ADDED = ("text", "n_chars")

# HTML's element names, and names that sites commonly give to parts of pages.
RAW = frozenset("script style title textarea iframe".split())
# Elements whose content is no text of the page, and those in which /> ends any element.
UNREAD = frozenset("noscript template svg object select button annotation annotation-xml".split())
FOREIGN = frozenset("svg math".split())
# Elements out of which no start tag closes another.
BOUNDS = UNREAD | frozenset("ul ol dl table article section div".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math semantics annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts "
    "mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
OUTSIDE = frozenset(
    "nav aside footer form menu menubar navigation navbar sidebar ad ads advert adverts advertisement adsense sponsor "
    "sponsored promo promotion banner cookie cookies consent notice alert popup modal newsletter subscribe share sharing "
    "social related recommended comment comments respond discussion breadcrumb breadcrumbs masthead copyright login "
    "complementary contentinfo search pagination pager toolbar dialog hidden".split()
)
INSIDE = frozenset("article main articlebody content post entry story post-content entry-content article-content article-body post-body story-body".split())
# Words that say nothing about what an element holds, beside listed ones.
PLAIN = frozenset(
    "area bar bars bg block blocks body bottom bottombar box boxes btn button buttons card cards center cell col column columns container content "
    "desktop entries entry fixed float footer form grid group header heading icon icons inline inner item items js large left level light link links list lists "
    "main margin mobile module modules nav note outer overlay page pane panel panels placeholder post posts primary right row rows secondary section sections "
    "site slot small sticky story stories tab tabs text thread title top topbar unit ui view widget widgets wrap wrapper zone "
    "article articles close count counts field fields footers global headers hide img input label local message messages reply replies "
    "results settings show slider submit teaser thumb toggle".split()
)
# Elements whose classes describe the page, and words by which a class says what is beside an element.
FRAMES = frozenset("html body main article".split())
BESIDE = frozenset("no has with without".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
PRIOR = 2000
# Names that a text has at most, but for one that says that it is outside.
MOST_NAMES = 512

_MARKUP = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
# Characters in which most tags end.
SOON = 512
_COMMENT = re.compile("<!--")
_NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden(?=[\s>=/])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


class Model(NamedTuple):
    """Log odds that words within an element of a name or class are content."""

    odds: dict[str, float]


class Part(NamedTuple):
    """A tag (no text), or a text with the names it stands in; ``block`` parts separate blocks.

    ``around`` are the names around the outermost outside element that it belongs to, but for those
    of the whole page; None if it belongs to no such element."""

    text: str | None
    names: tuple[str, ...]
    block: bool
    around: tuple[str, ...] | None = None


class Open(NamedTuple):
    """An open element, with the names of all elements down to it, and of those inside the page's body."""

    name: str
    names: tuple[str, ...]
    inner: tuple[str, ...]
    around: tuple[str, ...] | None
    unread: bool
    foreign: bool


TOP = Open("", (), (), None, False, False)


def _joined(above: tuple[str, ...], own: list[str]) -> tuple[str, ...]:
    if len(above) < MOST_NAMES:
        return tuple(dict.fromkeys((*above, *own)))
    bad = next((x for x in own if _outside(x)), None)
    return above if bad is None or any(_outside(x) for x in above[MOST_NAMES - 1 :]) else (*above, bad)


class _Ends:
    """Where tags end: at the first ``>`` outside quotes or, if there is none, at the first ``>``. Quotes and ends
    of the page are looked through once, however many tags are open or how their quotes are mixed up."""

    def __init__(self, html: str) -> None:
        self.html, self.last = html, html.rfind(">")
        self.events: list[int] | None = None

    def of(self, at: int) -> int:
        """The end of the tag whose name ends at ``at``, before the last ``>``."""
        if self.events is None and (found := _ATTRIBUTES.match(self.html, at, at + SOON)):
            return found.end()
        outside = self._outside_quotes(at)
        return (outside if outside >= 0 else self.html.find(">", at)) + 1

    def _outside_quotes(self, at: int) -> int:
        if self.events is None:
            self.events = [m.start() for m in re.finditer(r"""[>"']""", self.html)]
            # The event behind the quote that closes the one at an event, and what was found from there; -2: not looked yet.
            self.behind, self.found, seen = [0] * len(self.events), [-2] * len(self.events), {}
            for i in range(len(self.events) - 1, -1, -1):
                mark = self.html[self.events[i]]
                self.behind[i] = seen.get(mark, -1) + 1
                seen[mark] = i
        i, met, result = bisect_left(self.events, at), [], -1
        while i < len(self.events):
            if self.found[i] != -2:
                result = self.found[i]
                break
            met.append(i)
            if self.html[self.events[i]] == ">":
                result = self.events[i]
                break
            if not self.behind[i]:
                break
            i = self.behind[i]
        for i in met:
            self.found[i] = result
        return result


def parts(html: str) -> list[Part]:
    out: list[Part] = []
    stack: list[Open] = []
    # Depths of the open elements of each name.
    depths: dict[str, list[int]] = {}
    at, n, ends = 0, len(html), _Ends(html)

    def top() -> Open:
        return stack[-1] if stack else TOP

    def deepest(names) -> int:
        return max((depths[x][-1] for x in names if depths.get(x)), default=-1)

    def close(depth: int) -> None:
        while len(stack) > depth:
            depths[stack.pop().name].pop()

    def text(until: int) -> None:
        if until > at and not top().unread:
            out.append(Part(unescape(html[at:until]), top().names, False, top().around))

    while at < n:
        found = _MARKUP.search(html, at)
        comment = found is not None and found[0] == "<!--"
        if not found or (not comment and found.end() > ends.last):
            # Without an end there is no tag, but a comment lasts to the end of the page.
            comment = _COMMENT.search(html, at) if found else None
            text(comment.start() if comment else n)
            break
        text(found.start())
        name = (found[2] or "").lower()
        if comment:
            end = html.find("-->", found.end())
            at = end + 3 if end >= 0 else n
        else:
            at = ends.of(found.end()) if name else html.find(">", found.end()) + 1
        if not name:
            continue
        if found[1]:
            depth = deepest((name,))
            ended = stack[depth] if depth >= 0 else top()._replace(names=(name,))
            if depth >= 0:
                close(depth)
            if not ended.unread:
                out.append(Part(None, ended.names[-1:], name not in INLINE and name != "br", ended.around))
            continue
        attributes = html[found.end() : at]
        alone = attributes.endswith("/>")
        if name in RAW:
            # Its content is no markup, or no text of the page.
            if not (alone and top().foreign):
                end = _ENDS[name].search(html, at) if at <= ends.last else None
                at = end.end() if end else n
            if not top().unread:
                out.append(Part(None, (name,), name not in INLINE, top().around))
            continue
        own = [name]
        if len(attributes) > 2:
            for m in _NAMES.finditer(attributes):
                given = _telling(name, m[1], m[2] or m[3] or m[4] or "")
                own += [x for x in given if not _outside(x)] if name in FRAMES else given
            if _HIDDEN.search(attributes):
                own.append("hidden")
        if name == "br":
            if not top().unread:
                out.append(Part(" ", top().names, False, top().around))
            continue
        block = name not in INLINE
        pushed = name not in VOID and name != "head" and not alone
        if pushed and (name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or (block and top().name == "p")):
            closes = ("p",) if name not in ("li", "dt", "dd", "tr", "td", "th") else (name,)
            depth = deepest(closes)
            if depth >= 0 and depth > deepest(BOUNDS.difference(closes)):
                close(depth)
        above = top()
        around = above.around
        if around is None and any(_outside(x) for x in own):
            around = above.inner
        if not above.unread:
            out.append(Part(None, tuple(own), block, around))
        if pushed:
            depths.setdefault(name, []).append(len(stack))
            inner = () if name in ("html", "body") else _joined(above.inner, own)
            stack.append(Open(name, _joined(above.names, own), inner, around, above.unread or name in UNREAD, above.foreign or name in FOREIGN))
    return out


@lru_cache(100_000)
def _outside(name: str) -> bool:
    """Whether a name says that what it names is no content: a listed one, or one of several words of which
    some are listed and all others say nothing. With a word of its own meaning (social-science) the odds decide."""
    words = re.split(r"[-_]", name)
    if name in OUTSIDE:
        return True
    return BESIDE.isdisjoint(words) and any(x in OUTSIDE for x in words) and all(x in OUTSIDE or x in PLAIN or not x.isalpha() for x in words)


def _telling(name: str, kind: str, given: str) -> list[str]:
    """The names that an attribute gives to an element. Ids of headings and paragraphs are made from their text."""
    if kind.lower() == "id" and name in PROSE:
        return []
    return given.lower().split()


def _labelled(html: str) -> Counter:
    """Words inside and outside the content, for each name; nothing for pages without a label."""
    counts: Counter = Counter()
    found = parts(html)
    marks = [p for p in found if p.text is None and p.names and p.names[0] in ("article", "main")]
    if not 1 <= len(marks) <= 2:
        return counts
    for p in found:
        if p.text is None or not (words := len(p.text.split())):
            continue
        bad = [x for x in p.names if _outside(x)]
        inside = not bad and ("article" in p.names or "main" in p.names)
        # What a telling name explains says nothing about the plain elements around it.
        for name in bad or p.names:
            if name not in ("html", "body"):
                counts[name, inside] += words
    return counts


def _learn(batches):
    for batch in batches:
        total: Counter = Counter()
        for html in batch.column("html").to_pylist():
            total.update(_labelled(html))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())],
            names=["name", "inside", "words"],
        )


def fit(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE) -> Model:
    """Log odds from about ``sample`` pages, chosen by a hash of their text, of which the labelled ones
    count. At most ``MOST_FEATURES`` names are kept, those of the most words."""
    rows = pages.select(F.col(html_column).cast("string").alias("html")).where("html is not null")
    share = max(1, int(min(1.0, sample / max(rows.count(), 1)) * 1_000_000))
    chosen = rows.where(F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < share)
    counted = chosen.mapInArrow(_learn, "name string, inside boolean, words bigint").groupBy("name").agg(
        F.sum(F.when(F.col("inside"), F.col("words")).otherwise(0)).alias("a"), F.sum("words").alias("n")
    )
    found = {r.name: (r.a, r.n - r.a) for r in counted.where(f"n >= {LEAST_WORDS}").orderBy(F.desc("n"), "name").limit(MOST_FEATURES).collect()}
    for name in OUTSIDE | INSIDE | PROSE:
        a, b = found.get(name, (0, 0))
        found[name] = (a, b + PRIOR) if name in OUTSIDE else (a + PRIOR / (20 if name in PROSE else 1), b)
    return Model({name: math.log((a + 1) / (b + 1)) for name, (a, b) in found.items()})


def _score(model: Model, names: tuple[str, ...], known: dict) -> float:
    """Of a word in elements of these names."""
    score = known.get(names)
    if score is None:
        odds = [max(-6.0, min(6.0, model.odds.get(x, 0.0))) for x in names]
        bad = [x for x in names if _outside(x)]
        if "header" in names and "article" not in names and "main" not in names:
            bad.append("header")
        score = known[names] = -1.0 if bad else math.tanh((sum(odds) - 0.5) / 2)
    return score


def _inserted(model: Model, found: list[Part], known: dict):
    """Whether a part belongs to an insertion into content: into the article of a page that has one
    (or a main element), else into what by its names is content."""
    marked = any(p.text is None and p.around is None and p.names and p.names[0] in ("article", "main") for p in found)

    def inserted(part: Part) -> bool:
        if part.around is None:
            return False
        if marked:
            return "article" in part.around or "main" in part.around
        return not INSIDE.isdisjoint(part.around) or (bool(part.around) and _score(model, part.around, known) > 0)

    return inserted


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the run with the largest sum, in one scan; an empty one if no sum is positive."""
    best, total, begin, span = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, span = total, (begin, i + 1)
    return span


def extract(html: str | None, model: Model, known: dict | None = None) -> str:
    """The blocks of the best run, joined by two line ends; empty if no word has a positive score."""
    if not html:
        return ""
    known = {} if known is None else known
    found = parts(html)
    inserted = _inserted(model, found, known)
    scores = []
    for p in found:
        if inserted(p):
            # An insertion, however long, does not split the content around it.
            scores.append(0.0)
        elif p.text is None:
            # A tag costs more, the less its words are content.
            odds = model.odds.get(p.names[-1], 0.0) if p.names else 0.0
            scores.append(-0.02 - 0.2 / (1 + math.exp(max(-20.0, min(20.0, odds)))))
        else:
            words = len(p.text.split())
            score = _score(model, p.names, known)
            # Nor does a long text that is no content.
            scores.append(words * score if score > 0 else max(-3.0, words * score))
    begin, end = best_run(scores)
    blocks, current = [], []
    for p in found[begin:end]:
        if p.text is not None and _score(model, p.names, known) > 0:
            current.append(p.text)
        elif p.block and current:
            blocks.append(" ".join("".join(current).split()))
            current = []
    blocks.append(" ".join("".join(current).split()))
    return "\n\n".join(b for b in blocks if b)


def _extract(model: Model, html_column: str, names: list[str]):
    def run(batches):
        known: dict = {}
        for batch in batches:
            if len(known) > 100_000:
                known.clear()
            texts = [extract(x, model, known) for x in batch.column(html_column).to_pylist()]
            added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + added, names=names + list(ADDED))

    return run


def with_main_text(pages: DataFrame, model: Model, html_column: str = "html", keep_html: bool = False) -> DataFrame:
    """All columns and rows (without the html, unless asked for) with ``text``, the main text, and
    ``n_chars``, its code points; columns of these names are replaced.

    Null and empty pages, and pages without content, have an empty text. Broken markup is read as far
    as it goes: a tag without an end is text, an element without one lasts to the end of its parent,
    and a script, style, title, textarea or iframe without one to the end of the page.
    """
    kept = free(pages, *ADDED).withColumn(html_column, F.col(html_column).cast("string"))
    left_out = () if keep_html else (html_column,)
    names = [c for c in kept.columns if c not in left_out]
    return kept.mapInArrow(_extract(model, html_column, names), schema_with(kept, "text string, n_chars bigint", left_out))
