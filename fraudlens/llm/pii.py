"""Personal data in texts: patterns propose spans, checks confirm them, context adjusts their score.

Kinds ``email, ip, card, phone`` are found exactly as their patterns and checks say. ``iban`` (checked
modulo 97) and ``ssn`` are added if their score, raised by words that stand before them, reaches
``LEAST_SCORE``. Offsets count code points.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.storage import free, schema_with

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
LEAST_SCORE = 0.6
CONTEXT_CHARS = 40
ADDED = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "found")

# Scores without context, and words of the context that raise them.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "konto", "bank"),
    "ssn": ("ssn", "social", "security"),
}
# Characters of an IBAN, by country.
_IBAN_CHARS = {
    country: int(n)
    for n, countries in (
        x.split(":")
        for x in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
            "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
            "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for country in countries.split(",")
}
_CONTEXT = {k: re.compile(r"(?<![a-z])(?:" + "|".join(v) + ")") for k, v in CONTEXT.items()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, since the whole run is always taken.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(done, at + 1))


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield m.span()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _iban_end(found: str) -> int | None:
    """Where the IBAN ends that ``found`` begins with: its words may be followed by others.

    The country's length goes before the whole of ``found``; of an unknown country, the longest
    run of words that passes the check is taken.
    """
    ends = [i for i, c in enumerate(found) if c == " "] + [len(found)]
    sizes = {end - n: end for n, end in enumerate(ends) if end - n >= 15}
    length = _IBAN_CHARS.get(found[:2])
    if length is None:
        order = sorted(sizes.values(), reverse=True)
    else:
        order = [sizes[length]] if length in sizes else []
        order.append(len(found))
    return next((end for end in order if mod97(found[:end].replace(" ", ""))), None)


def _ibans(text: str):
    found = _IBAN.search(text)
    while found:
        end = _iban_end(found[0])
        if end:
            yield found.start(), found.start() + end
        # What follows, or what a failed one took along, may hold another.
        found = _IBAN.search(text, found.start() + (end or 1))


def _ssns(text: str):
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns}


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score of all spans, by start and then by kind."""
    if not text:
        return []
    out = []
    for rank, kind in enumerate(KINDS):
        for start, end in _FINDERS[kind](text):
            near = text[max(0, start - CONTEXT_CHARS) : start].lower()
            score = min(1.0, SCORES[kind] + 0.3 * bool(_CONTEXT[kind].search(near)))
            if kind in BASE or score >= LEAST_SCORE:
                out.append((start, rank, kind, end, score))
    return [(kind, start, end, score) for start, _, kind, end, score in sorted(out)]


def redacted(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """``text`` with a mark of the first kind in place of each run of overlapping spans."""
    if not spans:
        return text
    out, done = [], 0
    for kind, start, end, _ in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _scan(text_column: str, names: list[str], redact: bool):
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def scan(batches):
        for batch in batches:
            texts = batch.column(text_column).to_pylist()
            found = [find(t) for t in texts]
            kept = {n: batch.column(n) for n in names}
            if redact:
                kept[text_column] = pa.array([redacted(t, s) for t, s in zip(texts, found, strict=True)], pa.string())
            base = [[f"{k}:{a}:{b}" for k, a, b, _ in s if k in BASE] for s in found]
            yield pa.RecordBatch.from_pydict(kept | {f"n_{kind}": pa.array([sum(x[0] == kind for x in s) for s in found], pa.int64()) for kind in BASE} | {
                "base_sha256": pa.array([hashlib.sha256(",".join(b).encode()).hexdigest() for b in base], pa.string()),
                "spans": pa.array([",".join(f"{k}:{a}:{b}" for k, a, b, _ in s) for s in found], pa.string()),
                "found": pa.array([[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in s] for s in found], pa.list_(struct)),
            })

    return scan


def with_personal_data(rows: DataFrame, text_column: str = "text", keep_text: bool = True, redact: bool = False) -> DataFrame:
    """All columns and rows with ``n_email, n_ip, n_card, n_phone``, ``base_sha256`` (of the spans of
    these kinds), ``spans`` (all, as text) and ``found`` (all, with scores); columns of these names
    are replaced. With ``redact`` the spans are replaced by their kind in the text.

    Null and empty texts have no spans and stay as they are. Each row is a matter of its own, so that
    repeated rows and missing ids make no difference.
    """
    kept = free(rows, *ADDED)
    kept = kept.withColumn(text_column, F.col(text_column).cast("string"))
    left_out = () if keep_text else (text_column,)
    names = [c for c in kept.columns if c not in left_out]
    added = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int,score:double>>"
    return kept.mapInArrow(_scan(text_column, names, redact), schema_with(kept, added, left_out))
