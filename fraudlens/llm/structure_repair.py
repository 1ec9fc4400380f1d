"""Repair of the role structure of conversations at the least cost.

The role initials of a repaired conversation are nothing, or an optional ``s`` and then one or more
``ua``. Keeping a turn costs 0, giving it the role ``user`` or ``assistant`` 1, deleting it 2, and
inserting an empty one of these roles 5; a truncated turn that stays costs 5 more, and blank and
repeated turns must go. Of the cheapest edits the ASCII-least string of initials counts.

What it costs from a turn on depends on the state before it: nothing yet, after ``s``, ``u`` or ``a``.
These vectors of four costs are computed backward, but kept at every sqrt(n)-th turn only; walking
forward, a block's vectors are computed again from the checkpoint behind it, and tell which edits
are tight. Vectors less their minimum are few, so that a step is a look-up.

A conversation is one task's work, in a stream of its turns: a byte per turn is held for the costs,
and a byte per edit while the texts, which come in a second stream, are repaired.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudlens.llm.storage import written

SPACE = r"\x20\x09-\x0D"
START, S, U, A = range(4)
# The state after the initial of a turn that may stand there, and after a turn that is made to fit.
FITS = ({S: S, U: U}, {U: U}, {A: A}, {U: U})
MADE = (U, U, A, U)
ROLES = {U: "user", A: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# A turn as a number: its initial (1 to 3 as the states, 0 any other) times 4, and its fault.
NO_FAULT, BLANK, DUPLICATE, CUT = range(4)
LEGAL = {(S, U), (U, A), (A, U)}

Costs = tuple[int, int, int, int]
END: Costs = (0, 2 * INSERT, INSERT, 0)


def _edits(code: int, state: int, after: Costs) -> Iterator[tuple[int, str, int]]:
    """What a turn can become: the cost from there on, the edit and the state behind it, by the edit's initial."""
    yield DELETE + after[state], "D", state
    initial, fault = divmod(code, 4)
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT else 0
        if initial in FITS[state]:
            yield KEEP + more + after[FITS[state][initial]], "K", FITS[state][initial]
        yield REROLE + more + after[MADE[state]], "R", MADE[state]


def _before(code: int, after: Costs) -> Costs:
    least = [min(cost for cost, _, _ in _edits(code, state, after)) for state in range(4)]
    least[U], least[A] = min(least[U], INSERT + least[A]), min(least[A], INSERT + least[U])
    return min(least[START], INSERT + least[U]), min(least[S], INSERT + least[U]), least[U], least[A]


@cache
def _step(after: Costs, code: int) -> tuple[Costs, int]:
    """The vector before a turn less its minimum, and that minimum."""
    before = _before(code, after)
    least = min(before)
    return tuple(c - least for c in before), least


@cache
def _choice(after: Costs, code: int, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits up to and with a turn, and the state behind it."""
    before, edits = _before(code, after), ""
    while True:
        tight = [(edit, to) for cost, edit, to in _edits(code, state, after) if cost == before[state]]
        if INSERT + before[MADE[state]] == before[state]:
            tight.append(("I", None))
        edit, to = min(tight, key=lambda t: t[0])
        edits += edit
        if to is not None:
            return edits, to
        state = MADE[state]


def cheapest(codes: bytes) -> tuple[int, str]:
    """The least cost of repairing turns, and the initials of the edits."""
    n = len(codes)
    block = isqrt(n) + 1
    vector, cost = END, 0
    checkpoints = {n: END}
    for i in range(n - 1, -1, -1):
        vector, more = _step(vector, codes[i])
        cost += more
        if i % block == 0:
            checkpoints[i] = vector
    cost += vector[START]
    state, audit = START, []
    for begin in range(0, n, block):
        end = min(begin + block, n)
        behind = [checkpoints[end]]
        for i in range(end - 1, begin, -1):
            behind.append(_step(behind[-1], codes[i])[0])
        for i, after in zip(range(begin, end), reversed(behind), strict=True):
            edits, state = _choice(after, codes[i], state)
            audit.append(edits)
    while END[state]:
        audit.append("I")
        state = MADE[state]
    return cost, "".join(audit)


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    def __init__(self, name: int | None) -> None:
        self.name, self.codes = name, bytearray()
        self.first = self.last = None
        self.distinct = 0

    def add(self, code: int, turn: int | None) -> None:
        self.codes.append(code)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1

    def found(self) -> dict:
        codes = bytes(self.codes)
        faults = [c & 3 for c in codes]
        pairs = zip(codes, codes[1:], strict=False)
        cost, audit = cheapest(codes)
        return {
            "conv_id": self.name, "gaps": 0 if self.first is None else self.last - self.first + 1 - self.distinct,
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
            "illegal": sum((x >> 2, y >> 2) not in LEGAL for x, y in pairs), "cost": cost, "audit": audit,
        }


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[n].to_pylist() for n in names), strict=True)


def _some(rows: Iterator[dict], schema: pa.Schema, limit: int = 1024, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of some rows, or of some megabytes of text."""
    held, texts = [], 0
    for row in rows:
        held.append(row)
        texts += sum(len(v) for v in row.values() if isinstance(v, str))
        if len(held) == limit or texts > size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, texts = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


AUDITS = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[dict]:
        now = None
        for name, turn, code in _rows(batches, "conv_id", "turn", "code"):
            if now is None or now.name != name:
                if now:
                    yield now.found()
                now = _Conversation(name)
            now.add(code, turn)
        if now:
            yield now.found()

    yield from _some(found(), AUDITS)


def _turns(rows: DataFrame, tie: str | None) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    same = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        (F.col(tie).cast("string") if tie else same).alias("tie"), same.alias("same"), role.alias("role"), text.alias("text"),
    )


def _code(text: Column, role: Column) -> Column:
    """The turn's number, as far as it alone tells it."""
    initial = F.coalesce(*[F.when(F.substring(role, 1, 1) == letter, state) for letter, state in (("s", S), ("u", U), ("a", A))], F.lit(0))
    fault = F.when(~text.rlike(f"[^{SPACE}]"), BLANK).when(~text.rlike(rf"[.!?][{SPACE}]*\z"), CUT).otherwise(NO_FAULT)
    return initial * 4 + fault


def audits(rows: DataFrame, tie: str | None = None) -> DataFrame:
    """Faults and cheapest edits of each conversation of ``rows`` (``conv_id, turn, role, text``), a row per ``conv_id``.

    Turns are taken by number, null first, and those of one number by the column ``tie``, or else by a hash
    of role and text. A null role or text is one space; a null ``conv_id`` is a conversation of its own. ``blank`` turns
    have nothing but white space, ``duplicate`` ones a role and text seen before, ``truncated`` ones no
    ``.``, ``!`` or ``?`` at their end; the first of these faults counts. ``illegal`` counts neighbours whose role
    initials are not ``su``, ``ua`` or ``au``, ``gaps`` the numbers missing between the first and the last turn.
    """
    turns = _turns(rows, tie)
    each = turns.select("conv_id", "turn", "tie", "same", _code(F.col("text"), F.col("role")).alias("code")).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "same").orderBy("turn", "tie")) > 1
    code = F.when(seen & (F.col("code") % 4 != BLANK), F.col("code") - F.col("code") % 4 + DUPLICATE).otherwise(F.col("code"))
    marked = each.withColumn("code", code.cast("int")).sortWithinPartitions("conv_id", "turn", "tie")
    return marked.select("conv_id", "turn", "code").mapInArrow(_audit, f"conv_id long, {FOUND}")


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str, str]]]]:
    """Each conversation's audit, and what its turns become, which is to be used up first."""
    rows = _rows(batches, "found", "role", "text")
    here = next(rows, None)
    while here is not None:
        found = here[0]

        def turns(audit: str) -> Iterator[tuple[str, str, str]]:
            state = START
            for edit in audit:
                if edit == "I":
                    state = MADE[state]
                    yield edit, ROLES[state], ""
                    continue
                _, role, text = next(rows)
                if edit == "K":
                    state = FITS[state]["sua".index(role[0]) + 1]
                    yield edit, role, text
                elif edit == "R":
                    state = MADE[state]
                    yield edit, ROLES[state], text

        yield found, turns(found["audit"])
        here = next(rows, None)


def _in_order(rows: DataFrame, found: DataFrame, tie: str | None) -> DataFrame:
    """Each conversation's audit and behind it its turns, in one partition."""
    turns = _turns(rows, tie).select("conv_id", F.lit(1).alias("kind"), "turn", "tie", F.lit(None).cast(f"struct<{_ddl()}>").alias("found"), "role", "text")
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "bigint"), ("tie", "string"))]
    told = F.struct(*found.columns).alias("found")
    heads = found.select("conv_id", F.lit(0).alias("kind"), *nothing, told, *[F.lit(None).cast("string").alias(n) for n in ("role", "text")])
    both = turns.unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "turn", "tie").select("found", "role", "text")


def _ddl() -> str:
    return "conv_id: bigint, " + ", ".join(f"{n}: {t}" for n, t in (pair.split() for pair in FOUND.replace("long", "bigint").split(", ")))


def with_hashes(rows: DataFrame, tie: str | None = None) -> DataFrame:
    """:func:`audits` and ``repaired_sha256``, the hash of the repaired ``role:text``, joined by line ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for audit, turns in _repair(batches):
                whole = hashlib.sha256()
                for i, (_, role, text) in enumerate(turns):
                    whole.update(("\n" * (i > 0) + f"{role}:{text}").encode())
                yield {**audit, "repaired_sha256": whole.hexdigest()}

        yield from _some(found(), AUDITS.append(pa.field("repaired_sha256", pa.string())))

    found = written(audits(rows, tie), "audits")
    return _in_order(rows, found, tie).mapInArrow(run, f"conv_id long, {FOUND}, repaired_sha256 string")


def repaired(rows: DataFrame, tie: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: ``conv_id``, ``place`` from 0, ``edit`` (K, R or I), ``role`` and ``text``.
    Conversations of which nothing is left have no rows."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (
            {"conv_id": audit["conv_id"], "place": i, "edit": edit, "role": role, "text": text}
            for audit, turns in _repair(batches) for i, (edit, role, text) in enumerate(turns)
        )
        yield from _some(each, schema)

    found = written(audits(rows, tie), "audits")
    return _in_order(rows, found, tie).mapInArrow(run, "conv_id long, place long, edit string, role string, text string")
