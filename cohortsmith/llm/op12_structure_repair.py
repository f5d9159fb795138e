"""Conversation structure repair by one shortest path with scalar big-integer weights.

Wanted are the cheapest edits after which the role initials of a conversation read
``(s?(ua)+)?``: keep a row (0), rerole it to user or assistant (2), delete it (3), insert an empty
user or assistant row anywhere (2).  Blank and duplicate rows must go; a truncated row that stays
costs 1.  Of equally cheap edits those with the ASCII-least audit (the initials of the edits in
order) are taken.

Nodes of the DAG are (rows left, state of the pattern).  The weight of a path is one integer: its
high digits are the cost, and the low ``places`` digits spell the audit, first edit first, one
digit of fixed width per edit in ASCII order (D < I < K < R), zeros after the end - so a path that
ends earlier precedes its longer continuations, and the plain minimum of integers decides cost
and audit at once.  Putting an edit before a path adds its cost to the high digits, moves the
low ones one place down and sets the first.  Which row an edit acts on and which role it gives
follow from the audit alone.

Spark deals rows out by conversation and sorts them; a task streams them and holds one
conversation at a time (its edits depend on each other from the first row to the last).  The work
of a conversation grows with the square of its rows, by a 64th of that in machine words.

Defined cases: null roles and texts are one space; null turns come first; rows of one turn are
ordered by role, then text; a null conv_id is a conversation of its own; repeated rows are
duplicates; roles are told by their first character, as they stand; an empty table gives an empty
result; other input columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
DIGIT = {e: i + 1 for i, e in enumerate(sorted(COST))}
DIGIT_BITS = 3
BLANKS = " \t\n\v\f\r"
#: The pattern's states, and where a row of a role's initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FULL = {"u": "user", "a": "assistant"}
NEXT = {s: next(i for i in FULL if (s, i) in STEP) for s in range(4)}  # the one initial that a reroled or inserted row can have


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each (role, text): blank, duplicate, truncated or none."""
    seen, out = set(), []
    for row in rows:
        said = row[1].rstrip(BLANKS)
        out.append("blank" if not said else "duplicate" if row in seen else "" if said[-1] in ".!?" else "truncated")
        seen.add(row)
    return out


class Weights:
    """Integers of a cost and an audit of at most ``places`` edits."""

    def __init__(self, places: int):
        self.bits = places * DIGIT_BITS
        self.low = (1 << self.bits) - 1
        self.first = {e: d << self.bits - DIGIT_BITS for e, d in DIGIT.items()} if places else {}

    def before(self, edit: str, weight: int | None, extra: int = 0) -> int | None:
        """The weight of ``edit`` followed by a path of ``weight`` (None: no path)."""
        if weight is None:
            return None
        cost = (weight >> self.bits) + COST[edit] + extra
        return cost << self.bits | self.first[edit] | (weight & self.low) >> DIGIT_BITS

    def read(self, weight: int) -> tuple[int, str]:
        letter, audit, low = {d: e for e, d in DIGIT.items()}, [], weight & self.low
        digits = low.to_bytes(-(-self.bits // 24) * 3, "big") if self.bits else b""
        text = "".join(f"{int.from_bytes(digits[i:i + 3], 'big'):08o}" for i in range(0, len(digits), 3))
        for c in text[len(text) - self.bits // DIGIT_BITS:]:
            if c == "0":
                break
            audit.append(letter[int(c)])
        return weight >> self.bits, "".join(audit)


def _least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def cheapest(rows: list[tuple[str, str]], found: list[str]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits.  At most two rows are worth inserting in one place."""
    w = Weights(3 * len(rows) + 2)
    path: list = [0, None, None, 0]  # from each state, with no rows left
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            role, fault = rows[i][0][:1], found[i]
            late = TRUNCATED_COST if fault == "truncated" else 0
            after, path = path, []
            for s in range(4):
                edits = [w.before(DELETE, after[s])]
                if fault not in ("blank", "duplicate"):
                    if (s, role) in STEP:
                        edits.append(w.before(KEEP, after[STEP[s, role]], late))
                    edits.append(w.before(REROLE, after[STEP[s, NEXT[s]]], late))
                path.append(_least(*edits))
        user, assistant = path[USER], path[ASSISTANT]
        path[USER] = _least(user, w.before(INSERT, assistant))
        path[ASSISTANT] = _least(assistant, w.before(INSERT, user))
        for s in (START, SYSTEM):
            path[s] = _least(path[s], w.before(INSERT, path[USER]))
    return w.read(path[START])


def edited(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The rows after the edits of an audit."""
    out, state, at = [], START, iter(rows)
    for e in audit:
        row = ("", "") if e == INSERT else next(at)
        if e == DELETE:
            continue
        if e != KEEP:
            row = (FULL[NEXT[state]], row[1])
        state = STEP[state, row[0][:1]]
        out.append(row)
    return out


def repair(rows: list[tuple[int | None, str, str]]) -> dict:
    """Faults, cost, audit and repaired rows of one conversation's (turn, role, text) in order."""
    said = [r[1:] for r in rows]
    found, turns = faults(said), [r[0] for r in rows if r[0] is not None]
    cost, audit = cheapest(said, found)
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])),
            "cost": cost, "audit": audit, "repaired": [{"role": r, "text": t} for r, t in edited(said, audit)]}


_OUT = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                  ("audit", pa.string()), ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
_SQL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired array<struct<role:string,text:string>>")


def _streamed(it):
    """Sorted rows in, one row per conversation out."""
    rows, conv, out, size = [], None, [], 0
    for batch in it:
        for c, turn, role, text in zip(*(col.to_pylist() for col in batch.columns)):
            if rows and c != conv:
                out.append({"conv_id": conv, **repair(rows)})
                rows = []
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, _OUT)
                    out, size = [], 0
            conv = c
            rows.append((turn, role, text))
            size += len(text) + 100
    if rows:
        out.append({"conv_id": conv, **repair(rows)})
    if out:
        yield pa.RecordBatch.from_pylist(out, _OUT)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired
    array<struct<role,text>> of every conversation of ``rows`` (conv_id, turn, role, text)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    t = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role"), space("text"))
    t = t.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return t.mapInArrow(_streamed, _SQL)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the faults that crc32("conv_id:turn") % 20 sets: 0 drops the
    row, 1 empties its text, 2 takes its [.!?] away, 3 repeats it, 4 makes its role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    t = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), k.alias("k")).filter("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return t.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1))).alias("k")).drop("k")
