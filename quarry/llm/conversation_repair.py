r"""Conversation structure repair by least-weight edits.

A conversation is repaired when its role initials read ``(s?(ua)+)?``.  Each row is kept, given
another role, or deleted, and empty rows may be inserted.  The state is what the repaired part ends
with: nothing, ``s``, ``u`` or ``a``.  A node of the DAG is a state before a row; its value is one
integer, the least weight of repairing the rest: the cost in the high digits, and below them the
initials of the edits, first edit highest, at a fixed width, padded with zeros at the end.  Putting
an edit in front adds its cost, moves the initials down by one digit and sets the highest.  The
initials are digits in ASCII order from 1, so the least integer has the least cost and, among equal
costs, the least audit; it alone decides, and the audit is read off its digits.

Damage, order and faults: see ``damaged`` and ``repair``.  A null in any column counts as one space
where it is read as text; a null turn comes first; rows with a null id are one conversation.  Rows
of one turn follow one another by role, then text (bytes), so repeated rows are adjacent.

Scale: damage, first sightings and order are Spark expressions, aggregates and sorts.  Tasks stream
the sorted rows.  The first pass holds two bytes a row of one conversation and the integers of four
states; the second holds its audit and a running hash, and never its texts.  One conversation is
repaired in one task, since a hash of the whole repaired text is one sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

#: Initials of the edits in ASCII order, digits from 1; a digit has three bits.
EDITS = "DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

#: States, the state an inserted or reroled row leads to, and the role it has.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = ("user", "user", "assistant", "user")
#: State a kept row leads to, by its initial.
_KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_LEGAL = ("su", "ua", "au")

FINE, BLANK, DUPLICATE, CUT = range(4)


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` after damage, by ``crc32(conv_id:turn) % 20``: 0 marks a row as ``gone``, 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 gives it the role user."""
    def read(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), read("role").alias("role"), read("text").alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("draw") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("draw") == 0).alias("gone"), times.alias("copy")).drop("copy")


def least_weight(initials: str, faults: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows with these initials and faults."""
    width = 3 * (3 * len(initials) + 2)  # an edit for every row, and two insertions at each place
    high, low = 1 << width, (1 << width) - 1
    top = [digit << (width - 3) for digit in range(5)]

    def ahead(cost, digit, value):
        rest = value & low
        return value - rest + cost * high + top[digit] + (rest >> 3)

    never = high * (3 * len(initials) + 10)  # more than deleting everything
    values = [0, never, never, 0]
    for k in range(len(initials), -1, -1):
        if k < len(initials):
            extra, kept = TRUNCATED * (faults[k] == CUT), _KEPT.get(initials[k], {})
            after, values = values, []
            for state in range(4):
                choices = [ahead(DELETE, _D, after[state])]
                if faults[k] in (FINE, CUT):
                    choices.append(ahead(REROLE + extra, _R, after[_NEXT[state]]))
                    if state in kept:
                        choices.append(ahead(KEEP + extra, _K, after[kept[state]]))
                values.append(min(choices))
        without = values
        for _ in range(2):
            values = [min(without[s], ahead(INSERT, _I, values[_NEXT[s]])) for s in range(4)]
    digits = f"{values[EMPTY] & low:0{width // 3}o}"
    return values[EMPTY] >> width, digits.rstrip("0").translate(str.maketrans("1234", EDITS))


def _sorted_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """Rows of sorted batches, and whether each begins a conversation."""
    last = None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            yield last is None or row[0] != last[0], row
            last = row


def _streamed(df: DataFrame, state: type, schema: str) -> DataFrame:
    """One row per conversation from ``state``, fed with its rows in order; 500 results a batch."""
    names = [part.split(" ")[0] for part in schema.split(", ")]
    types = [pa.string() if part.endswith(" string") else pa.int64() for part in schema.split(", ")[1:]]

    def run(batches):
        current, out, id_type = None, [], None

        def batch():
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [id_type, *types])], names=names)

        def typed():
            nonlocal id_type
            for b in batches:
                id_type = b.schema.field(0).type
                yield b

        for begins, row in _sorted_rows(typed()):
            if begins:
                if current:
                    out.append(current.result())
                    if len(out) >= 500:
                        yield batch()
                        out.clear()
                current = state(row)
            current.add(row)
        if current:
            out.append(current.result())
            yield batch()

    return df.mapInArrow(run, schema)


class _Judged:
    """Faults, figures and audit of one conversation; holds two bytes a row."""

    def __init__(self, row: tuple):
        self.id, self.turns, self.last, self.illegal = row[0], None, None, 0
        self.initials, self.faults = bytearray(), bytearray()

    def add(self, row: tuple) -> None:
        _, turn, role, text, gone, fault, seen = row
        if gone:
            return
        if turn is not None:
            low, high, distinct = self.turns or (turn, turn, 1)
            self.turns = low, turn, distinct + (turn != high)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
        if self.initials and chr(self.initials[-1]) + initial not in _LEGAL:
            self.illegal += 1
        if fault != BLANK and (seen or self.last == (turn, role, text)):
            fault = DUPLICATE
        self.last = turn, role, text
        self.initials += initial.encode()
        self.faults.append(fault)

    def result(self) -> tuple:
        low, high, distinct = self.turns or (0, 0, 1)
        gaps = (high - low + 1 - distinct + (1 << 63)) % (1 << 64) - (1 << 63)
        cost, audit = least_weight(self.initials.decode(), bytes(self.faults))
        return self.id, gaps, self.faults.count(BLANK), self.faults.count(DUPLICATE), self.faults.count(CUT), self.illegal, cost, audit


class _Repaired:
    """Applies an audit to the rows of one conversation; its first row carries the figures."""

    def __init__(self, row: tuple):
        self.figures, self.audit = (row[0], *row[5:]), row[-1]
        self.at, self.state, self.hash, self.lines = 0, EMPTY, hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(_ROLE[self.state], "")
            self.state, self.at = _NEXT[self.state], self.at + 1

    def add(self, row: tuple) -> None:
        if row[1]:
            return
        role, text = row[3], row[4]
        self._insertions()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._line(role, text)
            self.state = _KEPT[role[0]][self.state]
        elif edit == "R":
            self._line(_ROLE[self.state], text)
            self.state = _NEXT[self.state]

    def result(self) -> tuple:
        self._insertions()
        return *self.figures, self.hash.hexdigest()


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(conversations: DataFrame) -> DataFrame:
    """Damage and repair ``conversations(conv_id, turn, role, text)``; one row per original id.

    The first fault of a row counts: no character beside white space, role and text of an earlier
    row, or a last such character other than ``.!?``.  ``gaps`` (modulo 2^64) counts the turns
    missing between the least and the greatest, ``illegal`` the neighbours other than su, ua, au.
    A conversation without rows after damage has zeros, an empty audit and the hash of nothing.
    An empty table gives an empty result; further columns are not read."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    rows = damaged(conversations).withColumn("fault", F.when(blank, BLANK).when(cut, CUT).otherwise(FINE))
    known = ~F.col("gone") & (F.col("fault") != BLANK)
    first = stored(rows.where(known).groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t")).agg(
        F.count("*").alias("n"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("from_null")).where("n > 1"), "repeats")
    seen = F.coalesce(F.col("turn").isNotNull() & (F.col("from_null") | (F.col("turn") > F.col("first"))), F.lit(False))
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    marked = rows.join(first, on, "left").select("conv_id", "turn", "role", "text", "gone", "fault", seen.alias("seen"))
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    figures = f"conv_id {id_type}, " + ", ".join(f"{c} long" for c in FIGURES) + ", audit string"
    judged = stored(_streamed(_by_conversation(marked, "turn", "role", "text"), _Judged, figures), "audits")
    heads = judged.select("conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                          *FIGURES, "audit")
    lines = rows.where(~F.col("gone")).select("conv_id", F.lit(False).alias("head"), "turn", "role", "text",
                                              *[F.lit(None).cast("long").alias(c) for c in FIGURES], F.lit(None).cast("string").alias("audit"))
    ordered = _by_conversation(heads.unionByName(lines), F.col("head").desc(), "turn", "role", "text")
    return _streamed(ordered, _Repaired, f"{figures}, repaired_sha256 string")


def _by_conversation(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)
