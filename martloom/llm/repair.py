"""Conversations audited and repaired by the cheapest edits, streamed turn by turn.

A row is blank (no character but white space), else a duplicate (its role and text were seen earlier in the
conversation), else truncated (its last such character isn't one of ``.!?``), or sound. A repair keeps, deletes or
re-roles each row and may insert empty turns anywhere, so that the initials of the roles give
``(s?(ua)+)?``. Costs: keep 0, re-role to user or assistant 2, delete 3, insert 2, and 1 for a
truncated row that stays; blank rows and duplicates must go. Of the cheapest edits those whose initials in order (D, I, K, R)
are least in ASCII are taken.

The rows are dealt by conversation, sorted by turn, and read as one stream, so a conversation may span
any number of Arrow batches. What is carried from row to row has a fixed size: per state of the pattern
(start, after s, after u, after a) the least cost, its place in the order of the edit strings, and the hash so far of
the repaired text. Two states' strings never start one another, as each ends in the edit of the last
row, so places alone decide ties. A step depends on the row's kind and on costs relative to the least, of
which there are few: steps are looked up once met.

Backpointers are one byte per state and row. A conversation of more than ``SPILL_ROWS`` rows spills them, a chunk at
a time, as rows of the written table of the stream, and a second stream over these chunks alone, last chunk first, follows them
to the string of edits; texts are never kept. A conversation is one task's work, as its rows are read in
order; the rest of the table isn't held up by more than that.

Which rows repeat earlier ones is found before by an aggregate over (conversation, hashes of role and text),
combined before the shuffle, so no set of seen texts is kept.

Defined results: a null role or text is one space (so the row is blank, or its role fits no pattern); null turns come first; rows
of equal turns are ordered by role, then text; rows with a null id are one conversation; an empty table
gives no rows; further columns are ignored. Roles and texts count as equal if two 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from .common import beside

SPILL_ROWS = 1 << 18
# Costs of the edits and what ends a sound text.
RE_ROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SOUND, CUT, GONE = range(3)  # kinds of rows: sound, truncated, to be deleted
WHITE = " \t\n\x0b\x0c\r"

START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ACCEPT = (START, AFTER_A)
NAMES = {"u": "user", "a": "assistant"}
# A state is given up if another one does all it can for less: from the second, the rest of the repair costs at
# most so much more than from the first.
REACH = {
    (START, AFTER_A): DELETE, (START, AFTER_U): DELETE + INSERT, (AFTER_S, AFTER_A): 0, (AFTER_S, AFTER_U): INSERT,
    (AFTER_U, AFTER_A): INSERT, (AFTER_A, AFTER_U): INSERT,
}


def inserted(state: int, count: int) -> tuple[int | None, str]:
    """State and initials after ``count`` inserted turns."""
    made = ""
    for _ in range(count):
        one = next((c for c in "ua" if (state, c) in NEXT), None)
        if one is None:
            return None, made
        state, made = NEXT[state, one], made + one
    return state, made


def _moves() -> dict[tuple[int, str], list[tuple[int, int, int, str, int, str]]]:
    """Per kind and initial: (from, to, cost, edits, inserted turns, new initial or "")."""
    out = {}
    for kind, initial in product((SOUND, CUT, GONE), ("s", "u", "a", "")):
        found = []
        for state, count in product(range(STATES), range(3)):
            at, _ = inserted(state, count)
            if at is None:
                continue
            head, paid = "I" * count, INSERT * count
            found.append((state, at, paid + DELETE, head + "D", count, ""))
            if kind != GONE:
                stays = paid + (TRUNCATED if kind == CUT else 0)
                if (at, initial) in NEXT:
                    found.append((state, NEXT[at, initial], stays, head + "K", count, ""))
                for role in "ua":
                    if (at, role) in NEXT:
                        found.append((state, NEXT[at, role], stays + RE_ROLE, head + "R", count, role))
        out[kind, initial] = found
    return out


MOVES = _moves()
# Backpointers: 1 + state + 4 * inserted + 12 * edit; 0 is no way here.
EDITS = "DKR"


def _code(state: int, count: int, edit: str) -> int:
    return 1 + state + 4 * count + 12 * EDITS.index(edit)


def _decode(code: int) -> tuple[int, str]:
    """The state before and the edits of a step."""
    code -= 1
    return code % 4, "I" * (code // 4 % 3) + EDITS[code // 12]


_STEPS: dict = {}


def step(now: tuple, kind: int, initial: str) -> tuple:
    """The states after a row.

    ``now``: per state None or (cost over the least, place of its edits). Returns the states after, the cost
    added to the least, backpointers and the moves: per state None or (from, inserted, role, keeps).
    """
    key = now, kind, initial
    if key not in _STEPS:
        best: list = [None] * STATES
        for state, to, cost, edits, count, role in MOVES[kind, initial]:
            if now[state] is not None:
                way = (now[state][0] + cost, now[state][1], edits), state, count, role
                if best[to] is None or way[0] < best[to][0]:
                    best[to] = way
        costs = [b and b[0][0] for b in best]
        for worse, better in REACH:
            if best[worse] and best[better] and costs[worse] > costs[better] + REACH[worse, better]:
                best[worse] = None
        least = min(b[0][0] for b in best if b)
        order = sorted((b[0][1:], s) for s, b in enumerate(best) if b)
        place = {s: i for i, (_, s) in enumerate(order)}
        after = tuple(b and (b[0][0] - least, place[s]) for s, b in enumerate(best))
        codes = bytes(b and _code(b[1], b[2], b[0][2][-1]) or 0 for b in best)
        moves = tuple(b and (b[1], b[2], b[3], b[0][2][-1] != "D") for b in best)
        _STEPS[key] = after, least, codes, moves
    return _STEPS[key]


def finish(now: tuple) -> tuple[int, int, int]:
    """Cost over the least, state and number of turns inserted at the end."""
    ways = []
    for state, count in product(range(STATES), range(3)):
        if now[state] is not None and inserted(state, count)[0] in ACCEPT:
            ways.append((now[state][0] + INSERT * count, now[state][1], count, state))
    cost, _, count, state = min(ways)
    return cost, state, count


def follow(codes: bytes, state: int) -> tuple[str, int]:
    """The edits that lead through a run of rows to ``state``, and the state before the run."""
    out = []
    for at in range(len(codes) - STATES, -1, -STATES):
        state, edits = _decode(codes[at + state])
        out.append(edits)
    return "".join(reversed(out)), state


class Repair:
    """One conversation, row by row."""

    def __init__(self):
        self.cost, self.now = 0, ((0, 0), None, None, None)
        self.hashes = [hashlib.sha256(), None, None, None]
        self.codes, self.spilled = bytearray(), 0
        self.rows = self.turns = self.nulls = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = self.initial = self.row = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        initial = role[:1]
        if self.rows and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        # Rows of one turn that are equal stand side by side; the first of them may be new.
        repeats = again or self.row == (turn, role, text)
        self.rows, self.initial, self.row = self.rows + 1, initial, (turn, role, text)
        end = text.rstrip(WHITE)[-1:]
        if not end:
            kind, self.blank = GONE, self.blank + 1
        elif repeats:
            kind, self.duplicate = GONE, self.duplicate + 1
        elif end not in ".!?":
            kind, self.truncated = CUT, self.truncated + 1
        else:
            kind = SOUND
        self.now, added, codes, moves = step(self.now, kind, initial if initial in ("s", "u", "a") else "")
        self.cost += added
        self.codes += codes
        self.hashes = [m and self._hash(m, role, text) for m in moves]

    def _hash(self, move: tuple, role: str, text: str):
        before, count, new, stays = move
        seen = self.hashes[before]
        if not count and not stays:
            return seen
        seen = seen.copy()
        self._insert(seen, before, count)
        if stays:
            newline = "\n" if before != START or count else ""
            seen.update(f"{newline}{NAMES.get(new, role)}:{text}".encode("utf-8", "surrogatepass"))
        return seen

    @staticmethod
    def _insert(seen, state: int, count: int) -> None:
        for i, c in enumerate(inserted(state, count)[1]):
            seen.update(f"{chr(10) if i or state != START else ''}{NAMES[c]}:".encode())

    def close(self) -> tuple[dict, int, str]:
        """Counts and hash, the state after the last row, and the edits after it."""
        cost, state, count = finish(self.now)
        seen = self.hashes[state].copy()
        self._insert(seen, state, count)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        found = {
            "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": self.cost + cost, "repaired_sha256": seen.hexdigest(),
        }
        return found, state, "I" * count


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, repaired_sha256 string"
RESULT = f"conv_id long, {COUNTS}, audit string"
# A spilled chunk has a number from 0 and codes; the conversation's own row has no number, and if it spilled the state
# after its last row.
STREAM = f"{RESULT}, chunk int, codes binary, state int"


def _streamer(spill_rows: int):
    names = [c.split()[0] for c in STREAM.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, it = object(), None
        out: list[dict] = []

        def spill(conv: str) -> None:
            out.append({"conv_id": number(conv), "chunk": it.spilled, "codes": bytes(it.codes)})
            it.spilled += 1
            it.codes.clear()

        def close() -> None:
            found, state, tail = it.close()
            found["conv_id"] = number(current)
            if it.spilled:
                spill(current)
                out.append({**found, "audit": tail, "state": state})
            else:
                out.append({**found, "audit": follow(bytes(it.codes), state)[0] + tail})

        for batch in batches:
            for conv, turn, role, text, dropped, again in zip(*(batch[c] for c in STREAMED)):
                if conv != current:
                    if it:
                        close()
                    current, it = conv, Repair()
                if not dropped:
                    it.add(number(turn), role, text, again)
                    if len(it.codes) >= STATES * spill_rows:
                        spill(conv)
            if len(out) >= 2000 or any("codes" in x for x in out):
                yield _frame(out, names)
                out.clear()
        if it:
            close()
        yield _frame(out, names)

    return run


def number(text: str) -> int | None:
    return int(text) if text else None


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    for name in names:
        if name not in ("repaired_sha256", "audit", "codes"):
            frame[name] = frame[name].astype("Int64")
    return frame


def _unwind(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of spilled conversations: the row of each comes first, then its chunks, the last one first."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    row, state, edits = None, 0, []

    def done() -> pd.DataFrame:
        return _frame([{**row, "audit": "".join(reversed(edits))}], names)

    for batch in batches:
        for r in batch.to_dict("records"):
            if pd.isna(r["chunk"]):
                if row:
                    yield done()
                row, state, edits = {n: r[n] for n in names} | {"conv_id": number(r["conv_id"])}, int(r["state"]), [r["audit"]]
            else:
                part, state = follow(r["codes"], state)
                edits.append(part)
    if row:
        yield done()


STREAMED = ("_conv", "_turn", "_role", "_text", "_dropped", "_again")


def repair(rows: DataFrame, dropped: Column | None = None, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): counts of faults, cost, edits, hash of the repaired text.

    Rows where ``dropped`` holds count only in that their conversation is returned.
    """
    space = F.lit(" ")
    keyed = rows.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.coalesce(dropped if dropped is not None else F.lit(False), F.lit(False)).alias("_dropped"),
    ).withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", F.lit(7), "role")})
    no_turn = F.max(F.col("turn").isNull())
    seen = (
        keyed.where(~F.col("_dropped"))
        .groupBy("conv", "h1", "h2")
        .agg(no_turn.alias("at_null"), F.min("turn").alias("first"), F.max("turn").alias("last"))
        .where((F.col("first") < F.col("last")) | (F.col("at_null") & F.col("last").isNotNull()))
    )
    repeated = stage(seen.select(F.col("conv").alias("c"), F.col("h1").alias("a"), F.col("h2").alias("b"), "at_null", "first"), "repeated")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    again = F.col("turn").isNotNull() & (F.col("at_null") | (F.col("turn") > F.col("first")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stream = (
        keyed.join(beside(repeated), same, "left")
        .select(
            text("conv").alias("_conv"), text("turn").alias("_turn"), F.col("turn").alias("_order"),
            F.col("role").alias("_role"), F.col("text").alias("_text"), "_dropped", F.coalesce(again, F.lit(False)).alias("_again"),
        )
        .repartition("_conv")
        .sortWithinPartitions("_conv", "_order", "_role", "_text")
        .select(*STREAMED)
    )
    read = stage(stream.mapInPandas(_streamer(spill_rows), STREAM), "repaired")
    whole = read.where("chunk IS NULL AND state IS NULL").select(*[c.split()[0] for c in RESULT.split(", ")])
    spilled = read.where("chunk IS NOT NULL OR state IS NOT NULL").withColumn("conv_id", text("conv_id")).repartition("conv_id")
    unwound = spilled.sortWithinPartitions("conv_id", F.desc_nulls_first("chunk")).mapInPandas(_unwind, RESULT)
    return whole.unionByName(unwound)


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults planted by ``crc32("conv_id:turn") % 20``: 0 drops a row (column ``dropped``), 1 empties its text, 2
    takes out its ``.!?``, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    held = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(held("conv_id"), F.lit(":"), held("turn"))) % 20
    marked = rows.select("conv_id", "turn", held("role").alias("role"), held("text").alias("text"), fault.alias("fault"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    cut = F.regexp_replace("text", "[.!?]", "")
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, cut).otherwise(F.col("text")).alias("text"),
        (F.col("fault") == 0).alias("dropped"),
        copies.alias("copy"),
    ).drop("copy")
