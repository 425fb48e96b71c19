"""Repair of conversations whose turns are blank, repeated, cut off, in the wrong order or missing, at least cost.

A repaired conversation has role initials ``(s?(ua)+)?``. Each turn is kept (0), given the role user or assistant (2) or deleted
(3; blank and repeated ones must be); empty turns of a user or an assistant may be inserted anywhere (2); a turn that is cut
off and not deleted adds 1. Of the cheapest repairs the one with the ASCII-least audit wins, the initials of its edits in order.

Cost and audit are one integer. Its high digits are the cost. Below, each turn has a slot of three digits, one letter each, in
base 256: up to two inserts, the edit of the turn, and zeros to the slot's end. A slot's letters end with the first that is
no insert, so no slot's text begins another's, and slots compare as the audits do. An edge of the graph (grammar state before
and after a turn) adds its cost and the letters of its slot, and the least integer at the last node is the answer: an ordinary
shortest path. Only one prefix per state survives a block of ``BLOCK`` turns, so a digit with its rank stands for its letters
in the next block, and the time is linear in the length.

A conversation may have any share of all turns. Turns are reduced to small rows, equal ones are counted, and these are sorted by
ranges of (conversation, turn): a conversation that crosses the border of a task leaves, in each, the least weights from every
state to every state, which are joined in order. Only the repaired turns themselves are streamed by conversation, since they
are one text in the end; a task holds the audit and one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrow_text import arrow_batches
from lakekit.session import stored

#: Costs of the edits, and turns of a block.
RENAME, DELETE, INSERT, CUT_OFF, BLOCK = 2, 3, 2, 1, 64
#: Grammar states: nothing yet, after the system turn, after a user's turn, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after an inserted or renamed turn, and the role that it gets.
ALTERNATE = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\x0c\r"


def _slot(letters: str) -> int:
    return int.from_bytes(letters.encode().ljust(3, b"\0"), "big")


def _moves(turn: str) -> list[tuple[int, int, int, int]]:
    """(state, next state, cost, slot) of the best edit with its inserts. ``turn``: the initial s, u, a or x (another), in upper case
    if the turn is cut off; d if it must be deleted."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    extra = CUT_OFF if turn.isupper() else 0
    for state in range(4):
        at = state
        for inserts in range(3):
            edits = [(at, DELETE, "D")]
            if turn != "d":
                edits.append((ALTERNATE[at][0], RENAME + extra, "R"))
                after = {"s": SYSTEM if at == START else None, "u": USER if at != USER else None,
                         "a": ASSISTANT if at == USER else None}.get(turn.lower())
                if after is not None:
                    edits.append((after, extra, "K"))
            for after, cost, letter in edits:
                found = (cost + INSERT * inserts, _slot("I" * inserts + letter))
                best[state, after] = min(best.get((state, after), found), found)
            at = ALTERNATE[at][0]
    return [(q, r, *w) for (q, r), w in best.items()]


MOVES = {turn: _moves(turn) for turn in "suaxSUAXd"}
#: Inserts that complete a conversation, by state.
CLOSING = ["", "II", "I", ""]

#: Least (cost, rank among the states, audit as a chain of pieces) per state, or None.
Front = list[tuple[int, int, tuple] | None]


def opened(state: int) -> Front:
    front: Front = [None] * 4
    front[state] = (0, 0, ())
    return front


def _ranked(found: list[tuple[int, int, int, tuple] | None]) -> Front:
    """Replaces what orders the audits so far (a rank and letters) by one rank."""
    order = sorted({x[1:3] for x in found if x})
    return [x and (x[0], order.index(x[1:3]), x[3]) for x in found]


def advanced(front: Front, turns: str) -> Front:
    """The front after these turns."""
    for at in range(0, len(turns), BLOCK):
        block = turns[at:at + BLOCK]
        top = 24 * len(block)
        unit = 1 << (top + 2)
        before = {x[1]: x[2] for x in front if x}
        weight = [None if x is None else x[0] * unit | x[1] << top for x in front]
        for i, turn in enumerate(block):
            shift, new = top - 24 * (i + 1), [None] * 4
            for q, r, cost, slot in MOVES[turn]:
                if weight[q] is not None:
                    w = weight[q] + cost * unit + (slot << shift)
                    if new[r] is None or w < new[r]:
                        new[r] = w
            weight = new
        found = []
        for w in weight:
            if w is None:
                found.append(None)
                continue
            rank, low = w >> top & 3, w & ((1 << top) - 1)
            found.append((w >> (top + 2), rank, low, (before[rank], low.to_bytes(3 * len(block), "big").replace(b"\0", b"").decode())))
        front = _ranked(found)
    return front


def joined(front: Front, part: list[tuple[int, int, int, str]]) -> Front:
    """The front after a part of a conversation, given by its least (state, next state, cost, audit)."""
    best: list[tuple | None] = [None] * 4
    width = 8 * max((len(x[3]) for x in part), default=0)
    for q, r, cost, audit in part:
        if front[q] is not None:
            low = int.from_bytes(audit.encode().ljust(width // 8, b"\0"), "big")
            weight = (front[q][0] + cost << width + 2) | front[q][1] << width | low
            if best[r] is None or weight < best[r][0]:
                best[r] = (weight, front[q][0] + cost, front[q][1], low, (front[q][2], audit))
    return _ranked([x and x[1:] for x in best])


def text_of(chain: tuple) -> str:
    pieces = []
    while chain:
        chain, piece = chain
        pieces.append(piece)
    return "".join(reversed(pieces))


def closed(front: Front) -> tuple[int, str]:
    """Cost and audit of the cheapest repair that ends here."""
    least = min((((x[0] + INSERT * len(end)) << 26) | x[1] << 24 | _slot(end), q)
                for q, (x, end) in enumerate(zip(front, CLOSING, strict=True)) if x)
    return least[0] >> 26, text_of(front[least[1]][2]) + CLOSING[least[1]]


@lru_cache(1 << 16)
def _short(turns: str) -> tuple[int, str]:
    return closed(advanced(opened(START), turns))


def repaired_audit(turns: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation; its turns are letters as for ``_moves``."""
    return _short(turns) if len(turns) <= 16 else closed(advanced(opened(START), turns))


PART = ("at long, whole boolean, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
        "first string, last string, cost long, audit string, weights array<struct<q: int, r: int, cost: long, audit: string>>")
PART_TYPE = pa.list_(pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


class _Part:
    """What one task knows of a conversation: its turns in order, so far."""

    def __init__(self, key):
        self.key, self.letters = key, []
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, turn, initial: str, kind: str, n: int, fresh: bool) -> None:
        """``n`` equal turns; kind: blank, cut or whole; fresh: no turn before had the same role and text."""
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        once = 1 if fresh and kind != "blank" else 0
        self.blank += n if kind == "blank" else 0
        self.duplicate += n - once if kind != "blank" else 0
        self.truncated += once if kind == "cut" else 0
        if once:
            letter = initial if initial in ("s", "u", "a") else "x"
            self.letters.append(letter.upper() if kind == "cut" else letter)
        self.letters.append("d" * (n - once))
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += n - 1  # no role may follow itself
        self.first, self.last = initial if self.first is None else self.first, initial

    def row(self, at: int, whole: bool) -> tuple:
        turns = "".join(self.letters)
        cost, audit, weights = None, None, None
        if whole:
            cost, audit = repaired_audit(turns)
        else:
            weights = [{"q": q, "r": r, "cost": x[0], "audit": text_of(x[2])}
                       for q in range(4) for r, x in enumerate(advanced(opened(q), turns)) if x]
        return (self.key, at, whole, self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated, self.illegal,
                self.first, self.last, cost, audit, weights)


PART_TYPES = [pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.string(), PART_TYPE]


def _batch(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [kind, *PART_TYPES], strict=True)], names)


NAMES = ["conv_id", *(f.split()[0] for f in PART.split(", weights")[0].split(", ")), "weights"]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a task; the first and the last may go on in another task."""
    task = TaskContext.get().partitionId()
    now, rows, first, kind = None, [], True, None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for key, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "kind", "n", "fresh")), strict=True):
            if now is not None and key != now.key:
                rows.append(now.row(task, not first))
                now, first = None, False
                if len(rows) >= 1000:
                    yield _batch(rows, kind, NAMES)
                    rows = []
            now = now or _Part(key)
            now.add(*turn)
    if now is not None:
        rows.append(now.row(task, False))
        yield _batch(rows, kind, NAMES)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of a conversation, sorted by task, as one row."""
    rows, parts, kind, held = [], [], None, object()

    def whole() -> tuple:
        front = opened(START)
        low = high = last = None
        turns = blank = duplicate = truncated = illegal = 0
        for p in parts:
            front = joined(front, [(w["q"], w["r"], w["cost"], w["audit"]) for w in p["weights"]])
            turns += p["turns"] - (p["low"] is not None and p["low"] == high)
            low, high = p["low"] if low is None else low, p["high"] if p["high"] is not None else high
            blank, duplicate, truncated = blank + p["blank"], duplicate + p["duplicate"], truncated + p["truncated"]
            illegal += p["illegal"] + (last is not None and last + p["first"] not in LEGAL)
            last = p["last"]
        cost, audit = closed(front)
        return (held, 0, True, low, high, turns, blank, duplicate, truncated, illegal, parts[0]["first"], last, cost, audit, None)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for p in batch.to_pylist():
            if parts and p["conv_id"] != held:
                rows.append(whole())
                parts = []
            held = p["conv_id"]
            parts.append(p)
    if parts:
        rows.append(whole())
    if rows:
        yield _batch(rows, kind, NAMES)


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The columns used; a null role or text is one space."""
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                                F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _kind(text: Column) -> Column:
    said = F.rtrim(text, F.lit(SPACES))
    return F.when(said == "", "blank").when(F.right(said, F.lit(1)).isin(".", "!", "?"), "whole").otherwise("cut")


def audits(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit.

    Turns are ordered by ``turn`` (nulls first), then role and a digest of the text. A turn's first fault counts: blank (white space only),
    duplicate (role and text came before), truncated (the last character that is no white space is none of ``.!?``). ``illegal``
    counts neighbours whose role initials are none of su, ua, au; ``gaps`` missing turn numbers between the least and the
    greatest. Null roles and texts are one space; rows without a conversation are one of their own. No rows give no rows.
    """
    arrow_batches(conversations.sparkSession)
    rows = _turns(conversations, conv_id, turn, role, text)
    counted = rows.groupBy("conv_id", "turn", "role", "digest", _kind(F.col("text")).alias("kind")).agg(F.count("*").alias("n"))
    counted = stored(counted, "repair-turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = counted.where("kind <> 'blank'").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("earliest"), F.count("*").alias("times"))
    again = firsts.where("times > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "earliest")
    marked = counted.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    small = stored(marked.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "role", "digest", "kind", "n",
        (F.col("earliest").isNull() | F.col("earliest.turn").eqNullSafe(F.col("turn"))).alias("fresh")), "repair-marked")
    order = ["conv_id", "turn", "role", "digest"]
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = small.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stored(ordered.select("conv_id", "turn", "initial", "kind", "n", "fresh").mapInArrow(_parts, f"conv_id {kind}, {PART}"), "repair-parts")
    cut = parts.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "at")
    done = parts.where("whole").unionByName(cut.mapInArrow(_merged, f"conv_id {kind}, {PART}"))
    return done.select("conv_id", F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate",
                       "truncated", "illegal", "cost", "audit")


REPAIRED = "position long, edit string, role string, text string"


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of conversations, each given by its audit and its turns in order."""
    audit, at, state, place, key = "", 0, START, 0, None
    for batch in batches:
        out: list[tuple] = []
        kind = batch.schema.field("conv_id").type

        def inserted() -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                state, role = ALTERNATE[state]
                out.append((key, place, "I", role, ""))
                at, place = at + 1, place + 1

        for c, first, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "is_turn", "role", "body")), strict=True):
            if not first:
                audit, at, state, place, key = text, 0, START, 0, c
                inserted()
                continue
            edit, at = audit[at], at + 1
            if edit != "D":
                if edit == "R":
                    state, role = ALTERNATE[state]
                else:
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                out.append((c, place, edit, role, text))
                place += 1
            inserted()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), [kind, pa.int64(), pa.string(), pa.string(), pa.string()], strict=True)],
                names=["conv_id", "position", "edit", "role", "text"])


def repaired_turns(conversations: DataFrame, found: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The repaired turns (conv_id, position from 0, edit K, R or I, role, text) by the audits ``found`` for the same rows.

    Turns of a conversation are in one partition, together and in order. A conversation of which nothing is left has no rows.
    """
    arrow_batches(conversations.sparkSession)
    rows = _turns(conversations, conv_id, turn, role, text)
    said = F.when(_kind(F.col("text")) == "blank", F.lit("")).otherwise(F.col("text"))
    turns = rows.select("conv_id", F.lit(True).alias("is_turn"), "turn", "role", "digest", said.alias("body"))
    heads = found.select("conv_id", F.lit(False).alias("is_turn"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("body"))
    ordered = turns.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", "turn", "role", "digest")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", "is_turn", "role", "body").mapInArrow(_replayed, f"conv_id {kind}, {REPAIRED}")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, sums, state, kind = [], [], None, None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for c, place, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "position", "role", "text")), strict=True):
            if place == 0:
                if state is not None:
                    sums.append(state.hexdigest())
                keys.append(c)
                state = hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
    if state is not None:
        sums.append(state.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines; ``turns`` as ``repaired_turns`` returns them, with nothing in between."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(_digested, f"conv_id {kind}, repaired_sha256 string")
