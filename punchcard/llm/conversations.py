"""Repair of the structure of conversations, by a program that streams over sorted turns.

A conversation is right when the initials of its roles spell ``(s?(ua)+)?``. Turns are
kept, given another role, or deleted, and empty ones are inserted, at the least cost.
Spark deals turns out by conversation and sorts them; a Python worker carries the state
of the dynamic program from batch to batch. The state is small: for each place in the
pattern the cost of the best edits so far, their order among each other, and the digest
of what they give. What a turn did to the state is one byte; these back-pointers spill
to a scratch file of the task when a conversation is very long.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import BATCH_BYTES, BATCH_ROWS, _show_package

# Costs of edits: of another role, of a deletion, of an insertion, of a cut-off turn that stays.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5

# Places in the pattern: nothing yet, after the system's turn, after a user's, after an
# assistant's. An initial leads from place to place.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEP = {
    (_EMPTY, "s"): _SYSTEM,
    (_EMPTY, "u"): _USER,
    (_SYSTEM, "u"): _USER,
    (_ASSISTANT, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
}
_ENDS = (_EMPTY, _ASSISTANT)
# Any place reaches what another can do by two insertions and a deletion at most, so a
# place that costs more than the cheapest by more than this is never on the best way.
_WORTH = 2 * INSERT + DELETE
# Kinds of turns: the initial and whether it is cut off; others must be deleted.
GONE = ""
# Back-pointers of this many turns are held before they spill.
HELD = 1 << 20

_ROLES = {"u": "user", "a": "assistant"}


def _next(place: int) -> str:
    """The initial that an edit of free choice gives at a place."""
    return "a" if place == _USER else "u"


class Move(NamedTuple):
    """The best way to a place over one turn."""

    before: int
    edits: str  # insertions, then K, R or D


def _moves(place: int, kind: str) -> Iterator[tuple[int, str, int]]:
    """All (place after, edits, cost) of a turn of this kind."""
    yield place, "D", DELETE
    if kind == GONE:
        return
    initial, extra = kind[:1], CUT_OFF * kind.endswith("!")
    # After two insertions the pattern is where it was, so more never pay.
    for inserted in range(3):
        cost, edits = extra + INSERT * inserted, "I" * inserted
        if (place, initial) in _STEP:
            yield _STEP[place, initial], edits + "K", cost
        yield _STEP[place, _next(place)], edits + "R", cost + REROLE
        place = _STEP[place, _next(place)]


# A state has, for each place that is worth keeping, (place, cost above the cheapest), in
# the order of the edits so far. Edits of equally many turns are never one the beginning
# of the other, so that this order is all that later comparisons need.
State = tuple[tuple[int, int], ...]
START: State = ((_EMPTY, 0),)


class Transition(NamedTuple):
    after: State
    cost: int  # of the cheapest place, above the cheapest before
    moves: dict[int, Move]  # by the place that they lead to
    number: int  # of these moves: the back-pointer


def _transition(state: State, kind: str) -> tuple[State, int, dict[int, Move]]:
    best: dict[int, tuple[int, int, str, int]] = {}
    for order, (before, cost) in enumerate(state):
        for place, edits, more in _moves(before, kind):
            way = (cost + more, order, edits, before)
            if place not in best or way < best[place]:
                best[place] = way
    least = min(way[0] for way in best.values())
    kept = {p: way for p, way in best.items() if way[0] <= least + _WORTH}
    in_order = sorted(kept, key=lambda p: kept[p][1:3])
    after = tuple((p, kept[p][0] - least) for p in in_order)
    return after, least, {p: Move(kept[p][3], kept[p][2]) for p in in_order}


class Program:
    """The transitions met so far, and their moves by number.

    There are few, whatever the input: 383 states, and 60 different sets of moves.
    """

    def __init__(self) -> None:
        self.transitions: dict[tuple[State, str], Transition] = {}
        self.moves: list[dict[int, Move]] = []

    def step(self, state: State, kind: str) -> Transition:
        found = self.transitions.get((state, kind))
        if found is None:
            after, cost, moves = _transition(state, kind)
            if moves not in self.moves:
                self.moves.append(moves)
            found = Transition(after, cost, moves, self.moves.index(moves))
            self.transitions[state, kind] = found
        return found


class Trail:
    """Numbers of moves, one byte for each turn, in a scratch file beyond ``HELD``.

    The file has no name, belongs to the task, and goes with it.
    """

    def __init__(self, held: int) -> None:
        self.held, self.tail, self.file, self.blocks = held, bytearray(), None, 0

    def add(self, number: int) -> None:
        self.tail.append(number)
        if len(self.tail) >= self.held:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.tail)
            self.blocks += 1
            self.tail = bytearray()

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.tail)
        for block in reversed(range(self.blocks)):
            self.file.seek(block * self.held)
            yield from reversed(self.file.read(self.held))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Repair:
    """One conversation, a turn at a time."""

    def __init__(self, program: Program, held: int = HELD) -> None:
        self.program, self.trail = program, Trail(held)
        self.state, self.cost = START, 0
        self.digests = {_EMPTY: hashlib.sha256()}

    def _written(self, move: Move, role: str, text: str):
        """The digest of the repaired turns, after one more turn on the way of a move."""
        digest, place = self.digests[move.before], move.before
        if move.edits == "D":
            return digest
        digest = digest.copy()
        for edit in move.edits:
            initial = role[:1] if edit == "K" else _next(place)
            if place != _EMPTY:
                digest.update(b"\n")
            name = role if edit == "K" else _ROLES[initial]
            digest.update(f"{name}:{text if edit != 'I' else ''}".encode("utf-8", "surrogatepass"))
            place = _STEP[place, initial]
        return digest

    def turn(self, kind: str, role: str = "", text: str = "") -> None:
        found = self.program.step(self.state, kind)
        self.digests = {p: self._written(move, role, text) for p, move in found.moves.items()}
        self.state = found.after
        self.cost += found.cost
        self.trail.add(found.number)

    def ended(self) -> tuple[int, str, str]:
        """Cost, edits and digest of the cheapest repair, of equal ones the least edits."""
        ways = []
        for order, (place, cost) in enumerate(self.state):
            inserted = 0 if place in _ENDS else 1 if place == _USER else 2
            ways.append((cost + INSERT * inserted, order, place, inserted))
        cost, _, place, inserted = min(ways)
        digest, at = self.digests[place], place
        for _ in range(inserted):
            digest = digest.copy()
            digest.update(f"\n{_ROLES[_next(at)]}:".encode())
            at = _STEP[at, _next(at)]
        edits = bytearray(b"I" * inserted)
        for number in self.trail.backwards():
            move = self.program.moves[number][place]
            edits += move.edits[::-1].encode()
            place = move.before
        self.trail.close()
        edits.reverse()
        return self.cost + cost, edits.decode(), digest.hexdigest()


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """Figures and repair of one conversation."""

    def __init__(self, program: Program) -> None:
        self.repair = Repair(program)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.last_initial: str | None = None
        self.last_row: tuple | None = None

    def row(self, turn: str | None, role: str, text: str, fault: str, first: bool) -> None:
        # The first of equal rows of a turn is a duplicate if an earlier turn has it too.
        if not fault or fault == "truncated":
            if not first or (turn, role, text) == self.last_row:
                fault = "duplicate"
            self.last_row = (turn, role, text)
        if fault:
            self.faults[fault] += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in _LEGAL
        self.last_initial = initial
        if fault in ("blank", "duplicate"):
            self.repair.turn(GONE)
        else:
            kind = initial if initial in ("s", "u", "a") else "?"
            self.repair.turn(kind + "!" * (fault == "truncated"), role, text)

    def result(self) -> tuple:
        gaps = 0
        if self.first_turn is not None:
            gaps = int(self.last_turn) - int(self.first_turn) + 1 - self.turns
        cost, edits, digest = self.repair.ended()
        figures = (min(gaps, (1 << 63) - 1), *self.faults.values(), self.illegal, cost)
        return *figures, edits, digest


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each conversation; its turns are neighbours and in order."""
    program, open_, key, done = Program(), None, None, []

    def flushed() -> pd.DataFrame:
        return pd.DataFrame(done, columns=["key", *_FIGURES, "audit", "repaired_sha256"])

    for batch in batches:
        columns = [batch[c].tolist() for c in ("key", "live", "turn", "role", "text", "fault", "first")]
        for own, live, *row in zip(*columns, strict=True):
            if open_ is None or own != key:
                if open_ is not None:
                    done.append((key, *open_.result()))
                open_, key = _Conversation(program), own
            if live:
                open_.row(*row)
        if done:
            yield flushed()
            done = []
    if open_ is not None:
        done.append((key, *open_.result()))
        yield flushed()


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns after repair. The edits of a conversation stand before its turns."""
    key, edits, at, end, place, number, done = None, "", 0, 0, _EMPTY, 0, []

    def inserted() -> Iterator[tuple]:
        nonlocal at, place, number
        while at < len(edits) and edits[at] == "I":
            initial = _next(place)
            yield key, number, "I", None, _ROLES[initial], ""
            place, at, number = _STEP[place, initial], at + 1, number + 1

    for batch in batches:
        columns = [batch[c].tolist() for c in ("key", "audit", "turn", "role", "text")]
        for own, audit, turn, role, text in zip(*columns, strict=True):
            if audit is not None:  # a conversation begins
                key, edits, at, place, number = own, audit, 0, _EMPTY, 0
                end = len(edits.rstrip("I"))
                continue
            done.extend(inserted())
            edit, at = edits[at], at + 1
            if edit == "D":
                done.append((key, None, edit, turn, role, text))
            else:
                initial = role[:1] if edit == "K" else _next(place)
                named = role if edit == "K" else _ROLES[initial]
                done.append((key, number, edit, turn, named, text))
                place, number = _STEP[place, initial], number + 1
            if at == end:  # nothing but insertions is left
                done.extend(inserted())
        if done:
            yield pd.DataFrame(done, columns=["key", "place", "edit", "turn", "role", "text"]).astype(
                {"place": "Int64"}
            )
            done = []


# White space in the sense of the pattern for words.
_BLANKS = " \t\n\x0b\f\r"


def _fault(text: Column) -> Column:
    """What the text of a turn shows by itself: blank, truncated, or nothing."""
    bare = F.rtrim(text, F.lit(_BLANKS))
    return (
        F.when(bare == "", "blank")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )


def _in_pandas(
    df: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """``mapInPandas`` with bounded batches."""
    spark = df.sparkSession
    _show_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInPandas(function, schema)


def _named(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, live_col: str | None
) -> DataFrame:
    """(conv, turn, role, text, live): a null role or text counts as one space."""
    return turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        F.coalesce(F.col(live_col) if live_col else F.lit(None), F.lit(True)).alias("live"),
    )


def damaged(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Turns damaged by the crc32 of "conversation:turn" modulo 20, for a test of repair.

    Remainder 0: dropped; 1: empty text; 2: without the characters ``.!?``; 3: twice; 4:
    role user. A null role or text becomes one space, and a null in the crc32's key counts
    as one. Columns (``conv_col``, ``turn_col``, ``role_col``, ``text_col``, live): live is
    false for a dropped row, which stays as a sign of its conversation, without role and text.
    """
    rows = _named(turns, conv_col, turn_col, role_col, text_col, None)
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    rows = rows.withColumn("harm", F.crc32(F.concat_ws(":", *name).cast("binary")) % 20)
    text = (
        F.when(F.col("harm") == 1, "")
        .when(F.col("harm") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    live = F.col("harm") != 0
    changed = rows.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.when(live, F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))).alias(role_col),
        F.when(live, text).alias(text_col),
        live.alias("live"),
        F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return changed.withColumn("copies", F.explode("copies")).drop("copies")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation in one partition, by turn; rows of one turn by role and text."""
    text = F.when(_fault(F.col("text")) == "blank", "").otherwise(F.col("text"))
    return rows.repartition("conv").sortWithinPartitions(
        "conv", *first, F.asc_nulls_first("turn"), "role", text
    )




def conversation_repairs(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    live_col: str | None = None,
) -> DataFrame:
    """One row per conversation: ``conv_col``, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256.

    Turns count in the order of ``turn_col``, nulls first; rows of one turn by role, then
    text (blank ones as empty), so that equal rows are neighbours. A null role or text counts
    as one space; rows with a null conversation are one conversation. Rows where ``live_col``
    is false only tell that their conversation exists. Other columns are ignored.

    gaps: turns missing between the least and the largest. blank, duplicate, truncated: rows
    by their first fault: nothing but white space; role and text seen earlier; the last
    character before trailing white space is none of ``.!?``. illegal: neighbours whose
    roles' initials are not su, ua or au. audit: the cheapest edits, of equal ones the least
    as text, with Keep, Rerole, Delete, Insert by their initials; cost is what they cost.
    repaired_sha256: of the repaired turns as role:text, joined by newlines. A conversation
    without live rows has zeros, an empty audit and the digest of nothing; an empty table
    gives no rows. Texts of any length count whole.

    Repeats are found by a join on digests, which Spark splits where one is skewed, so the
    worker holds nothing but the state; a conversation's turns pass through one task, as
    the digest of its repaired text has to be taken in order.
    """
    rows = _named(turns, conv_col, turn_col, role_col, text_col, live_col)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("fault", F.when(F.col("live"), _fault(F.col("text")))).withColumn(
        "digest", F.when(F.col("live") & (F.col("fault") != "blank"), F.unhex(digest))
    )
    since = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"))
    seen = (
        rows.filter(F.col("digest").isNotNull())
        .groupBy(F.col("conv").alias("seen_conv"), F.col("digest").alias("seen"))
        .agg(F.min(since).alias("since"))
    )
    joined = rows.join(
        seen, F.col("conv").eqNullSafe(F.col("seen_conv")) & (F.col("digest") == F.col("seen")), "left"
    )
    # A row that goes anyway travels without its text.
    first = F.col("since.b").eqNullSafe(F.col("turn"))
    goes = ~F.col("live") | (F.col("fault") == "blank")
    dealt = _in_order(
        joined.select(
            "conv",
            "turn",
            "role",
            F.when(goes, "").otherwise(F.col("text")).alias("text"),
            "live",
            F.coalesce("fault", F.lit("")).alias("fault"),
            first.alias("first"),
        )
    )
    sent = dealt.select(
        F.col("conv").cast("string").alias("key"),
        "live",
        F.col("turn").cast("string").alias("turn"),
        "role",
        "text",
        "fault",
        "first",
    )
    figures = ", ".join(f"{name} long" for name in _FIGURES)
    found = _in_pandas(sent, _repaired, f"key string, {figures}, audit string, repaired_sha256 string")
    kind = turns.schema[conv_col].dataType
    return found.select(
        F.col("key").cast(kind).alias(conv_col), *_FIGURES, "audit", "repaired_sha256"
    )


def repaired_turns(
    turns: DataFrame,
    repairs: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    live_col: str | None = None,
) -> DataFrame:
    """The turns after the ``repairs`` that ``conversation_repairs`` found for them.

    Columns (``conv_col``, place, edit, ``turn_col``, ``role_col``, ``text_col``): place
    counts the repaired turns of a conversation from 0 and is null for a deleted one; an
    inserted one has no turn. Nulls, order and ``live_col`` as there. The edits of a conversation
    travel before its turns, which then pass in one stream.
    """
    kind, turn_kind = turns.schema[conv_col].dataType, turns.schema[turn_col].dataType
    named = _named(turns, conv_col, turn_col, role_col, text_col, live_col)
    rows = named.filter("live").select("conv", "turn", "role", "text")
    heads = repairs.select(F.col(conv_col).alias("conv"), "audit")
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(
        heads.withColumns({c: F.lit(None).cast(rows.schema[c].dataType) for c in ("turn", "role", "text")})
    )
    dealt = _in_order(both.withColumn("later", F.col("audit").isNull()), "later")
    sent = dealt.select(
        F.col("conv").cast("string").alias("key"),
        "audit",
        F.col("turn").cast("string").alias("turn"),
        "role",
        "text",
    )
    found = _in_pandas(
        sent, _edited, "key string, place long, edit string, turn string, role string, text string"
    )
    return found.select(
        F.col("key").cast(kind).alias(conv_col),
        "place",
        "edit",
        F.col("turn").cast(turn_kind).alias(turn_col),
        F.col("role").alias(role_col),
        F.col("text").alias(text_col),
    )
