import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from punchcard.llm import conversations
from punchcard.llm.conversations import GONE, START, Program, Repair, conversation_repairs
from punchcard.llm.conversations import damaged, repaired_turns

SF_DIR = "/root/testdata/sf0.01"
sys.setrecursionlimit(20_000)
SCHEMA = "conv_id long, turn long, role string, text string, live string, key int, audit int"


def plain_repair(rows):
    """Cheapest edits of (kind, role, text) rows: cost, edits and repaired turns, by trying all."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, last, inserts):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        for role in "ua":
            if inserts < 3 and (last, role) in step:
                cost, edits = best(i, role, inserts + 1)
                ways.append((cost + 5, "I" + edits))
        if i < len(rows):
            kind, role, _ = rows[i]
            cost, edits = best(i + 1, last, 0)
            ways.append((cost + 2, "D" + edits))
            if kind != GONE:
                stays = 5 * kind.endswith("!")
                if (last, kind[0]) in step:
                    cost, edits = best(i + 1, kind[0], 0)
                    ways.append((cost + stays, "K" + edits))
                for initial in "ua":
                    if (last, initial) in step:
                        cost, edits = best(i + 1, initial, 0)
                        ways.append((cost + stays + 1, "R" + edits))
        return min(ways) if ways else (10**9, "")

    cost, edits = best(0, "", 0)
    out, last, i = [], "", 0
    for edit in edits:
        row = None if edit == "I" else rows[i]
        i += edit != "I"
        if edit == "D":
            continue
        last = row[0][0] if edit == "K" else "a" if last == "u" else "u"
        role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[last]
        out.append((role, row[2] if row else ""))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return cost, edits, out, digest


def blank(text):
    return not re.search(r"[^\x20\x09-\x0D]", text)


def plain_damage(rows):
    """(conversation, turn, role, text) rows after damage, and all conversations."""
    out = []
    for conv, turn, role, text in rows:
        name = [" " if x is None else str(x) for x in (conv, turn)]
        harm = zlib.crc32(":".join(name).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        out += [(conv, turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return out, {row[0] for row in rows}


def in_order(rows):
    return sorted(
        rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], "" if blank(r[3]) else r[3])
    )


def plain_figures(rows):
    """The result's columns after conv_id, and the repaired turns."""
    rows = in_order(rows)
    faults, kinds, seen = defaultdict(int), [], set()
    for _, _, role, text in rows:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
        if blank(text):
            faults["blank"] += 1
            kinds.append(GONE)
        elif (role, text) in seen:
            faults["duplicate"] += 1
            kinds.append(GONE)
        else:
            cut = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)[1] not in ".!?"
            faults["truncated"] += cut
            kinds.append(initial + "!" * cut)
        seen.add((role, text))
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = zip(rows, rows[1:])
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs)
    cost, edits, out, digest = plain_repair([(k, r[2], r[3]) for k, r in zip(kinds, rows)])
    return (
        (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, edits, digest),
        out,
    )


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "no", 3, 4) for r in rows], SCHEMA)
    harmed = damaged(frame)
    found = conversation_repairs(harmed, live_col="live")
    live, convs = plain_damage(rows)
    by = {conv: plain_figures([r for r in live if r[0] == conv]) for conv in convs}
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    assert got == {conv: figures for conv, (figures, _) in by.items()}
    assert found.count() == len(convs)
    turns = defaultdict(list)
    edits = defaultdict(list)
    for r in repaired_turns(harmed, found, live_col="live").collect():
        edits[r.conv_id].append(r.edit)
        if r.place is not None:
            turns[r.conv_id].append((r.place, r.role, r.text))
    for conv, (figures, out) in by.items():
        assert [t[1:] for t in sorted(turns[conv])] == out
        assert [t[0] for t in sorted(turns[conv])] == list(range(len(out)))
        assert sorted(edits[conv]) == sorted(figures[6])
    return got


def test_all_conversations_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    got = check(spark, [tuple(r) for r in rows])
    assert len({r[6] for r in got.values()}) > 20


def test_odd_conversations(spark):
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "sys", "", None, "tool", "USER", "a", "ü"]
    texts = [None, "", " \n\t\x0b\f\r", "Yes.", "Yes. \r\n", "No", "No?", "\xa0", "x" * 5000 + ".", "...", "é!", "\u0085"]
    rows = [
        (
            rng.choice([*range(150), None]),
            rng.choice([None, -4, 0, 0, 1, 2, 3, 4, 5, 9]),
            rng.choice(roles[:3] if rng.random() < 0.7 else roles),
            rng.choice(texts),
        )
        for _ in range(900)
    ]
    rows += [(700, turn, "user", f"Once more {turn}.") for turn in range(90)]
    rows += [(701, turn, "user", "Again and again.") for turn in range(90)]
    rows += [(702, None, "user", "Again and again.")] * 40
    check(spark, [*rows, *rows[:60]])


def test_dropped_conversation(spark):
    dropped = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    got = check(spark, [(c, 0, "user", "Hi.") for c in dropped])
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {c: (0, 0, 0, 0, 0, 0, "", empty) for c in dropped}


def test_empty_table(spark):
    check(spark, [])


def test_turns_far_apart(spark):
    rows = [(1, -(1 << 63), "user", "A."), (1, (1 << 63) - 1, "assistant", "B.")]
    found = conversation_repairs(spark.createDataFrame([(*r, "", 0, 0) for r in rows], SCHEMA))
    assert found.first().gaps == (1 << 63) - 1


KINDS = [GONE, *(initial + cut for initial in "sua?" for cut in ("", "!"))]


@pytest.mark.parametrize("held", [3, 1 << 20])
def test_edits_against_all_edits(held):
    """Random kinds of turns; back-pointers in the worker or spilled every third turn."""
    program, rng = Program(), random.Random(held)
    names = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}
    for _ in range(1500):
        some = rng.sample(KINDS, rng.randint(1, 5))
        rows = []
        for i in range(rng.randint(0, 14)):
            kind = rng.choice(some)
            rows.append((kind, names[kind[0]] if kind else "user", f"text {i}."))
        repair = Repair(program, held)
        for row in rows:
            repair.turn(*row)
        cost, edits, _, digest = plain_repair(rows)
        assert repair.ended() == (cost, edits, digest)


def test_few_states_and_moves():
    """All states that any input can reach: a back-pointer fits a byte."""
    program, todo, seen = Program(), [START], {START}
    while todo:
        state = todo.pop()
        for kind in KINDS:
            after = program.step(state, kind).after
            if after not in seen:
                seen.add(after)
                todo.append(after)
    assert (len(seen), len(program.moves)) == (383, 60)


def test_giant_conversation_in_little_memory(monkeypatch):
    """A million turns: the worker holds a block of back-pointers and the edits."""
    import tracemalloc

    monkeypatch.setattr(conversations, "HELD", 1 << 12)
    rng, program = random.Random(1), Program()
    repair = Repair(program, 1 << 12)
    tracemalloc.start()
    text = "y" * 200
    for _ in range(300_000):
        kind = rng.choice(["u", "u", "a", "s!", GONE])
        repair.turn(kind, {"u": "user", "a": "assistant", "s": "system"}.get(kind[:1], ""), text)
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    cost, edits, _ = repair.ended()
    assert tracemalloc.get_traced_memory()[1] < 4 << 20
    tracemalloc.stop()
    assert len(edits) >= 300_000 and cost > 0
