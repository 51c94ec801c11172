"""Conversation repair against an exhaustive search."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coursepulse.llm import queries, repair

WHITE = " \t\n\x0b\x0c\r"
LEGAL_AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    """(conv_id, turn, role, text) rows after damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(turns):
    seen, faults = set(), []
    for role, text in turns:
        stripped = text.strip(WHITE)
        faults.append("blank" if not stripped else "duplicate" if (role, text) in seen
                      else "truncated" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def cheapest(turns, faults):
    """Cost, letters and what is left, by trying everything from every place on."""

    @lru_cache(maxsize=None)
    def rest(at, last, inserted):
        options = []
        if at == len(turns) and last in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if role[0] in LEGAL_AFTER[last]:
                    cost, letters, left = rest(at, role[0], inserted + 1)
                    options.append((cost + 5, "I" + letters, ((role, ""), *left)))
        if at < len(turns):
            role, text = turns[at]
            cost, letters, left = rest(at + 1, last, 0)
            options.append((cost + 2, "D" + letters, left))
            if faults[at] in ("", "truncated"):
                more = 5 if faults[at] else 0
                for now in {role, "user", "assistant"}:
                    if now[:1] and now[0] in LEGAL_AFTER[last]:
                        cost, letters, left = rest(at + 1, now[0], 0)
                        options.append((cost + more + (now != role), ("K" if now == role else "R") + letters,
                                        ((now, text), *left)))
        return min(options, default=(10 ** 6, "", ()))

    return rest(0, "", 0)


def report_of(rows):
    """The whole report on rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = [r[2:] for r in rows]
    numbers = [r[1] for r in rows if r[1] is not None]
    faults = faults_of(turns)
    cost, letters, left = cheapest(tuple(turns), tuple(faults))
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *[faults.count(name) for name in ("blank", "duplicate", "truncated")],
        sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
        cost, letters,
        hashlib.sha256("\n".join(f"{role}:{text}" for role, text in left).encode()).hexdigest())


def by_conversation(rows):
    found = {}
    for row in rows:
        found.setdefault(row[0], []).append(row)
    return found


def walk(turns, least):
    """Letters and cost by blocks and checkpoints."""
    codes = ["sua".find(role[:1] or "?") % 4 * 4 + repair.FAULTS.index(fault)
             for (role, _), fault in zip(turns, faults_of(turns))]
    backward, blocks = repair.Backward(least), []
    for place in reversed(range(len(codes))):
        blocks.append(backward.turn(codes[place], place))
    blocks = [b for b in (*blocks, backward.close()) if b]
    assert sum(len(b[1]) for b in blocks) == len(codes)
    forward, letters = repair.Forward(), ""
    starts = {place: (held, after) for place, held, after in blocks}
    for place in range(len(codes)):
        if place in starts:
            forward.block(*starts[place])
        letters += "".join(edit.letter for edit in forward.turn())
    letters += "".join(edit.letter for edit in forward.close())
    return forward.cost, letters, blocks


TURN = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]),
                 st.sampled_from(["", "Yes.", "No!", "and then", "\t ", "Why? \n"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(TURN, max_size=12), st.integers(1, 4))
def test_walk_is_cheapest_and_least(turns, least):
    cost, letters, _ = walk(turns, least)
    assert (cost, letters) == cheapest(tuple(turns), tuple(faults_of(turns)))[:2]


def test_checkpoints_grow_with_the_root():
    pick = random.Random(3)
    turns = [(pick.choice(["user", "assistant", "system"]), f"turn {n}.") for n in range(20_000)]
    _, letters, blocks = walk(turns, 1)
    assert len(letters) >= len(turns)
    assert len(blocks) <= 300 and max(len(b[1]) for b in blocks) <= 300


def _frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


ODD = [
    (None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."),
    (2 ** 62 + 1, 5, "user", "a."), (2 ** 62 + 1, 9, "assistant", "b."), (2 ** 62 + 2, 1, "user", None),
    (3, None, "assistant", "x"), (3, None, "assistant", "x."), (3, 4, None, "y."), (3, 4, "", "z"),
    (4, 1, "system", "s."), (4, 2, "system", "t."), (4, 7, "user", "u."), (4, 7, "assistant", "v" * 200_000),
    (5, 0, "assistant", "é\n."), (5, 0, "assistant", "é\n."), (6, 1, "unter", "q."),
]


def test_odd_rows(spark):
    rows = _frame(spark, ODD).withColumns({"place": F.lit(1), "code": F.lit("x")})
    found = {r[0]: tuple(r[1:]) for r in repair.repair_report(rows).collect()}
    given = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ODD]
    assert found == {key: report_of(of) for key, of in by_conversation(given).items()}
    assert repair.repair_report(rows.filter(F.lit(False))).count() == 0
    assert repair.damaged_report(rows.filter(F.lit(False))).count() == 0


def test_repaired_turns(spark):
    rows = _frame(spark, [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", ""),
                          (1, 3, "assistant", "C."), (2, 0, "user", "")])
    found = [tuple(r) for r in repair.repaired_turns(rows).orderBy("conv_id", "position").collect()]
    cost, letters, left = cheapest(
        (("user", "A."), ("user", "B."), ("assistant", ""), ("assistant", "C.")), ("", "", "blank", ""))
    assert [(f[4], f[5]) for f in found] == list(left)
    assert "".join(f[2] for f in found) == letters.replace("D", "")
    assert all((f[3] is None) == (f[2] == "I") for f in found)


def test_a_long_conversation(spark):
    pick = random.Random(8)
    rows = [(7, n // 2, pick.choice(["user", "assistant"]), pick.choice(["Yes.", f"Turn {n}.", "cut"]))
            for n in range(3000)] + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Yes.")]
    found = {r[0]: tuple(r[1:]) for r in repair.repair_report(_frame(spark, rows).repartition(5)).collect()}
    rows = sorted(rows)
    turns = [r[2:] for r in rows if r[0] == 7]
    cost, letters, _ = walk(turns, 1)
    assert found[7][5:7] == (cost, letters)
    assert found[8][5:7] == (0, "KK")


@pytest.mark.parametrize("copies", [1, 2])
def test_query_by_brute_force(spark, sf_dir, copies):
    rows = queries.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(_frame(spark, ODD[:-4]))
    for _ in range(copies - 1):
        rows = rows.unionByName(rows)
    given = [tuple(r) for r in rows.collect()]
    left = by_conversation(damaged(given))
    found = {r[0]: tuple(r[1:]) for r in repair.damaged_report(rows).collect()}
    nothing = (0,) * 6 + ("", hashlib.sha256().hexdigest())
    assert found == {key: report_of(left[key]) if key in left else nothing
                     for key in by_conversation(given)}
