"""Conversation repair against all edits of small conversations and a plain dynamic programme."""
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cellscope.llm import conversations as C

GRAMMAR = re.compile("(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"
OTHER = {"conv": "c", "pos": 1, "digest": "d", "n": 0, "seg": 1, "k": 3, "kind": 1}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def judged(rows):
    """Faults of one conversation's rows (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(SPACES)[-1:]
        out.append("b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def solve(rows, marks):
    """Dynamic programme over the output's state: start, s, u, a; each with (cost, audit, output)."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def offer(into, state, value):
        if state is not None and (state not in into or value[:2] < into[state][:2]):
            into[state] = value

    def inserts(states):
        for _ in range(4):
            for s, (c, e, out) in list(states.items()):
                for role in ("user", "assistant"):
                    offer(states, step.get((s, role[0])), (c + 3, e + "I", out + (f"{role}:",)))
        return states

    states = inserts({"0": (0, "", ())})
    for (role, text), mark in zip(rows, marks):
        new = {}
        for s, (c, e, out) in states.items():
            offer(new, s, (c + 4, e + "D", out))
            if mark not in ("b", "d"):
                more = c + 3 * (mark == "t")
                offer(new, step.get((s, role[:1])), (more, e + "K", out + (f"{role}:{text}",)))
                for r in ("user", "assistant"):
                    offer(new, step.get((s, r[0])), (more + 3, e + "R", out + (f"{r}:{text}",)))
        states = inserts(new)
    return min(v for s, v in states.items() if s in "0a")


def brute(rows):
    out, groups = [], {}
    for conv in {r[0] for r in rows}:
        groups[conv] = []
    for r in damaged(rows):
        groups[r[0]].append(r[1:])
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).hexdigest()))
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        rt = [t[1:] for t in turns]
        marks = judged(rt)
        cost, audit, lines = solve(rt, marks)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rt, rt[1:]))
        out.append((conv, gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows, parts=4):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts).withColumns({k: F.lit(v) for k, v in OTHER.items()})


def got(df, **kw):
    return sorted((tuple(r) for r in C.report(df, **kw).collect()), key=str)


def test_parser_finds_the_least_of_all_edits():
    """Every way to edit up to three turns with up to three insertions."""
    def ways(n):
        for ops in itertools.product("KuaD", repeat=n):
            for slots in itertools.product(("", "u", "a", "ua", "au"), repeat=n + 1):
                if sum(map(len, slots)) <= 3:
                    yield ops, slots

    plans = {n: list(ways(n)) for n in range(4)}
    cases = [t for n in range(4) for t in itertools.product([("s", ""), ("u", ""), ("a", ""), ("x", ""), ("u", "t"), ("a", "d")], repeat=n)]
    rng = random.Random(1)
    for turns in [c for c in cases if len(c) < 3] + rng.sample([c for c in cases if len(c) == 3], 25):
        best = None
        for ops, slots in plans[len(turns)]:
            cost, audit, out = 3 * len(slots[0]), "I" * len(slots[0]), slots[0]
            for (initial, fault), op, slot in zip(turns, ops, slots[1:]):
                if op != "D" and fault == "d":
                    break
                cost += 4 if op == "D" else (0 if op == "K" else 3) + 3 * (fault == "t")
                out += ("" if op == "D" else initial if op == "K" else op) + slot
                audit += ("R" if op in "ua" else op) + "I" * len(slot)
                cost += 3 * len(slot)
            else:
                if GRAMMAR.fullmatch(out) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        found = C.parse(list(turns))
        assert min(found[s] for s in C.ACCEPT if s in found) == best


def random_rows(rng, convs, longest):
    texts = ["A b.", "Yes!", "cut off", "", "\t ", "why?  ", "Ok.\n", "é日."]
    return [(c, t if rng.random() < 0.95 else rng.choice([None, 3, 50]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
             rng.choice([*texts, None, f"t{rng.random()}.", f"t{rng.random()}."])) for c in convs for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("segment", [3, C.SEGMENT])
def test_equals_a_dynamic_programme(spark, segment):
    rng = random.Random(segment)
    rows = random_rows(rng, [None, *range(60)], 12) + random_rows(rng, [777], 150)
    rng.shuffle(rows)
    assert got(table(spark, rows), segment=segment) == brute(rows)


def test_one_conversation_holds_most_rows_and_copies(spark):
    rows = [(5, i, "user" if i % 2 else "assistant", f"line {i % 40}.") for i in range(900)] + [(6, 1, "user", "a.")] * 300
    assert got(table(spark, rows), segment=64) == brute(rows)


def test_long_text_and_empty_table(spark, odd_rows):
    rows = [(1, k, "user" if k % 2 else "assistant", t) for k, (_, t) in enumerate(odd_rows)]
    assert got(table(spark, rows)) == brute(rows)
    assert C.report(table(spark, [])).count() == 0 and C.repair(table(spark, [])).count() == 0


def test_repair_returns_the_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "cut"), (2, 0, "user", "Hi."), (2, 1, "user", "Hi.")]
    back = {}
    for r in sorted(map(tuple, C.repair(table(spark, rows)).collect())):
        back.setdefault(r[0], []).append(f"{r[2]}:{r[3]}")
    want = {}
    for conv in (1, 2):
        rt = [r[2:] for r in rows if r[0] == conv]
        want[conv] = list(solve(rt, judged(rt))[2])
    assert back == want
