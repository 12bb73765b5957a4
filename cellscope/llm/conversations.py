"""Repair of conversation structure by a generalised LR parser.

A conversation should read as an optional system turn and then one or more pairs of a user and an
assistant turn, or be empty. The grammar over role initials is

    R -> (nothing) | B | s B        B -> B P | P        P -> u a

and its LR table is below. The parser walks over the turns; each may be kept (0), be given
another role (3) or be deleted (4), and an empty user or assistant turn may be inserted anywhere
(3). Blank and repeated turns must be deleted; a truncated turn that stays costs 3 more. All
choices are followed at once: the frontier of a graph-structured stack holds the stacks by their
top, stacks share their lower cells, and equal tops are merged by the smaller (cost, audit), the
audit being the initials of the edits so far. Merging is exact: what can follow depends on the top
alone (states 3 and 5 differ only in the system turn below). Two audits of one top and equal cost are
never a prefix of each other (the rest would be insertions, which cost), so the smaller one stays smaller whatever follows.

Scale. Turns get their place by ranges (ordering.py), never by a window over a conversation. A
conversation is parsed in segments of 4,096 turns, each from every possible top; a segment's
result (cost and audit from each top to each top) composes with its neighbour's like a matrix, so one
conversation with a third of all turns is parsed by many tasks, and only its segments' results, a letter for each
turn and edit, meet. Texts don't take part: the edits are joined back to the turns by place.
The digest of a repaired conversation is one SHA-256 over its text, which by its definition
is computed in sequence: its lines arrive sorted and are streamed through the hash, none is held.

Defined results: null roles and texts are one space (the text is then blank). Turns are ordered by
turn (nulls first), then role, then the text's digest, so copies are adjacent. A row repeated in the table is a
duplicate like any other. Roles are judged by their first character; a role that is neither s, u
nor a can't be kept. Null conv_ids are one conversation. Very long texts are read by built-in functions and streamed once.
An empty table gives no rows. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import batched, drop_paths, staged
from cellscope.llm.ordering import positions

SEGMENT = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: More than the lines that a segment can have, insertions included.
_LINES = 1 << 20

# LR(0) table of the grammar above
SHIFT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 6}, 3: {"u": 2}, 5: {"u": 2}}
REDUCE = {4: (1, "B"), 6: (2, "P"), 7: (2, "B")}
GOTO = {(0, "B"): 3, (0, "P"): 4, (1, "B"): 5, (1, "P"): 4, (3, "P"): 7, (5, "P"): 7}
ACCEPT = (0, 3, 5)
#: A stack is a cell (state, cell below); one for each top a segment may start from.
_BOTTOM = (0, None)
STACKS = {0: _BOTTOM, 1: (1, _BOTTOM), 2: (2, _BOTTOM), 3: (3, _BOTTOM), 5: (5, (1, _BOTTOM))}


@lru_cache(256)
def push(stack: tuple, symbol: str) -> tuple | None:
    """The stack after a symbol and all reductions, or None where the table has no shift."""
    to = SHIFT.get(stack[0], {}).get(symbol)
    if to is None:
        return None
    stack = (to, stack)
    while stack[0] in REDUCE:
        size, left = REDUCE[stack[0]]
        for _ in range(size):
            stack = stack[1]
        stack = (GOTO[(stack[0], left)], stack)
    return stack


def _offer(frontier: dict, stack: tuple | None, cost: int, audit: str) -> bool:
    """Merge a stack into the frontier; whether it is now the one of its top."""
    if stack is None:
        return False
    held = frontier.get(stack[0])
    if held is not None and (held[0], held[1]) <= (cost, audit):
        return False
    frontier[stack[0]] = (cost, audit, stack)
    return True


def _with_inserts(frontier: dict) -> dict:
    """All that insertions reach from the frontier."""
    todo = list(frontier.values())
    while todo:
        cost, audit, stack = todo.pop()
        for role in NAMES:
            after = push(stack, role)
            if _offer(frontier, after, cost + INSERT, audit + "I"):
                todo.append(frontier[after[0]])
    return frontier


def parse(turns: list[tuple[str, str]], start: int = 0, opens: bool = True) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, audit) from top `start` to each top over turns (initial, fault); `opens`:
    nothing has been read before, so insertions may come first. Faults: b, d, t or none."""
    frontier = {start: (0, "", STACKS[start])}
    if opens:
        _with_inserts(frontier)
    for initial, fault in turns:
        after: dict = {}
        for cost, audit, stack in frontier.values():
            _offer(after, stack, cost + DELETE, audit + "D")
            if fault in ("b", "d"):
                continue
            stays = cost + (TRUNCATED if fault == "t" else 0)
            if initial in ("s", "u", "a"):
                _offer(after, push(stack, initial), stays + KEEP, audit + "K")
            for role in NAMES:
                _offer(after, push(stack, role), stays + REROLE, audit + "R")
        frontier = _with_inserts(after)
    return {top: (cost, audit) for top, (cost, audit, _) in frontier.items()}


def replay(start: int, audit: str, turns: list[str]) -> list[tuple[int, str, bool]]:
    """(turn's index, role, own) of what an audit leaves of turns (initials), in order: own False is an inserted
    turn, role None a kept one. The role of a new or reroled turn is the one the stack can take."""
    stack, at, out = STACKS[start], 0, []
    for edit in audit:
        if edit == "D":
            at += 1
        elif edit == "K":
            stack = push(stack, turns[at])
            out.append((at, None, True))
            at += 1
        else:
            role = next(r for r in NAMES if push(stack, r) is not None)
            stack = push(stack, role)
            out.append((at, NAMES[role], edit == "R"))
            at += edit == "R"
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text after the damage that crc32 of `conv_id:turn` modulo 20 does: 0 drops
    the turn, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), word("role").alias("role"),
                                word("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        conv_key("conv_id").alias("conv"), "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def conv_key(column: str):
    """A conversation's name, never null, in text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def placed(rows: DataFrame, made: list[str]) -> DataFrame:
    """conv, turn, role, text, digest, pos (in the conversation) and n (its turns)."""
    rows = rows.select("conv", "turn", "role", "text", F.md5(F.col("text").cast("binary")).alias("digest"))
    return staged(positions(rows, ["conv"], ["turn", "role", "digest"], "turns", made).withColumnRenamed("group_rows", "n"),
                  "turns", made)


def faults(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv, seg, pos, initial and fault (b, d, t or empty) of every turn. The first of equal
    turns is an aggregate; it is joined back by place, which no two turns share."""
    space = r"\x20\x09-\x0D"
    blank = ~F.col("text").rlike(f"[^{space}]")
    cut = ~F.col("text").rlike(rf"[.!?][{space}]*\z")
    first = turns.groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("first"))
    seen = turns.select("conv", "pos", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), cut.alias("cut"))
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("")
    return (seen.join(first, ["conv", "pos"], "left")
            .select("conv", F.expr(f"pos div {segment}").alias("seg"), "pos", "initial", fault.alias("fault")))


def _groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with equal keys in sorted input, each held in memory while it is used."""
    held, current = None, None
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        for r, k in enumerate(zip(*(cols[x] for x in key))):
            if k != current:
                if held:
                    yield current, held
                held, current = {n: [] for n in cols}, k
            for n, v in cols.items():
                held[n].append(v[r])
    if held:
        yield current, held


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SEGMENT = pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("turns", pa.string()), *((c, pa.int64()) for c in _COUNTS),
                      ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())),
                      ("audits", pa.list_(pa.string()))])


def segments(marked: DataFrame) -> DataFrame:
    """The parse of every segment from every top (the first: from the bottom alone)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, seg), t in _groups(batches, ("conv", "seg")):
            turns = list(zip(t["initial"], t["fault"]))
            # one character for each turn: what isn't s, u or a can't be kept, whatever it is
            letters = "".join(x if x in ("s", "u", "a") else "-" for x in t["initial"])
            found = [(a, b, *v) for a in (STACKS if seg else [0]) for b, v in parse(turns, a, not seg).items()]
            illegal = sum(x + y not in LEGAL for x, y in zip(letters, letters[1:]))
            yield (conv, seg, letters, *(t["fault"].count(x) for x in "bdt"), illegal, *map(list, zip(*found)))

    return (marked.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos")
            .mapInArrow(lambda batches: batched(rows(batches), _SEGMENT),
                        "conv string, seg long, turns string, blank long, duplicate long, truncated long, illegal long, "
                        "starts array<int>, ends array<int>, costs array<long>, audits array<string>"))


_CHOSEN = pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("start", pa.int32()), ("turns", pa.string()), ("audit", pa.string()),
                     *((c, pa.int64()) for c in _COUNTS), ("cost", pa.int64()), ("whole", pa.string())])


def compose(parsed: DataFrame) -> DataFrame:
    """For each segment the top it starts from and its part of the cheapest audit; the row of the
    first segment also has the conversation's counts, cost and whole audit. Segments come in order; besides
    the best audit to each top only their letters are held."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), t in _groups(batches, ("conv",)):
            best, back = {0: (0, "")}, []
            for k in range(len(t["seg"])):
                after, came = {}, {}
                for a, b, cost, audit in zip(t["starts"][k], t["ends"][k], t["costs"][k], t["audits"][k]):
                    if a not in best:
                        continue
                    new = (best[a][0] + cost, best[a][1] + audit)
                    if b not in after or new < after[b]:
                        after[b], came[b] = new, (a, len(audit))
                best = after
                back.append(came)
                t["audits"][k] = t["costs"][k] = None
            cost, whole = min(best[b] for b in ACCEPT if b in best)
            at = next(b for b in ACCEPT if best.get(b) == (cost, whole))
            parts, end = [], len(whole)
            for came in reversed(back):
                at, size = came[at]
                parts.append((at, whole[end - size:end]))
                end -= size
            counts = [sum(t[c]) for c in _COUNTS]
            counts[-1] += sum(x[-1] + y[0] not in LEGAL for x, y in zip(t["turns"], t["turns"][1:]))
            for k, (start, audit) in enumerate(reversed(parts)):
                totals = (*counts, cost, whole) if k == 0 else (None,) * (len(counts) + 2)
                yield (conv, t["seg"][k], start, t["turns"][k], audit, *totals)

    return (parsed.repartition("conv").sortWithinPartitions("conv", "seg")
            .mapInArrow(lambda batches: batched(rows(batches), _CHOSEN),
                        "conv string, seg long, start int, turns string, audit string, blank long, duplicate long, truncated long, "
                        "illegal long, cost long, whole string"))


_EDIT = pa.schema([("conv", pa.string()), ("pos", pa.int64()), ("k", pa.int64()), ("role", pa.string()), ("own", pa.bool_())])


def edits(chosen: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv, pos, k, role, own of every line that stays (own, at place pos) or is new: k is the
    order of a conversation's lines."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for conv, seg, start, turns, audit in zip(*(batch.column(c).to_pylist() for c in ("conv", "seg", "start", "turns", "audit"))):
                for k, (at, role, own) in enumerate(replay(start, audit, turns)):
                    yield conv, seg * segment + at, seg * _LINES + k, role, own

    return (chosen.select("conv", "seg", "start", "turns", "audit")
            .mapInArrow(lambda batches: batched(rows(batches), _EDIT), "conv string, pos long, k long, role string, own boolean"))


def repaired_lines(turns: DataFrame, chosen: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv, k, role, text of the repaired conversations, k being the lines' order."""
    lines = edits(chosen, segment)
    old = turns.select("conv", "pos", F.col("role").alias("old_role"), "text")
    stay = (lines.where("own").join(old, ["conv", "pos"])
            .select("conv", "k", F.coalesce("role", "old_role").alias("role"), "text"))
    return stay.unionByName(lines.where("NOT own").select("conv", "k", "role", F.lit("").alias("text")))


def digests(lines: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its lines `role:text`, joined by line feeds."""
    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, sha = None, None
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
                if conv != current:
                    if sha is not None:
                        yield current, sha.hexdigest()
                    current, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(role.encode())
                sha.update(b":")
                sha.update(text.encode())
        if sha is not None:
            yield current, sha.hexdigest()

    return (lines.repartition("conv").sortWithinPartitions("conv", "k").select("conv", "role", "text")
            .mapInArrow(lambda batches: batched(rows(batches), schema), "conv string, repaired_sha256 string"))


def solved(rows: DataFrame, segment: int, made: list[str]) -> tuple[DataFrame, DataFrame]:
    """The turns with their places and the chosen edits of `rows` (conv, turn, role, text)."""
    turns = placed(rows, made)
    parsed = staged(segments(faults(turns, segment)), "segments", made)
    return turns, staged(compose(parsed), "chosen", made)


def repair(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, place, role and text of all conversations, repaired: place numbers a
    conversation's turns from 0."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    made: list[str] = []
    rows = conversations.select(conv_key("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                word("role").alias("role"), word("text").alias("text"))
    turns, chosen = solved(rows, segment, made)
    lines = positions(repaired_lines(turns, chosen, segment), ["conv"], ["k"], "lines", made)
    kind = conversations.schema["conv_id"].dataType
    out = staged(lines.select(F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(kind).alias("conv_id"),
                              F.col("pos").alias("place"), "role", "text"), "repaired")
    drop_paths(conversations.sparkSession, made)
    return out


def report(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation of the table: damage it, count its faults, repair it."""
    made: list[str] = []
    turns, chosen = solved(damage(conversations), segment, made)
    gaps = turns.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    totals = chosen.where("seg = 0").select("conv", "blank", "duplicate", "truncated", "illegal", "cost", F.col("whole").alias("audit"))
    ids = conversations.select("conv_id").distinct().withColumn("conv", conv_key("conv_id"))
    out = (ids.join(gaps, "conv", "left").join(totals, "conv", "left")
           .join(digests(repaired_lines(turns, chosen, segment)), "conv", "left"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
