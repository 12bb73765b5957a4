"""Merkle manifest of a dataset by time-forward processing.

A document's leaf is the digest of its fields. The leaves of a source, in ascending order of doc_id, are
hashed three at a time, level by level, into the source's subroot; the subroots, in the order of
their sources, likewise into the root. The manifest gives every document its leaf, its subroot, the
root and the path of siblings that leads from one to the other.

Time-forward processing treats a tree as a circuit whose nodes are labelled in an order in which
children come before parents, (level, index) here. Nodes are evaluated by ascending label; a
result is sent to the parent as a message into a priority queue ordered by label, from which the
parent takes its inputs when its turn comes. The reversed sweep takes labels in descending order:
a node that knows the path above it sends each child that path, preceded by the child's siblings.

The queue is external: a tree is cut into subtrees of six levels (729 inputs). Messages inside one
subtree wait in the task's heap, those between subtrees in Spark's sorted shuffle, which delivers
them ordered by (tree, subtree, position) and spills to disk. A pass up turns 729 units into one, so
three passes serve 10^8 documents of one source; no task holds more than one subtree, whatever a source's
share of the rows. Every pass is a table in the shared folder, so a lost executor repeats tasks of one pass.

Fields are hashed in the JVM; after that only digests (64 characters a document) move.

Defined results: null fields are hashed as `-`, empty texts as `0:`. Null doc_ids come first in
their source; equal doc_ids are ordered by leaf, so repeated rows have equal leaves side by side and each
its own path. The null source comes first. A text of any length is hashed whole. An empty table gives no rows (it has no
root). Columns besides the five have no influence, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import batched, drop_paths, staged
from cellscope.llm.ordering import positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
#: Levels of a subtree that one task evaluates at a time.
LEVELS = 6


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields, each `-` if null, else its bytes' count, a colon and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
             for x in (c.cast("string") for c in fields)]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs: DataFrame, altered_text: Column | None = None) -> DataFrame:
    """tree (its source, made non-null in the same order), doc_id, digest, and `altered`: the
    digest with `altered_text` in place of the text, where that differs."""
    fields = [F.col(c) for c in FIELDS]
    digest = leaf(fields)
    altered = F.lit(None).cast("string")
    if altered_text is not None:
        altered = F.when(~altered_text.eqNullSafe(F.col("text")), leaf([*fields[:-1], altered_text]))
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"),
                       altered.alias("altered"))


def height(units: int, most: int = LEVELS) -> int:
    """Levels until one node remains, `most` at most."""
    k = 0
    while k < most and units > 1:
        units = -(-units // FANOUT)
        k += 1
    return k


def sweep_up(digests: list[str], levels: int) -> dict[tuple[int, int], list[str]]:
    """Evaluate a subtree by ascending label: what arrived at each node. The top's value is under
    (levels, 0), as its only input if there are no levels, else hashed from its children."""
    inputs: dict[tuple[int, int], list[str]] = {}
    queue = [((0, i), 0, d) for i, d in enumerate(digests)]
    heapq.heapify(queue)
    while queue:
        label = queue[0][0]
        got = []
        while queue and queue[0][0] == label:
            got.append(heapq.heappop(queue)[2])
        inputs[label] = got
        level, i = label
        if level < levels:
            value = got[0] if level == 0 else _sha("".join(got))
            heapq.heappush(queue, ((level + 1, i // FANOUT), i % FANOUT, value))
    return inputs


def top_value(inputs: dict[tuple[int, int], list[str]], levels: int) -> str:
    got = inputs[(levels, 0)]
    return got[0] if levels == 0 else _sha("".join(got))


def sweep_down(inputs: dict[tuple[int, int], list[str]], levels: int, path: str, units: int) -> list[str]:
    """The path of every unit by descending label. A path is its levels from below, joined by
    commas, each the digests left of the node, a dot and those right of it."""
    out = [""] * units
    queue = [((-levels, 0), path)]
    while queue:
        (level, i), above = heapq.heappop(queue)
        level, i = -level, -i
        if level == 0:
            out[i] = above
            continue
        got = inputs[(level, i)]
        for k in range(len(got)):
            step = f"{''.join(got[:k])}.{''.join(got[k + 1:])}"
            heapq.heappush(queue, ((1 - level, -(FANOUT * i + k)), f"{step},{above}" if above else step))
    return out


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The rows of one subtree after the other, from rows sorted by tree and subtree."""
    held, current = None, None
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        for r, key in enumerate(zip(cols["tree"], cols["sub"])):
            if key != current:
                if held:
                    yield held
                held, current = {n: [] for n in cols}, key
            for n, v in cols.items():
                held[n].append(v[r])
    if held:
        yield held


def _dealt(units: DataFrame) -> DataFrame:
    return units.withColumn("sub", F.expr(f"pos div {FANOUT ** LEVELS}"))


def pass_up(units: DataFrame) -> DataFrame:
    """One unit for each subtree of `units`: tree, pos, group_rows, digest."""
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("group_rows", pa.int64()), ("digest", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for t in _subtrees(batches):
            n = t["group_rows"][0]
            levels = height(n)
            yield t["tree"][0], t["sub"][0], -(-n // FANOUT ** LEVELS), top_value(sweep_up(t["digest"], levels), levels)

    return (_dealt(units.select("tree", "pos", "group_rows", "digest")).repartition("tree", "sub")
            .sortWithinPartitions("tree", "sub", "pos")
            .mapInArrow(lambda batches: batched(rows(batches), schema), "tree string, pos long, group_rows long, digest string"))


def pass_down(units: DataFrame, messages: DataFrame) -> DataFrame:
    """`units` (their columns, plus path and note) from `messages` (tree, pos, path, note) to the
    tops of their subtrees. A subtree's message is sorted before its units."""
    mail = messages.select("tree", F.col("pos").alias("sub"), F.lit(-1).cast("long").alias("pos"), "path", "note")
    both = _dealt(units).unionByName(mail, allowMissingColumns=True)
    names = units.columns
    kinds = {f.name: f.dataType.simpleString() for f in units.schema.fields} | {"path": "string", "note": "string"}
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in kinds.items()])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for t in _subtrees(batches):
            levels = height(t["group_rows"][1])
            units = list(zip(*(t[c][1:] for c in names)))
            paths = sweep_down(sweep_up(t["digest"][1:], levels), levels, t["path"][0], len(units))
            for unit, path in zip(units, paths):
                yield (*unit, path, t["note"][0])

    return (both.repartition("tree", "sub").sortWithinPartitions("tree", "sub", "pos")
            .mapInArrow(lambda batches: batched(rows(batches), schema), ", ".join(f"{n} {k}" for n, k in kinds.items())))


def _climb(units: DataFrame, name: str, made: list[str]) -> list[DataFrame]:
    """`units` and, after each pass up, what is left, until every tree is one unit."""
    levels = [units]
    while (levels[-1].agg(F.max("group_rows")).first()[0] or 0) > 1:
        levels.append(staged(pass_up(levels[-1]), f"{name}-up", made))
    return levels


def manifest(found: DataFrame) -> DataFrame:
    """doc_id, leaf, altered (as given), subroot, root and path of every row of `leaves`."""
    made: list[str] = []
    units = staged(positions(found, ["tree"], ["doc_id", "digest"], "leaves", made), "leaf-units", made)
    levels = _climb(units, "source", made)
    tops = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    tops = staged(positions(tops, ["tree"], ["source_tree"], "subroots", made), "subroot-units", made)
    upper = _climb(tops, "root", made)

    # down again: the root's path is empty; notes carry the root, then subroot and root
    mail = upper[-1].select("tree", "pos", F.lit("").alias("path"), F.col("digest").alias("note"))
    if len(upper) == 1:     # one source or none: its subroot is the root
        mail = upper[0].select(F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("pos"), F.lit("").alias("path"),
                               F.concat("digest", F.lit(" "), "digest").alias("note"))
    else:
        for below in reversed(upper[:-1]):
            mail = staged(pass_down(below, mail), "root-down", made)
        mail = mail.select(F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("pos"), "path",
                           F.concat("digest", F.lit(" "), "note").alias("note"))
    if len(levels) == 1:    # every source has one leaf
        down = units.join(mail.select("tree", "path", "note"), "tree")
    else:
        for below in reversed(levels[:-1]):
            down = staged(pass_down(below, mail), "source-down", made if below is not units else [])
            mail = down.select("tree", "pos", "path", "note")
    down = down.select("doc_id", F.col("digest").alias("leaf"), "altered", F.substring_index("note", " ", 1).alias("subroot"),
                       F.substring_index("note", " ", -1).alias("root"), "path")
    if len(levels) > 1:
        drop_paths(found.sparkSession, made)
    return down


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    step = lambda d, s: F.sha2(F.concat(F.substring_index(s, ".", 1), d, F.substring_index(s, ".", -1)).cast("binary"), 256)
    return F.when(path == "", digest).otherwise(F.aggregate(F.split(path, ","), digest, step))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings from the leaf upwards, left to right."""
    return F.sha2(F.translate(path, ".,", "").cast("binary"), 256)


def report(docs: DataFrame) -> DataFrame:
    """Manifest of `docs`, checked against a copy in which the texts of half the documents (those whose
    doc_id, in decimal, has an even crc32) lost their line feeds."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(even, F.translate(F.col("text"), "\n", "")).otherwise(F.col("text"))
    m = manifest(leaves(docs, text)).withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("path")))
    return m.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))
