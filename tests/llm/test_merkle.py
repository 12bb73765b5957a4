"""The manifest against a tree built in memory."""
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cellscope.llm import merkle

OTHER = {"tree": "t", "digest": "x", "pos": 1, "group_rows": 2, "path": "p", "note": "n",
         "_part": 0, "sub": 5, "altered": "z"}


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))


def paths(digests):
    """Root and for each leaf its steps [(left, right)]."""
    steps, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for i, k in enumerate(at):
            run = level[k // 3 * 3:k // 3 * 3 + 3]
            steps[i].append(("".join(run[:k % 3]), "".join(run[k % 3 + 1:])))
        level = [h("".join(level[j:j + 3])) for j in range(0, len(level), 3)]
        at = [k // 3 for k in at]
    return level[0], steps


def fold(d, steps):
    for left, right in steps:
        d = h(left + d + right)
    return d


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text"""
    out, tops, groups = [], [], {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops.append(paths([leaf(r) for r in groups[s]]))
    root, upper = paths([t[0] for t in tops])
    for s, (subroot, steps), up in zip(names, tops, upper):
        for r, low in zip(groups[s], steps):
            path = low + up
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            new = leaf((*r[:4], r[4].replace("\n", "") if bad and r[4] is not None else r[4]))
            out.append((r[0], leaf(r), subroot, root, h("".join(a + b for a, b in path)), fold(new, path), fold(new, path) == root))
    return sorted(out, key=str)


def made(spark, rows, extra=True, parts=4):
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.repartition(parts).withColumns({k: F.lit(v) for k, v in OTHER.items()} if extra else {})


def got(df):
    return sorted((tuple(r) for r in merkle.report(df).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [3], [4], [1, 1, 1, 1], [2, 7, 28, 1], [729, 730, 5]])
def test_equals_a_tree_in_memory(spark, words, sizes):
    rng = random.Random(sum(sizes))
    rows, n = [], 0
    for s, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n, f"s{s}", "en", rng.choice([None, 3]), words(3, n) + "\n" + words(2, n)))
            n += 1
    rng.shuffle(rows)
    assert got(made(spark, rows)) == brute(rows)


def test_several_passes_and_sources_in_byte_order(spark):
    rows = [(i, ["é", "z", "Z", "", None][0 if i % 3 else i % 5], None, i, f"t{i % 50}\n") for i in range(2600)]
    assert got(made(spark, rows)) == brute(rows)


def test_odd_rows_and_repeats(spark, odd_rows):
    rows = [(i, s, None, None, t) for i, t in odd_rows for s in ("a", None)] + [(1, "a", "x", 0, "")] * 40
    assert got(made(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert merkle.report(made(spark, [])).count() == 0


def test_change_of_any_field_shows(spark):
    rows = [(i, "a" if i % 2 else "b", "en", 5, f"text {i}") for i in range(30)]
    m = {r["doc_id"]: r for r in merkle.manifest(merkle.leaves(made(spark, rows, False))).collect()}
    for k, other in enumerate((99, "b", "de", 6, "text")):
        changed = list(rows[7])
        changed[k] = other
        steps = [tuple(s.split(".")) for s in m[7]["path"].split(",")]
        assert fold(leaf(rows[7]), steps) == m[7]["root"] != fold(leaf(changed), steps)
