"""Near-dedup against brute force over all pairs."""
import random

import pytest
from pyspark.sql import functions as F

from cellscope.llm import near_dup, shingles


def brute(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(df, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.link(df).collect()}
    assert got == brute(rows)


def edited(text, n, rng):
    w = text.split()
    for k in rng.sample(range(len(w)), n):
        w[k] = f"new{rng.randint(0, 10**9)}"
    return " ".join(w)


def test_groups_chains_and_singles(spark, docs_of, words):
    rng = random.Random(1)
    rows = [(i, words(rng.randint(1, 160), i)) for i in range(200)]
    next_id = 200
    for base in range(0, 40):                       # copies with few to many edits: both sides of the threshold
        for edits in (0, 1, 2, 3, 4, 5):
            text = rows[base][1]
            if len(text.split()) > edits:
                rows.append((next_id, edited(text, edits, rng)))
                next_id += 1
    text = words(150, 999)
    for _ in range(30):                             # a chain: each copy edits the one before
        text = edited(text, 2, rng)
        rows.append((next_id, text))
        next_id += 1
    rows += [(next_id, rows[3][1].upper()), (next_id + 1, "  ".join(rows[4][1].split()) + "\n")]
    rng.shuffle(rows)
    check(docs_of(rows), rows)


def test_large_group_whose_members_differ_pairwise(spark, docs_of, words):
    """Many copies of one text that isn't there itself: some pairs are links, some are not."""
    rng = random.Random(2)
    base = words(120, 5)
    rows = [(1000 - i, edited(base, rng.randint(1, 5), rng)) for i in range(150)]
    check(docs_of(rows), rows)


def test_odd_rows(spark, docs_of, odd_rows):
    df = docs_of(odd_rows, extra={"component_id": F.lit(1), "regs": F.lit("x"), "text_hash": F.lit(2), "a": F.lit(3)})
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["kept"])
                  for r in near_dup.link(df).collect()), key=str)
    by_id = {(n, i): (c, k) for n, i, c, k in got}
    assert len(got) == len(odd_rows)
    assert by_id[(False, 5)] == (5, True) and by_id[(False, 6)] == (5, False)
    assert by_id[(True, 0)] == (None, True)
    assert all(by_id[(False, i)] == (i, True) for i in (1, 2, 3, 4, 7, 8, 9))
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 8, 9]


def test_one_id_with_several_texts(spark, docs_of, words):
    rng = random.Random(8)
    a, b, c, d = (words(90, 700 + k) for k in range(4))
    rows = [(3, b), (5, a), (5, b), (7, edited(a, 1, rng)), (9, c), (9, d), (9, d), (8, edited(c, 1, rng)), (10, ""), (10, edited(d, 1, rng))]
    df = docs_of(rows)
    got = {(r["doc_id"], r["component_id"]) for r in near_dup.link(df).where("n_shingles > 0").collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (8, 8), (9, 8), (10, 8)}      # an id's texts are one document
    left = [(r["doc_id"], r["text"]) for r in near_dup.keep_one(df).collect()]
    want = [(3, b), (5, a), (8, rows[7][1]), (9, d), (10, "")]           # no unique text goes, no copy stays
    assert sorted(left) == sorted(want)


def test_empty_table(spark, docs_of):
    assert near_dup.link(docs_of([])).count() == 0


def test_components_of_a_long_path(spark):
    n = 200
    order = list(range(n))
    random.Random(4).shuffle(order)
    pairs = spark.createDataFrame(list(zip(order, order[1:])) + [(n + 1, n + 2)], "a long, b long")
    got = {r["node"]: r["component"] for r in near_dup.components(pairs).collect()}
    assert got == {**{i: 0 for i in range(n)}, n + 1: n + 1, n + 2: n + 1}


def test_registers_merge_and_estimate():
    import numpy as np

    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 63, 500).astype(np.uint64) for _ in range(2))
    union = shingles.registers(np.concatenate([a, b]))
    assert (union == np.maximum(shingles.registers(a), shingles.registers(b))).all()
    ra, rb = (np.stack([shingles.registers(np.concatenate([a[:k], x]))]) for k, x in ((400, a[400:]), (400, b[400:])))
    j, near = shingles.may_reach(ra, rb, np.array([500.0]), np.array([500.0]), 0.75, 18.0)
    assert abs(j[0] - 400 / 600) < 0.15


@pytest.mark.parametrize("text", ["", "  ", "a", "A b\tc\x0bd", "é É", "x" * 70 + " " + "x" * 71, "a a a a a a a a"])
def test_shingle_counts(text):
    w = text.encode().lower().split()
    n = len({tuple(w[k:k + 5]) for k in range(len(w) - 4)}) if len(w) >= 5 else int(bool(w))
    assert len(shingles.shingle_set(text)) == n


def test_hot_group_of_three_thousand_near_copies(spark, docs_of, words):
    """One large group near the threshold: no link lost, and far fewer links than pairs."""
    rng = random.Random(11)
    base = words(100, 77)
    rows = [(i, edited(base, rng.choice([1, 2, 3, 3, 3, 4, 4]), rng)) for i in range(3000)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.link(docs_of(rows, partitions=6)).collect()}
    # by numpy: sets over a common numbering, overlaps of all pairs as a product of matrices
    import numpy as np
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    seen = {}
    for s in sets:
        for x in s:
            seen[x] = seen.get(x, 0) + 1
    number = {x: k for k, x in enumerate(x for x, n in seen.items() if n > 1)}
    m = np.zeros((len(rows), len(number)), np.float32)
    for i, s in enumerate(sets):
        m[i, [number[x] for x in s if x in number]] = 1
    size = np.array([len(s) for s in sets])
    both = (m @ m.T).round().astype(np.int64)
    near = 100 * both >= 75 * (size[:, None] + size[None] - both)
    np.fill_diagonal(near, True)
    label = np.arange(len(rows))
    while True:
        new = np.where(near, label[None], len(rows)).min(1)
        if (new == label).all():
            break
        label = new
    assert got == {i: (int(size[i]), int(label[i])) for i in range(len(rows))}
    assert 50 < len(set(label.tolist())) < 2950


def test_blocks_return_spanning_links_only(spark):
    import numpy as np
    n = 60
    common = np.arange(100, dtype=np.int64)
    rows = []
    for i in range(n):
        s = np.sort(np.append(common, [1000 + i]))
        rows.append((1, 0, 1, i, i, len(s), 100, bytearray(shingles.registers(s.astype(np.uint64)).tobytes()), common.tolist()))
    df = spark.createDataFrame(rows, "bucket long, band int, blocks int, rid long, c long, n long, m long, regs binary, foreign array<long>")
    links = [tuple(r) for r in near_dup.links_in_blocks(df, (75, 100)).collect()]
    assert len(links) <= n - 1 and len(links) > 0
