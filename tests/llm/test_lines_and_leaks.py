"""Line dedup and decontamination against plain Python versions."""
import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellscope.llm import decontam, line_dedup

SPACE = " \t\n\x0b\x0c\r"


def brute_lines(rows):
    """Text left of each row, and how many lines went."""
    places = []
    for r, (doc, text) in enumerate(rows):
        solid = [(p, x.strip(SPACE)) for p, x in enumerate((text or "").split("\n")) if x.strip(SPACE)]
        for k in range(len(solid) - 2):
            places.append((doc is not None, doc or 0, text, k, r, solid[k:k + 3]))
    first, gone = {}, defaultdict(set)
    for named, doc, text, k, r, lines in sorted(places, key=lambda x: x[:2] + (x[3],)):
        key = tuple(x for _, x in lines)
        if first.setdefault(key, (doc, text, k)) != (doc, text, k):
            gone[r].update(p for p, _ in lines)
    out = []
    for r, (doc, text) in enumerate(rows):
        lines = (text or "").split("\n")
        left = "\n".join(x for p, x in enumerate(lines) if p not in gone[r]) if gone[r] else text
        out.append((doc, left, len(gone[r])))
    return out


def line_rows(words):
    rng = random.Random(7)
    lines = [words(rng.randint(3, 9), i) for i in range(60)]
    rows = [(i, "\n".join(rng.choice(lines[:30] if rng.random() < 0.7 else lines + ["", "  "]) for _ in range(rng.randint(0, 25))))
            for i in range(60)]
    block = "\n".join(lines[40:46])
    return rows + [(100 + i, f"{words(5, 500 + i)}\n\n{block} \t\n{words(5, 900 + i)}") for i in range(60)] + [
        (300, "a\na\na\na\na"), (301, "a\nb"), (302, "x\ny\nz\nx\ny\nz\n")]


def test_line_dedup_matches_brute_force(spark, docs_of, words):
    rows = line_rows(words)
    random.Random(1).shuffle(rows)
    want = {d: (t, n) for d, t, n in brute_lines(rows)}
    df = docs_of(rows, extra={"h": F.lit(1), "first": F.lit(2), "l": F.lit(3)})
    out = line_dedup.dedup(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {d: t for d, (t, _) in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
    for r in line_dedup.report(df).collect():
        text, n = want[r["doc_id"]]
        assert (r["n_removed"], r["text_md5"]) == (n, hashlib.md5(text.encode()).hexdigest())


def test_line_dedup_odd_rows(spark, docs_of, odd_rows):
    got = [(r["doc_id"], r["text"]) for r in line_dedup.dedup(docs_of(odd_rows)).collect()]
    rest = {5: "", 6: ""}            # the row without an id comes first and keeps the lines
    want = [(d, rest.get(d, t)) for d, t in odd_rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.report(docs_of([])).count() == 0


def brute_leaks(rows, items):
    word = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for item, text in set(items):
        b = word(text)
        for doc, t in rows:
            w = word(t)
            for j in range(len(b) - decontam.SPAN + 1):
                start = max(0, min(j - j % decontam.STEP, len(b) - decontam.BLOCK))
                size = min(decontam.BLOCK, len(b) - start)
                for i in range(len(w) - decontam.SPAN + 1):
                    if any(all(w[i + k] == b[j + k] for k, x in enumerate(m) if x == "1") for m in decontam.MASKS):
                        s = i - j + start
                        same = sum(0 <= s + k < len(w) and w[s + k] == b[start + k] for k in range(size))
                        if same * decontam.MIN_SHARE[1] >= size * decontam.MIN_SHARE[0]:
                            out[doc, item] = max(same, out.get((doc, item), 0))
    return out


@pytest.fixture
def leak_case(words):
    rng = random.Random(11)
    items = [(i, words(rng.randint(12, 45), 5000 + i)) for i in range(8)] + [(90, "too short"), (91, None), (92, ""), (0, words(12, 1))]
    rows = [(i, words(rng.randint(5, 60), i)) for i in range(30)]
    for i in range(40):
        w = items[i % 8][1].split()
        for k in rng.sample(range(len(w)), rng.randint(0, len(w) // 4)):
            w[k] = "other"
        if i % 5 == 4:
            w = w[rng.randint(0, 8):]
        rows.append((100 + i, f"{words(8, 70 + i)}. {' '.join(w).upper()}, {words(4, 90 + i)}"))
    return rows, items


@pytest.mark.parametrize("limit", [10_000, 0])       # broadcast and shuffled join
def test_leaks_match_brute_force(spark, docs_of, leak_case, limit):
    rows, items = leak_case
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string").withColumn("w", F.lit(1))
    df = docs_of(rows, extra={"w": F.lit(1), "seed": F.lit(2), "item_id": F.lit(3)})
    want = brute_leaks(rows, items)
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontam.leaks(df, bench, broadcast_rows=limit).collect()}
    assert got == want and len(want) >= 25
    left = decontam.clean(df, bench, broadcast_rows=limit)
    assert left.columns == df.columns
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_leaks_odd_rows(spark, docs_of, odd_rows, words):
    bench = spark.createDataFrame([(1, words(30, 1001)), (2, None), (None, words(30, 1002))], "item_id long, text string")
    rows = odd_rows + [(None, words(30, 1001)), (77, words(30, 1001)), (77, words(30, 1001))]
    got = decontam.leaks(docs_of(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(4, 1), (None, 1), (77, 1)}
    assert decontam.clean(docs_of(rows), bench).count() == len(rows) - 4
    assert decontam.leaks(docs_of([]), bench).count() == 0
    assert decontam.leaks(docs_of(rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [10_000, 0])
def test_short_items_are_found_word_for_word(spark, docs_of, words, limit):
    bench = spark.createDataFrame([(1, "Who wrote Faust, part two?"), (2, "qqq"), (3, words(30, 1)), (4, "a b c d e f g h i"),
                                   (5, "...")], "item_id long, text string")
    rows = [(1, f"{words(20, 2)}. Who wrote FAUST part two {words(9, 3)}"), (2, "who wrote faust part two"),
            (3, f"who wrote faust part one {words(12, 4)}"), (4, "x qqq"), (5, words(30, 1) + " a b c d e f g h i"),
            (6, "a b c d e f g h"), (7, ""), (8, None), (9, "wrote faust part two who")]
    got = {(r["doc_id"], r["item_id"], r["matched"]) for r in decontam.leaks(docs_of(rows), bench, broadcast_rows=limit).collect()}
    assert got == {(1, 1, 5), (2, 1, 5), (4, 2, 1), (5, 3, 20), (5, 4, 9)}
    assert {r["doc_id"] for r in decontam.clean(docs_of(rows), bench, broadcast_rows=limit).collect()} == {3, 6, 7, 8, 9}


def test_no_python_in_the_plan(spark, docs_of, words):
    bench = spark.createDataFrame([(1, words(30, 1))], "item_id long, text string")
    plan = decontam.clean(docs_of([(1, words(40, 1))]), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
