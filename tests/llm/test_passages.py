"""Passages of more than 50 words that share no three whole lines, against plain Python."""
import re
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from cellscope.llm import line_dedup, passages


def brute(rows):
    """Words left of each row."""
    places = sorted(((d is not None, d or 0, k, tuple(w[k:k + 51])) for d, t in set(rows) if t is not None
                     for w in [re.findall(r"[^ \t\n\x0b\x0c\r]+", t)] for k in range(len(w) - 50)))
    first, gone = {}, defaultdict(set)
    for named, d, k, window in places:
        if first.setdefault(window, (named, d, k)) != (named, d, k):
            gone[(d if named else None)].update(range(k, k + 51))
    return {(d, t): [w for k, w in enumerate((t or "").split()) if k not in gone[d]] for d, t in rows}


def planted(words):
    p, q, r = words(51, 1), words(70, 2), words(300, 3).split()
    lines = "\n".join(words(20, 50 + k) for k in range(6)).split("\n")
    return [
        (1, f"{words(30, 11)} {p} {words(9, 12)}"),                       # within a line
        (2, f"{words(7, 13)}\n{p}\n{words(8, 14)}"),                      # a line of its own
        (3, p.replace(" ", "\n", 1)),                                     # two lines, whole text
        (4, f"{words(5, 15)} {q}\n{words(3, 16)}"),
        (5, f"{words(6, 17)}\n{words(2, 18)} {q}"),                       # at the end
        (6, " ".join(r)), (7, " ".join(r[100:230]) + " x"), (8, "y " + " ".join(r[40:90]) + " z"),   # 130 and 50 words
        (9, f"{words(4, 19)} {q} {words(5, 20)} {q} {words(6, 21)}"),     # repeated in one text
        (10, "\n".join(lines)), (11, f"a {lines[1]}\n{lines[2]}\n{lines[3]} b"),   # joined at both ends
        (12, q.upper()), (13, "w " * 200), (14, None), (15, ""), (16, f"{words(9, 22)}  {p}"), (16, f"{words(9, 22)}  {p}"),
        (None, f"{p} {words(4, 23)}")]


def test_planted_passages(spark, docs_of, words):
    rows = planted(words)
    df = docs_of(rows, extra={"mark": F.lit(1), "h1": F.lit(2), "start": F.lit(3), "_x": F.lit(4)})
    out = passages.dedup(df)
    assert out.columns == df.columns
    got, want = out.collect(), brute(rows)
    assert sorted((r["doc_id"] or 0, (r["text"] or "").split()) for r in got) == sorted((d or 0, want[d, t]) for d, t in rows)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)
    text = {r["doc_id"]: r["text"] for r in got}
    assert text[2] == rows[1][1].split("\n")[0] + "\n" + rows[1][1].split("\n")[2]
    assert text[8] == rows[7][1] and text[12] == rows[11][1] and text[14] is None and text[15] == ""
    assert passages.dedup(docs_of([])).count() == 0


def test_lines_stage_removes_passages(spark, docs_of, words):
    """No 51-word run is left twice by the stage; three-line windows alone leave most of them."""
    rows = planted(words)

    def repeated(df):
        texts = {(r["doc_id"], r["text"]) for r in df.collect()}
        seen = defaultdict(int)
        for _, t in texts:
            w = (t or "").split()
            for k in range(len(w) - 50):
                seen[tuple(w[k:k + 51])] += 1
        return sum(n > 1 for n in seen.values())

    assert repeated(line_dedup.dedup(docs_of(rows))) > 100
    assert repeated(corpus_pipeline.lines(spark, docs_of(rows), "")) == 0


def test_long_texts(spark, docs_of, odd_rows):
    rows = [(d, t) for d, t in odd_rows] + [(70, odd_rows[3][1].replace("\n", " "))]
    want = brute(rows)
    got = passages.dedup(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "").split()) for r in got) == sorted((d or 0, want[d, t]) for d, t in rows)
