"""Removal of repeated passages of more than 50 words, wherever their lines begin and end.

Every run of 51 consecutive words (separated by ASCII white space, compared exactly) is a window.
A window that occurs in several places of the corpus stays where it comes first, by doc_id and
position; the words that any later occurrence covers are removed, overlapping windows together
removing their union. So of a passage of 51 or more words no copy is left, on one line, within a
line or over several.

Windows are not hashed one by one: each has a mark, the least hash of the 36 runs of 16 words in
it, and equal windows have equal marks. Neighbouring windows share their mark, so a text has about
one for every 18 words. Only windows whose mark occurs in a second place are hashed whole (128
bits) and compared; this loses nothing.

Marks and windows are reduced by aggregates with partial minima and joined back by joins that
adaptive execution can split, so a passage that a third of all documents hold is not one task's
work. Starts of windows are collected for one document at a time.

Defined results: null and empty texts and texts of fewer than 51 words stay as they are; rows of
the same doc_id and text count as one document; a null doc_id comes before all others. Where words
go, one stretch of white space remains between their neighbours: the one before them if it holds
a line end, else the one after them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm import shingles as S
from cellscope.llm.common import as_rows, drop_paths, map_batches, staged, with_text

WINDOW = 51
RUN = 16
_WORD = re.compile("[^ \t\n\x0b\x0c\r]+")
#: Odd factors of the rolling hashes (5 modulo 8, so that powers differ in all high bits).
_FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _rolling(words: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Hashes of all runs of `size` words, from sums over powers of an odd factor modulo 2^64."""
    powers = lambda f: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(words) - 1, f, np.uint64)]))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(factor))])
    return S._mix((total[size:] - total[:-size]) * powers(pow(factor, -1, 1 << 64))[:len(words) - size + 1])


def marks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run, and for every window the least hash of its runs."""
    runs = _rolling(words, RUN, _FACTORS[0])
    least, span, want = runs, 1, WINDOW - RUN + 1
    while 2 * span <= want:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    return runs, np.minimum(least[:len(runs) - want + 1], least[want - span:])


def _marks_of(docs: DataFrame) -> DataFrame:
    """_id, _hash, mark, twice: every mark of every row once, and whether its run is repeated there."""
    def run(batch: pa.RecordBatch) -> dict:
        ids, hashes, found, twice = [], [], [], []
        for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_hash", "text"))):
            words = S.word_hashes(text, exact=True)
            if len(words) < WINDOW:
                continue
            runs, least = marks(words)
            own, runs = np.unique(least), np.sort(runs)
            found.append(own)
            twice.append(np.searchsorted(runs, own, "right") - np.searchsorted(runs, own) > 1)
            ids += [i] * len(own)
            hashes += [h] * len(own)
        return {"_id": pa.array(ids, pa.int64()), "_hash": pa.array(hashes, pa.int64()),
                "mark": pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)),
                "twice": pa.array(np.concatenate(twice or [np.zeros(0, bool)]))}

    return map_batches(docs, run, "_id long, _hash long, mark long, twice boolean")


def _windows_of(docs: DataFrame) -> DataFrame:
    """_id, _hash, start, h1 and h2 of the windows whose mark is among `marks` of the row."""
    def run(batch: pa.RecordBatch) -> dict:
        ids, hashes, out = [], [], [[np.zeros(0, np.int64)] for _ in range(3)]
        marked = batch.column("marks")
        for k, (i, h, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_id", "_hash", "text")))):
            words = S.word_hashes(text, exact=True)
            at = np.flatnonzero(np.isin(marks(words)[1].view(np.int64), marked[k].values.to_numpy()))
            ids += [i] * len(at)
            hashes += [h] * len(at)
            both = [_rolling(x, WINDOW, f)[at].view(np.int64) for x, f in zip((words, S._mix(words)), _FACTORS)]
            for column, values in zip(out, (at, *both)):
                column.append(values)
        start, h1, h2 = (pa.array(np.concatenate(x)) for x in out)
        return {"_id": pa.array(ids, pa.int64()), "_hash": pa.array(hashes, pa.int64()), "start": start, "h1": h1, "h2": h2}

    return map_batches(docs, run, "_id long, _hash long, start long, h1 long, h2 long")


def without(text: str, starts: np.ndarray) -> str:
    """The text without the words of the windows that begin at `starts`."""
    spans = [m.span() for m in _WORD.finditer(text)]
    gone = np.zeros(len(spans) + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, starts + WINDOW, -1)
    gone = np.concatenate([[False], np.cumsum(gone)[:-1] > 0, [False]])
    begins, ends = np.flatnonzero(~gone[:-1] & gone[1:]), np.flatnonzero(gone[:-1] & ~gone[1:])
    out, at = [], 0
    for a, b in zip(begins.tolist(), ends.tolist()):       # words a to b - 1 go
        left = spans[a - 1][1] if a else 0
        right = spans[b][0] if b < len(spans) else len(text)
        before, after = text[left:spans[a][0]], text[spans[b - 1][1]:right]
        out += [text[at:left], before if "\n" in before else after]
        at = right
    return "".join(out) + text[at:]


def _rests(docs: DataFrame) -> DataFrame:
    """_id, _hash, _rest: the text that is left of each row with its `starts`."""
    def run(batch: pa.RecordBatch) -> dict:
        starts = batch.column("starts")
        rest = [without(t, starts[k].values.to_numpy()) for k, t in enumerate(batch.column("text").to_pylist())]
        return {"_id": batch.column("_id"), "_hash": batch.column("_hash"), "_rest": pa.array(rest, pa.string())}

    return map_batches(docs, run, "_id long, _hash long, _rest string")


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}_id").eqNullSafe(F.col(f"{right}_id")) & (F.col(f"{left}_hash") == F.col(f"{right}_hash"))


def dedup(docs: DataFrame) -> DataFrame:
    """`docs` (all columns) with `text` rid of later occurrences of passages and `n_chars`, if
    there, brought up to date for the rows that changed. `docs` is read several times."""
    spark, made = docs.sparkSession, []
    own = [F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash")]
    texts = docs.where("text IS NOT NULL").select(*own, "text")
    place = F.struct("_id", "_hash")

    rows = staged(_marks_of(texts), "marks", made)
    repeated = staged(rows.groupBy("mark").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("twice").alias("twice"))
                      .where("twice OR NOT (lo <=> hi)").select(F.col("mark").alias("m")), "repeated", made)
    found = staged(rows.join(repeated, F.col("mark") == F.col("m"))
                   .groupBy(F.col("_id").alias("m_id"), F.col("_hash").alias("m_hash"))
                   .agg(F.collect_set("mark").alias("marks")), "marked", made)
    windows = staged(_windows_of(texts.join(found, _same("", "m")).select("_id", "_hash", "text", "marks")), "windows", made)
    place = F.struct("_id", "_hash", "start")
    firsts = staged(windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                    .where("NOT (first <=> last)").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first"), "firsts", made)
    later = (windows.join(firsts, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
             .where(~F.col("first").eqNullSafe(place))
             .groupBy(F.col("_id").alias("l_id"), F.col("_hash").alias("l_hash")).agg(F.collect_set("start").alias("starts")))
    # one text for each document that changes, however often its row is repeated
    rests = staged(_rests(texts.join(staged(later, "later", made), _same("", "l")).select("_id", "_hash", "text", "starts"))
                   .dropDuplicates(["_id", "_hash"])
                   .select(F.col("_id").alias("r_id"), F.col("_hash").alias("r_hash"), "_rest"), "rests")
    drop_paths(spark, made)

    out = as_rows(docs).select("_row", "text", *own).join(rests, _same("", "r"), "left")
    return with_text(out, docs, F.coalesce("_rest", "text"), F.col("_rest").isNotNull())
