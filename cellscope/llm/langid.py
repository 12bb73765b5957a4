"""Language identification by rank-order profiles of character n-grams.

A language's profile is the ranked list of its most frequent 1- to 3-grams, counted over all
training texts. A document is ranked the same way over its whole text; its distance to a
profile is the sum of out-of-place ranks, with the profile's length for n-grams it lacks.

Counting runs in Arrow batches with one partial count per n-gram and task, then one shuffle of
those partial counts; only the profiles (languages times `size` rows) come to the driver.
Prediction is row by row, without a shuffle.

Defined results: a text that is null or has no letter is `und` with score 0; equal distances go
to the language that sorts first; without any training text every prediction is `und`; rows with
a null doc_id are never learned from; repeated rows get equal predictions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellscope.llm.common import blocks, id_bucket, map_batches, texts

PROFILE_SIZE = 400
#: What makes a text one in a language: a letter by its Unicode category, no number like ½ or Ⅷ.
_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_EDGE = 1     # stands for whatever separates words; no letter has this code


def _codes(text: str) -> np.ndarray:
    """Letters in lower case as code points; whatever stands between words is one _EDGE."""
    flat = _NOT_LETTERS.sub(chr(_EDGE), f" {text.lower()} ")
    return np.frombuffer(flat.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)


def _block_ngrams(block: str) -> np.ndarray:
    c = _codes(block)
    letter = c != _EDGE
    two = (c[:-1] | (c[1:] << 21))[letter[:-1] | letter[1:]]
    three = (c[:-2] | (c[1:-1] << 21) | (c[2:] << 42))[letter[1:-1]]
    return np.concatenate([c[letter], two, three])


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 1- to 3-grams of a text, packed 21 bits a character, and their counts. Word
    edges count as a character at either end of an n-gram."""
    if len(text) <= 1 << 20:
        return np.unique(_block_ngrams(text), return_counts=True)
    keys, counts = zip(*(np.unique(_block_ngrams(b), return_counts=True) for b in blocks(text)))
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def _ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams first, equal counts by n-gram."""
    if len(keys) > 4 * size:      # only counts that can be among the first
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))[:size]]


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of `docs`: one partial count for each task, then a sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                for b in blocks(text):
                    by.setdefault(lang, []).append(b)
            for lang, found in by.items():
                at, part, size = 0, [], 0
                for at, b in enumerate(found):
                    part.append(b)
                    size += len(b)
                    if size >= 1 << 20 or at == len(found) - 1:
                        k, n = np.unique(_block_ngrams(" ".join(part)), return_counts=True)
                        if lang in held:
                            k, inverse = np.unique(np.concatenate([held[lang][0], k]), return_inverse=True)
                            n = np.bincount(inverse, np.concatenate([held[lang][1], n])).astype(np.int64)
                        held[lang] = (k, n)
                        part, size = [], 0
        for lang, (k, n) in held.items():
            for at in range(0, len(k), 50_000):
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(k[at:at + 50_000]),
                                                  "gram": k[at:at + 50_000], "n": n[at:at + 50_000]})

    partial = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(docs: DataFrame, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """For each language of `docs` (text, lang) its `size` most frequent n-grams, in order."""
    ranked = count_ngrams(docs).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), F.col("gram"))))
    out: dict[str, list[tuple[int, int]]] = {}
    for r in ranked.where(F.col("rank") <= size).select("lang", "gram", "rank").collect():
        out.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: [g for _, g in sorted(found)] for lang, found in sorted(out.items())}


class Profiles:
    """Rank tables of all languages over the union of their n-grams."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.langs = sorted(profiles)
        self.size = size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, and 1 minus its distance as a share of the largest distance."""
        if not self.langs or not _LETTER.search(text):
            return "und", 0.0
        found = _ranked(*ngrams(text), self.size)
        at = np.searchsorted(self.grams, found)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == found, at, len(self.grams)) if len(self.grams) else at
        ranks = self.ranks[:, at]
        places = np.abs(ranks - np.arange(len(found)))
        distance = np.where(ranks < 0, self.size, np.minimum(places, self.size)).sum(1)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.size * len(found)))


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE_SIZE) -> DataFrame:
    """doc_id, lang_pred and score for every row of `docs`."""
    sent = docs.sparkSession.sparkContext.broadcast(Profiles(profiles, size))   # languages x size ranks
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        found = [sent.value.predict(x) for x in texts(batch)]
        return {"doc_id": batch.column("doc_id"), "lang_pred": [x[0] for x in found],
                "score": pa.array([x[1] for x in found], pa.float64())}

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")


def train_and_identify(docs: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """Profiles from rows whose id's crc32 mod 3 is not 1, predictions for all rows."""
    bucket = id_bucket(F.col("doc_id"), 3)
    train = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (bucket != 1))
    found = identify(docs, learn_profiles(train, size), size)
    return found.select("doc_id", F.coalesce(id_bucket(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")
