"""Secret scan: pattern spans plus character Markov models.

Two first-order Markov models over the characters of keys and identifiers are trained from
labelled samples: *random* (values that the patterns below mark in the corpus, and seeded random
strings in the usual key alphabets) and *ordinary* (all names of the corpus: tokens of letters, _
and - outside those values). A token of at
least `MIN_TOKEN` characters that no pattern marks becomes a span of kind `markov` if its
log-likelihood ratio reaches `min_llr` in all and `min_rate` for each character, which is
calibrated on random strings that the models haven't seen.

Training counts character pairs over every document: one partial count per task (at most the
square of the alphabet), one small shuffle, a few thousand rows to the driver. Scanning is row by
row. Offsets are code points, ends exclusive.

Defined results: a null text is empty and has no spans; null ids and repeated rows are scanned
like any row; an empty table trains on the seeded strings alone.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import blocks, map_batches, texts

KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = {"assign": 12, "access": 18, "hex": 16}
MIN_TOKEN = 16
#: Fewer different characters are a rule or a filler, not a key.
MIN_DISTINCT = 8

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                     re.IGNORECASE | re.ASCII)
#: One of these stands, in lower case, in every text that _ASSIGN matches.
_ASSIGN_STEMS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")    # maximal runs, so the same as all runs of 16 and more
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

ALPHABET = string.ascii_letters + string.digits + "+/_=-"
_EDGE = len(ALPHABET)
_N = _EDGE + 1
_CODE = np.full(256, _EDGE, np.int64)
_CODE[list(ALPHABET.encode())] = np.arange(_EDGE)

_NOT_NAME = np.isin(np.arange(_N), [ALPHABET.index(c) for c in string.digits + "+/="])

Span = tuple[int, int, int]    # start, index of the kind, end


def base_spans(text: str) -> list[Span]:
    """The spans of the three patterns, by start and kind."""
    out: list[Span] = []
    low = text.lower()
    if any(s in low for s in _ASSIGN_STEMS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_VALUE["access"]]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _pairs(raw: bytes, names_only: bool = False) -> np.ndarray:
    """Counts of neighbouring characters; anything outside the alphabet is the edge. With
    `names_only`, tokens with anything but letters, _ and - don't count."""
    code = _CODE[np.frombuffer(raw, np.uint8)]
    pair = code[:-1] * _N + code[1:]
    if names_only:
        run = np.cumsum(code == _EDGE)                    # every edge starts a token
        mixed = np.zeros(run[-1] + 1 if len(run) else 1, bool)
        mixed[run[_NOT_NAME[code]]] = True
        pair = pair[~mixed[run[:-1]] & ~(mixed[run[1:]] & (code[1:] != _EDGE))]
    return np.bincount(pair, minlength=_N * _N)


def _values(text: str, spans: list[Span]) -> list[str]:
    """The secret part of each span (without an assignment's key)."""
    return [_ASSIGN.match(text, a)[2] if kind == 0 else text[a:b] for a, kind, b in spans]


def seeded_samples(n: int = 600, length: int = 40, seed: int = 11) -> list[str]:
    """Labelled random strings: `n` in each of the usual key alphabets."""
    rng = random.Random(seed)
    kinds = (string.ascii_letters + string.digits + "+/", string.ascii_lowercase + string.digits,
             string.ascii_uppercase + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "-_")
    return ["".join(rng.choices(k, k=length)) for k in kinds for _ in range(n)]


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of every pair of characters, from counts over all rows of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hit = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
        for batch in batches:
            for text in texts(batch):
                for b in blocks(text):
                    total += _pairs(f" {b} ".encode(), names_only=True)
                for value in _values(text, base_spans(text)):
                    hit += _pairs(f" {value} ".encode())
                    total -= _pairs(f" {value} ".encode(), names_only=True)
        k = np.flatnonzero(total + hit)
        yield pa.RecordBatch.from_pydict({"pair": k, "n_all": total[k], "n_hit": hit[k]})

    partial = docs.select("text").mapInArrow(run, "pair long, n_all long, n_hit long")
    got = partial.groupBy("pair").agg(F.sum("n_all").alias("a"), F.sum("n_hit").alias("h")).collect()
    every, rand = np.zeros(_N * _N), _pairs(f" {' '.join(seeded_samples())} ".encode()).astype(float)
    for r in got:
        every[r["pair"]] += r["a"]
        rand[r["pair"]] += r["h"]

    def log_p(counts: np.ndarray) -> np.ndarray:
        c = np.maximum(counts, 0).reshape(_N, _N) + 0.5
        return np.log(c / c.sum(1, keepdims=True))

    return log_p(rand) - log_p(every)


def ratio(token: str, llr: np.ndarray) -> float:
    code = _CODE[np.frombuffer(f" {token} ".encode(), np.uint8)]
    return float(llr[code[:-1], code[1:]].sum())


def find(text: str, llr: np.ndarray, min_llr: float = 16.0, min_rate: float = 0.6) -> list[Span]:
    """All spans: those of the patterns, and tokens that no pattern touches and that look random."""
    spans = base_spans(text)
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if len(set(m[0])) >= MIN_DISTINCT and all(b <= s or e <= a for s, _, e in spans) \
                and (got := ratio(m[0], llr)) >= max(min_llr, min_rate * (b - a)):
            spans.append((a, 3, b))
    return sorted(spans)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, llr: np.ndarray, min_llr: float = 16.0, min_rate: float = 0.6) -> DataFrame:
    """doc_id, counts of each kind and the spans of every row of `docs`, with a digest of the
    pattern spans."""
    sent = docs.sparkSession.sparkContext.broadcast(llr)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        found = [find(x, sent.value, min_llr, min_rate) for x in texts(batch)]
        base = [[s for s in spans if s[1] < 3] for spans in found]
        return {"doc_id": batch.column("doc_id"),
                **{f"n_{k}": pa.array([sum(s[1] == i for s in spans) for spans in found], pa.int64())
                   for i, k in enumerate(KINDS)},
                "base_sha256": [hashlib.sha256(_written(s).encode()).hexdigest() for s in base],
                "spans": [_written(s) for s in found]}

    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_markov long, "
                       "base_sha256 string, spans string")


def calibrated_rate(llr: np.ndarray, share: float = 0.02, least: float = 0.6) -> float:
    """The ratio per character that all but `share` of fresh labelled random strings exceed; it
    rises with the corpus, which makes unseen pairs of ordinary names ever less likely."""
    fresh = seeded_samples(200, 20, seed=12)
    return max(least, float(np.quantile([ratio(x, llr) / len(x) for x in fresh], share)))


def train_and_scan(docs: DataFrame) -> DataFrame:
    llr = train(docs)
    return scan(docs, llr, min_rate=calibrated_rate(llr))
