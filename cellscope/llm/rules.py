"""Quality rules: learned decision lists over document statistics.

Statistics of every whole text are computed in Arrow batches. A decision list is learned from
labelled rows by sequential covering: grow a conjunction of thresholds by information gain on
two thirds of the rows, prune its last conditions on the other third, keep it if it is precise
there, remove the rows it covers, repeat. The list comes out as ordered, readable conditions
and as one Spark conditional expression (`F.when(...).when(...).otherwise(True)`).

Fitting takes a bounded sample of labelled rows' statistics (`max_rows`, a few numbers each);
statistics and verdicts cover every document, with no shuffle.

Defined results: a null text has no words (all statistics 0); null ids and repeated rows are
treated as any row, ids being no input of a rule; rows with conflicting labels are not learned
from; without both classes the list is empty and every document passes it.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import SPACE, map_batches, texts
from cellscope.llm.mil_quality import training_ids

SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct_words", "n_stutter", "n_upper", "n_digits", "n_marks")

#: What the learner sees: ratios of the statistics, so that rules hold for short and long texts.
RATIOS = {
    "mean_word": ("word_chars", "n_words"), "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"), "stutter_share": ("n_stutter", "n_words"),
    "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
}
FEATURES = (*RATIOS, "n_words")


def _count(raw: bytes, chars: str) -> int:
    """How many of these ASCII characters the text holds."""
    return len(raw) - len(raw.translate(None, chars.encode()))


def statistics_of(text: str) -> tuple[int, ...]:
    """COUNTS and MORE of one whole text."""
    raw = text.encode()
    words = raw.split()            # of bytes: splits at ASCII white space only
    n = len(words)
    word_chars = len(text) - _count(raw, SPACE)
    repeated = 0
    if n >= WINDOW:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            found = Counter(windows)
            covered = 0            # words before this position are counted already
            for i, w in enumerate(windows):
                if found[w] > 1:
                    repeated += i + WINDOW - max(i, covered)
                    covered = i + WINDOW
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (n, word_chars, _count(raw, SYMBOLS), len(lines) - len(set(lines)), repeated,
            len(lines), len(set(words)), sum(map(eq, words, words[1:])),
            _count(raw, string.ascii_uppercase), _count(raw, string.digits), _count(raw, "!?."))


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, COUNTS and MORE (long) for every row of `docs`."""
    cols = [f for f in docs.schema.fields if f.name in keep]
    names = (*COUNTS, *MORE)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in cols] + [f"{n} long" for n in names])

    def run(batch: pa.RecordBatch) -> dict:
        table = zip(*map(statistics_of, texts(batch)))
        return {**{f.name: batch.column(f.name) for f in cols},
                **{n: pa.array(x, pa.int64()) for n, x in zip(names, table)}}

    return map_batches(docs.select(*keep, "text"), run, schema)


def with_ratios(stats: DataFrame) -> DataFrame:
    return stats.withColumns({k: F.col(a) / F.greatest(F.col(b), F.lit(1)) for k, (a, b) in RATIOS.items()})


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, most: int, cuts: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best = (1e-9, None)
        for k, name in enumerate(FEATURES):
            values = x[inside, k]
            for t in np.unique(np.quantile(values, np.linspace(0, 1, cuts))):
                for above in (True, False):
                    got = values >= t if above else values <= t
                    p1 = (bad[inside] & got).sum()
                    n1 = got.sum() - p1
                    if not p1 or got.all():
                        continue
                    gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                    if gain > best[0]:
                        best = (gain, Condition(name, above, float(t)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The leading part of the rule with the best (p - n) / (p + n) on the pruning rows."""
    def worth(r: Rule) -> float:
        got = _covers(r, x)
        p = (bad & got).sum()
        return (p - (got.sum() - p)) / max(1, got.sum())

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4, precision: float = 0.97,
          least: int = 3, cuts: int = 48, seed: int = 5) -> list[Rule]:
    """Ordered rules that find the bad rows. A rule stays if, on the pruning rows that earlier
    rules left, at least `least` rows are covered and `precision` of them are bad."""
    if not len(x) or bad.all() or not bad.any():
        return []
    order = np.random.default_rng(seed).permutation(len(x))
    cut = len(x) * 2 // 3
    (gx, gb), (px, pb) = ((x[i], bad[i]) for i in (order[:cut], order[cut:]))
    rules: list[Rule] = []
    while len(rules) < max_rules and gb.any():
        rule = _prune(_grow(gx, gb, max_conditions, cuts), px, pb)
        got = _covers(rule, px)
        if not rule or got.sum() < least or (pb & got).sum() < precision * got.sum():
            break
        rules.append(rule)
        keep_g, keep_p = ~_covers(rule, gx), ~got
        gx, gb, px, pb = gx[keep_g], gb[keep_g], px[keep_p], pb[keep_p]
    return rules


def describe(rules: list[Rule]) -> list[str]:
    return ["reject if " + " and ".join(map(str, r)) for r in rules] + ["otherwise keep"]


def verdict(rules: list[Rule]) -> Column:
    """The decision list as a Spark expression over the statistics: true keeps the document."""
    out = None
    for rule in rules:
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    """The fixed rules: fewer than 10 words, or over 20 % of words in repeated windows."""
    return (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, **options) -> list[Rule]:
    """Learn from at most `max_rows` labelled documents (ids bounded, hence broadcast)."""
    ids = training_ids(labels, max_rows)
    sample = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(ids), "doc_id")
    found = with_ratios(statistics(sample, keep=("doc_id", "label", "text_hash"))) \
        .select("doc_id", F.struct("text_hash", "label", *FEATURES, base_failed().alias("base_failed")).alias("row"))
    # of an id with several texts the one with the least hash: the same rules on every run
    got = found.groupBy("doc_id").agg(F.min("row").alias("row")).select("doc_id", "row.*").collect()
    got.sort(key=lambda r: str(r["doc_id"]))
    got = [r for r in got if not r["base_failed"]]     # what the fixed rules reject needs no rule
    x = np.array([[float(r[f]) for f in FEATURES] for r in got]).reshape(len(got), len(FEATURES))
    return learn(x, np.array([r["label"] == 0 for r in got], bool), **options)


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, COUNTS, base_failed and kept for every row of `docs`."""
    return (with_ratios(statistics(docs)).withColumn("base_failed", base_failed())
            .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules)))
            .select("doc_id", *COUNTS, "base_failed", "kept"))


def screen(docs: DataFrame, labels: DataFrame, max_rows: int = 8000) -> DataFrame:
    return apply_rules(docs, fit(docs, labels, max_rows))
