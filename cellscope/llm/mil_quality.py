"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage of the whole text is encoded as a
feature vector (byte-class bigrams, hashed words, repetition), a learned layer embeds it, gated
attention (tanh branch times sigmoid branch) gives it a weight, and the weighted sum of the
passage embeddings is scored by a logistic unit. All weights are learned from document labels
alone; no passage is ever labelled.

Fitting takes a bounded sample of labelled documents (`max_docs`, and evenly spaced passages of
documents with more than `max_passages`); scoring reads every passage of every text in Arrow
batches (very long texts in blocks, at which passages start anew) and needs no shuffle.

Defined results: null and empty texts are one all-zero passage and get a score like any other;
rows with a null doc_id are scored and never learned from; repeated rows get equal scores; a
document with conflicting or null labels is not learned from; without both classes in the
sample every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import blocks, id_bucket, map_batches, texts

PASSAGE_WORDS = 64
N_WORD_BUCKETS = 64


def _byte_classes() -> np.ndarray:
    cls = np.zeros(256, np.int64)
    groups = [b" \t\x0b\x0c\r", b"\n", b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"AEIOU", b"BCDFGHJKLMNPQRSTVWXYZ",
              b"0123456789", b".,;:", b"!?", b"#*$%&|<>", b"'\"()-"]
    cls[:] = len(groups)           # other ASCII and control bytes
    cls[128:] = len(groups) + 1    # parts of non-ASCII characters
    for k, chars in enumerate(groups):
        cls[list(chars)] = k
    return cls


_CLASS = _byte_classes()
_N_CLASS = int(_CLASS.max()) + 1
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_POWERS = np.cumprod(np.full(64, 0x01000193, np.uint32), dtype=np.uint32)
N_FEATURES = _N_CLASS * _N_CLASS + N_WORD_BUCKETS + 4


def _encode_block(block: str) -> np.ndarray | None:
    raw = np.frombuffer(block.encode(), np.uint8)
    word = ~_IS_SPACE[raw]
    if not word.any():
        return None
    starts = np.flatnonzero(word & np.concatenate(([True], ~word[:-1])))
    n = len(starts)
    p = -(-n // PASSAGE_WORDS)
    # word hashes: polynomial over the bytes of a word, white space counts as zero
    of_byte = np.maximum(np.cumsum(np.bincount(starts, minlength=len(raw))) - 1, 0)
    pos = np.arange(len(raw)) - starts[of_byte]
    hashed = np.add.reduceat(np.where(word, raw, 0).astype(np.uint32) * _POWERS[np.abs(pos) % 64], starts,
                             dtype=np.uint32)
    passage_of_word = np.arange(n) // PASSAGE_WORDS
    passage = passage_of_word[of_byte]
    cls = _CLASS[raw]
    k = _N_CLASS * _N_CLASS
    bigrams = np.bincount(passage[:-1] * k + cls[:-1] * _N_CLASS + cls[1:], minlength=p * k).reshape(p, k)
    bucket = ((hashed * np.uint32(2654435761)) >> np.uint32(26)).astype(np.int64)
    words = np.bincount(passage_of_word * N_WORD_BUCKETS + bucket, minlength=p * N_WORD_BUCKETS).reshape(p, -1)
    count = np.bincount(passage_of_word, minlength=p).astype(np.float64)
    size = np.maximum(1, bigrams.sum(1))
    keys = np.unique((passage_of_word.astype(np.uint64) << np.uint64(32)) | hashed)
    distinct = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=p)
    same = np.bincount(passage_of_word[1:][hashed[1:] == hashed[:-1]], minlength=p)
    return np.hstack([
        np.sqrt(bigrams / size[:, None]), np.sqrt(words / count[:, None]),
        np.stack([distinct / count, same / count, np.log1p(size / count), np.log1p(count)], 1),
    ]).astype(np.float32)


def encode(text: str) -> np.ndarray:
    """One row of N_FEATURES for each passage of the whole text; a text without words has one
    row of zeros."""
    parts = [x for x in map(_encode_block, blocks(text)) if x is not None]
    return np.vstack(parts) if parts else np.zeros((1, N_FEATURES), np.float32)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class MilModel:
    """Gated-attention bag classifier. `params` is None for the constant model."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    params: dict | None = None

    def forward(self, x: np.ndarray, first: np.ndarray):
        """x: standardised passages of all bags; first: row where each bag starts."""
        q = self.params
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        h = np.tanh(x @ q["W"] + q["b"])
        t, s = np.tanh(h @ q["V"]), _sigmoid(h @ q["U"])
        e = (t * s) @ q["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        return bag, h, t, s, a, z, _sigmoid(z @ q["c"] + q["d"])

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.params is None:
            return np.full(len(bags), self.prior)
        first = np.concatenate(([0], np.cumsum([len(x) for x in bags])[:-1]))
        return self.forward((np.vstack(bags) - self.mean) / self.scale, first)[-1].astype(np.float64)


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, epochs: int = 16,
             batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> MilModel:
    """Adam on the mean log loss of the bags."""
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return MilModel(float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    rows = np.vstack(bags)
    model = MilModel(float(labels.mean()), rows.mean(0), rows.std(0) + 0.01)
    bags = [(x - model.mean) / model.scale for x in bags]
    d, k = N_FEATURES, hidden
    shapes = {"W": (d, k), "b": (k,), "V": (k, k), "U": (k, k), "w": (k,), "c": (k,), "d": ()}
    q = {n: (rng.normal(0, 1 / np.sqrt(s[0]), s) if s and n != "b" else np.zeros(s)).astype(np.float32)
         for n, s in shapes.items()}
    model.params = q
    m, v = ({n: np.zeros_like(x) for n, x in q.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            x = np.vstack([bags[i] for i in pick])
            first = np.concatenate(([0], np.cumsum([len(bags[i]) for i in pick])[:-1]))
            bag, h, t, s, a, z, p = model.forward(x, first)
            dl = (p - labels[pick]) / len(pick)
            dz = (dl[:, None] * q["c"])[bag]
            da = (h * dz).sum(1)
            de = a * (da - np.add.reduceat(a * da, first)[bag])
            dg = de[:, None] * q["w"]
            dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
            dh = a[:, None] * dz + dt @ q["V"].T + ds @ q["U"].T
            dx = dh * (1 - h * h)
            grad = {"W": x.T @ dx, "b": dx.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de,
                    "c": z.T @ dl, "d": dl.sum()}
            step += 1
            for n, g in grad.items():
                g = g + decay * q[n]
                m[n] = 0.9 * m[n] + 0.1 * g
                v[n] = 0.999 * v[n] + 0.001 * g * g
                q[n] = (q[n] - rate * (m[n] / (1 - 0.9 ** step))
                        / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def training_ids(labels: DataFrame, max_docs: int, held_out_mod: int = 5) -> DataFrame:
    """At most `max_docs` labelled ids outside the held-out fold, half of each class where both
    have enough, picked by a hash of the id: (doc_id, label)."""
    clean = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .where(id_bucket(F.col("doc_id"), held_out_mod) != 0)
             .groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
             .where("lo = hi").select("doc_id", F.col("lo").cast("int").alias("label")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    half = max_docs // 2
    return (clean.where("label = 0").orderBy(*order).limit(half)
            .unionByName(clean.where("label = 1").orderBy(*order).limit(max_docs - half)))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 4000, max_passages: int = 64,
        **options) -> MilModel:
    """Learn from at most `max_docs` labelled rows of `docs`. The sample of ids is bounded, so it
    is broadcast; its passages (at most `max_docs * max_passages` rows) come to the driver."""
    ids = training_ids(labels, max_docs)

    def passages(batch: pa.RecordBatch) -> dict:
        out = []
        for x in texts(batch):
            bag = encode(x)
            if len(bag) > max_passages:
                bag = bag[np.linspace(0, len(bag) - 1, max_passages).astype(int)]
            out.append(bag.tobytes())
        return {**{c: batch.column(c) for c in ("doc_id", "label", "text_hash")}, "bag": pa.array(out, pa.binary())}

    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id") \
        .select("doc_id", "label", F.xxhash64("text").alias("text_hash"), "text")
    kind = sample.schema["doc_id"].dataType.simpleString()
    # of an id with several texts the one with the least hash: the same model on every run
    got = (map_batches(sample, passages, f"doc_id {kind}, label int, text_hash long, bag binary")
           .groupBy("doc_id").agg(F.min(F.struct("text_hash", "label", "bag")).alias("m")).select("doc_id", "m.label", "m.bag").collect())
    got.sort(key=lambda r: str(r["doc_id"]))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, N_FEATURES) for r in got]
    return fit_bags(bags, np.array([r["label"] for r in got]), **options)


def score(docs: DataFrame, model: MilModel, keep: tuple[str, ...] = ("doc_id",), into: str = "score") -> DataFrame:
    """`keep` columns and the score (0 to 1) in column `into`, for every row of `docs`."""
    cols = [f for f in docs.schema.fields if f.name in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in cols] + [f"`{into}` double"])
    sent = docs.sparkSession.sparkContext.broadcast(model)   # a few thousand weights

    def run(batch: pa.RecordBatch) -> dict:
        found = texts(batch)
        scores = []
        for at in range(0, len(found), 32):
            scores.append(sent.value.score([encode(x) for x in found[at:at + 32]]))
        return {**{f.name: batch.column(f.name) for f in cols}, into: pa.array(np.concatenate(scores))}

    return map_batches(docs.select(*[f.name for f in cols], *[c for c in ["text"] if c not in keep]), run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_docs: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold) for every row of `docs`."""
    scored = score(docs, fit(docs, labels, max_docs=max_docs))
    return scored.select("doc_id", F.coalesce(id_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_docs: int = 4000) -> DataFrame:
    """The rows of `docs` (all columns) that the classifier accepts."""
    into = "score"
    while into in docs.columns:
        into += "_"
    scored = score(docs, fit(docs, labels, max_docs=max_docs), keep=tuple(docs.columns), into=into)
    return scored.where(F.col(into) >= threshold).select(*docs.columns)
