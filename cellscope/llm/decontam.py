"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations alone.

Texts become arrays of hashed words (runs of letters and digits, in lower case). Fixed masks over
windows of words ignore some positions, so a window still matches after a substitution there; the
hashes of the words under a mask are joined between benchmark and documents. Around every hit a
block of `BLOCK` aligned words is compared position by position: the document holds the item if
at least `MIN_SHARE` of the block agrees.

A document's windows are generated, hashed and probed inside one code-generated stage. The
benchmark's seed table is counted first: up to `broadcast_rows` rows it is broadcast, beyond that
the same join runs as a shuffled one over hashes alone. Only hits leave the stage; they are
reduced per document and item with partial aggregates, so a passage that a third of all documents hold is no group of
its own anywhere.

Items of fewer words than a mask spans have one seed over all their words, so they are found word
for word; documents get windows of such lengths only if the benchmark has them.

Defined results: null and empty texts match nothing; repeated rows and rows with a null doc_id are
matched like any (a null id appears as such in the matches); repeated benchmark rows count once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import as_rows, from_rows, staged

#: Positions with 1 are hashed, positions with 0 are ignored.
MASKS = ("1101011001", "1010110011", "1100101101")
SPAN = max(map(len, MASKS))
#: Words compared around a hit, and the grid on which such blocks start in an item.
BLOCK = 20
STEP = 10
MIN_SHARE = (3, 4)
WORD = r"[\p{L}\p{N}]+"


def word_hashes(text: str) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _seed(words: str, at: Column, number: int, mask: str) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(words, at + k) for k, bit in enumerate(mask) if bit == "1"])


def _masks(lengths: list[int]) -> list[tuple[int, str]]:
    """Number and positions of the masks; whole items of so many words have negative numbers."""
    return [*enumerate(MASKS), *((-n, "1" * n) for n in lengths)]


def seeds(text_rows: DataFrame, keep: list[str], lengths: list[int] = []) -> DataFrame:  # noqa: B006
    """`keep`, w (hashed words), at (first word of the window) and seed for every window and mask,
    and for every window of one of the `lengths`."""
    n, masks = F.size("w"), _masks(lengths)
    if lengths:
        every = lambda i, m: F.transform(F.sequence(F.lit(0), n - len(m)), lambda x: x * len(masks) + i)
        runs = [F.when(n >= len(m), every(i, m)) for i, (_, m) in enumerate(masks)]
        each = F.flatten(F.array_compact(F.array(*runs)))
    else:
        each = F.when(n >= SPAN, F.sequence(F.lit(0), (n - SPAN + 1) * len(MASKS) - 1))
    at = F.expr(f"k div {len(masks)}").cast("int")
    mask = F.col("k") % len(masks)
    value = reduce(lambda rest, m: F.when(mask == m, _seed("w", at, *masks[m])).otherwise(rest),
                   range(len(masks) - 1), _seed("w", at, *masks[-1]))
    return (text_rows.select(*keep, word_hashes("text").alias("w"))
            .select(*keep, "w", F.explode(each).alias("k"))
            .select(*keep, "w", at.alias("at"), value.alias("seed")))


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """item_id, b_seed, b_at and the block of aligned words that holds the window: b_from (its
    first word in the item, a multiple of STEP or as far as the item goes) and b_words."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct()
    first = F.greatest(F.lit(0), F.least(F.col("at") - F.col("at") % STEP, F.size("w") - BLOCK))
    whole = reduce(lambda rest, n: F.when(F.size("w") == n, _seed("w", F.lit(0), -n, "1" * n)).otherwise(rest),
                   range(1, SPAN), F.lit(None).cast("long"))
    short = (items.select("item_id", word_hashes("text").alias("w")).where(F.size("w").between(1, SPAN - 1))
             .select("item_id", "w", F.lit(0).alias("at"), whole.alias("seed")))
    return (seeds(items, ["item_id"]).unionByName(short)
            .select("item_id", F.col("seed").alias("b_seed"), F.col("at").alias("b_at"), first.alias("b_from"),
                    F.slice("w", first + 1, BLOCK).alias("b_words")).distinct())


def matches(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """doc_id, text_hash, item_id, matched (words of the best block that agree) for every document
    and item that it holds."""
    table = staged(benchmark_seeds(benchmark), "seeds")
    size = F.size("b_words")
    lengths = sorted(r["n"] for r in table.where(size < SPAN).select(size.alias("n")).distinct().collect())
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    if table.count() <= broadcast_rows:
        hits = seeds(source, ["doc_id", "text_hash"], lengths).join(F.broadcast(table), F.col("seed") == F.col("b_seed"))
    else:
        # too large to broadcast: only hashes and places go through the shuffle, and the words of
        # documents with a hit are joined back
        bare = seeds(source, ["doc_id", "text_hash"], lengths).drop("w")
        found = bare.join(table, F.col("seed") == F.col("b_seed"))
        own = source.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), word_hashes("text").alias("w")) \
            .dropDuplicates(["_id", "_hash"])
        hits = found.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    shift = F.col("at") - F.col("b_at") + F.col("b_from")     # of the block's first word in the document
    lead = F.greatest(F.lit(0), -shift)                       # words of the block before the document starts
    blocks = hits.select("doc_id", "text_hash", "item_id", "b_words", lead.alias("lead"),
                         F.slice("w", F.greatest(F.lit(0), shift) + 1, BLOCK - lead).alias("d_words")).distinct()
    agree = F.size(F.filter(F.transform("b_words", lambda x, k: F.when(k >= F.col("lead"),
                                                                       x == F.get("d_words", k - F.col("lead")))),
                            lambda same: F.coalesce(same, F.lit(False))))
    # the share is tested behind the aggregate: as a filter before it, it would move into the join
    # and take that out of the code-generated stage
    return (blocks.select("doc_id", "text_hash", "item_id", agree.cast("long").alias("n"), F.size("b_words").alias("of"))
            .groupBy("doc_id", "text_hash", "item_id", "of").agg(F.max("n").alias("matched"))
            .where(F.col("matched") * MIN_SHARE[1] >= F.col("of") * MIN_SHARE[0])
            .select("doc_id", "text_hash", "item_id", "matched"))


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, matched: every document that holds a benchmark item, once for each."""
    return (matches(docs, benchmark, **options).groupBy("doc_id", "item_id")
            .agg(F.max("matched").alias("matched")))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` (all columns) that hold no benchmark item."""
    found = matches(docs, benchmark, **options).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return from_rows(as_rows(docs).join(found, same, "left_anti"), docs)


def _oracle() -> str:
    def seed(m: str) -> str:
        return " || ' ' || ".join(f"w[pos + {k + 1}]" for k, bit in enumerate(m) if bit == "1")

    masks = " UNION ALL ".join(f"SELECT * EXCLUDE (n), {i} AS m, {seed(m)} AS seed FROM {{0}}"
                               for i, m in enumerate(MASKS))
    words = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
    return f"""
WITH b0 AS (SELECT DISTINCT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
b1 AS (SELECT item_id, w, len(w) AS n, unnest(range(len(w) - {SPAN - 1})) AS pos FROM b0 WHERE len(w) >= {SPAN}),
b2 AS ({masks.format("b1")}),
b AS (SELECT DISTINCT item_id, m, seed, pos AS b_at,
        greatest(0, least(pos - pos % {STEP}, len(w) - {BLOCK})) AS b_from, w AS iw FROM b2),
d0 AS (SELECT doc_id, {words} AS w FROM documents),
d1 AS (SELECT doc_id, w, len(w) AS n, unnest(range(len(w) - {SPAN - 1})) AS pos FROM d0 WHERE len(w) >= {SPAN}),
d2 AS ({masks.format("d1")}),
hit AS (SELECT d.doc_id, b.item_id, d.w, b.iw, d.pos - b.b_at AS g, b.b_from,
               least({BLOCK}, len(b.iw) - b.b_from) AS size
        FROM d2 d JOIN b ON d.m = b.m AND d.seed = b.seed),
seen AS (SELECT doc_id, item_id, size, len([k for k in range(b_from, b_from + size)
                if k + g >= 0 AND k + g < len(w) AND w[k + g + 1] = iw[k + 1]]) AS matched FROM hit)
SELECT doc_id, item_id, max(matched)::BIGINT AS matched FROM seen
WHERE matched * {MIN_SHARE[1]} >= size * {MIN_SHARE[0]} GROUP BY doc_id, item_id
"""


ORACLE_SQL = _oracle()
