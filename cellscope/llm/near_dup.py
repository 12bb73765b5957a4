"""MinHash near-dedup with SetSketch registers.

Documents are linked if their sets of five-word shingles have a Jaccard similarity of 0.75 or
more; the result gives each document the smallest doc_id it reaches over links.

1. Every whole text becomes its shingle set, a 128-bit fingerprint of the set and 128 SetSketch
   registers (exponentially spaced truncated minima, two bytes each). Equal sets are one node.
2. Bands of registers are hashed into buckets: 32 narrow bands of four registers, of which two
   sets at the threshold share none with probability below 1e-5, and 16 wide bands of eight,
   whose buckets stay small inside large groups.
3. A bucket of n nodes gives at most 2(n-1) pairs: every node with the bucket's smallest id and
   with its smallest hash (another hub in every bucket). Pairs are estimated jointly by
   likelihood from their registers; those whose likelihood at the threshold is 18 below the best
   (six standard deviations) go, and of the rest one for each node is confirmed on full sets.
4. Narrow buckets that still hold several components are searched whole, so no pair is given up
   for the size of a bucket. A node's shingles that occur in another component at all hold its
   overlap with any node there: they rule out most nodes and pairs exactly, and decide the others
   where they meet. Large buckets are dealt out as pairs of blocks of 512 nodes; each pair of nodes
   is looked at in the first band that it shares, and skipped where its components are joined
   already. Only links that join two components leave a block, so no list of pairs is ever made.
5. Components come from alternating large-star and small-star steps over the confirmed pairs.

Nothing is collected: sketches, pairs, texts of candidates and component labels are tables in
the shared folder. Hubs are found by aggregates with partial sums and joined back by joins that
adaptive execution can split, so a bucket with a third of all rows isn't one task's work.

Defined results: null and empty texts, and texts without words, have the empty set: n_shingles
0, linked with nothing. With fewer than five words the whole sequence is one shingle. Rows with
a null doc_id can't be named in a component: component_id null, kept true. Repeated rows all
appear in the result with the same component. Where one doc_id has several texts, `link` takes
them as one document that links whatever any of them links (an empty text aside), while `keep_one`
decides for each text by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm import shingles as S
from cellscope.llm.common import as_rows, batched, drop_paths, from_rows, giving_back, map_batches, staged

NARROW, WIDE = 4, 8
THRESHOLD = (75, 100)
MARGIN = 18.0
SALTS = 8
BLOCK = 512
BLOCK_BYTES = 16 << 20


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id (long), text_hash, n_shingles, fp1, fp2 and regs (binary) of every row."""
    def run(batch: pa.RecordBatch) -> dict:
        n, fp1, fp2, regs = [], [], [], []
        for text in batch.column("text").to_pylist():
            s = S.shingle_set(text)
            a, b = S.fingerprint(s)
            n.append(len(s))
            fp1.append(a)
            fp2.append(b)
            regs.append(S.registers(s).tobytes() if len(s) else None)
        return {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "n_shingles": pa.array(n, pa.int64()), "fp1": pa.array(fp1, pa.int64()),
                "fp2": pa.array(fp2, pa.int64()), "regs": pa.array(regs, pa.binary())}

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return map_batches(src, run, "doc_id long, text_hash long, n_shingles long, fp1 long, fp2 long, regs binary")


def nodes_of(sketches: DataFrame) -> DataFrame:
    """One node for each distinct non-empty set: rid (smallest doc_id), its text_hash, n, regs."""
    return (sketches.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("fp1", "fp2")
            .agg(F.min("doc_id").alias("rid"), F.min_by("text_hash", "doc_id").alias("text_hash"),
                 F.first("n_shingles").alias("n"), F.first("regs").alias("regs")))


def shared_ids(sketches: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that a doc_id with several sets has in common."""
    sets = sketches.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "fp1", "fp2")
    fp = F.struct("fp1", "fp2")
    several = staged(sets.groupBy("doc_id").agg(F.min(fp).alias("lo"), F.max(fp).alias("hi"))
                     .where("lo <> hi").select("doc_id"), "several")
    found = sets.join(several, "doc_id").distinct().join(nodes.select("fp1", "fp2", "rid"), ["fp1", "fp2"])
    least = found.groupBy("doc_id").agg(F.min("rid").alias("b"))
    return found.join(least, "doc_id").where("rid <> b").select(F.col("rid").alias("a"), "b").distinct()


def band_rows(nodes: DataFrame, registers: int) -> DataFrame:
    """(bucket, band, rid): one row for each node and band of so many registers."""
    width = 2 * registers
    return (nodes.select("rid", "regs", F.explode(F.sequence(F.lit(0), F.lit(S.M // registers - 1))).alias("band"))
            .select(F.xxhash64(F.lit(registers), "band", F.substring("regs", F.col("band") * width + 1, F.lit(width)))
                    .alias("bucket"), "band", "rid"))


def star_pairs(rows: DataFrame, made: list[str] | None = None) -> DataFrame:
    """Distinct (node, hub) of all buckets with two or more nodes."""
    order = F.xxhash64("rid", "bucket")
    hubs = (rows.groupBy("bucket").agg(F.min("rid").alias("h1"), F.min_by("rid", order).alias("h2"),
                                       F.max("rid").alias("top"))
            .where("h1 < top").select(F.col("bucket").alias("b"), "h1", "h2"))
    hubs = staged(hubs, "hubs", made)    # read back, so that the join has its own shuffles, which can be split
    found = rows.join(hubs, rows["bucket"] == hubs["b"])
    return (found.select("rid", F.explode(F.array("h1", "h2")).alias("hub"))
            .where("rid <> hub").distinct())


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose sizes and registers allow the threshold, with both text hashes and the
    estimate. Sizes alone rule pairs out exactly."""
    side = lambda x: nodes.select(F.col("rid").alias(x), F.col("text_hash").alias(f"{x}_text"),
                                  F.col("n").alias(f"{x}_n"), F.col("regs").alias(f"{x}_regs"))
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    both = (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(small * threshold[1] >= large * threshold[0]))

    def run(batch: pa.RecordBatch) -> dict:
        ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, S.M)
                  for c in ("a_regs", "b_regs"))
        na, nb = (batch.column(c).to_numpy().astype(float) for c in ("a_n", "b_n"))
        j, near = S.may_reach(ra, rb, na, nb, threshold[0] / threshold[1], MARGIN)
        out = pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("a", "b", "a_text", "b_text")] + [pa.array(j)],
            ["a", "b", "a_text", "b_text", "est"]).filter(pa.array(near))
        return {c: out.column(c) for c in out.schema.names}

    return map_batches(both, run, "a long, b long, a_text long, b_text long, est double")


def _confirmed(pairs: DataFrame, texts: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. `texts`: rid, text_hash, text."""
    side = lambda x: texts.select(F.col("rid").alias(x), F.col("text_hash").alias(f"{x}_text"),
                                  F.col("text").alias(f"{x}_doc"))
    both = pairs.select("a", "b", "a_text", "b_text").join(side("a"), ["a", "a_text"]).join(side("b"), ["b", "b_text"])

    def run(batch: pa.RecordBatch) -> dict:
        sets = lru_cache(64)(S.shingle_set)     # a hub's pairs come one after the other
        near = []
        for x, y in zip(batch.column("a_doc").to_pylist(), batch.column("b_doc").to_pylist()):
            p, q = sets(x), sets(y)
            common = len(np.intersect1d(p, q, assume_unique=True))
            near.append(threshold[1] * common >= threshold[0] * (len(p) + len(q) - common))
        keep = pa.array(near, pa.bool_())
        return {c: batch.column(c).filter(keep) for c in ("a", "b")}

    return map_batches(both, run, "a long, b long")


def shingle_rows(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(shingle, rid, c) for every shingle of `members`: distinct (rid, c); `texts`: rid, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, c, text in zip(*(batch.column(x).to_pylist() for x in ("rid", "c", "text"))):
                s = S.shingle_set(text).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.repeat(pa.scalar(rid, pa.int64()), len(s)),
                                                  pa.repeat(pa.scalar(c, pa.int64()), len(s))], ["shingle", "rid", "c"])

    return members.join(texts, "rid").select("rid", "c", "text").mapInArrow(giving_back(run), "shingle long, rid long, c long")


def linkable(members: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: tuple[int, int],
             made: list[str]) -> DataFrame:
    """Of `members` (rid, c) the nodes that may still link to another component: rid, n, m, regs and
    foreign, the m shingles that also occur in a node of another component. They hold every overlap
    with such a node. A node whose foreign shingles are too few even for a partner inside its own
    set can't link; without such nodes others have fewer foreign shingles, so the count is repeated
    while it drops a tenth of the nodes."""
    rows = staged(shingle_rows(members, texts.select("rid", "text")), "shingles", made)
    size = members.count()
    while True:
        shared = staged(rows.groupBy("shingle").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                        .where("lo < hi").select("shingle"), "foreign", made)
        counts = rows.join(shared, "shingle").groupBy("rid").agg(F.count("*").alias("m"))
        found = staged(nodes.select("rid", "n", "regs").join(counts, "rid")
                       .where(F.col("m") * threshold[1] >= F.col("n") * threshold[0]), "linkable", made)
        left = found.count()
        if left >= 0.9 * size:
            break
        rows, size = staged(rows.join(found.select("rid"), "rid", "left_semi"), "shingles", made), left
    # no larger than the node's own set
    held = (rows.join(found.select("rid"), "rid", "left_semi").join(shared, "shingle")
            .groupBy("rid").agg(F.sort_array(F.collect_list("shingle")).alias("foreign")))
    return staged(found.join(held, "rid"), "foreign-sets", made)


def _find(parent: dict, x: int) -> int:
    while x in parent:
        x = parent[x]
    return x


def links_in_blocks(found: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b) between nodes of one bucket but two components, enough of them to join whatever
    the bucket's links join. `found`: bucket, band, blocks, rid, c, n, m, regs, foreign.

    The nodes of a bucket are dealt out as pairs of blocks with all that a decision needs, so pairs
    are ruled out, confirmed and joined where they meet. Sizes, foreign shingles and registers rule
    most of them out; of the others, the likeliest first, those whose components are not yet joined here are
    confirmed by their foreign shingles, which hold the whole overlap. Only links that joined two
    components leave a task: fewer than there are nodes in its blocks, however many pairs it saw."""
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    dealt = (found.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own",
                     "band", "rid", "c", "n", "m", "regs", "foreign"))
    key = ["bucket", "lo", "hi"]
    up, down = threshold

    def candidates(t: dict, sets: list) -> Iterator[tuple[int, int]]:
        """Pairs that may link, a stretch of rows at a time, the likeliest first."""
        regs = np.frombuffer(b"".join(t["regs"]), np.uint16).reshape(-1, S.M)
        bands = regs.view(np.uint64)
        c, n, m, own = (np.array(t[x], np.int64) for x in ("c", "n", "m", "own"))
        lo, hi, band = t["lo"][0], t["hi"][0], t["band"][0]
        first, second = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        for at in range(0, len(first), 64):
            i = np.repeat(first[at:at + 64], len(second))
            j = np.tile(second, len(first[at:at + 64]))
            small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            # an overlap of k suffices if down * k >= up * (n + n' - k)
            keep = ((c[i] != c[j]) & (small * down >= large * up)
                    & (np.minimum(m[i], m[j]) * (down + up) >= up * (n[i] + n[j])))
            if lo == hi:
                keep &= i < j
            i, j = i[keep], j[keep]
            if len(i):        # each pair in the first band that it shares
                once = (bands[i] == bands[j]).argmax(1) == band
                i, j = i[once], j[once]
            if len(i):
                est, near = S.may_reach(regs[i], regs[j], n[i].astype(float), n[j].astype(float), up / down, MARGIN)
                order = np.flatnonzero(near)[np.argsort(-est[near], kind="stable")]
                yield from zip(i[order].tolist(), j[order].tolist())

    def search(t: dict) -> Iterator[tuple[int, int]]:
        sets, parent = t["foreign"], {}
        for i, j in candidates(t, sets):
            x, y = _find(parent, t["c"][i]), _find(parent, t["c"][j])
            if x == y:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if down * common >= up * (t["n"][i] + t["n"][j] - common):
                parent[max(x, y)] = min(x, y)
                yield t["rid"][i], t["rid"][j]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        names = ("own", "band", "lo", "hi", "rid", "c", "n", "m", "regs", "foreign")
        held, current = {x: [] for x in names}, None
        for batch in batches:
            cols = {x: batch.column(x).to_pylist() for x in (*key, *names) if x != "foreign"}
            foreign = batch.column("foreign")
            for r, k in enumerate(zip(*(cols[x] for x in key))):
                if k != current:
                    if len(held["rid"]) > 1:
                        yield from search(held)
                    held, current = {x: [] for x in names}, k
                for x in names[:-1]:
                    held[x].append(cols[x][r])
                held["foreign"].append(foreign[r].values.to_numpy().copy())
        if len(held["rid"]) > 1:
            yield from search(held)

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return (dealt.repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(giving_back(lambda batches: batched(rows(batches), schema, 4096)), "a long, b long"))


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of the undirected pairs (a, b): component is the
    smallest node it reaches. Alternates large-star and small-star steps, each an aggregate for
    the least neighbour and a join back, until a round changes nothing."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
            else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = (both.groupBy("a").agg(F.min("b").alias("m"))
                 .select(F.col("a").alias("k"), F.least("a", "m").alias("m")))
        # a hub's pairs are dealt over SALTS tasks; its least neighbour is copied to each
        salted = least.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
        joined = both.join(salted, (both["a"] == salted["k"]) & (F.pmod(F.xxhash64(both["b"]), F.lit(SALTS)) == salted["s"]))
        if large:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b")))
                .where("a <> b").distinct())

    def signature(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
                     .first())

    old, made = [], []
    edges = staged(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), name, made)
    last = signature(edges)
    while last[0]:
        old, made = made, []
        edges = staged(star(star(edges, True), False), name, made)
        now = signature(edges)
        drop_paths(pairs.sparkSession, old)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def in_blocks(left: DataFrame, found: DataFrame) -> DataFrame:
    """`left` (bucket, band, rid, c) of the nodes `found`, with the number of blocks that their
    bucket is cut into: at most `BLOCK` nodes and about `BLOCK_BYTES` of shingles each. Buckets whose nodes
    are of one component by now go."""
    rows = left.join(found.select("rid", "m"), "rid")
    sizes = (rows.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("m").alias("shingles"), F.min("c").alias("lo"), F.max("c").alias("hi"))
             .where("lo < hi")
             .select("bucket", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")))
    return left.join(sizes, "bucket").join(found, "rid")


def _as_edges(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _first_choice(est: Column) -> list[Column]:
    """The smallest hub among those that are likely near, else the likeliest."""
    sure = est >= 0.79
    return [F.desc(sure), F.when(sure, F.col("b")), F.desc(est), F.col("b")]


def link(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs`."""
    from pyspark.sql import Window as W

    sketches = staged(sketch(docs), "sketches")
    nodes = staged(nodes_of(sketches), "nodes")
    narrow = band_rows(nodes, NARROW)
    made: list[str] = []      # tables that only the search needs
    stars = staged(star_pairs(narrow.unionByName(band_rows(nodes, WIDE)), made)
                   .select(F.col("rid").alias("a"), F.col("hub").alias("b")), "stars", made)

    # texts of all nodes that share a bucket; repeated rows of one document are one text
    ends = stars.select(F.col("a").alias("rid")).union(stars.select("b")).distinct()
    ends = nodes.select("rid", "text_hash").join(ends, "rid", "left_semi")
    texts = staged(docs.select(F.col("doc_id").cast("long").alias("rid"), F.xxhash64("text").alias("text_hash"), "text")
                   .join(ends, ["rid", "text_hash"], "left_semi").dropDuplicates(["rid", "text_hash"]), "texts", made)

    # one pair for each node, then those that still stand between components
    pairs = staged(_estimated(stars, nodes, threshold), "pairs", made)
    choice = F.row_number().over(W.partitionBy("a").orderBy(*_first_choice(F.col("est"))))
    first = staged(pairs.withColumn("k", choice).where("k = 1").drop("k"), "first", made)
    labels = components(_confirmed(first, texts, threshold).unionByName(shared_ids(sketches, nodes)))

    # narrow buckets that still hold several components
    tagged = staged(narrow.join(labels.withColumnRenamed("node", "rid"), "rid", "left")
                    .select("bucket", "band", "rid", F.coalesce("component", "rid").alias("c")), "tagged", made)
    mixed = staged(tagged.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                   .where("lo < hi").select("bucket"), "mixed", made)
    left = staged(tagged.join(mixed, "bucket"), "left", made)
    if not left.isEmpty():
        found = linkable(left.select("rid", "c").distinct(), nodes, texts, threshold, made)
        labels = components(_as_edges(labels).unionByName(links_in_blocks(in_blocks(left, found), threshold)))
    # the result reads the sketches, the nodes and the last labels
    drop_paths(docs.sparkSession, made)

    named = (nodes.select("fp1", "fp2", "rid").join(labels, F.col("rid") == F.col("node"), "left")
             .select("fp1", "fp2", F.coalesce("component", "rid").alias("component_id")))
    return (sketches.join(named, ["fp1", "fp2"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("c"))
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("c")).alias("component_id"),
                    F.coalesce(F.col("doc_id") == F.col("c"), F.lit(True)).alias("kept")))


def numbered(docs: DataFrame) -> DataFrame:
    """_doc, _text (hash) and _id of every distinct row with a doc_id, _id in the order of both."""
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_text"))
    return staged(rows.distinct().orderBy("_doc", "_text").withColumn("_id", F.monotonically_increasing_id()), "numbered")


def keep_one(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of `docs` (all columns) with one text of each component: the one with the smallest
    doc_id, once if its row is repeated. Texts that share a doc_id alone aren't linked by it. Rows
    without a doc_id stay."""
    made: list[str] = []
    rows = as_rows(docs).select("_row", F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_text"))
    named = rows.where("_doc IS NOT NULL")
    several = named.groupBy("_doc").agg(F.min("_text").alias("lo"), F.max("_text").alias("hi")).where("lo <> hi")
    if several.isEmpty():
        kept = link(docs, threshold).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_kept")).distinct()
        named = named.dropDuplicates(["_doc"]).join(kept, F.col("_doc") == F.col("_kept"), "left_semi")
    else:
        ids = numbered(docs)
        same = (F.col("doc_id").cast("long") == F.col("_doc")) & (F.xxhash64("text") == F.col("_text"))
        found = staged(docs.select("doc_id", "text").join(ids, same).select(F.col("_id").alias("doc_id"), "text"), "own-ids", made)
        kept = link(found, threshold).where("kept").select(F.col("doc_id").alias("_id")).distinct()
        # equal texts of one doc_id are one row
        named = named.dropDuplicates(["_doc", "_text"]).join(ids.join(kept, "_id", "left_semi"), ["_doc", "_text"], "left_semi")
        drop_paths(docs.sparkSession, made)
    return from_rows(named, docs).unionByName(from_rows(rows.where("_doc IS NULL"), docs))
