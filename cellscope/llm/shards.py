"""Contiguous shards of near equal bytes, from global prefix sums (DataFrame functions only).

Documents are taken in ascending order of doc_id. Their sizes are summed

1. in blocks of 64 consecutive rows, by one window for each block,
2. over the blocks of a partition, 3. over the totals of the partitions (one row each),

so that every row learns how many bytes and rows lie before it in the whole table without any
task seeing more than its stretch. With T bytes in all, shard k is the k-th of `shards` equal
stretches of 0..T: a document belongs to the stretch that holds its middle. A shard is therefore
a contiguous range of doc_ids, and its size differs from T / shards by less than the larger half of
the documents at its two ends. No partition is cut by a key, so a source, group of equal texts or doc_id with
a third of all rows changes nothing: equal texts are dealt by their doc_ids like any others.

The text is read once, for its size and checksum; only these are shuffled (`place`). `write` carries
whole rows. Sums are exact longs, up to 2.8e17 bytes with 16 shards.

Defined results: a null text has size 1 and the checksum of no bytes (0), as the empty text has. Null
doc_ids come first. Repeated rows and rows with the same doc_id each have their own slot, ordered by
size, then checksum; which of two rows alike in all three comes first is left open. One text of more than T / shards
bytes leaves neighbouring shards without rows. An empty table gives no rows. Other columns, whatever
their names, take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import drop_paths, staged
from cellscope.llm.ordering import in_order

SHARDS = 16
#: Rows of one window: small, so that blocks spread evenly over tasks.
BLOCK = 64


def place(docs: DataFrame, shards: int = SHARDS, carry: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (number in the shard, gapless from 0) of every row;
    with `carry` also `row`, a struct of all columns of `docs`."""
    made: list[str] = []
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), *([F.struct("*").alias("row")] if carry else []))
    kept = sizes.columns
    rows = in_order(sizes, ["doc_id", "size", "text_crc32"], "sizes", made) \
        .withColumn("_block", F.expr(f"_at div {BLOCK}"))

    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(earlier(w)), F.lit(0))
    blocks = staged(rows.groupBy("_part", "_block").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "blocks", made)
    in_part = Window.partitionBy("_part").orderBy("_block")
    # one row for each partition: their number is that of the tasks, not of the documents
    parts = blocks.groupBy("_part").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    parts = parts.select("_part", before("bytes", Window.orderBy("_part")).alias("part_bytes"),
                         before("n", Window.orderBy("_part")).alias("part_rows"),
                         F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))
    base = blocks.select("_part", "_block", before("bytes", in_part).alias("bytes"), before("n", in_part).alias("n")) \
        .join(parts, "_part") \
        .select("_part", "_block", (F.col("bytes") + F.col("part_bytes")).alias("_bytes"),
                (F.col("n") + F.col("part_rows")).alias("_rows"), "all_bytes")
    base = staged(base, "prefix", made)

    in_block = Window.partitionBy("_part", "_block").orderBy("_at")
    placed = (rows.withColumn("_before", before("size", in_block)).join(base, ["_part", "_block"])
              .withColumn("_middle", 2 * (F.col("_bytes") + F.col("_before")) + F.col("size")))
    shard = F.least(F.lit(shards - 1).cast("long"), F.expr(f"_middle * {shards} div (2 * all_bytes)")).cast("int")
    out: list[str] = []
    placed = staged(placed.select(*kept, shard.alias("shard"), (F.col("_rows") + F.col("_at") % BLOCK).alias("_row")), "placed", out)
    drop_paths(docs.sparkSession, made)
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))      # a row for each shard
    return placed.join(F.broadcast(firsts), "shard").select(*kept, "shard", (F.col("_row") - F.col("_first")).alias("slot"))


def write(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The whole rows as Parquet, one folder `shard=k` for each shard, files in slot order."""
    rows = place(docs, shards, carry=True)
    free = next(f"shard{'_' * k}" for k in range(len(docs.columns) + 1) if f"shard{'_' * k}" not in docs.columns)
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("row.*", F.col("shard").alias(free)).write.partitionBy(free).parquet(path))


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The placement under the law `bytes`; the count of shards is part of it, so none is grown."""
    return place(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"))
