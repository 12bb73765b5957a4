"""Token ids in ORC: stripes with integer run-length encoding, row indexes and Bloom filters.

`write` encodes every whole text, appends an end id and writes (doc_id, n_tokens, ids) in
ascending doc_id order: rows are range-partitioned on doc_id, ties spread over partitions by a
row number, so a doc_id that a third of all rows share isn't one task's work. Ids are stored as
ORC integers (run-length encoded); each stripe carries row indexes, and a Bloom filter on doc_id.

`read` scans the files stripe by stripe in parallel; `lookup` and `between` push their predicate
on doc_id into the reader, which skips files, stripes and row groups by their statistics and
Bloom filters. `positions` adds where each document starts in the whole stream: running sums
inside a stripe range, then one running sum over the ranges' totals (one row per range).

Defined results: a null or empty text is the end id alone; null ids come first; repeated rows are
all written, in the order of the input's row numbers; an empty table gives a readable, empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellscope.llm.common import fresh_path, giving_back, staged, stretches, texts
from cellscope.llm.tokens import PART, text_ids, tokenizer_path

END_ID = 0
OPTIONS = {
    "orc.create.index": "true", "orc.row.index.stride": "2000", "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd",
}


def encode(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens and ids (array of int, with the end id) of every row, in input order."""
    path = tokenizer_path(tokenizer)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = text_ids(path)
        for batch in batches:
            found = texts(batch)
            for a, b in stretches([len(x) for x in found], PART):      # a part at a time: ids outgrow their texts
                flat, n = ids_of.encode_all(found[a:b])
                upto = np.cumsum(n)
                flat = np.insert(flat, upto, end_id).view("<i4")
                ends = np.concatenate(([0], upto + np.arange(1, len(n) + 1))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(n + 1),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(giving_back(run, lambda: text_ids(path).release()),
                                                    f"doc_id {kind}, n_tokens long, ids array<int>")


def write(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID) -> None:
    """Write the ids of all rows of `docs` to ORC files under `path`, in ascending doc_id order:
    part numbers rise with doc_id, and so do rows in a part."""
    row = "_row"
    ordered = (docs.select("doc_id", "text").withColumn(row, F.monotonically_increasing_id())
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col(row))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), row))
    encode(ordered, tokenizer, end_id).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def lookup(spark: SparkSession, path: str, ids: Iterable[int]) -> DataFrame:
    """The rows of a few documents; all but their row groups are skipped."""
    return read(spark, path).where(F.col("doc_id").isin(list(ids)))


def between(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    return read(spark, path).where(F.col("doc_id").between(first, last))


def positions(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, read from the files."""
    src = read(spark, path).select("doc_id", "ids", F.col("_metadata.file_name").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, before = None, 0        # the stripe range being read, and its ids so far
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            n = np.diff(ends).astype(np.int64)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            starts = []
            for key, k in zip(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()), n.tolist()):
                if key != at:
                    at, before = key, 0
                starts.append(before)
                before += k
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(n), pa.array(crc, pa.int64()),
                 batch.column("file"), batch.column("block")],
                ["doc_id", "inside", "n_tokens", "ids_crc32", "file", "block"])

    rows = staged(src.mapInArrow(run, f"doc_id {kind}, inside long, n_tokens long, ids_crc32 long, "
                                      "file string, block long"), "positions")
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    order = W.orderBy(part, "file", "block").rowsBetween(W.unboundedPreceding, -1)
    bases = (rows.groupBy("file", "block").agg(F.sum("n_tokens").alias("total"))
             .select(F.col("file").alias("f"), F.col("block").alias("b"),
                     F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base")))
    return (rows.join(bases, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def round_trip(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID) -> DataFrame:
    path = fresh_path(docs.sparkSession, "orc-ids")
    write(docs, path, tokenizer, end_id)
    return positions(docs.sparkSession, path)
