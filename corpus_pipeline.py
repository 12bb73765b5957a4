"""Corpus pipeline: from `documents` to packed training windows in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes every stage's result
as Parquet in the shared folder and reads it back as the next stage's input, so a lost executor
never repeats more than one stage. All stages but the last return the columns of `documents`.

1. quality: documents that the attention-based classifier rejects go.
2. lines: later occurrences of three-line windows are removed from the texts, then those of
   passages of more than 50 words that such windows miss; no document goes.
3. near duplicates: one document of each linked group stays, the one with the smallest doc_id.
4. decontamination: documents that hold a benchmark item go.
5. packing: every remaining document becomes pieces of training windows, with their token ids.

Null and empty texts pass through all stages (score, line dedup and matching are defined on
them; they are packed as an end id); rows without a doc_id are kept by every stage that decides
by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellscope.llm import decontam, line_dedup, mil_quality, near_dup, packing, passages
from cellscope.llm.common import fresh_path, ship, staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mil_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return passages.dedup(staged(line_dedup.dedup(docs), "lines"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: The classifier is learned and tokens come from a library: no SQL for the whole run. The stages
#: are tested one by one against brute force in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
