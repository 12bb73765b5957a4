"""Publication of tables as versioned snapshots.

A published table is a folder with
* `_data/_version=<id>/[<partition>=<value>/]`: what one write added, never changed afterwards;
* `_manifest/<number>.json`: which of these folders make up the table, and its schema.

The table is what the manifest with the highest number says. A write first writes its data beside
what is there and then adds the next manifest, by renaming a finished file: before that, readers
see the old table, after that the new one, and never a gap or half of a write, whatever is killed
when. A replaced partition is one that the new manifest lists from another version; a partition
that became empty isn't listed. Nothing is moved or overwritten, so a plan may read the table it
replaces. Two writers of one table can't both add the same number: the later one fails.

What the newest two manifests don't list is deleted after a switch, so that readers who began
before it can finish; folders that no manifest ever listed (killed writes) go when they are
a day old. A manifest holds a line for each partition folder, not for each file.

Append-only tables without a manifest (raw, ledger, quarantine) are plain Parquet folders, whose
appends Spark's commit protocol makes whole. Staged copies live under the shared checkpoint folder
named by `spark.checkpoint.dir`.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cellscope.session import scratch_path

KEPT_MANIFESTS = 2
ORPHAN_SECONDS = 24 * 3600


class ConcurrentWrite(RuntimeError):
    """Another writer published the table meanwhile; nothing of this write is visible."""


def _fs(spark: SparkSession, path: str):
    """The file system of `path` and the path as its own object."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list:
    fs, p = _fs(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


@dataclass(frozen=True)
class Manifest:
    number: int
    parts: tuple[str, ...]       # folders under _data
    partition_by: tuple[str, ...]
    schema: T.StructType

    def to_json(self) -> str:
        return json.dumps({"parts": self.parts, "partition_by": self.partition_by, "schema": json.loads(self.schema.json())})


def _read_manifest(spark: SparkSession, path: str, number: int) -> Manifest:
    fs, p = _fs(spark, f"{path}/_manifest/{number:012d}.json")
    stream = fs.open(p)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    found = json.loads(text)
    return Manifest(number, tuple(found["parts"]), tuple(found["partition_by"]), T.StructType.fromJson(found["schema"]))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = [s.getPath().getName() for s in _children(spark, f"{path}/_manifest")]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The current manifest of a published table."""
    numbers = _numbers(spark, path)
    return _read_manifest(spark, path, numbers[-1]) if numbers else None


def _switch(spark: SparkSession, path: str, new: Manifest) -> None:
    """Make `new` the table: its file is finished under another name, then renamed."""
    fs, target = _fs(spark, f"{path}/_manifest/{new.number:012d}.json")
    _, draft = _fs(spark, f"{path}/_manifest/.{new.number:012d}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(draft, False)
    stream.write(bytearray(new.to_json().encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise ConcurrentWrite(f"{path}: version {new.number} was published by another writer")


def _clean(spark: SparkSession, path: str) -> None:
    """Delete what no kept manifest lists: folders of older ones, and old remains of killed writes."""
    numbers = _numbers(spark, path)
    kept, gone = numbers[-KEPT_MANIFESTS:], numbers[:-KEPT_MANIFESTS]
    live = {x for n in kept for x in _read_manifest(spark, path, n).parts}
    for n in gone:
        for part in _read_manifest(spark, path, n).parts:
            if part not in live:
                drop(spark, f"{path}/_data/{part}")
        drop(spark, f"{path}/_manifest/{n:012d}.json")
    versions = {x.split("/")[0] for x in live}
    for folder in _children(spark, f"{path}/_data"):
        if folder.getPath().getName() not in versions and folder.getModificationTime() / 1000 < time.time() - ORPHAN_SECONDS:
            drop(spark, folder.getPath().toString())


def _partitions(spark: SparkSession, path: str, version: str, depth: int) -> list[str]:
    """The partition folders that a write made, relative to _data."""
    found = [version]
    for _ in range(depth):
        found = [f"{x}/{s.getPath().getName()}" for x in found for s in _children(spark, f"{path}/_data/{x}")
                 if s.isDirectory() and "=" in s.getPath().getName()]
    return found


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep: Callable[[str, set[str]], bool] | None = None) -> None:
    """Write `df` as a new version and switch to it. `keep(partition, written)` tells which folders of the
    current version stay, by their partition path (`kpi_date=2024-01-01`, or empty) and
    those just written; None: none of them."""
    spark = df.sparkSession
    old = manifest(spark, path)
    plain = read_table(spark, path) if old is None and keep else None
    if plain is not None:       # a plain folder becomes version 0
        publish(plain, path, partition_by)
        old = manifest(spark, path)
    version = f"_version={uuid.uuid4().hex[:16]}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/_data/{version}")
    new = _partitions(spark, path, version, len(partition_by))
    written = {_partition(x) for x in new}
    stay = [x for x in old.parts if keep(_partition(x), written)] if old and keep else []
    _switch(spark, path, Manifest(old.number + 1 if old else 0, (*stay, *new), tuple(partition_by), df.schema))
    _clean(spark, path)


def _partition(part: str) -> str:
    return part.partition("/")[2]


def _published(spark: SparkSession, path: str, found: Manifest) -> DataFrame:
    columns = [f.name for f in found.schema.fields]
    if not found.parts:
        return spark.createDataFrame([], found.schema)
    schema = T.StructType([*found.schema.fields, T.StructField("_version", T.StringType())])
    return (spark.read.schema(schema).option("basePath", f"{path}/_data")
            .parquet(*[f"{path}/_data/{x}" for x in found.parts]).select(*columns))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when `path` holds a table (a non-empty folder)."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - remote session: ask the reader instead
        try:
            spark.read.parquet(path).schema  # resolves the listing only, reads no rows
            return True
        except Exception:  # noqa: BLE001 - missing or empty path
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.exists(p) and len(fs.listStatus(p)) > 0)


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """The table at `path`, or None. A published table is what its manifest lists, however many
    rows that is. A plain one without rows has no file to tell its columns: it reads as None, or as an
    empty table with the columns of `like`."""
    found = manifest(spark, path)
    if found is not None:
        return _published(spark, path, found)
    if table_exists(spark, path):
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
    return None if like is None else spark.createDataFrame([], like.schema)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a staged folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def staged(df: DataFrame, name: str):
    """`stage`, deleted at the end of the block."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop(df.sparkSession, path)


def stage(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """Write `df` once to a fresh folder of the shared checkpoint location and read it back. The folder
    is added to `made`, for `drop` when nothing reads it any more.

    Cuts the lineage (a lost executor re-reads the staged files instead of recomputing the
    whole plan) and decouples a plan from the table it is about to overwrite.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table with `df` (SCD1 overwrite, rebuilt SCD2)."""
    publish(df, path)


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...], touched: list | None = None) -> None:
    """Replace partitions in one switch: those that `df` has rows for and those of the values in
    `touched` (of the only partition column), which disappear where `df` has none. Re-running a
    date publishes the same rows again."""
    gone = {f"{partition_by[0]}={value}" for value in touched or []}
    publish(df, path, partition_by, keep=lambda partition, written: partition not in written and partition not in gone)


def add(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Add rows to a published table in one switch."""
    publish(df, path, partition_by, keep=lambda partition, written: True)


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Add rows to a plain Parquet folder."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
