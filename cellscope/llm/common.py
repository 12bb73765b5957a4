"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only characters that separate words in every operator here.
SPACE = " \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application, so that jobs
    run wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, read from the session.

    Where it is unset, a local session (tests, a laptop) gets a scratch folder of its own; a
    cluster session is an error, since a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    named = named or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-scratch-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts the lineage, so a lost
    executor re-reads files instead of repeating the work, and later plans scan only the
    columns they need. The folder is added to `made`, for `drop_paths` once nothing reads it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_paths(spark: SparkSession, made: list[str]) -> None:
    """Delete folders that `staged` made, and forget them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while made:
        p = jvm.org.apache.hadoop.fs.Path(made.pop())
        p.getFileSystem(conf).delete(p, True)


def as_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as one column `_row`: whatever other columns are called, they
    can't clash with those an operator adds."""
    return docs.select(F.struct("*").alias("_row"), "doc_id", "text")


def from_rows(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of `docs` from `_row`, those named in `new` replaced."""
    return rows.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def with_text(rows: DataFrame, docs: DataFrame, text: Column, changed: Column) -> DataFrame:
    """`from_rows` with another text, and `n_chars`, if there, up to date where it changed."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length(text).cast(kind)).otherwise(F.col("_row").getField("n_chars"))
    return from_rows(rows, docs, **new)


def id_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo `mod` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def give_back() -> None:
    """Return to the system what this process has freed but its allocators hold. Python workers are
    kept for later tasks, and wait beside an executor whose heap has grown meanwhile."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def giving_back(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                release: Callable[[], None] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`fn` for mapInArrow, with `release` and `give_back` once a task is through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            if release:
                release()
            give_back()

    return run


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Arrow batches of `df` through `fn`, which returns the columns of `schema` by name.

    Spark bounds a batch by rows and by bytes (spark.sql.execution.arrow.*), so a task holds
    one batch at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))

    return df.mapInArrow(giving_back(run), schema)


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 1024, chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most `most` rows and about `chars` characters in text columns."""
    wide = [k for k, f in enumerate(schema) if f.type == pa.string()]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(row[k] or "") for k in wide)
        if len(held) >= most or size >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as Python strings; null is the empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def stretches(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Borders of runs of items whose sizes come to at most `most`, or of one larger item."""
    start = held = 0
    for k, size in enumerate(sizes):
        if k > start and held + size > most:
            yield start, k
            start, held = k, 0
        held += size
    if sizes:
        yield start, len(sizes)


def blocks(text: str, size: int = 1 << 20) -> list[str]:
    """Stretches of at most `size` characters that make up the text, cut behind white space
    where there is any: bounds the memory that one very long text takes."""
    if len(text) <= size:
        return [text]
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + size)
        if end < len(text):
            cut = max(text.rfind(c, at + 1, end) for c in SPACE)
            end = cut + 1 if cut > at else end
        out.append(text[at:end])
        at = end
    return out
