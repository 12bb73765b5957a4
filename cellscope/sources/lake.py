"""The NDJSON lake: `raw/network_events/dt=YYYY-MM-DD/hr=HH/<object>.jsonl`.

Objects are read as text lines (one JSON document per line) so that the same line feeds the
typed record and the drift catch-all. The date scan relies on partition pruning of the
`dt=` directory level (A8); blank lines are dropped (A9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from cellscope import schemas as S

LAKE_PARTITIONS = T.StructType([T.StructField("value", T.StringType()),
                                T.StructField("dt", T.StringType()), T.StructField("hr", T.StringType())])


def lake_dir(lake_root: str) -> str:
    return f"{lake_root.rstrip('/')}/{S.LAKE_PREFIX}"


def object_key_of(path_col) -> F.Column:
    """Object key (path below the lake root) from a file URI."""
    return F.regexp_extract(path_col, r"(raw/network_events/.*)$", 1)


def objects(spark: SparkSession, lake_root: str, date: str | None = None) -> DataFrame:
    """Objects of one logical date (or the whole lake) as rows `object_key`: the file listing as
    a DataFrame, contents are not read."""
    path = lake_dir(lake_root) + (f"/dt={date}" if date else "")
    try:
        files = (spark.read.format("binaryFile").option("basePath", lake_dir(lake_root))
                 .option("recursiveFileLookup", "true").load(path))
        return files.select(object_key_of(F.col("_metadata.file_path")).alias("object_key"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "object_key string")


def read_lines(spark: SparkSession, lake_root: str, date: str | None = None) -> DataFrame:
    """Non-blank lines of one date (or the whole lake) with their object key, dt, hr. Only the folder of the
    date is listed, not the lake's other days."""
    path = lake_dir(lake_root) + (f"/dt={date}" if date else "")
    try:
        df = spark.read.schema(LAKE_PARTITIONS).option("basePath", lake_dir(lake_root)).text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, dt string, hr string, object_key string")
    return (df.where(F.trim("value") != "")
            .select("value", "dt", "hr", object_key_of(F.col("_metadata.file_path")).alias("object_key")))


def write_ndjson(lines: DataFrame, lake_root: str, mode: str = "append") -> None:
    """One JSON document per line, UTF-8, partitioned by ingestion dt/hr.

    `lines` has `value` (JSON text), `dt`, `hr`.
    """
    (lines.select("value", "dt", "hr").write.mode(mode).partitionBy("dt", "hr")
     .text(lake_dir(lake_root)))


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create an empty folder if it is missing (a file stream needs its directory to exist
    before the first object lands)."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - remote session: the server side must provide it
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        fs.mkdirs(p)
