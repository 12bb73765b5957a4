"""The stored key of the raw table: its event ids, laid out by hash so that an insert doesn't move them.

`raw/_event_ids/<n>` is a Parquet table of the ids alone, in `n` buckets of `event_id`. An anti-join of
new rows with it sends the new rows to the buckets; the stored side, which grows with all
history, is read where it lies, without a shuffle. `n` is the session's `spark.cellscope.idBuckets`
(default 64; on a cluster so many that a bucket's ids fit a task's sort). Another number builds another
folder from the raw table's id column, once.

The raw table stays the truth. `_covered` lists, per ingestion date, how many raw rows have
their ids stored. `cover` compares it with the row counts of the raw files, which costs no column, and
stores what is missing for the dates that differ. It runs before ids are compared and after rows are
added, so a run killed in between, or a raw table older than this layout, is made good by the next load.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.plans import publish

KEY = "event_id"
BUCKETS_CONF, DEFAULT_BUCKETS = "spark.cellscope.idBuckets", 64


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get(BUCKETS_CONF, str(DEFAULT_BUCKETS)))


def ids_path(spark: SparkSession, warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/raw/_event_ids/{buckets(spark)}"


def _name(spark: SparkSession, warehouse: str) -> str:
    return f"cellscope_event_ids_{hashlib.md5(ids_path(spark, warehouse).encode()).hexdigest()}"


def stored_ids(spark: SparkSession, warehouse: str) -> DataFrame:
    """The stored ids as a bucketed table of this session's catalog."""
    name, location = _name(spark, warehouse), ids_path(spark, warehouse).replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({KEY} STRING) USING parquet CLUSTERED BY ({KEY}) "
              f"SORTED BY ({KEY}) INTO {buckets(spark)} BUCKETS LOCATION '{location}/ids'")
    spark.catalog.refreshTable(name)        # other sessions add files too
    return spark.table(name)


def cover(spark: SparkSession, warehouse: str, raw_path: str) -> DataFrame:
    """Store the ids of raw rows that are not stored yet; returns the stored ids, all of them then."""
    covered_path = f"{ids_path(spark, warehouse)}/_covered"
    ids, raw = stored_ids(spark, warehouse), publish.read_table(spark, raw_path)
    if raw is None:
        return ids
    date = F.col("_ingest_date").cast("string")
    have = raw.groupBy(date.alias("_ingest_date")).agg(F.count(F.lit(1)).alias("raw_rows"))
    have = spark.createDataFrame(have.collect(), have.schema)       # one row for each ingestion date
    covered = publish.read_table(spark, covered_path, have)
    stale = [r["_ingest_date"] for r in have.join(covered, have.columns, "left_anti").collect()]
    if not stale:
        return ids
    missing = raw.where(date.isin(*stale)).select(KEY).join(ids, KEY, "left_anti")
    # staged, since the write below adds to the table that the plan reads
    with publish.staged(missing, "event-ids") as missing:
        n = buckets(spark)
        (missing.repartition(n, KEY).write.bucketBy(n, KEY).sortBy(KEY).mode("append").format("parquet")
         .option("path", f"{ids_path(spark, warehouse)}/ids").saveAsTable(_name(spark, warehouse)))
    publish.full_refresh(have, covered_path)
    return stored_ids(spark, warehouse)
