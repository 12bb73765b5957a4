"""Facts as a stream of newly loaded raw rows, with a watermark that loses nothing.

The raw table is the source: files that loads append are processed once, a restart goes on with those not
yet committed. A fact's watermark is its newest event time minus the allowed delay, as it is before a
micro-batch; rows at or above it go into the fact, older ones into `curated/_late_<fact>`, where an analyst sees
what the incremental policy of the source system would have dropped, until `merge_late` adds it.

The state is the published tables themselves. Both writes leave out ids that the fact or its late table
already holds (only the days of the batch are compared), and the fact is written first: a batch repeated after a
crash adds nothing twice, and a late row stays late, since the watermark only rises. The runs by date and
this stream may take turns on the same tables, one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellscope import schemas as S
from cellscope.operators import curated, staging
from cellscope.plans import publish
from cellscope.plans.load import raw_path
from cellscope.sources import lake

FACTS = {"fct_voice_call": curated.fct_voice_call, "fct_data_session": curated.fct_data_session}
KEY, DAY = "event_id", "event_date"


def fact_paths(warehouse: str, name: str) -> tuple[str, str]:
    base = f"{warehouse.rstrip('/')}/curated"
    return f"{base}/{name}", f"{base}/_late_{name}"


def newest_event(fact: DataFrame | None) -> int | None:
    """Newest event time of a fact in microseconds, from its newest day alone."""
    day = None if fact is None else fact.agg(F.max(DAY).cast("string").alias("d")).first()["d"]
    if day is None:
        return None
    return fact.where(F.col(DAY) == F.lit(day).cast("date")).agg(F.max(F.unix_micros("event_time")).alias("t")).first()["t"]


def unseen(rows: DataFrame, *tables: DataFrame | None) -> DataFrame:
    """Rows whose id none of the tables holds; only the days of `rows` are compared, as an id has one raw row."""
    days = [r["d"] for r in rows.select(F.col(DAY).cast("string").alias("d")).distinct().collect()]
    for held in tables:
        if held is not None and days:
            rows = rows.join(held.where(F.col(DAY).cast("string").isin(*days)).select(KEY), KEY, "left_anti")
    return rows


def commit_fact(rows: DataFrame, warehouse: str, name: str, delay_seconds: int = 0) -> None:
    """Add the rows of one micro-batch to a fact, or to its late table."""
    spark = rows.sparkSession
    fact_path, late_path = fact_paths(warehouse, name)
    fact, late = publish.read_table(spark, fact_path), publish.read_table(spark, late_path)
    newest = newest_event(fact)
    on_time = F.lit(True) if newest is None else F.unix_micros("event_time") >= newest - delay_seconds * 1_000_000
    with publish.staged(rows.withColumn(DAY, F.to_date("event_time")), f"{name}-batch") as rows:
        with publish.staged(unseen(rows, fact, late).withColumn("_on_time", on_time), f"{name}-new") as new:
            for path, part in ((fact_path, new.where("_on_time")), (late_path, new.where("NOT _on_time"))):
                if not part.isEmpty():
                    publish.add(part.drop("_on_time"), path, (DAY,))


def merge_late(spark: SparkSession, warehouse: str, name: str) -> int:
    """Add the withheld rows of a fact to it and empty its late table; returns how many were added."""
    fact_path, late_path = fact_paths(warehouse, name)
    late = publish.read_table(spark, late_path)
    if late is None:
        return 0
    with publish.staged(unseen(late, publish.read_table(spark, fact_path)), f"{name}-late") as new:
        n = new.count()
        if n:
            publish.add(new, fact_path, (DAY,))
    publish.full_refresh(late.limit(0), late_path)
    return n


def raw_stream(spark: SparkSession, warehouse: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Rows that loads append to the raw table."""
    path, table = raw_path(warehouse), publish.read_table(spark, raw_path(warehouse))
    contract = T.StructType([T.StructField(f.name, S.RAW_DECIMALS.get(f.name, f.dataType)) for f in S.RAW_SCHEMA.fields]
                            + [T.StructField("_ingest_date", T.DateType())])
    lake.ensure_dir(spark, path)        # may start before the first load
    reader = spark.readStream.schema(contract if table is None else table.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def stream_facts(spark: SparkSession, warehouse: str, checkpoint: str, delay_seconds: int = 0, available_now: bool = True,
                 max_files_per_trigger: int | None = None, keep_flags: tuple[str, ...] = ()) -> StreamingQuery:
    """Keep both facts up to date with the raw table (or drain what is new once with `available_now`)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        valid = staging.stg_valid(staging.stg_network_events(batch.drop("_ingest_date"), keep_flags))
        for name, rows_of in FACTS.items():
            commit_fact(rows_of(valid), warehouse, name, delay_seconds)

    writer = raw_stream(spark, warehouse, max_files_per_trigger).writeStream.foreachBatch(write_batch) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
