"""Streaming load of newly landed lake objects into the raw table.

The file source's checkpoint knows which files it has handed out: each is processed once, a
restart continues with the files not yet committed (W6). Every micro-batch is committed by the
batch loader's own code, so both share one object ledger, one quarantine and the keep-first
insert: objects that a batch load recorded are skipped, `load_date` skips what the stream loaded,
and a batch that is replayed after a crash adds nothing. The insert is also the duplicate
suppression (W4): it compares ids with the whole raw table, however late a re-delivery is, and
never drops a first delivery.

A bad object doesn't stop the stream. Under "quarantine" its bad lines go to the quarantine and
the rest is loaded. Under "failfast" it stays out as a whole and is listed in `raw/_failed_objects`;
not being in the ledger, it is tried again by `load_date`, which ends with an error while it is bad.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellscope.operators import ingest
from cellscope.plans import publish
from cellscope.plans import load
from cellscope.sources import lake


def lake_stream(spark: SparkSession, lake_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New lake files as a stream of lines with their object key."""
    reader = spark.readStream.schema(lake.LAKE_PARTITIONS).option("basePath", lake.lake_dir(lake_root))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lake.ensure_dir(spark, lake.lake_dir(lake_root))     # may start before the first landing
    lines = reader.text(lake.lake_dir(lake_root))
    return (lines.where(F.trim("value") != "")
            .select("value", "dt", "hr", lake.object_key_of(F.col("_metadata.file_path")).alias("object_key")))


def commit_batch(batch: DataFrame, warehouse: str, on_malformed: str, name: str) -> None:
    """Load the lines of one micro-batch (value, dt, hr, object_key)."""
    spark = batch.sparkSession
    # read once from the lake; the dates of a batch are few
    with publish.staged(batch, "batch") as lines:
        dates = [r["dt"] for r in lines.select("dt").distinct().collect()]
        fresh = ingest.objects_to_load(lines.select("object_key").distinct(), load.ledger(spark, warehouse, dates))
        with publish.staged(fresh, "batch-objects") as todo:
            if todo.isEmpty():
                return
            parsed = load.parse_lines(lines.join(todo, "object_key", "left_semi"), "quarantine")
            with publish.staged(parsed, "batch-parsed") as parsed:
                _, failed = load.store(spark, warehouse, parsed, todo, on_malformed, name)
                known = publish.read_table(spark, load.failed_path(warehouse), failed)
                new = failed.join(known.select("object_key"), "object_key", "left_anti")
                if not new.isEmpty():
                    publish.append(new.select("object_key", "example", F.current_timestamp().alias("failed_at"),
                                              ingest.object_date("object_key").alias("_ingest_date")),
                                   load.failed_path(warehouse), ("_ingest_date",))


def stream_load(spark: SparkSession, lake_root: str, warehouse: str, checkpoint: str, available_now: bool = True,
                max_files_per_trigger: int | None = None, on_malformed: str = "failfast") -> StreamingQuery:
    """Load landed objects continuously (or drain them once with `available_now`)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, warehouse, on_malformed, f"batch-{batch_id}")

    lines = lake_stream(spark, lake_root, max_files_per_trigger)
    writer = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
