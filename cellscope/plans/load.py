"""Batch load of one logical date from the lake into the raw table.

Idempotent at two levels, like the source system:
* object level: objects recorded in the ledger are not read again (A10);
* row level: an `event_id` already in the raw table is not inserted again (A11).

An object is loaded as a whole or not at all (A12): under `failfast` one line that can't be
stored keeps its object out, the sound objects are committed, and the run ends with an error
that names the others. Under `quarantine` such lines go to `raw/_quarantine` and the rest of
their object is loaded.

Write order is quarantine, rows, ledger. A run that dies in between leaves objects unrecorded;
the next run reads them again, and anti-joins drop every quarantined line and every row that
already landed, so replays are harmless. Spark's commit protocol makes each append
all-or-nothing, so a lost executor only retries tasks, never publishes half a write.

Tables (Parquet, under `warehouse`):
* `raw/network_events`, partitioned by `_ingest_date` (the object's `dt`);
* `raw/_loaded_objects` (object_key, loaded_at), partitioned by `_ingest_date`;
* `raw/_event_ids`, the ids of the raw table in hash buckets (keys.py), which new ids are compared with;
* `raw/_quarantine` (_source_object_key, _corrupt_record), partitioned by `_ingest_date`;
* `raw/_failed_objects` (object_key, example, failed_at), partitioned by `_ingest_date`: objects that the
  streaming load left out; `load_date` tries them again, since they aren't in the ledger.

The batch and the streaming load share this code, the ledger and the quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellscope import schemas as S
from cellscope.operators import ingest
from cellscope.plans import keys, publish
from cellscope.sources import cdc, lake


@dataclass(frozen=True)
class LoadResult:
    date: str
    objects_seen: int
    objects_loaded: int
    objects_skipped: int
    rows_inserted: int


class MalformedObjects(RuntimeError):
    """Some objects hold lines that can't be stored; every other object has been loaded."""

    def __init__(self, result: LoadResult, failed: int, examples: list[str]):
        super().__init__(f"{failed} object(s) not loaded, for example {', '.join(examples)}")
        self.result = result


def raw_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/raw/network_events"


def ledger_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/raw/_loaded_objects"


def quarantine_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/raw/_quarantine"


def failed_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/raw/_failed_objects"


def ledger(spark: SparkSession, warehouse: str, dates: list[str]) -> DataFrame:
    """Objects of these dates that are loaded already."""
    found = publish.read_table(spark, ledger_path(warehouse))
    if found is None or not dates:
        return spark.createDataFrame([], "object_key string")
    return found.where(F.col("_ingest_date").cast("string").isin(*dates)).select("object_key")


def parse_lines(lines: DataFrame, on_malformed: str = "failfast", contract_types: bool = True) -> DataFrame:
    """Landed lines -> raw rows (A3, A9, B2-B5); `_loaded_at` is the run's start time (T4).

    `contract_types` stores the measures as the raw contract's fixed-point decimals."""
    unwrapped = cdc.unwrap(lines, on_malformed=on_malformed)
    rows = cdc.record_to_raw(unwrapped, object_key=F.col("object_key"), on_malformed=on_malformed) \
        .withColumn("_ingest_date", ingest.object_date("_source_object_key"))
    return ingest.cast_to_contract_decimals(rows) if contract_types else rows


def store(spark: SparkSession, warehouse: str, parsed: DataFrame, todo: DataFrame, on_malformed: str,
          name: str) -> tuple[int, DataFrame]:
    """Commit the parsed lines of the objects `todo`: quarantine, rows, ledger, in this order.

    `parsed` (materialised, with `_corrupt_record`) and `todo` (object_key) are read several times.
    Under "quarantine" bad lines are kept aside and the rest of their objects loaded; else
    objects with bad lines stay out as a whole. Returns the rows inserted and the objects left out
    (object_key, example). Running it again for the same lines adds nothing."""
    bad = parsed.where(F.col("_corrupt_record").isNotNull())
    rows = parsed.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    failed = bad.groupBy(F.col("_source_object_key").alias("object_key")).agg(F.min("_corrupt_record").alias("example"))
    if on_malformed == "quarantine":
        line = ["_source_object_key", "_corrupt_record"]
        held = publish.read_table(spark, quarantine_path(warehouse), bad)
        new_bad = bad.select(*line, "_ingest_date").distinct().join(held.select(*line), line, "left_anti")
        publish.append(new_bad, quarantine_path(warehouse), ("_ingest_date",))
        failed = failed.limit(0)
    else:
        out = failed.select("object_key")
        rows = rows.join(out.withColumnRenamed("object_key", "_source_object_key"), "_source_object_key", "left_anti")
        todo = todo.join(out, "object_key", "left_anti")

    ids = keys.cover(spark, warehouse, raw_path(warehouse))
    first = ingest.keep_first(rows.withColumn("_loaded_at", F.current_timestamp()))
    # staged: behind the shuffles of keep_first the join would move the stored ids instead of the batch
    with publish.staged(first.select(*S.RAW_COLUMNS, "_ingest_date"), "first") as first:
        # the inserted-row count is a metric of the append itself: no second pass over the rows
        counter = Observation(f"load-{name}")
        new = first.join(ids, keys.KEY, "left_anti").observe(counter, F.count(F.lit(1)).alias("rows"))
        publish.append(new, raw_path(warehouse), ("_ingest_date",))
    keys.cover(spark, warehouse, raw_path(warehouse))

    loaded = todo.select("object_key", F.current_timestamp().alias("loaded_at"), ingest.object_date("object_key").alias("_ingest_date"))
    publish.append(loaded, ledger_path(warehouse), ("_ingest_date",))
    return int(counter.get["rows"]), failed


def load_date(spark: SparkSession, lake_root: str, warehouse: str, date: str,
              on_malformed: str = "failfast", contract_types: bool = True) -> LoadResult:
    """Load every not-yet-loaded object under `dt=<date>/` into the raw table.

    The listing, the ledger and the objects' lines meet in joins on the object key; only counts
    come to the driver. New ids are checked against the whole raw table, like a primary key.
    """
    objects, done = lake.objects(spark, lake_root, date), ledger(spark, warehouse, [date])
    with publish.staged(ingest.objects_to_load(objects, done), "objects") as todo:
        seen, n_todo = objects.count(), todo.count()
        if not n_todo:
            return LoadResult(date, seen, 0, seen, 0)
        lines = lake.read_lines(spark, lake_root, date=date).join(todo, "object_key", "left_semi")
        with publish.staged(parse_lines(lines, "quarantine", contract_types), "parsed") as parsed:
            inserted, failed = store(spark, warehouse, parsed, todo, on_malformed, date)
            n_failed = failed.count()
            result = LoadResult(date, seen, n_todo - n_failed, seen - n_todo, inserted)
            if n_failed:
                raise MalformedObjects(result, n_failed, [r[0] for r in failed.orderBy("object_key").limit(5).collect()])
    return result
