"""Loading landed change records into the raw table: keep-first, object ledger, report.

The raw table's key is `event_id`, first delivery wins (A11, I6, T6). "First" is the order
of (`_source_object_key` as text, `_cdc_source_ts_ms`); line position inside an object is not
kept by Spark, so it is not part of the rule.

Keep-first counts deliveries per `event_id` first, which combines map-side on fixed-width
buffers; only ids delivered more than once go through a `min(struct(order, payload))`
aggregate, so the payload of the many single deliveries is never sorted. Against the existing
table it is a left-anti join on `event_id`. Rows without an id can't be keyed: they are
rejected while the records are decoded, and `keep_first` refuses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope import schemas as S

ORDER_COLUMNS = ("_source_object_key", "_cdc_source_ts_ms")


def object_date(key) -> F.Column:
    """Logical date of a lake object, from its `dt=` path segment."""
    key = F.col(key) if isinstance(key, str) else key
    return F.regexp_extract(key, r"dt=(\d{4}-\d{2}-\d{2})", 1)


def keep_first(batch: DataFrame, target: DataFrame | None = None, key: str = "event_id",
               order: tuple[str, ...] = ORDER_COLUMNS) -> DataFrame:
    """Rows of `batch` that a keyed insert-if-absent would store.

    One row per key (the first by `order`), minus keys already present in `target`.
    """
    payload = [c for c in batch.columns if c != key and c not in order]
    batch = batch.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"row without {key}")))
                             .otherwise(F.col(key)))
    repeated = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload]))
    again = (batch.join(repeated, key, "left_semi").groupBy(key).agg(first.alias("_first"))
             .select(key, "_first.*").select(*batch.columns))
    kept = batch.join(repeated, key, "left_anti").select(*batch.columns).unionByName(again)
    if target is not None:
        kept = kept.join(target.select(key), key, "left_anti")
    return kept


def objects_to_load(objects: DataFrame, ledger: DataFrame, key: str = "object_key") -> DataFrame:
    """A10: objects not yet recorded in the ledger."""
    return objects.join(ledger.select(key), key, "left_anti")


def load_report(objects: DataFrame, ledger: DataFrame, inserted: DataFrame,
                key: str = "object_key") -> DataFrame:
    """Per logical date, objects seen / loaded / skipped and rows inserted.

    `objects` lists the objects seen, `ledger` those loaded before the run, `inserted` the
    rows stored by the run (with `_source_object_key`). Every input is reduced per date first.
    """
    seen = objects.select(key).distinct()
    marked = seen.join(ledger.select(key).distinct().withColumn("_skipped", F.lit(True)), key, "left")
    per_obj = marked.groupBy(object_date(key).alias("load_date")).agg(
        F.count(F.lit(1)).alias("objects_seen"),
        F.count_if(F.col("_skipped").isNull()).alias("objects_loaded"),
        F.count_if(F.col("_skipped").isNotNull()).alias("objects_skipped"))
    rows = inserted.groupBy(object_date("_source_object_key").alias("load_date")).agg(
        F.count(F.lit(1)).alias("rows_inserted"))
    return (per_obj.join(rows, "load_date", "left")
            .select("load_date", "objects_seen", "objects_loaded", "objects_skipped",
                    F.coalesce("rows_inserted", F.lit(0)).cast("long").alias("rows_inserted")))


def ingest_hour_partitions(messages: DataFrame, ts_ms_col: str) -> DataFrame:
    """A4: rows per UTC ingestion (dt, hr), taken per message from its own time."""
    ts = F.timestamp_millis(F.col(ts_ms_col))
    return (messages.groupBy(F.date_format(ts, "yyyy-MM-dd").alias("dt"), F.date_format(ts, "HH").alias("hr"))
            .agg(F.count(F.lit(1)).alias("row_count")))


def cast_to_contract_decimals(raw: DataFrame) -> DataFrame:
    """Cast measures to the warehouse's fixed-point types (signal 6,1; volume 12,2;
    throughput 8,2; latency 8,1), rounding half up as a fixed-point column does on insert.
    Values that do not fit are rejected while the records are decoded (`cdc.unfit`)."""
    return raw.select(*[F.col(c).try_cast(S.RAW_DECIMALS[c]).alias(c) if c in S.RAW_DECIMALS else F.col(c)
                        for c in raw.columns])
