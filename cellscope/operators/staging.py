"""Staging: typed, flagged 1:1 view of the raw table and its valid / rejected split.

Row-local only (no shuffle): every expression stays in one whole-stage-codegen span over the
raw scan. Nothing is dropped here; a row is routed by its `dq_flags`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope import schemas as S
from cellscope.functions import expressions as X


def stg_network_events(raw: DataFrame, keep_flags: tuple[str, ...] = ()) -> DataFrame:
    """raw.network_events -> typed + flagged rows.

    `keep_flags` names flags that do not reject a row (the documented intent for
    `signal_out_of_range`, T1); they are still listed in `dq_flags`. Default: reference code
    behaviour, any flag rejects. The split decision is materialised as `is_valid` so that it
    is a plain boolean column (pushable when staging is written out), unlike an array test.
    """
    event_time = X.guarded_timestamp("event_time_raw")
    typed = raw.select(
        "event_id", "event_type", event_time.alias("event_time"), "subscriber_id",
        "subscriber_msisdn_masked", "subscriber_plan", "subscriber_activation_date", "cell_id",
        "cell_region", "cell_radio_tech", F.col("signal_dbm").alias("signal_dbm_raw"),
        "duration_sec", "call_result", "data_volume_mb", "avg_throughput_mbps", "latency_ms",
        X.json_bool("extra", "volte_enabled").alias("volte_enabled"), "extra",
        "_source_object_key", "_cdc_source_ts_ms", "_loaded_at",
    )
    flags = X.dq_flags("event_time", "subscriber_id", "duration_sec", "data_volume_mb",
                       "signal_dbm_raw")
    flagged = typed.withColumn("dq_flags", flags)
    signal = F.when(F.array_contains("dq_flags", "signal_out_of_range"), F.lit(None).cast("double")) \
        .otherwise(F.col("signal_dbm_raw"))
    if keep_flags:
        blocking = F.filter("dq_flags", lambda f: ~f.isin(*keep_flags))
        is_valid = F.size(blocking) == 0
    else:
        is_valid = F.size("dq_flags") == 0
    return flagged.select(
        *[signal.alias("signal_dbm") if c == "signal_dbm" else F.col(c) for c in S.STAGING_COLUMNS],
        is_valid.alias("is_valid"),
    )


def stg_valid(stg: DataFrame) -> DataFrame:
    """Rows without any (blocking) flag: the only input of curated."""
    return stg.where(F.col("is_valid")).drop("is_valid")


def stg_rejected(stg: DataFrame) -> DataFrame:
    """Rows with at least one (blocking) flag, kept for audit."""
    return stg.where(~F.col("is_valid")).drop("is_valid")


def flag_counts(stg: DataFrame) -> DataFrame:
    """Rows per data-quality flag (Q2-Q5, Q11): explode + partial aggregation."""
    return (stg.select(F.explode("dq_flags").alias("flag"))
            .groupBy("flag").agg(F.count(F.lit(1)).alias("row_count")))


def with_flag_text(stg: DataFrame) -> DataFrame:
    """`dq_flags` rendered as comma-joined text, for comparisons with other engines."""
    return stg.withColumn("dq_flags", F.array_join("dq_flags", ","))
