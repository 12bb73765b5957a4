"""Hourly cell KPIs (E14) and the per-region daily roll-up.

The KPIs come from partial aggregates per (cell, hour, latency value): counts and sums that add
up, and by their keys the histogram that the exact 95th percentile needs. One shuffle of the
events makes them; a stored set of them merges with that of new rows, so a run doesn't read old
events. The percentile is selected from the histogram (quantiles.py), never from a group in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope import schemas as S
from cellscope.functions import expressions as X
from cellscope.operators.quantiles import exact_quantiles

KPI_KEYS = ["cell_id", "kpi_hour"]
KPI_COUNTS = ["row_count", "call_attempts", "dropped_calls", "failed_setups", "data_sessions", "throughput_n", "signal_n"]
KPI_SUMS = ["volume_sum", "throughput_sum", "signal_sum"]
# latencies have one decimal: 24,414 bins of 4,096 steps cover the column's range
LATENCY_UNIT, LATENCY_SHIFTS = 0.1, (12,)


def kpi_partials(valid: DataFrame, *by: Column) -> DataFrame:
    """Partial aggregates of valid rows: one row per cell, hour of event time and latency (and `by`)."""
    et = F.col("event_type")
    voice, data = et == "voice_call", et == "data_session"
    cr = F.col("call_result")
    fixed = lambda c: F.col(c).cast("decimal(18,6)")
    total = lambda c: F.sum(c).cast("decimal(38,6)")
    return (valid.where(F.col("event_time").isNotNull())
            .groupBy(*by, "cell_id", F.date_trunc("hour", "event_time").alias("kpi_hour"),
                     F.col("latency_ms").cast("double").alias("latency_ms"))
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_if(voice).alias("call_attempts"),
                 F.count_if(voice & (cr == "dropped")).alias("dropped_calls"),
                 F.count_if(voice & (cr == "failed_setup")).alias("failed_setups"),
                 F.count_if(data).alias("data_sessions"),
                 F.count(F.when(data, F.col("avg_throughput_mbps"))).alias("throughput_n"),
                 F.count("signal_dbm").alias("signal_n"),
                 total(F.when(data, fixed("data_volume_mb"))).alias("volume_sum"),
                 total(F.when(data, fixed("avg_throughput_mbps"))).alias("throughput_sum"),
                 total(fixed("signal_dbm")).alias("signal_sum")))


def kpi_from_partials(partials: DataFrame) -> DataFrame:
    """agg_cell_hourly_kpi from partial aggregates, of which a key may have several rows."""
    counted = (partials.groupBy(*KPI_KEYS, "latency_ms")
               .agg(*[F.sum(c).alias(c) for c in KPI_COUNTS], *[F.sum(c).cast("decimal(38,6)").alias(c) for c in KPI_SUMS]))
    return _finish(counted)


def _finish(counted: DataFrame) -> DataFrame:
    agg = (counted.groupBy(*KPI_KEYS)
           .agg(*[F.sum(c).alias(c) for c in KPI_COUNTS], *[F.sum(c).cast("decimal(38,6)").alias(c) for c in KPI_SUMS]))
    p95 = (exact_quantiles(counted, KPI_KEYS, "latency_ms", "row_count", (0.95,), LATENCY_UNIT, LATENCY_SHIFTS)
           .select(F.col("cell_id").alias("_cell"), F.col("kpi_hour").alias("_hour"), F.col("quantiles")[0].alias("p95")))
    joined = agg.join(p95, F.col("cell_id").eqNullSafe(F.col("_cell")) & (F.col("kpi_hour") == F.col("_hour")), "left")
    mean = lambda total, n: F.try_divide(F.col(total), F.col(n).cast("decimal(20,0)"))
    return joined.select(
        "cell_id", "kpi_hour", "call_attempts", "dropped_calls", "failed_setups",
        X.round_half_up(X.exact_ratio(F.col("dropped_calls") + F.col("failed_setups"),
                                      "call_attempts"), 4).alias("drop_rate"),
        "data_sessions",
        F.col("volume_sum").cast("double").alias("total_volume_mb"),
        X.round_half_up(mean("throughput_sum", "throughput_n"), 4).alias("avg_throughput_mbps"),
        F.round("p95", 4).alias("p95_latency_ms"),
        X.round_half_up(mean("signal_sum", "signal_n"), 4).alias("avg_signal_dbm"),
        F.to_date("kpi_hour").alias("kpi_date"))


def cell_hourly_kpi(valid: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """agg_cell_hourly_kpi: one row per cell and hour of event time (valid rows, T17).

    The partials are read three times, each time with other columns; `stage` (a write and a read back)
    saves making them again from the events."""
    partials = kpi_partials(valid)
    return _finish(stage(partials, "kpi-partials") if stage else partials)


def region_quality(valid: DataFrame, period: str = "day", level: str = "cell_region") -> DataFrame:
    """Worst regions (or cells: `level="cell_id"`) per day (or week: `period="week"`, weeks
    start Monday), with the KPI at fault (E16).

    Same score as the cell ranking (drop rate x 100 + latency / 10 - throughput / 10) per
    (level, period); `kpi_at_fault` names the term that most exceeds its best value: drop rate and
    latency above 0, throughput below the period's best (ties in that order, NULL when no term
    costs anything). The rank window is
    partitioned by period and holds one row per region or cell site.
    """
    et = F.col("event_type")
    voice, data = et == "voice_call", et == "data_session"
    agg = (valid.where(et.isin("voice_call", "data_session"))
           .groupBy(level, F.to_date(F.date_trunc(period, "event_time")).alias("event_date"))
           .agg(F.count_if(voice).alias("voice_call_count"),
                F.count_if(voice & F.col("call_result").isin(*S.BAD_CALL_RESULTS)).alias("dropped_or_failed_count"),
                F.count_if(data).alias("data_session_count"),
                X.exact_avg(F.when(data, F.col("avg_throughput_mbps"))).alias("tp"),
                X.exact_avg(F.when(data, F.col("latency_ms"))).alias("lat")))
    zero = F.lit(0).cast("decimal(1,0)")
    drop_rate = X.exact_ratio("dropped_or_failed_count", "voice_call_count")
    drop_term = F.coalesce(drop_rate, zero) * S.DROP_RATE_WEIGHT
    lat_term = F.coalesce(F.col("lat"), zero) / int(S.LATENCY_DIVISOR)
    tp_term = F.coalesce(F.col("tp"), zero) / int(S.THROUGHPUT_DIVISOR)
    best_tp = F.max(tp_term).over(Window.partitionBy("event_date"))
    # a level without data sessions has no throughput that could be at fault
    lost = F.when(F.col("tp").isNotNull(), best_tp - tp_term).otherwise(zero)
    scored = (agg.select("*", drop_rate.alias("drop_rate"), (drop_term + lat_term - tp_term).alias("score"),
                         drop_term.alias("dt"), lat_term.alias("lt"), lost.alias("tt"))
              .withColumn("most", F.greatest("dt", "lt", "tt"))
              .withColumn("kpi_at_fault", F.when(F.col("most") <= 0, F.lit(None))
                          .when(F.col("dt") == F.col("most"), "drop_rate")
                          .when(F.col("lt") == F.col("most"), "latency").otherwise("throughput")))
    by_day = Window.partitionBy("event_date").orderBy(F.col("score").desc())
    return scored.select(
        level, "event_date",
        F.col("voice_call_count").cast("long").alias("voice_call_count"),
        F.col("dropped_or_failed_count").cast("long").alias("dropped_or_failed_count"),
        X.round_half_up("drop_rate", 4).alias("drop_rate"),
        F.col("data_session_count").cast("long").alias("data_session_count"),
        X.round_half_up("tp", 2).alias("avg_throughput_mbps"),
        X.round_half_up("lat", 2).alias("avg_latency_ms"),
        X.round_half_up("score", 4).alias("quality_score"),
        "kpi_at_fault",
        F.rank().over(by_day).alias("day_rank"))
