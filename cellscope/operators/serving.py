"""Serving: which cells need attention, which subscribers show churn signals.

"Now" is defined by the data: the latest event time over both facts (E1). It is resolved
once to a literal (`reference_time_value`, one aggregate over the `event_time` column) and
inlined, never joined. As a literal, the trailing windows become plain range predicates:
Parquet pushdown applies, and on published facts (partitioned by `event_date`) a derived
`event_date` bound prunes every partition outside the window. `reference_time_df()` keeps the
scalar-subquery form for callers that want a single lazy plan.

Both views are written as one aggregate each (instead of two aggregates plus outer joins):
conditional counts over the union of the facts, grouped once by the view's key. The
aggregates combine map-side, so a hot cell or subscriber costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope import schemas as S
from cellscope.functions import expressions as X
from cellscope.operators.curated import voice_and_data_events


def reference_time_df(voice: DataFrame, data: DataFrame) -> DataFrame:
    """One row, one column `reference_time`: max event time over both facts."""
    times = voice.select("event_time").unionByName(data.select("event_time"))
    return times.agg(F.max("event_time").alias("reference_time"))


def reference_time_value(voice: DataFrame, data: DataFrame) -> Column:
    """E1 resolved to a TIMESTAMP literal (NULL when both facts are empty, T16)."""
    value = reference_time_df(voice, data).first()[0]
    return F.lit(value).cast("timestamp")


def _in_window(df: DataFrame, ref: Column, days: int) -> DataFrame:
    """Rows with event_time in (ref - days, ref]; prunes `event_date` partitions if present."""
    out = df.where(X.in_trailing_window("event_time", ref, days))
    if "event_date" in df.columns:
        lo = F.to_date(ref - F.make_interval(days=F.lit(days)))
        out = out.where((F.col("event_date") >= lo) & (F.col("event_date") <= F.to_date(ref)))
    return out


def voice_agg(voice: DataFrame, ref: Column) -> DataFrame:
    """Voice calls and dropped/failed calls per cell in the trailing window."""
    return (_in_window(voice, ref, S.RANKING_WINDOW_DAYS)
            .groupBy("cell_id")
            .agg(F.count(F.lit(1)).alias("voice_call_count"),
                 F.count_if(F.col("call_result").isin(*S.BAD_CALL_RESULTS)).alias("dropped_or_failed_count")))


def data_agg(data: DataFrame, ref: Column) -> DataFrame:
    """Data sessions, mean throughput and latency per cell in the trailing window."""
    return (_in_window(data, ref, S.RANKING_WINDOW_DAYS)
            .groupBy("cell_id")
            .agg(F.count(F.lit(1)).alias("data_session_count"),
                 X.exact_avg("avg_throughput_mbps").alias("avg_throughput_mbps"),
                 X.exact_avg("latency_ms").alias("avg_latency_ms")))


def cell_quality_ranking(voice: DataFrame, data: DataFrame, dim_cell: DataFrame,
                         ref: Column | None = None, rank_on_rounded: bool = False) -> DataFrame:
    """Cells ranked by a higher-is-worse quality score over the last 7 days.

    score = drop_rate * 100 + mean latency / 10 - mean throughput / 10, missing terms as 0.
    Cells without traffic in the window are left out (C6). The rank is computed over the
    unrounded score (T10) unless `rank_on_rounded`. The final rank is a window without
    partition over one row per cell: its size is the number of cell sites, not events.
    """
    ref = reference_time_value(voice, data) if ref is None else ref
    voice, data = _in_window(voice, ref, S.RANKING_WINDOW_DAYS), _in_window(data, ref, S.RANKING_WINDOW_DAYS)
    v = voice.select("event_time", "cell_id", "call_result",
                     F.lit(None).cast("double").alias("avg_throughput_mbps"),
                     F.lit(None).cast("double").alias("latency_ms"), F.lit(True).alias("is_voice"))
    d = data.select("event_time", "cell_id", F.lit(None).cast("string").alias("call_result"),
                    "avg_throughput_mbps", "latency_ms", F.lit(False).alias("is_voice"))
    ev = v.unionByName(d)
    is_voice = F.col("is_voice")
    agg = ev.groupBy("cell_id").agg(
        F.count_if(is_voice).alias("voice_call_count"),
        F.count_if(is_voice & F.col("call_result").isin(*S.BAD_CALL_RESULTS)).alias("dropped_or_failed_count"),
        F.count_if(~is_voice).alias("data_session_count"),
        X.exact_avg("avg_throughput_mbps").alias("avg_throughput_mbps"),
        X.exact_avg("latency_ms").alias("avg_latency_ms"),
    )
    # inner join == dim LEFT JOIN agg followed by the traffic filter
    cells = dim_cell.select("cell_id", "cell_region", "cell_radio_tech").join(agg, "cell_id")
    # exact decimal arithmetic as in the source system (T5): rounding and ranking see exact
    # digits, not floating-point noise that depends on the merge order of partial sums
    zero = F.lit(0).cast("decimal(1,0)")
    drop_rate = X.exact_ratio("dropped_or_failed_count", "voice_call_count")
    score = (F.coalesce(drop_rate, zero) * S.DROP_RATE_WEIGHT
             + F.coalesce(F.col("avg_latency_ms"), zero) / int(S.LATENCY_DIVISOR)
             - F.coalesce(F.col("avg_throughput_mbps"), zero) / int(S.THROUGHPUT_DIVISOR))
    scored = cells.select("*", drop_rate.alias("drop_rate"), score.alias("score"))
    rank_key = F.round("score", 4) if rank_on_rounded else F.col("score")
    return (scored.select(
        "cell_id", "cell_region", "cell_radio_tech",
        F.col("voice_call_count").cast("long").alias("voice_call_count"),
        F.col("dropped_or_failed_count").cast("long").alias("dropped_or_failed_count"),
        X.round_half_up("drop_rate", 4).alias("drop_rate"),
        F.col("data_session_count").cast("long").alias("data_session_count"),
        X.round_half_up("avg_throughput_mbps", 2).alias("avg_throughput_mbps"),
        X.round_half_up("avg_latency_ms", 2).alias("avg_latency_ms"),
        X.round_half_up("score", 4).alias("quality_score"),
        F.rank().over(Window.orderBy(rank_key.desc())).alias("quality_rank"))
        .orderBy("quality_rank", "cell_id"))


def _subscriber_events(voice: DataFrame, data: DataFrame, dim_cell: DataFrame) -> DataFrame:
    """Voice and data events of known subscribers with the cell's current technology.

    The dimension has one row per cell site; Spark broadcasts it when its measured size is
    under the broadcast threshold and falls back to a shuffle join otherwise.
    """
    ev = voice_and_data_events(voice, data).where(F.col("subscriber_id").isNotNull())
    return ev.join(dim_cell.select("cell_id", "cell_radio_tech"), "cell_id", "left")


def _poor_experience(e_time: Column, ref: Column) -> Column:
    """dropped/failed call, or a slow data session on 4G/5G, in the last 14 days."""
    poor = (F.col("call_result").isin(*S.BAD_CALL_RESULTS)
            | (F.col("latency_ms").isNotNull() & (F.col("latency_ms") > S.POOR_LATENCY_MS)
               & F.col("cell_radio_tech").isin(*S.POOR_LATENCY_TECHS)))
    return X.in_trailing_window(e_time, ref, S.POOR_WINDOW_DAYS) & poor


def subscriber_signals(voice: DataFrame, data: DataFrame, dim_cell: DataFrame,
                       ref: Column | None = None, recent_only: bool = True) -> DataFrame:
    """Per subscriber: last-7-day activity, prior-4-week activity, poor events in 14 days.

    One aggregate replaces activity + poor-experience + their outer join (E4, E5, D4). With
    `recent_only`, events older than the 35-day baseline are pruned before the shuffle; such
    subscribers can never be flagged, so the churn view is unchanged.
    """
    ref = reference_time_value(voice, data) if ref is None else ref
    if recent_only:
        voice = _in_window(voice, ref, S.BASELINE_WINDOW_DAYS)
        data = _in_window(data, ref, S.BASELINE_WINDOW_DAYS)
    ev = _subscriber_events(voice, data, dim_cell)
    t = F.col("event_time")
    return ev.groupBy("subscriber_id").agg(
        F.count_if(X.in_trailing_window(t, ref, S.ACTIVITY_WINDOW_DAYS)).alias("last_7_day_activity"),
        F.count_if(X.in_trailing_window(t, ref, S.BASELINE_WINDOW_DAYS, S.ACTIVITY_WINDOW_DAYS)).alias("prior_28_day_activity"),
        F.count_if(_poor_experience(t, ref)).alias("poor_experience_count_14d"),
    )


def subscriber_activity(voice: DataFrame, data: DataFrame, ref: Column | None = None) -> DataFrame:
    """E4 on its own: every subscriber with a voice/data event, both activity counts."""
    ref = reference_time_value(voice, data) if ref is None else ref
    ev = voice_and_data_events(voice, data).where(F.col("subscriber_id").isNotNull())
    t = F.col("event_time")
    return ev.groupBy("subscriber_id").agg(
        F.count_if(X.in_trailing_window(t, ref, S.ACTIVITY_WINDOW_DAYS)).alias("last_7_day_activity"),
        F.round(F.count_if(X.in_trailing_window(t, ref, S.BASELINE_WINDOW_DAYS, S.ACTIVITY_WINDOW_DAYS))
                / F.lit(float(S.BASELINE_WEEKS)), 2).alias("trailing_4_week_weekly_avg_activity"))


def poor_experience(voice: DataFrame, data: DataFrame, dim_cell: DataFrame,
                    ref: Column | None = None) -> DataFrame:
    """E5 on its own: subscribers with at least one poor-experience event in 14 days."""
    ref = reference_time_value(voice, data) if ref is None else ref
    voice = _in_window(voice, ref, S.POOR_WINDOW_DAYS)
    data = _in_window(data, ref, S.POOR_WINDOW_DAYS)
    ev = _subscriber_events(voice, data, dim_cell).where(_poor_experience(F.col("event_time"), ref))
    return ev.groupBy("subscriber_id").agg(F.count(F.lit(1)).alias("poor_experience_count"))


def churn_signals(voice: DataFrame, data: DataFrame, dim_cell: DataFrame, dim_sub: DataFrame,
                  ref: Column | None = None) -> DataFrame:
    """Subscribers with a usage drop AND repeated poor experience, with their current plan.

    usage drop (E10): baseline > 0 and last-7 <= 0.6 * baseline, where baseline is the
    prior-28-day count / 4; evaluated exactly in integers as 20 * last7 <= 3 * prior28.
    poor experience (E11): at least 3 poor events in 14 days.
    `dim_sub` is the plan history (its `is_current` rows are joined, D5) or, equivalently and
    cheaper when no history is at hand, `curated.current_plans(valid)`.
    """
    sig = subscriber_signals(voice, data, dim_cell, ref)
    l7, p28, poor = F.col("last_7_day_activity"), F.col("prior_28_day_activity"), F.col("poor_experience_count_14d")
    usage_drop = (p28 > 0) & (l7 * (S.USAGE_DROP_RATIO_DEN * S.BASELINE_WEEKS) <= p28 * S.USAGE_DROP_RATIO_NUM)
    poor_flag = poor >= S.POOR_EVENTS_THRESHOLD
    flagged = (sig.select("subscriber_id", l7.cast("long").alias("last_7_day_activity"),
                          F.round(p28 / F.lit(float(S.BASELINE_WEEKS)), 2).alias("trailing_4_week_weekly_avg_activity"),
                          poor.cast("long").alias("poor_experience_count_14d"),
                          usage_drop.alias("usage_drop_flag"), poor_flag.alias("poor_experience_flag"))
               .where(F.col("usage_drop_flag") & F.col("poor_experience_flag")))
    current = dim_sub.where(F.col("is_current")).select("subscriber_id", "plan")
    return (flagged.join(current, "subscriber_id")
            .select("subscriber_id", "plan", "last_7_day_activity", "trailing_4_week_weekly_avg_activity",
                    "poor_experience_count_14d", "usage_drop_flag", "poor_experience_flag")
            .orderBy(F.col("poor_experience_count_14d").desc(), F.col("last_7_day_activity").asc(),
                     F.col("subscriber_id").asc()))
