import datetime as dt

from pyspark.sql import functions as F

from cellscope.operators import serving

T = dt.datetime(2024, 1, 30, 12)
VOICE = "event_id string, event_time timestamp, subscriber_id string, cell_id string, call_result string, duration_sec int, signal_dbm double"
DATA = ("event_id string, event_time timestamp, subscriber_id string, cell_id string, data_volume_mb double, "
        "avg_throughput_mbps double, latency_ms double, signal_dbm double")
DIM = "cell_id string, cell_region string, cell_radio_tech string, last_seen_at timestamp"


def facts(spark, voice=(), data=()):
    return spark.createDataFrame(list(voice), VOICE), spark.createDataFrame(list(data), DATA)


def test_voice_only_data_only_sms_only_cells(spark):
    voice, data = facts(spark,
                        voice=[("v1", T, "s", "CV", "dropped", 1, -80.0), ("v2", T, "s", "CV", "completed", 1, -80.0)],
                        data=[("d1", T, "s", "CD", 1.0, 50.0, 20.0, -80.0)])
    dim = spark.createDataFrame([("CV", "R", "4G", T), ("CD", "R", "4G", T), ("CS", "R", "4G", T)], DIM)
    got = {r.cell_id: r for r in serving.cell_quality_ranking(voice, data, dim).collect()}
    assert set(got) == {"CV", "CD"}
    assert got["CV"].quality_score == 50.0 and got["CV"].drop_rate == 0.5 and got["CV"].avg_latency_ms is None
    assert got["CD"].quality_score == -3.0 and got["CD"].drop_rate is None
    assert got["CV"].quality_rank == 1 and got["CD"].quality_rank == 2


def test_equal_scores_share_rank_and_skip(spark):
    voice, data = facts(spark, voice=[("a", T, "s", "C1", "dropped", 1, None), ("b", T, "s", "C2", "dropped", 1, None),
                                      ("c", T, "s", "C3", "completed", 1, None)])
    dim = spark.createDataFrame([(c, "R", "4G", T) for c in ("C1", "C2", "C3")], DIM)
    got = {r.cell_id: r.quality_rank for r in serving.cell_quality_ranking(voice, data, dim).collect()}
    assert got == {"C1": 1, "C2": 1, "C3": 3}


def test_window_is_half_open(spark):
    voice, data = facts(spark, voice=[("new", T, "s", "C1", "completed", 1, None),
                                      ("edge", T - dt.timedelta(days=7), "s", "C1", "dropped", 1, None)])
    dim = spark.createDataFrame([("C1", "R", "4G", T)], DIM)
    (row,) = serving.cell_quality_ranking(voice, data, dim).collect()
    assert row.voice_call_count == 1 and row.dropped_or_failed_count == 0


def test_empty_facts_give_empty_views(spark):
    voice, data = facts(spark)
    dim = spark.createDataFrame([], DIM)
    dim_sub = spark.createDataFrame([], "subscriber_id string, plan string, is_current boolean")
    assert serving.cell_quality_ranking(voice, data, dim).count() == 0
    assert serving.churn_signals(voice, data, dim, dim_sub).count() == 0


def _churn_case(spark, last7, prior28, poor_latency, tech="4G"):
    v, d = [], []
    for i in range(last7):
        d.append((f"l{i}", T - dt.timedelta(days=1, minutes=i), "s", "C1", 1.0, 10.0, poor_latency, None))
    for i in range(prior28):
        d.append((f"p{i}", T - dt.timedelta(days=10, minutes=i), "s", "C1", 1.0, 10.0, 20.0, None))
    v.append(("anchor", T, "other", "C1", "completed", 1, None))
    voice, data = facts(spark, v, d)
    dim = spark.createDataFrame([("C1", "R", tech, T)], DIM)
    dim_sub = spark.createDataFrame([("s", "prepaid", True), ("other", "prepaid", True)],
                                    "subscriber_id string, plan string, is_current boolean")
    return serving.churn_signals(voice, data, dim, dim_sub).collect()


def test_usage_drop_equality_is_flagged(spark):
    # last-7 = 3, prior-28 = 20 -> baseline 5, 3 <= 0.6 * 5 holds exactly
    got = _churn_case(spark, 3, 20, 150.0)
    assert [(r.subscriber_id, r.last_7_day_activity, r.trailing_4_week_weekly_avg_activity) for r in got] == [("s", 3, 5.0)]


def test_no_baseline_not_flagged(spark):
    assert _churn_case(spark, 3, 0, 150.0) == []


def test_latency_boundaries(spark):
    assert _churn_case(spark, 3, 20, 100.0) == []          # exactly 100 ms is not poor
    assert _churn_case(spark, 3, 20, 150.0, tech="3G") == []  # slow 3G is not counted
