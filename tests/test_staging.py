import datetime as dt

from pyspark.sql import functions as F

from cellscope import schemas as S
from cellscope.operators import staging


def raw_rows(spark, rows):
    """Build raw rows from partial dicts; unspecified columns get clean defaults."""
    base = dict(event_id="e", event_type="voice_call", event_time_raw="2024-01-01T00:00:00",
                subscriber_id="s1", subscriber_msisdn_masked="+99450***0001", subscriber_plan="prepaid",
                subscriber_activation_date=dt.date(2020, 1, 1), cell_id="C1", cell_region="R1",
                cell_radio_tech="4G", signal_dbm=-80.0, duration_sec=10, call_result="completed",
                data_volume_mb=None, avg_throughput_mbps=None, latency_ms=None, extra="{}",
                _source_object_key="k", _cdc_source_ts_ms=1, _loaded_at=dt.datetime(2024, 1, 1, 1))
    return spark.createDataFrame([{**base, **r} for r in rows], S.RAW_SCHEMA)


def test_timestamp_guard_and_zones(spark):
    raw = raw_rows(spark, [
        dict(event_id="a", event_time_raw="2026-02-30T00:00:00"),
        dict(event_id="b", event_time_raw="2026"),
        dict(event_id="c", event_time_raw="2026-01-31T10:00:00Z"),
        dict(event_id="d", event_time_raw="2026-01-31T10:00:00+02:00"),
        dict(event_id="e", event_time_raw="not-a-timestamp"),
    ])
    out = {r.event_id: r for r in staging.stg_network_events(raw).collect()}
    assert out["a"].event_time is None and out["a"].dq_flags == ["bad_timestamp"]
    assert out["b"].event_time is None and out["b"].dq_flags == ["bad_timestamp"]
    assert out["c"].event_time == dt.datetime(2026, 1, 31, 10, 0)
    assert out["d"].event_time == dt.datetime(2026, 1, 31, 8, 0)
    assert out["e"].dq_flags == ["bad_timestamp"]


def test_signal_range_boundaries(spark):
    raw = raw_rows(spark, [dict(event_id=str(i), signal_dbm=v)
                           for i, v in enumerate([-140.0, -44.0, -140.1, -43.9])])
    out = {r.event_id: r for r in staging.stg_network_events(raw).collect()}
    assert out["0"].dq_flags == [] and out["0"].signal_dbm == -140.0
    assert out["1"].dq_flags == [] and out["1"].signal_dbm == -44.0
    assert out["2"].dq_flags == ["signal_out_of_range"] and out["2"].signal_dbm is None
    assert out["3"].dq_flags == ["signal_out_of_range"] and out["3"].signal_dbm is None


def test_three_corruptions_one_rejected_row(spark):
    raw = raw_rows(spark, [dict(event_id="x", event_time_raw="junk", subscriber_id=None, duration_sec=-5)])
    stg = staging.stg_network_events(raw)
    (row,) = stg.collect()
    assert row.dq_flags == ["bad_timestamp", "missing_subscriber", "negative_duration"]
    assert staging.stg_valid(stg).count() == 0 and staging.stg_rejected(stg).count() == 1


def test_keep_flags_documented_intent(spark):
    raw = raw_rows(spark, [dict(event_id="x", signal_dbm=10.0)])
    stg = staging.stg_network_events(raw, keep_flags=("signal_out_of_range",))
    assert staging.stg_valid(stg).count() == 1
    assert staging.stg_network_events(raw).where("is_valid").count() == 0


def test_volte_promoted_from_extra(spark):
    raw = raw_rows(spark, [dict(event_id="t", extra='{"volte_enabled": true}'),
                           dict(event_id="f", extra='{"volte_enabled": false}'),
                           dict(event_id="o", extra='{"volte_enabled": "on"}'),
                           dict(event_id="n", extra="{}")])
    out = {r.event_id: r.volte_enabled for r in staging.stg_network_events(raw).collect()}
    assert out == {"t": True, "f": False, "o": None, "n": None}


def test_flag_counts(spark):
    raw = raw_rows(spark, [dict(event_id="a", subscriber_id=None), dict(event_id="b", subscriber_id=None),
                           dict(event_id="c", data_volume_mb=-1.0)])
    got = {r.flag: r.row_count for r in staging.flag_counts(staging.stg_network_events(raw)).collect()}
    assert got == {"missing_subscriber": 2, "negative_volume": 1}


def test_msisdn_mask(spark):
    from cellscope.functions import expressions as X
    df = spark.createDataFrame([("+994501234567",), ("+99450***4567",), (None,)], "m string")
    assert [r[0] for r in df.select(X.mask_msisdn("m")).collect()] == ["+99450***4567", "+99450***4567", None]


def test_mask_fails_closed(spark):
    from cellscope.functions import expressions as X

    cases = {"+994501234567": "+99450***4567", "994501234567": "+99450***4567", "0501234567": "+99450***4567",
             "+99450 123 45 67": "+99450***4567", "00994-50-123-45-67": "+99450***4567", "+99450***4567": "+99450***4567",
             "(050) 123.45.67": "+99450***4567", "12345": None, "sim-0501234567": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "m string")
    assert {r.m: r.x for r in df.select("m", X.mask_msisdn("m").alias("x")).collect()} == cases
