import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cellscope import schemas as S
from cellscope.operators import ingest
from cellscope.sources import cdc

RECORD = dict(event_id="e1", event_type="voice_call", event_time_raw="2024-08-01T10:00:00",
              subscriber_id="s1", subscriber_msisdn_masked="+99450***1234", subscriber_plan="prepaid",
              subscriber_activation_date=19936, cell_id="BAK-0001", cell_region="Baku",
              cell_radio_tech="LTE", signal_dbm=-80.5, duration_sec=12, call_result="completed",
              data_volume_mb=None, avg_throughput_mbps=None, latency_ms=None, __source_ts_ms=1722506400000)


def decode(spark, values):
    msgs = spark.createDataFrame([(v,) for v in values], "value string")
    return cdc.record_to_raw(cdc.unwrap(cdc.drop_tombstones(msgs))).collect()


def test_known_columns_and_epoch_day(spark):
    (row,) = decode(spark, [json.dumps(RECORD)])
    for c in S.RECORD_COLUMNS:
        if c != "subscriber_activation_date":
            assert row[c] == RECORD[c], c
    assert row.subscriber_activation_date == dt.date(2024, 8, 1)
    assert row._cdc_source_ts_ms == 1722506400000
    assert json.loads(row.extra) == {}


def test_epoch_day_string_and_null(spark):
    rows = decode(spark, [json.dumps({"event_id": "a", "subscriber_activation_date": "2024-07-01"}),
                          json.dumps({"event_id": "b", "subscriber_activation_date": None}),
                          json.dumps({"event_id": "c"})])
    got = {r.event_id: r.subscriber_activation_date for r in rows}
    assert got == {"a": dt.date(2024, 7, 1), "b": None, "c": None}


def test_drift_keys_go_to_extra_and_metadata_is_removed(spark):
    rec = dict(RECORD, promo_code="SPRING26", inserted_at="2024-08-01T10:00:01",
               extra=json.dumps({"volte_enabled": True, "probe": {"fw": 2}}))
    (row,) = decode(spark, [json.dumps(rec)])
    assert json.loads(row.extra) == {"volte_enabled": True, "probe": {"fw": 2}, "promo_code": "SPRING26"}


def test_envelope_and_flat_shapes_and_tombstones(spark):
    after = {k: v for k, v in RECORD.items() if k != "__source_ts_ms"}
    env = json.dumps({"before": None, "after": dict(after, event_id="env"), "source": {"ts_ms": 5}, "op": "c"})
    delete = json.dumps({"before": {"event_id": "gone"}, "after": None, "source": {"ts_ms": 6}, "op": "d"})
    rows = decode(spark, [env, json.dumps(RECORD), None, delete])
    got = {r.event_id: r._cdc_source_ts_ms for r in rows}
    assert got == {"env": 5, "e1": 1722506400000}


def test_malformed_line_fails_fast(spark):
    msgs = spark.createDataFrame([(json.dumps(RECORD),), ("{not json",)], "value string")
    with pytest.raises(Exception):
        cdc.record_to_raw(cdc.unwrap(msgs)).collect()


def test_malformed_line_quarantined(spark):
    msgs = spark.createDataFrame([(json.dumps(RECORD),), ("{not json",)], "value string")
    out = cdc.record_to_raw(cdc.unwrap(msgs, on_malformed="quarantine"), on_malformed="quarantine").collect()
    assert sorted(r._corrupt_record is None for r in out) == [False, True]


def test_nested_event_flatten(spark):
    ev = {"event_id": "n1", "event_type": "sms", "event_time": "2024-01-01T00:00:00",
          "subscriber": {"subscriber_id": "s", "msisdn_masked": "+99450***0001", "plan": "prepaid",
                         "activation_date": "2023-05-01"},
          "cell": {"cell_id": "C", "region": "Baku", "radio_tech": "5G"}, "volte_enabled": False}
    (row,) = cdc.flatten_nested(spark.createDataFrame([(json.dumps(ev),)], "value string")).collect()
    assert (row.event_time_raw, row.subscriber_plan, row.cell_radio_tech) == ("2024-01-01T00:00:00", "prepaid", "5G")
    assert row.subscriber_activation_date == dt.date(2023, 5, 1)
    assert json.loads(row.extra) == {"volte_enabled": False}


def test_keep_first_by_object_key_text_order(spark):
    batch = spark.createDataFrame([
        ("e1", "raw/network_events/dt=2024-01-01/hr=00/p0_200-399.jsonl", 1, "second"),
        ("e1", "raw/network_events/dt=2024-01-01/hr=00/p0_1000-1199.jsonl", 1, "first"),
        ("e2", "raw/network_events/dt=2024-01-01/hr=00/p0_0-199.jsonl", 1, "only"),
    ], "event_id string, _source_object_key string, _cdc_source_ts_ms bigint, payload string")
    got = {r.event_id: r.payload for r in ingest.keep_first(batch).collect()}
    assert got == {"e1": "first", "e2": "only"}
    target = spark.createDataFrame([("e2",)], "event_id string")
    assert [r.event_id for r in ingest.keep_first(batch, target).collect()] == ["e1"]


def test_ingest_hour_rollover_utc(spark):
    ms = int(dt.datetime(2024, 1, 31, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(ms,), (ms + 1000,)], "ts bigint")
    got = rows = sorted((r.dt, r.hr, r.row_count) for r in ingest.ingest_hour_partitions(df, "ts").collect())
    assert got == [("2024-01-31", "23", 1), ("2024-02-01", "00", 1)]


def test_contract_decimals_round_half_up(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(22.875, -80.25, 1.005, 12.0)],
                               "latency_ms double, signal_dbm double, data_volume_mb double, avg_throughput_mbps double")
    (row,) = ingest.cast_to_contract_decimals(df).collect()
    assert row.latency_ms == Decimal("22.9") and row.signal_dbm == Decimal("-80.3")


@pytest.mark.parametrize("bad", [
    {"data_volume_mb": -99999999999999}, {"duration_sec": -5000000000}, {"signal_dbm": -99999999.5},
    {"latency_ms": 1e12}, {"avg_throughput_mbps": "abc"}, {"subscriber_activation_date": "soon"},
    {"event_id": None}])
def test_values_that_do_not_fit_are_told(spark, bad):
    line = json.dumps({**RECORD, **bad})
    with pytest.raises(Exception, match="does not fit|event_id"):
        decode(spark, [line])
    msgs = spark.createDataFrame([(json.dumps(RECORD),), (line,)], "value string")
    out = cdc.record_to_raw(cdc.unwrap(msgs, on_malformed="quarantine"), on_malformed="quarantine").collect()
    assert sorted((r._corrupt_record or "") for r in out) == ["", line]


def test_keep_first_refuses_rows_without_a_key(spark):
    batch = spark.createDataFrame([(None, "o", 1), ("a", "o", 1)], "event_id string, _source_object_key string, _cdc_source_ts_ms bigint")
    with pytest.raises(Exception, match="row without event_id"):
        ingest.keep_first(batch).collect()


def test_epoch_day_decode_rejects_non_dates(spark):
    from cellscope.functions import expressions as X
    df = spark.createDataFrame([("19936",), ("2024-07-01",), ("true",), ("1.5",)], "v string")
    got = [r[0] for r in df.select(X.epoch_day_to_date("v")).collect()]
    assert got == [dt.date(2024, 8, 1), dt.date(2024, 7, 1), None, None]


def test_decode_parses_once_and_keeps_its_filter_off_the_scan(spark, tmp_path):
    """One parse of each message; the delete filter stays behind it; every step is compiled."""
    path = str(tmp_path / "lines")
    spark.createDataFrame([(json.dumps(RECORD),)], "value string").write.parquet(path)
    out = cdc.record_to_raw(cdc.unwrap(spark.read.parquet(path)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils.parseJson(value") == 1
    assert plan.count("VariantExpressionEvalUtils.parseJson(") == 2      # the other: an `extra` that is JSON in a string
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "parseJson" not in scan and "PushedFilters: []" in scan
    for line in plan.splitlines():
        if any(x in line for x in ("Project", "Filter", "Generate")) and "lambda" not in line and "FileScan" not in line:
            assert "*(" in line, line        # whole-stage code, but for the functions over the map's entries


def test_wrong_types_are_seen_by_the_struct_read(spark):
    bad = [dict(RECORD, event_id=f"b{i}", **{c: v}) for i, (c, v) in enumerate([
        ("signal_dbm", "loud"), ("duration_sec", 10 ** 12), ("latency_ms", {"ms": 3}), ("data_volume_mb", [1]),
        ("subscriber_activation_date", "soon"), ("avg_throughput_mbps", 1e9)])]
    good = [dict(RECORD, event_id="ok1", signal_dbm="-80.5"), dict(RECORD, event_id="ok2", subscriber_id=77, cell_id=True)]
    msgs = spark.createDataFrame([(json.dumps(x),) for x in bad + good] + [("[1]",), ("3",)], "value string")
    out = cdc.record_to_raw(cdc.unwrap(msgs, on_malformed="quarantine"), on_malformed="quarantine").collect()
    kept = {r.event_id: r for r in out if r._corrupt_record is None}
    assert set(kept) == {"ok1", "ok2"} and len(out) == 10
    assert kept["ok1"].signal_dbm == -80.5 and kept["ok2"].subscriber_id == "77" and kept["ok2"].cell_id == "true"
