import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cellscope.operators import kpi, staging
from cellscope.operators.quantiles import exact_quantiles
from cellscope.plans import publish
from cellscope.plans.load import load_date, raw_path
from cellscope.plans.pipeline import publish_kpi, table
from cellscope.sources import lake

T = dt.datetime(2024, 1, 1, 10, 5)
SCHEMA = ("event_type string, event_time timestamp, cell_id string, cell_region string, call_result string, "
          "data_volume_mb double, avg_throughput_mbps double, latency_ms double, signal_dbm double")


def rows(spark):
    data = [("data_session", T, "C", "R", None, 1.0, 10.0, float(i), -80.0) for i in range(1, 101)]
    data += [("voice_call", T, "C", "R", "dropped", None, None, None, -90.0),
             ("voice_call", T, "C", "R", "completed", None, None, None, None),
             ("sms", T, "C", "R", None, None, None, None, -70.0)]
    return spark.createDataFrame(data, SCHEMA)


def test_hourly_kpi_measures(spark):
    (r,) = kpi.cell_hourly_kpi(rows(spark)).collect()
    assert (r.call_attempts, r.dropped_calls, r.failed_setups, r.data_sessions) == (2, 1, 0, 100)
    assert r.drop_rate == 0.5 and r.total_volume_mb == 100.0 and r.avg_throughput_mbps == 10.0
    assert r.p95_latency_ms == 95.05          # linear interpolation, as percentile_cont
    assert r.avg_signal_dbm == round((100 * -80.0 - 90.0 - 70.0) / 102, 4)
    assert r.kpi_hour == dt.datetime(2024, 1, 1, 10) and str(r.kpi_date) == "2024-01-01"


def test_hourly_kpi_from_merged_partials(spark):
    from functools import reduce

    valid = rows(spark).unionByName(rows(spark).withColumn("cell_id", F.lit(None).cast("string")).where("latency_ms is null"))
    whole = sorted(map(str, kpi.cell_hourly_kpi(valid).collect()))
    parts = [kpi.kpi_partials(valid.where(F.abs(F.xxhash64(F.coalesce("latency_ms", F.lit(0.0)))) % 3 == i)) for i in range(3)]
    assert sorted(map(str, kpi.kpi_from_partials(reduce(type(valid).unionByName, parts)).collect())) == whole
    assert len(whole) == 2 and kpi.cell_hourly_kpi(valid.where("false")).count() == 0


@pytest.mark.parametrize("unit,shifts", [(0.1, (12,)), (0.1, (8, 4)), (1e-6, (32, 16)), (1000.0, (0,))])
def test_quantiles_equal_brute_force(spark, unit, shifts):
    import numpy as np

    rng = np.random.default_rng(5)
    groups = {"hot": [round(x, 1) for x in rng.gamma(2, 40, 6000)], "one": [7.5], "two": [1.0, 2.0], "ties": [3.0] * 50 + [4.0],
              "below": [-5.5, -0.1, 0.0, 12.3], None: [round(x, 1) for x in rng.normal(0, 900, 700)]}
    data = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("hot", None), ("void", None)]
    counted = spark.createDataFrame(data, "k string, x double").groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"))
    probs = (0.0, 0.5, 0.95, 1.0)
    got = {r.k: r.quantiles for r in exact_quantiles(counted, ["k"], "x", "n", probs, unit, shifts).collect()}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        assert np.allclose(got[k], np.quantile(xs, probs), rtol=0, atol=1e-9), k


def test_quantiles_sort_no_group_in_one_task(spark):
    df = kpi.cell_hourly_kpi(rows(spark))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in text
    counted = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") / 10).alias("x"), F.lit(1).alias("n"))
    (r,) = exact_quantiles(counted, ["k"], "x", "n", (0.95,), 0.1, (12,)).collect()
    assert abs(r.quantiles[0] - 0.95 * 19999.9) < 1e-6


def test_throughput_can_be_at_fault(spark):
    data = [("data_session", T, c, c, None, 1.0, tp, 1.0, -80.0) for c, tp in (("slow", 1.0), ("fast", 500.0))]
    data += [("voice_call", T, "slow", "slow", "completed", None, None, None, None)]
    got = {r.cell_region: r.kpi_at_fault for r in kpi.region_quality(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {"slow": "throughput", "fast": "latency"}


def kpi_rows(spark, wh):
    return sorted(map(str, publish.read_table(spark, table(wh, "curated", "agg_cell_hourly_kpi")).collect()))


def all_from_raw(spark, wh):
    raw = spark.read.parquet(raw_path(wh)).drop("_ingest_date")
    got = kpi.cell_hourly_kpi(staging.stg_valid(staging.stg_network_events(raw)))
    return sorted(map(str, got.collect()))


def land_events(spark, root, day, *events):
    lines = [(json.dumps({"event_id": i, "event_type": "data_session", "event_time_raw": t, "subscriber_id": "s", "cell_id": "C",
                          "cell_region": "R", "data_volume_mb": 1.5, "avg_throughput_mbps": 3.0, "latency_ms": lat, "signal_dbm": -80.0,
                          "__source_ts_ms": 1}), day, "00") for i, t, lat in events]
    lake.write_ndjson(spark.createDataFrame(lines, "value string, dt string, hr string").coalesce(1), root)


def test_kpi_state_merges_late_rows_without_reading_old_raw(spark, tmp_path, monkeypatch):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land_events(spark, root, "2024-01-10", ("a", "2024-01-10T10:01:00", 10.0), ("b", "2024-01-10T10:02:00", 30.0))
    land_events(spark, root, "2024-01-11", ("c", "2024-01-10T10:03:00", 90.5), ("d", "2024-01-11T08:00:00", 5.0))
    land_events(spark, root, "2024-01-12", ("e", "2024-01-10T10:04:00", 70.0), ("f", "2024-01-12T00:00:00", None))
    load_date(spark, root, wh, "2024-01-10")
    load_date(spark, root, wh, "2024-01-11")         # loaded, its KPI not asked for
    publish_kpi(spark, wh, "2024-01-10")
    assert kpi_rows(spark, wh) == all_from_raw(spark, wh) and len(kpi_rows(spark, wh)) == 2
    load_date(spark, root, wh, "2024-01-12")
    seen = []
    with monkeypatch.context() as m:
        whole = staging.stg_network_events
        m.setattr(staging, "stg_network_events", lambda raw, *a: (seen.extend(raw.select("_source_object_key").distinct().collect()), whole(raw, *a))[1])
        publish_kpi(spark, wh, "2024-01-12")
    assert len(seen) == 1 and "dt=2024-01-12" in seen[0][0]       # rows of the run's date only
    assert kpi_rows(spark, wh) == all_from_raw(spark, wh) and len(kpi_rows(spark, wh)) == 3
    for again in ("2024-01-12", "2024-01-10"):
        publish_kpi(spark, wh, again)
        assert kpi_rows(spark, wh) == all_from_raw(spark, wh)


@pytest.mark.parametrize("step", [1, 2, 3])
def test_killed_kpi_run_is_made_good_by_the_next(spark, tmp_path, monkeypatch, step):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land_events(spark, root, "2024-01-10", ("a", "2024-01-10T10:01:00", 10.0))
    load_date(spark, root, wh, "2024-01-10")
    publish_kpi(spark, wh, "2024-01-10")
    land_events(spark, root, "2024-01-11", ("b", "2024-01-10T10:02:00", 20.0), ("c", "2024-01-11T10:02:00", 20.0))
    load_date(spark, root, wh, "2024-01-11")
    calls, write = [], publish.publish
    with monkeypatch.context() as m:
        def killed(*a, **k):
            calls.append(a)
            if len(calls) == step:
                raise KeyboardInterrupt
            return write(*a, **k)
        m.setattr(publish, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            publish_kpi(spark, wh, "2024-01-11")
    land_events(spark, root, "2024-01-12", ("d", "2024-01-11T10:05:00", 40.0))
    load_date(spark, root, wh, "2024-01-12")
    publish_kpi(spark, wh, "2024-01-12")             # the killed date is made good by another one's run
    assert kpi_rows(spark, wh) == all_from_raw(spark, wh)


def test_other_flags_count_everything_again(spark, tmp_path):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land_events(spark, root, "2024-01-10", ("a", "2024-01-10T10:01:00", 10.0), (None, "2024-01-10T10:01:00", 10.0))
    land_events(spark, root, "2024-01-11", ("b", "2024-01-10T10:02:00", -20.0))
    load_date(spark, root, wh, "2024-01-10", "quarantine")
    load_date(spark, root, wh, "2024-01-11")
    publish_kpi(spark, wh, "2024-01-11")
    publish_kpi(spark, wh, "2024-01-11", keep_flags=("negative_latency",))
    covered = publish.read_table(spark, table(wh, "curated", "_kpi_covered"))
    assert {(r["_ingest_date"], r.raw_rows, r.keep_flags) for r in covered.collect()} == \
        {("2024-01-10", 1, "negative_latency"), ("2024-01-11", 1, "negative_latency")}
