import datetime as dt

import pytest

from cellscope.operators import quality

T = dt.datetime(2024, 1, 1)


def test_gate_raises_on_orphan_and_ignores_null_call_result(spark):
    dim_cell = spark.createDataFrame([("C1",)], "cell_id string")
    dim_sub = spark.createDataFrame([("s", T)], "subscriber_id string, valid_from timestamp")
    voice = spark.createDataFrame([("v1", "C1", "s", None), ("v2", "ORPHAN", "s", "completed")],
                                  "event_id string, cell_id string, subscriber_id string, call_result string")
    data = spark.createDataFrame([("d1", "C1", None)], "event_id string, cell_id string, subscriber_id string")
    checks = quality.checks_table(quality.curated_checks(dim_cell, dim_sub, voice, data))
    status = {r.check_name: (r.failing_rows, r.status) for r in checks.collect()}
    assert status["accepted_values_fct_voice_call_call_result"] == (0, "pass")
    assert status["relationships_fct_voice_call_cell_id_to_dim_cell_site"] == (1, "fail")
    assert status["relationships_fct_data_session_subscriber_id_to_dim_subscriber"] == (0, "pass")
    with pytest.raises(quality.QualityGateError):
        quality.gate(checks, "curated")
    (decision,) = quality.gate_decision(checks, "curated").collect()
    assert decision.publish is False and decision.checks_failed == 1


def test_unique_ignores_nulls_and_counts_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    (row,) = quality.checks_table([quality.unique(df, "m", "k")]).collect()
    assert row.failing_rows == 1


def test_completeness_identity(spark):
    total = spark.range(10)
    (row,) = quality.checks_table([quality.equal_counts(total, [spark.range(4), spark.range(6)], "c", "m")]).collect()
    assert row.failing_rows == 0
    (row,) = quality.checks_table([quality.equal_counts(total, [spark.range(4)], "c", "m")]).collect()
    assert row.failing_rows == 6 and row.status == "fail"


def test_reconcile_thresholds(spark):
    src = spark.createDataFrame([(T,)] * 1000 + [(T + dt.timedelta(days=1),)] * 1000 +
                                [(T + dt.timedelta(days=2),)] * 1000, "t timestamp")
    raw = spark.createDataFrame([(T,)] * 1000 + [(T + dt.timedelta(days=1),)] * 990 +
                                [(T + dt.timedelta(days=2),)] * 970, "t timestamp")
    got = {r.window_date.day: r.status for r in quality.reconcile(src, raw, "t", "t").collect()}
    assert got == {1: "pass", 2: "warn", 3: "fail"}


def test_drift_report_is_bounded_and_exact(spark):
    import json

    rows = [(json.dumps({f"k{j}": 1 for j in range(i % 7)} | {"volte_enabled": True}),) for i in range(70)]
    stg = spark.createDataFrame(rows, "extra string")
    got = [tuple(r) for r in quality.drift_report(stg, most=2).collect()]
    assert sorted(got, key=str) == sorted([("k0", 1, 60), ("k1", 1, 50), (None, 4, 40 + 30 + 20 + 10)], key=str)
    assert [r["drift_key"] for r in quality.drift_report(stg).orderBy("drift_key").collect()] == [f"k{j}" for j in range(6)]
    assert quality.drift_report(stg.where("false")).count() == 0


def test_relationships_in_one_pass_equal_single_checks(spark):
    dim = spark.createDataFrame([("C1",), ("C2",), ("C2",)], "cell_id string")
    sub = spark.createDataFrame([(1,), (2,)], "subscriber_id long")
    voice = spark.createDataFrame([("C1", 1), ("gone", 1), ("gone", 9), (None, None), ("1", 2)], "cell_id string, subscriber_id long")
    data = voice.limit(0)
    keys = {"cell_id": "dim_cell_site", "subscriber_id": "dim_subscriber"}
    parents = {"dim_cell_site": (dim, "cell_id"), "dim_subscriber": (sub, "subscriber_id")}
    fused = quality.all_relationships({"v": (voice, keys), "d": (data, keys)}, parents)
    single = quality.checks_table([quality.relationships(df, m, c, parents[p][0], c, p) for m, df in (("v", voice), ("d", data))
                                   for c, p in keys.items()]).drop("status")
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, single.collect()))
    assert sorted(r.failing_rows for r in fused.collect()) == [0, 0, 1, 3]       # "1" is a subscriber, not a cell


def test_accepted_values_ride_along_with_the_key(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "odd"), (None, None), ("b", "odd")], "k string, v string")
    rows = quality.model_checks(df, "m", ("k",), "k", accepted={"v": ("x",)})
    assert {r.check_name: r.failing_rows for r in rows.collect()} == {"not_null_m_k": 1, "accepted_values_m_v": 2, "unique_m_k": 1}


def test_stored_ids_vouch_for_the_key_only_if_it_holds(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "event_id string")
    assert [r.failing_rows for r in quality.stored_key_checks(ids, 2).collect()] == [0, 0]
    assert quality.stored_key_checks(ids, 3) is None                                # a row of raw more than ids
    assert quality.stored_key_checks(ids.unionByName(ids), 4) is None               # ids stored twice
    assert quality.stored_key_checks(ids.unionByName(spark.createDataFrame([(None,)], "event_id string")), 3) is None
    assert quality.stored_key_checks(ids.limit(0), 0).count() == 2
