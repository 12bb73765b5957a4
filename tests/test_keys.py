"""The bucketed id table that inserts are compared with."""
import json

import pytest
from pyspark.sql import functions as F

from cellscope.plans import keys, load, publish
from cellscope.sources import lake

DAYS = ("2024-01-10", "2024-01-11")


def land(spark, root, day, *ids):
    lines = [(json.dumps({"event_id": i, "event_type": "sms", "event_time_raw": "2024-01-10T10:00:00", "subscriber_id": "s",
                          "cell_id": "C", "cell_region": "R", "__source_ts_ms": 1}), day, "00") for i in ids]
    lake.write_ndjson(spark.createDataFrame(lines, "value string, dt string, hr string").coalesce(1), root)


def raw_ids(spark, wh):
    return sorted(r.event_id for r in spark.read.parquet(load.raw_path(wh)).select("event_id").collect())


def test_insert_moves_new_rows_only(spark, tmp_path, monkeypatch):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land(spark, root, DAYS[0], *[f"e{i}" for i in range(200)])
    assert load.load_date(spark, root, wh, DAYS[0]).rows_inserted == 200
    stored = keys.cover(spark, wh, load.raw_path(wh))
    assert stored.count() == 200
    plans, append = [], publish.append

    def planned(df, path, by=()):
        if path == load.raw_path(wh):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return append(df, path, by)

    land(spark, root, DAYS[1], "e5", "new", "new")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "200"}
    before = {k: spark.conf.get(k) for k in conf}
    with monkeypatch.context() as m:
        m.setattr(publish, "append", planned)
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            assert load.load_date(spark, root, wh, DAYS[1]).rows_inserted == 1
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
    (text,) = plans
    # one exchange, on the side of the batch; the stored ids come from their buckets
    assert text.count("Exchange") == 1 and "SortMergeJoin" in text and "Bucketed: true" in text, text


def test_replays_and_late_copies_insert_nothing(spark, tmp_path):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land(spark, root, DAYS[0], "a", "b")
    land(spark, root, DAYS[1], "b", "c", "c")
    load.load_date(spark, root, wh, DAYS[0])
    assert load.load_date(spark, root, wh, DAYS[1]).rows_inserted == 1
    land(spark, root, DAYS[0], "a", "b", "c")            # a new object with ids of both dates
    again = load.load_date(spark, root, wh, DAYS[0])
    assert (again.objects_loaded, again.rows_inserted) == (1, 0)
    assert raw_ids(spark, wh) == ["a", "b", "c"]


@pytest.mark.parametrize("step", ["rows", "ids", "covered"])
def test_killed_load_is_made_good(spark, tmp_path, monkeypatch, step):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land(spark, root, DAYS[0], "a", "b")
    with monkeypatch.context() as m:
        calls, cover, full = [], keys.cover, publish.full_refresh

        def killed_cover(*args):
            calls.append(args)
            if step == "rows" and len(calls) == 2:       # rows are in, their ids not
                raise KeyboardInterrupt
            return cover(*args)

        def killed_refresh(df, path):
            if step == "covered" and path.endswith("_covered"):      # ids are in, not yet listed
                raise KeyboardInterrupt
            full(df, path)

        def killed_append(df, path, by=()):
            if step == "ids" and path == load.ledger_path(wh):       # everything but the ledger
                raise KeyboardInterrupt
            return append(df, path, by)

        append = publish.append
        m.setattr(keys, "cover", killed_cover)
        m.setattr(publish, "full_refresh", killed_refresh)
        m.setattr(publish, "append", killed_append)
        with pytest.raises(KeyboardInterrupt):
            load.load_date(spark, root, wh, DAYS[0])
    land(spark, root, DAYS[0], "b", "c")
    result = load.load_date(spark, root, wh, DAYS[0])
    assert (result.objects_loaded, result.rows_inserted) == (2, 1)
    assert raw_ids(spark, wh) == ["a", "b", "c"]
    assert keys.cover(spark, wh, load.raw_path(wh)).count() == 3


def test_raw_table_without_stored_ids_and_another_number_of_buckets(spark, tmp_path):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land(spark, root, DAYS[0], "a", "b")
    load.load_date(spark, root, wh, DAYS[0])
    spark.conf.set(keys.BUCKETS_CONF, "3")
    try:
        land(spark, root, DAYS[1], "b", "z")
        assert load.load_date(spark, root, wh, DAYS[1]).rows_inserted == 1
        stored = keys.cover(spark, wh, load.raw_path(wh))
        assert sorted(r.event_id for r in stored.collect()) == ["a", "b", "z"]
    finally:
        spark.conf.unset(keys.BUCKETS_CONF)
    # the first folder, two rows behind by now, catches up
    land(spark, root, DAYS[1], "z", "y")
    assert load.load_date(spark, root, wh, DAYS[1]).rows_inserted == 1
    assert raw_ids(spark, wh) == ["a", "b", "y", "z"]
    assert stored.select(F.count_distinct("event_id")).first()[0] == 3


def test_staging_gate_finds_a_repeated_raw_row(spark, tmp_path):
    from cellscope.operators import quality
    from cellscope.plans.pipeline import run_pipeline

    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land(spark, root, DAYS[0], "a", "b")
    first = run_pipeline(spark, root, wh, DAYS[0])
    assert [(r.check_name, r.failing_rows) for r in first.checks["staging"]] == \
        [("not_null_stg_network_events_event_id", 0), ("unique_stg_network_events_event_id", 0)]
    copy = spark.read.parquet(load.raw_path(wh)).where("event_id = 'a'")
    publish.append(publish.stage(copy, "copy"), load.raw_path(wh), ("_ingest_date",))
    with pytest.raises(quality.QualityGateError, match="unique_stg_network_events_event_id=1"):
        run_pipeline(spark, root, wh, DAYS[0])
