import json
import os

from cellscope.plans.load import raw_path
from cellscope.sources import lake
from cellscope.streaming.landing import land_stream
from cellscope.streaming.loader import stream_load

MSG_SCHEMA = "value string, timestamp timestamp"


def write_messages(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for value, ts in records:
            fh.write(json.dumps({"value": value, "timestamp": ts}) + "\n")


def rec(i, ts_ms=1704067200000):
    return json.dumps({"event_id": f"e{i}", "event_type": "sms", "event_time_raw": "2024-01-01T00:00:00",
                       "subscriber_id": "s", "cell_id": "C", "__source_ts_ms": ts_ms + i})


def test_landing_restart_adds_no_duplicates_then_load(spark, tmp_path):
    src, root, wh = str(tmp_path / "src"), str(tmp_path / "lake"), str(tmp_path / "wh")
    ck1, ck2 = str(tmp_path / "ck-land"), str(tmp_path / "ck-load")
    write_messages(src, "a.json", [(rec(i), "2024-01-01T23:59:59Z" if i < 2 else "2024-01-02T00:00:01Z")
                                   for i in range(4)] + [(None, "2024-01-02T00:00:02Z")])
    stream = lambda: spark.readStream.schema(MSG_SCHEMA).json(src)
    land_stream(stream(), root, ck1, available_now=True).awaitTermination()
    lines = lake.read_lines(spark, root)
    assert lines.count() == 4  # the tombstone is not landed
    assert sorted((r.dt, r.hr) for r in lines.select("dt", "hr").distinct().collect()) == \
        [("2024-01-01", "23"), ("2024-01-02", "00")]
    land_stream(stream(), root, ck1, available_now=True).awaitTermination()
    assert lake.read_lines(spark, root).count() == 4
    write_messages(src, "b.json", [(rec(9), "2024-01-02T01:00:00Z"), (rec(0), "2024-01-02T01:00:00Z")])
    land_stream(stream(), root, ck1, available_now=True).awaitTermination()
    assert lake.read_lines(spark, root).count() == 6

    # one file per micro-batch: later batches check ids against rows stored by earlier ones
    stream_load(spark, root, wh, ck2, max_files_per_trigger=1).awaitTermination()
    assert spark.read.parquet(raw_path(wh)).count() == 5  # e0 re-delivered once, kept once
    stream_load(spark, root, wh, ck2).awaitTermination()
    assert spark.read.parquet(raw_path(wh)).count() == 5


def test_late_first_delivery_is_loaded(spark, tmp_path):
    """Three ids, the last one 11 hours older by change time, and a re-delivery: all ids stay."""
    root, wh, hour = str(tmp_path / "lake"), str(tmp_path / "wh"), 3_600_000
    base = 1704067200000 + 24 * hour
    for k, r in enumerate([rec(1, base), rec(2, base), rec(3, base - 11 * hour), rec(1, base - 11 * hour)]):
        lake.write_ndjson(spark.createDataFrame([(r, "2024-01-02", f"{k:02d}")], "value string, dt string, hr string"), root)
    stream_load(spark, root, wh, str(tmp_path / "ck"), max_files_per_trigger=1).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(raw_path(wh)).collect()) == ["e1", "e2", "e3"]


def test_landing_returns_when_fewer_batches_arrive(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    write_messages(src, "m.json", [(rec(1), "2024-01-01T10:00:00Z")])
    msgs = spark.readStream.schema(MSG_SCHEMA).json(src)
    q = land_stream(msgs, root, str(tmp_path / "ck"), max_batches=5)
    assert not q.isActive and lake.read_lines(spark, root).count() == 1


def test_landing_stops_after_max_batches(spark, tmp_path):
    src, root, ck = str(tmp_path / "src"), str(tmp_path / "lake"), str(tmp_path / "ck")
    for i in range(3):
        write_messages(src, f"m{i}.json", [(rec(i), "2024-01-01T10:00:00Z")])
    msgs = spark.readStream.schema(MSG_SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    q = land_stream(msgs, root, ck, max_batches=2)
    assert not q.isActive
    assert lake.read_lines(spark, root).count() == 2
    # the next run continues from the checkpoint with the remaining message
    land_stream(spark.readStream.schema(MSG_SCHEMA).json(src), root, ck, available_now=True).awaitTermination()
    assert lake.read_lines(spark, root).count() == 3


def test_loader_starts_before_anything_landed(spark, tmp_path):
    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    stream_load(spark, root, wh, str(tmp_path / "ck")).awaitTermination()
    lake.write_ndjson(spark.createDataFrame([(rec(1), "2024-01-01", "00")], "value string, dt string, hr string"), root)
    stream_load(spark, root, wh, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(raw_path(wh)).count() == 1


def land_objects(spark, root, *objects):
    for lines, dt, hr in objects:
        lake.write_ndjson(spark.createDataFrame([(x, dt, hr) for x in lines], "value string, dt string, hr string").coalesce(1), root)


def ids(spark, wh):
    return sorted(r.event_id for r in spark.read.parquet(raw_path(wh)).collect())


def test_bad_object_does_not_stop_the_stream_and_load_date_skips_the_rest(spark, tmp_path):
    import pytest

    from cellscope.plans.load import MalformedObjects, failed_path, load_date

    root, wh, ck = str(tmp_path / "lake"), str(tmp_path / "wh"), str(tmp_path / "ck")
    land_objects(spark, root, ([rec(1)], "2024-01-02", "00"), ([rec(2), "{broken"], "2024-01-02", "01"), ([rec(3)], "2024-01-02", "02"))
    load = lambda: stream_load(spark, root, wh, ck, max_files_per_trigger=1).awaitTermination()
    load()
    assert ids(spark, wh) == ["e1", "e3"]                   # the bad object stays out as a whole
    assert [r.example for r in spark.read.parquet(failed_path(wh)).collect()] == ["{broken"]
    land_objects(spark, root, ([rec(4)], "2024-01-02", "03"))
    load()                                                   # a restart goes on behind it
    load()
    assert ids(spark, wh) == ["e1", "e3", "e4"] and spark.read.parquet(failed_path(wh)).count() == 1
    with pytest.raises(MalformedObjects) as e:               # one ledger: only the bad object is left to load
        load_date(spark, root, wh, "2024-01-02")
    assert (e.value.result.objects_seen, e.value.result.objects_skipped, e.value.result.rows_inserted) == (4, 3, 0)
    done = load_date(spark, root, wh, "2024-01-02", on_malformed="quarantine")
    assert (done.objects_skipped, done.objects_loaded, done.rows_inserted) == (3, 1, 1) and ids(spark, wh) == ["e1", "e2", "e3", "e4"]


def test_stream_quarantines_lines_and_skips_objects_of_batch_loads(spark, tmp_path):
    from cellscope.plans.load import ledger_path, load_date, quarantine_path

    root, wh, ck = str(tmp_path / "lake"), str(tmp_path / "wh"), str(tmp_path / "ck")
    land_objects(spark, root, ([rec(1)], "2024-01-02", "00"))
    assert load_date(spark, root, wh, "2024-01-02").rows_inserted == 1
    land_objects(spark, root, ([rec(2), "[1]", rec(5)], "2024-01-02", "01"), ([rec(3)], "2024-01-03", "02"))
    for _ in range(2):
        stream_load(spark, root, wh, ck, on_malformed="quarantine").awaitTermination()
    assert ids(spark, wh) == ["e1", "e2", "e3", "e5"]
    assert [r._corrupt_record for r in spark.read.parquet(quarantine_path(wh)).collect()] == ["[1]"]
    objects = [r.object_key for r in spark.read.parquet(ledger_path(wh)).collect()]
    assert len(objects) == len(set(objects)) == 3
    assert load_date(spark, root, wh, "2024-01-02").objects_loaded == 0 == load_date(spark, root, wh, "2024-01-03").objects_loaded


def test_batch_killed_between_rows_and_ledger_repeats_nothing(spark, tmp_path, monkeypatch):
    import pytest

    from cellscope.plans import load as plan
    from cellscope.plans import publish
    from cellscope.streaming.loader import commit_batch

    root, wh = str(tmp_path / "lake"), str(tmp_path / "wh")
    land_objects(spark, root, ([rec(1), "bad", rec(2)], "2024-01-02", "00"))
    batch, append = lake.read_lines(spark, root), publish.append
    for stop in (plan.raw_path(wh), plan.ledger_path(wh)):
        def killed(df, path, by=()):
            if path == stop:
                raise KeyboardInterrupt
            append(df, path, by)
        with monkeypatch.context() as m:
            m.setattr(publish, "append", killed)
            with pytest.raises(KeyboardInterrupt):
                commit_batch(batch, wh, "quarantine", "b0")
    for _ in range(2):
        commit_batch(batch, wh, "quarantine", "b0")
    assert ids(spark, wh) == ["e1", "e2"]
    assert spark.read.parquet(plan.quarantine_path(wh)).count() == 1 == spark.read.parquet(plan.ledger_path(wh)).count()
