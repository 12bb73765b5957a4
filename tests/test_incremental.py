import datetime as dt

from cellscope.operators import incremental
from cellscope.plans import publish
from cellscope.plans.pipeline import publish_fact

T = dt.datetime(2024, 1, 10)
SCHEMA = "event_id string, event_time timestamp, v int"


def test_late_drop_vs_upsert(spark):
    target = spark.createDataFrame([("a", T, 1), ("b", T + dt.timedelta(hours=1), 1)], SCHEMA)
    source = spark.createDataFrame([("late", T - dt.timedelta(days=1), 2),     # older than newest
                                    ("tie", T + dt.timedelta(hours=1), 2),      # equal to newest
                                    ("new", T + dt.timedelta(hours=2), 2),
                                    ("a", T + dt.timedelta(hours=3), 9)], SCHEMA)  # existing id, newer
    drop = {r.event_id: r.v for r in incremental.merge(target, source, late="drop").collect()}
    assert drop == {"a": 9, "b": 1, "new": 2}
    up = {r.event_id: r.v for r in incremental.merge(target, source, late="upsert").collect()}
    assert up == {"a": 1, "b": 1, "late": 2, "tie": 2, "new": 2}


def test_upserted_event_with_changed_date_leaves_one_row(spark, tmp_path):
    path = str(tmp_path / "fct")
    first = spark.createDataFrame([("x", T, 1), ("y", T, 1)], SCHEMA)
    publish_fact(spark, first, path, late="drop")
    moved = spark.createDataFrame([("x", T + dt.timedelta(days=3), 2)], SCHEMA)
    publish_fact(spark, moved, path, late="drop")
    got = sorted((r.event_id, r.v, str(r.event_date)) for r in publish.read_table(spark, path).collect())
    assert got == [("x", 2, "2024-01-13"), ("y", 1, "2024-01-10")]


def test_upsert_publish_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "fct")
    rows = spark.createDataFrame([("x", T, 1), ("y", T - dt.timedelta(days=2), 1)], SCHEMA)
    publish_fact(spark, rows, path, late="upsert")
    publish_fact(spark, rows, path, late="upsert")
    assert publish.read_table(spark, path).count() == 2
