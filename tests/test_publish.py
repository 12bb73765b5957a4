"""Snapshots: a killed write leaves the old or the new table, whatever it was doing."""
import os

import pytest
from pyspark.sql import functions as F

from cellscope.plans import publish


class Killed(BaseException):
    pass



def days(spark, *rows):
    return spark.createDataFrame([(i, d, x) for i, d, x in rows], "id long, d string, x string") \
        .select("id", F.col("d").cast("date").alias("day"), "x")


def read(spark, path):
    df = publish.read_table(spark, path)
    return None if df is None else sorted((r["id"], str(r["day"]), r["x"]) for r in df.collect())


A = [(1, "2024-01-01", "a"), (2, "2024-01-02", "b")]
B = [(3, "2024-01-02", "c"), (4, "2024-01-03", "d")]


def writes(spark, path):
    return {"full_refresh": (lambda: publish.full_refresh(days(spark, *B), path), B),
            "replace_partitions": (lambda: publish.replace_partitions(days(spark, *B), path, ("day",)), [A[0], *B]),
            "add": (lambda: publish.add(days(spark, *B), path, ("day",)), sorted(A + B))}


@pytest.mark.parametrize("kind", ["full_refresh", "replace_partitions", "add"])
@pytest.mark.parametrize("step", ["_partitions", "_switch", "_clean"])
def test_killed_write_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, kind, step):
    path = str(tmp_path / "t")
    publish.replace_partitions(days(spark, *A), path, ("day",))
    write, after = writes(spark, path)[kind]
    with monkeypatch.context() as m:
        m.setattr(publish, step, lambda *a, **k: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            write()
    assert read(spark, path) == (after if step == "_clean" else A)
    write()
    assert read(spark, path) == (sorted(A + B + B) if (kind, step) == ("add", "_clean") else after)


def test_killed_while_the_manifest_is_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.full_refresh(days(spark, *A), path)
    with monkeypatch.context() as m:
        m.setattr(publish.Manifest, "to_json", lambda self: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            publish.full_refresh(days(spark, *B), path)
    assert read(spark, path) == A        # an unfinished draft is no manifest
    publish.full_refresh(days(spark, *B), path)
    assert read(spark, path) == B


def test_first_write_killed_is_no_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as m:
        m.setattr(publish, "_switch", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            publish.full_refresh(days(spark, *A), path)
    assert read(spark, path) in (None, [])
    publish.replace_partitions(days(spark, *A), path, ("day",))
    assert read(spark, path) == A


def test_emptied_day_disappears_and_empty_tables_keep_their_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partitions(days(spark, *A), path, ("day",))
    publish.replace_partitions(days(spark, B[1]), path, ("day",), touched=["2024-01-02", "2024-01-03"])
    assert read(spark, path) == [A[0], B[1]]
    publish.replace_partitions(days(spark, *A).limit(0), path, ("day",), touched=["2024-01-01", "2024-01-03"])
    assert read(spark, path) == [] and publish.read_table(spark, path).dtypes == days(spark, *A).dtypes


def test_plan_reads_the_table_it_replaces_and_a_running_reader_finishes(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partitions(days(spark, *A), path, ("day",))
    before = publish.read_table(spark, path)
    publish.replace_partitions(before.withColumn("x", F.concat("x", F.lit("!"))), path, ("day",))
    assert sorted(r["x"] for r in before.collect()) == ["a", "b"]        # planned before the switch
    assert [r[2] for r in read(spark, path)] == ["a!", "b!"]


def test_old_versions_go_and_only_they(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partitions(days(spark, *A), path, ("day",))
    for k in range(4):
        publish.replace_partitions(days(spark, (9, "2024-01-02", str(k))), path, ("day",))
    assert read(spark, path) == [A[0], (9, "2024-01-02", "3")]
    folders = [d for d in os.listdir(f"{path}/_data") if os.listdir(f"{path}/_data/{d}")]
    assert len(os.listdir(f"{path}/_data")) <= 5 and len([n for n in os.listdir(f"{path}/_manifest") if n.endswith(".json")]) == 2
    live = [d for d in folders for x in os.listdir(f"{path}/_data/{d}") if x == "day=2024-01-02"]
    assert len(live) == 2                # of the two newest manifests


def test_second_writer_of_a_version_fails_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.full_refresh(days(spark, *A), path)
    stale = publish.manifest(spark, path)
    publish.full_refresh(days(spark, *B), path)
    monkeypatch.setattr(publish, "manifest", lambda *a: stale)
    with pytest.raises(publish.ConcurrentWrite):
        publish.full_refresh(days(spark, *A), path)
    monkeypatch.undo()
    assert read(spark, path) == B


def test_partition_filters_prune_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partitions(days(spark, *A, *B), path, ("day",))
    publish.add(days(spark, *A), path, ("day",))
    df = publish.read_table(spark, path).where("day = date'2024-01-01'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and df.count() == 2
    assert len(df.inputFiles()) >= 1 and all("day=2024-01-01" in f for f in df.where("1 = 1").select(F.input_file_name().alias("f")).distinct().toPandas()["f"])


def test_a_plain_folder_becomes_the_first_version(spark, tmp_path):
    path = str(tmp_path / "t")
    days(spark, *A).write.partitionBy("day").parquet(path)
    publish.replace_partitions(days(spark, *B), path, ("day",))
    assert read(spark, path) == [A[0], *B]
