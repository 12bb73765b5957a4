"""Physical-plan properties the scale design relies on."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from cellscope.operators import curated, serving
from cellscope.plans.layers import Layers
from cellscope.session import scratch_path

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _published_facts(spark, L):
    p = scratch_path(spark, "plan-facts")
    L.voice.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(p + "/v")
    L.data.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(p + "/d")
    return spark.read.parquet(p + "/v"), spark.read.parquet(p + "/d")


def test_ranking_window_prunes_partitions_and_pushes_filters(spark):
    L = Layers(E._raw_table(spark, SF))
    voice, data = _published_facts(spark, L)
    text = plan(serving.cell_quality_ranking(voice, data, L.dim_cell))
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "GreaterThan(event_time" in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    # only the needed fact columns are read
    assert re.search(r"ReadSchema: struct<event_time:timestamp,cell_id:string,call_result:string>", text)


def test_churn_has_no_nested_loop_or_cartesian_join(spark):
    L = Layers(E._raw_table(spark, SF))
    text = plan(L.churn())
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_plan_history_shuffles_events_twice_and_runs_twice(spark):
    L = Layers(E._raw_table(spark, SF))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(curated.dim_subscriber(L.valid))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # events: counted by slice, dealt by slice; outer runs of slices: by 30 days, then by subscriber
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 4


def test_latest_cell_combines_map_side(spark):
    L = Layers(E._raw_table(spark, SF))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(curated.dim_cell_site(L.valid))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # a partial (map-side) aggregate sits below the shuffle on cell_id
    assert "partial_max" in text
    assert text.index("Exchange hashpartitioning(cell_id") < text.index("partial_max")
