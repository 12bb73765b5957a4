"""One logical date end to end: load -> staging -> gate -> curated -> gate -> serving, and
the hourly KPI beside it (write-audit-publish, Q13).

Writes happen only at raw, curated, serving and KPI. Every layer is read back from its
written table, which also cuts the lineage: a lost executor recomputes from the last written
table, not from the lake.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.operators import curated, incremental, ingest, kpi, quality, serving, staging
from cellscope.plans import keys, publish
from cellscope.plans.load import LoadResult, load_date, raw_path


@dataclass
class PipelineResult:
    load: LoadResult
    checks: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)

    @property
    def failed(self) -> list[str]:
        """Names of the checks that failed without blocking (Q14)."""
        return [r["check_name"] for rows in self.checks.values() for r in rows
                if "check_name" in r.asDict() and r["status"] == "fail"]


def table(warehouse: str, layer: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{layer}/{name}"


def publish_fact(spark: SparkSession, source: DataFrame, path: str, late: str = "upsert",
                 key: str = "event_id") -> None:
    """Merge `source` into a fact table partitioned by `event_date`.

    upsert: unseen ids are added (late data kept). drop: rows newer than the table's newest
    event time replace matching ids; replace: all rows do. The touched dates (of new rows and of
    replaced old rows) are replaced. Either way readers see all of it or nothing.
    """
    source = source.withColumn("event_date", F.to_date("event_time"))
    target = publish.read_table(spark, path)
    if target is None:
        publish.replace_partitions(source, path, ("event_date",))
        return
    new = incremental.new_rows(target, source, key, late=late)
    if late == "upsert":
        publish.add(new, path, ("event_date",))
        return
    with publish.staged(new, "fact-new") as new:
        touched = incremental.touched_partitions(target, new, key, "event_date")
        # one value for each date that the run rewrites; a date whose rows all moved is left without any
        dates = [str(r["event_date"]) for r in touched.collect()]
        old = target.where(F.col("event_date").cast("string").isin(*dates)) if dates else target.limit(0)
        publish.replace_partitions(old.join(new.select(key), key, "left_anti").unionByName(new), path, ("event_date",), touched=dates)


def publish_dims(spark: SparkSession, valid_all: DataFrame, valid_run: DataFrame, paths: dict,
                 incremental_dims: bool = True) -> None:
    """Cell dimension (SCD1) and subscriber history (SCD2).

    Incremental (default): the cell dimension merges its stored latest state with the run's
    rows, the subscriber history its stored versions with those of the run; older rows are read only for
    subscribers of whom a late event splits a stored version. Both equal a full rebuild because the raw table is append-only. The first run, or
    `incremental_dims=False`, rebuilds from all valid rows as the source system does.
    """
    cell_state = publish.read_table(spark, paths["dim_cell_site"])
    sub_state = publish.read_table(spark, paths["dim_subscriber"])
    if incremental_dims and cell_state is not None and "_event_id" in cell_state.columns:
        publish.full_refresh(curated.merge_dim_cell_site(cell_state, valid_run), paths["dim_cell_site"])
    else:
        publish.full_refresh(curated.dim_cell_site(valid_all, keep_state=True), paths["dim_cell_site"])
    if incremental_dims and sub_state is not None and set(curated.VERSION_STATE) <= set(sub_state.columns):
        made: list[str] = []
        stage = lambda df, name: publish.stage(df, name, made)
        publish.full_refresh(curated.merge_dim_subscriber(sub_state, valid_all, valid_run, stage), paths["dim_subscriber"])
        for p in made:
            publish.drop(spark, p)
    else:
        publish.full_refresh(curated.dim_subscriber(valid_all, keep_state=True), paths["dim_subscriber"])


def publish_kpi(spark: SparkSession, warehouse: str, date: str, keep_flags: tuple[str, ...] = ()) -> None:
    """Hourly KPI (a job of its own in the source system, needing the raw table alone): replace
    every event date that rows ingested on `date` touch, with events ingested on other days counted.

    `_kpi_partials` stores the partial aggregates of each ingestion date, so only raw rows of `date` are
    read, and those of dates whose number of raw rows is not the one that `_kpi_covered` has for them
    (never counted, loaded since, or counted under other `keep_flags`: of all dates then). The KPI is
    published first, then the partials, then the numbers: a run killed in between is repeated by the next one.
    """
    raw = publish.read_table(spark, raw_path(warehouse))
    if raw is None:
        return
    paths = {n: table(warehouse, "curated", n) for n in ("agg_cell_hourly_kpi", "_kpi_partials", "_kpi_covered")}
    flags = ",".join(sorted(keep_flags))
    as_text = F.col("_ingest_date").cast("string").alias("_ingest_date")
    # one row for each ingestion date; no column is read for it, only the files' row counts
    have = raw.groupBy(as_text).agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("keep_flags", F.lit(flags))
    have = spark.createDataFrame(have.collect(), have.schema)
    covered = publish.read_table(spark, paths["_kpi_covered"], have)
    stale = have.join(covered, [*have.columns], "left_anti").select("_ingest_date").collect()
    dates = sorted({date, *[r["_ingest_date"] for r in stale]})
    rows = raw.where(F.col("_ingest_date").cast("string").isin(*dates))
    valid = staging.stg_valid(staging.stg_network_events(rows.drop("_ingest_date"), keep_flags))
    ingested = F.to_date(ingest.object_date("_source_object_key")).cast("string")
    new = kpi.kpi_partials(valid, ingested.alias("_ingest_date")).withColumn("kpi_date", F.to_date("kpi_hour"))
    with publish.staged(new, "kpi-partials") as new:
        old = publish.read_table(spark, paths["_kpi_partials"], new)
        mine = F.col("_ingest_date").cast("string").isin(*dates)
        touched = new.select("kpi_date").union(old.where(mine).select("kpi_date")).distinct()
        touched = [str(r["kpi_date"]) for r in touched.collect()]       # one for each date that the run replaces
        if touched:
            merged = old.where(~mine).unionByName(new).where(F.col("kpi_date").cast("string").isin(*touched))
            publish.replace_partitions(kpi.kpi_from_partials(merged), paths["agg_cell_hourly_kpi"], ("kpi_date",), touched=touched)
        gone = tuple(f"_ingest_date={d}/" for d in dates)
        publish.publish(new, paths["_kpi_partials"], ("_ingest_date", "kpi_date"), keep=lambda part, _: not part.startswith(gone))
    publish.full_refresh(have, paths["_kpi_covered"])


def publish_dq_summary(spark: SparkSession, warehouse: str, date: str, result: PipelineResult) -> None:
    """Q11 of one run: rows per flag and failing rows per check, as the run's day of a table.
    The rows are those of the checks that ran (one per check or flag)."""
    rows = [("flag", r["flag"], r["row_count"], "reject") for r in result.checks.get("flags", [])]
    for layer in ("staging", "curated", "serving", "completeness"):
        rows += [("test", r["check_name"], r["failing_rows"], r["status"]) for r in result.checks.get(layer, [])]
    df = spark.createDataFrame(rows, "kind string, name string, failing_rows long, status string")
    publish.replace_partitions(df.withColumn("run_date", F.lit(date)), table(warehouse, "quality", "dq_summary"),
                               ("run_date",), touched=[date])


def run_pipeline(spark: SparkSession, lake_root: str, warehouse: str, date: str,
                 late: str = "upsert", keep_flags: tuple[str, ...] = (),
                 incremental_dims: bool = True,
                 on_malformed: str = "failfast", source: DataFrame | None = None,
                 source_time: str = "event_time") -> PipelineResult:
    """Load one logical date and publish every layer that depends on it.

    Order: load (ledger + keep-first) -> hourly KPI (it needs the raw table alone, so no gate holds it
    back) -> staging checks (block curated) -> dimensions and
    facts -> curated checks (block serving) -> serving views -> non-blocking reports. Re-running a date, also after a crash part-way, converges to the same tables:
    the load inserts nothing twice and the facts merge the date's rows by `event_id`.

    late: incremental policy of the facts ("upsert" keeps late rows, "drop" reproduces the
    source system's watermark, "replace" also takes changed rows). keep_flags: flags that do not
    reject a row (T1). incremental_dims: merge instead of rebuild. on_malformed: see `load_date`. source: the source system's rows, if at hand: their
    counts by day of `source_time` are compared with the raw table's (Q10), for days that the newest source row closed.
    """
    result = PipelineResult(load=load_date(spark, lake_root, warehouse, date, on_malformed))

    raw_all = publish.read_table(spark, raw_path(warehouse))
    if raw_all is None:        # nothing landed yet: nothing to publish
        return result
    raw_run = raw_all.where(F.col("_ingest_date") == date).drop("_ingest_date")
    stg_all = staging.stg_network_events(raw_all.drop("_ingest_date"), keep_flags)
    stg_run = staging.stg_network_events(raw_run, keep_flags)

    publish_kpi(spark, warehouse, date, keep_flags)
    if source is not None:
        newest = source.agg(F.max(source_time).cast("timestamp").alias("t")).first()["t"]
        result.checks["reconcile"] = quality.reconcile(source, stg_all, source_time, "event_time", closed_before=F.lit(newest)).collect()

    # staging gate (Q1) on the whole model: an id of this run may clash with an earlier one
    known = quality.stored_key_checks(keys.cover(spark, warehouse, raw_path(warehouse)), raw_all.count())
    result.checks["staging"] = quality.gate(quality.checks_table([known] if known is not None else quality.staging_checks(stg_all)), "staging")

    # curated: dimensions merged (or rebuilt), facts merged from this run's rows
    valid_all, valid_run = staging.stg_valid(stg_all), staging.stg_valid(stg_run)
    paths = {n: table(warehouse, "curated", n) for n in
             ("dim_cell_site", "dim_subscriber", "fct_voice_call", "fct_data_session")}
    publish_dims(spark, valid_all, valid_run, paths, incremental_dims)
    voice_run, data_run = curated.fct_voice_call(valid_run), curated.fct_data_session(valid_run)
    publish_fact(spark, voice_run, paths["fct_voice_call"], late)
    publish_fact(spark, data_run, paths["fct_data_session"], late)

    dim_cell = publish.read_table(spark, paths["dim_cell_site"])
    dim_sub = publish.read_table(spark, paths["dim_subscriber"])
    # event_date stays: the serving windows use it to prune partitions
    with_date = lambda df: df.withColumn("event_date", F.to_date("event_time"))
    voice = publish.read_table(spark, paths["fct_voice_call"], with_date(voice_run))
    data = publish.read_table(spark, paths["fct_data_session"], with_date(data_run))
    result.checks["curated"] = quality.gate(
        quality.checks_table(quality.curated_checks(dim_cell, dim_sub, voice, data)), "curated")

    # serving: materialised once per run, also exposed as temp views for analyst SQL
    ref = serving.reference_time_value(voice, data)
    ranking = serving.cell_quality_ranking(voice, data, dim_cell, ref)
    churn = serving.churn_signals(voice, data, dim_cell, dim_sub, ref)
    publish.full_refresh(ranking, table(warehouse, "serving", "vw_cell_quality_ranking"))
    publish.full_refresh(churn, table(warehouse, "serving", "vw_subscriber_churn_signals"))
    ranking = publish.read_table(spark, table(warehouse, "serving", "vw_cell_quality_ranking"))
    churn = publish.read_table(spark, table(warehouse, "serving", "vw_subscriber_churn_signals"))
    ranking.createOrReplaceTempView("vw_cell_quality_ranking")
    churn.createOrReplaceTempView("vw_subscriber_churn_signals")
    # serving tests report but do not block (Q14); so do freshness and drift (Q8, Q9, Q11)
    result.checks["serving"] = quality.checks_table(quality.serving_checks(ranking, churn)).collect()
    result.checks["freshness"] = quality.freshness(raw_run, F.current_timestamp()).collect()
    result.checks["drift_keys"] = quality.drift_report(stg_run).collect()
    result.checks["flags"] = staging.flag_counts(stg_run).collect()

    result.checks["completeness"] = quality.checks_table([quality.equal_counts(
        stg_run, [valid_run, staging.stg_rejected(stg_run)], "raw_equals_valid_plus_rejected", "stg_network_events")]).collect()
    publish_dq_summary(spark, warehouse, date, result)

    counts = quality.layer_counts({
        ("raw", "network_events"): raw_all, ("curated", "dim_cell_site"): dim_cell,
        ("curated", "dim_subscriber"): dim_sub, ("curated", "fct_voice_call"): voice,
        ("curated", "fct_data_session"): data, ("serving", "vw_cell_quality_ranking"): ranking,
        ("serving", "vw_subscriber_churn_signals"): churn}).collect()
    staged = quality.staging_layer_counts(stg_all).where("layer = 'staging'").collect()      # one pass
    result.counts = {r["model"]: r["row_count"] for r in [*counts, *staged]}
    return result


PUBLISHED = {
    "network_events": ("raw", "network_events"),
    "dim_cell_site": ("curated", "dim_cell_site"),
    "dim_subscriber": ("curated", "dim_subscriber"),
    "fct_voice_call": ("curated", "fct_voice_call"),
    "fct_data_session": ("curated", "fct_data_session"),
    "agg_cell_hourly_kpi": ("curated", "agg_cell_hourly_kpi"),
    "dq_summary": ("quality", "dq_summary"),
    "vw_cell_quality_ranking": ("serving", "vw_cell_quality_ranking"),
    "vw_subscriber_churn_signals": ("serving", "vw_subscriber_churn_signals"),
}


def register_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Expose every published table as a temp view for SQL users (analyst entry point).

    Views are lazy scans of the Parquet tables, so filters in the user's SQL still prune
    partitions and columns. Returns the names registered (tables not published yet are
    skipped).
    """
    names = []
    for view, (layer, name) in PUBLISHED.items():
        df = publish.read_table(spark, table(warehouse, layer, name))
        if df is not None:
            df.createOrReplaceTempView(view)
            names.append(view)
    return names
