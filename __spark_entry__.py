"""

Every query reads the driver's tables (through the fixture view of `events`, see
FIXTURES.md) and runs over the whole table.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# the package lives next to this file; make it importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.session import ensure_session, session_key
from cellscope.plans import publish
from cellscope.plans.layers import Layers
from cellscope import schemas as S
from cellscope.operators import curated, incremental, ingest, kpi, quality, serving, staging
from cellscope.functions import expressions as X
from cellscope.sources import cdc, fixture

SMOKE_DIR = "/root/testdata/sf0.001"


def _raw_table(spark: SparkSession, sf_dir: str, landed: bool = False) -> DataFrame:
    """The raw table as a row-local view of `events` (with re-deliveries if `landed`): a plan
    over three columns of the scan, nothing is written."""
    ensure_session(spark)
    return fixture.landed_events(spark, sf_dir) if landed else fixture.network_events(spark, sf_dir)


_LAYERS: dict = {}


def _layers(spark: SparkSession, sf_dir: str) -> Layers:
    """One lazily built chain of layers per session and data folder (plan objects only)."""
    key = (session_key(spark), sf_dir)
    if key not in _LAYERS:
        _LAYERS[key] = Layers(_raw_table(spark, sf_dir))
    return _LAYERS[key]


_STAGED: dict = {}


def _staged_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers over a written staging table, for queries of which several branches read a layer: it is derived
    from `events` once for a session and data folder, as a run of the pipeline writes it once."""
    key = (session_key(spark), sf_dir)
    if key not in _STAGED:
        layers = Layers(_raw_table(spark, sf_dir))
        made: list[str] = []
        layers.__dict__["stg"] = publish.stage(layers.stg, "stg", made)
        _STAGED[key] = (spark, layers, made)
    return _STAGED[key][1]


def reset_cache() -> None:
    """Forget layer objects, delete staged tables."""
    _LAYERS.clear()
    for spark, _, made in _STAGED.values():
        for path in made:
            publish.drop(spark, path)
    _STAGED.clear()


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: which cells need attention now (cell quality ranking) on sf0.001."""
    return _layers(spark, SMOKE_DIR).ranking()


def _stg_text(df: DataFrame) -> DataFrame:
    return staging.with_flag_text(df).drop("is_valid")


def q_stg_events(spark, d):
    return _stg_text(_layers(spark, d).stg)


def q_stg_valid(spark, d):
    return _stg_text(_layers(spark, d).valid)


def q_stg_rejected(spark, d):
    return _stg_text(_layers(spark, d).rejected)


def q_stg_flag_counts(spark, d):
    return staging.flag_counts(_layers(spark, d).stg)


def q_fct_voice_call(spark, d):
    return _layers(spark, d).voice


def q_fct_data_session(spark, d):
    return _layers(spark, d).data


def q_dim_cell_site(spark, d):
    return _layers(spark, d).dim_cell


def q_reference_time(spark, d):
    L = _layers(spark, d)
    return serving.reference_time_df(L.voice, L.data)


def q_voice_agg(spark, d):
    L = _layers(spark, d)
    return serving.voice_agg(L.voice, L.reference_time())


def q_data_agg(spark, d):
    L = _layers(spark, d)
    return serving.data_agg(L.data, L.reference_time()).select(
        "cell_id", "data_session_count",
        F.round("avg_throughput_mbps", 6).cast("double").alias("avg_throughput_mbps"),
        F.round("avg_latency_ms", 6).cast("double").alias("avg_latency_ms"))


def q_cell_quality_ranking(spark, d):
    return _layers(spark, d).ranking()


def q_dim_subscriber(spark, d):
    return _staged_layers(spark, d).dim_sub


def q_churn_signals(spark, d):
    return _staged_layers(spark, d).churn()


def q_subscriber_activity(spark, d):
    L = _layers(spark, d)
    return serving.subscriber_activity(L.voice, L.data, L.ref)


def q_poor_experience(spark, d):
    L = _layers(spark, d)
    return serving.poor_experience(L.voice, L.data, L.dim_cell, L.ref)


def q_plan_as_of_event(spark, d):
    L = _staged_layers(spark, d)
    return curated.plan_as_of_event(L.voice, L.data, L.dim_sub)


def q_fct_by_date(spark, d):
    return curated.fct_by_date(_layers(spark, d).voice)


def q_cell_hourly_kpi(spark, d):
    _, _, made = _STAGED.setdefault(("kpi", session_key(spark), d), (spark, None, []))
    return kpi.cell_hourly_kpi(_layers(spark, d).valid, lambda df, name: publish.stage(df, name, made))


def q_region_quality(spark, d):
    return kpi.region_quality(_layers(spark, d).valid)


def q_cell_weekly_quality(spark, d):
    return kpi.region_quality(_layers(spark, d).valid, period="week", level="cell_id")


def q_dq_unique(spark, d):
    L = _staged_layers(spark, d)
    return quality.checks_table([quality.event_key_checks(L.stg)]
                                + quality.dimension_key_checks(L.dim_cell, L.dim_sub)
                                + quality.serving_checks(L.ranking(), L.churn()))


def q_dq_accepted_values(spark, d):
    L = _layers(spark, d)
    return quality.checks_table([quality.accepted_values(L.voice, "fct_voice_call", "call_result",
                                                         ("completed", "dropped", "failed_setup"))])


def q_dq_relationships(spark, d):
    L = _staged_layers(spark, d)
    return quality.checks_table(quality.relationship_checks(L.dim_cell, L.dim_sub, L.voice, L.data))


def _curated_checks(L: Layers, event_models: tuple[str, ...]) -> list:
    return ([quality.event_key_checks(L.stg, event_models)] + quality.dimension_key_checks(L.dim_cell, L.dim_sub)
            + [quality.accepted_values(L.voice, "fct_voice_call", "call_result", S.CALL_RESULTS)]
            + quality.relationship_checks(L.dim_cell, L.dim_sub, L.voice, L.data))


def q_dq_gate(spark, d):
    L = _staged_layers(spark, d)
    checks = quality.checks_table(_curated_checks(L, ("fct_voice_call", "fct_data_session")))
    return quality.gate_decision(checks, "curated")


def q_layer_counts(spark, d):
    L = _staged_layers(spark, d)
    others = quality.layer_counts({
        ("raw", "network_events"): L.raw,
        ("curated", "dim_cell_site"): L.dim_cell, ("curated", "dim_subscriber"): L.dim_sub,
        ("serving", "vw_cell_quality_ranking"): L.ranking(),
        ("serving", "vw_subscriber_churn_signals"): L.churn(),
    })
    return quality.staging_layer_counts(L.stg).unionByName(others)


def q_dq_completeness(spark, d):
    L = _layers(spark, d)
    return quality.checks_table([quality.equal_counts(L.stg, [L.valid, L.rejected],
                                                      "raw_equals_valid_plus_rejected", "stg_network_events")])


def q_dq_summary(spark, d):
    L = _staged_layers(spark, d)
    checks = quality.checks_table(_curated_checks(L, ("stg_network_events", "fct_voice_call", "fct_data_session")))
    return quality.flag_summary(staging.flag_counts(L.stg), checks)


def q_dq_drift_keys(spark, d):
    return quality.drift_keys(_layers(spark, d).stg)


def q_stg_volte(spark, d):
    return quality.volte_counts(_layers(spark, d).stg)


def q_dq_freshness(spark, d):
    return quality.freshness(_layers(spark, d).raw, F.lit("2024-01-31 00:00:00").cast("timestamp"))


def q_dq_reconcile(spark, d):
    L = _layers(spark, d)
    source = fixture.read_table(spark, d, "events")
    # only windows closed by the newest source change are compared
    newest = source.agg(F.max("ts").cast("timestamp")).scalar()
    return quality.reconcile(source, L.stg, "ts", "event_time", closed_before=newest)


def q_cdc_latency(spark, d):
    return quality.cdc_latency(_layers(spark, d).raw)


def q_degraded_recall(spark, d):
    L = _layers(spark, d)
    return quality.degraded_recall(L.ranking(), fixture.degraded_cells(L.dim_cell), k=6)


def q_cdc_unwrap(spark, d):
    raw = _raw_table(spark, d)
    # voice/data rows arrive as full change envelopes, sms rows as already-unwrapped records
    value = cdc.record_json(raw, envelope=F.col("event_type") != "sms")
    out = cdc.record_to_raw(cdc.unwrap(raw.select(value.alias("value"))))
    return out.select(*S.RECORD_COLUMNS, "extra", "_cdc_source_ts_ms")


def q_flatten_events(spark, d):
    raw = _raw_table(spark, d)
    nested = F.to_json(F.struct(
        "event_id", "event_type", F.col("event_time_raw").alias("event_time"),
        F.struct("subscriber_id", F.col("subscriber_msisdn_masked").alias("msisdn_masked"),
                 F.col("subscriber_plan").alias("plan"),
                 F.col("subscriber_activation_date").cast("string").alias("activation_date")).alias("subscriber"),
        F.struct("cell_id", F.col("cell_region").alias("region"),
                 F.col("cell_radio_tech").alias("radio_tech")).alias("cell"),
        "signal_dbm", "duration_sec", "call_result", "data_volume_mb", "avg_throughput_mbps", "latency_ms",
        F.from_json("extra", cdc.ANY_MAP).alias("extra")))
    return cdc.flatten_nested(raw.select(nested.alias("value")))


def q_epoch_day_decode(spark, d):
    raw = _raw_table(spark, d)
    # the connector sends DATE as epoch days; older records carry ISO text: both decode
    value = F.when(F.col("event_type") == "sms", cdc.record_json(raw, activation_as_epoch_days=False)) \
        .otherwise(cdc.record_json(raw))
    out = cdc.record_to_raw(cdc.unwrap(raw.select(value.alias("value"))))
    return out.select("event_id", "subscriber_activation_date")


def q_drift_extra(spark, d):
    raw = _raw_table(spark, d)
    fields = [F.col(c) for c in S.RECORD_COLUMNS]
    value = F.to_json(F.struct(*fields, F.col("extra"), F.lit("v2").alias("probe_version"),
                               F.col("_loaded_at").cast("string").alias("inserted_at"),
                               F.col("_cdc_source_ts_ms").alias(S.SOURCE_TS_FIELD)))
    out = cdc.record_to_raw(cdc.unwrap(raw.select(value.alias("value"))))
    kv = F.explode(F.from_json("extra", cdc.ANY_MAP))
    return out.select("event_id", kv).select("event_id", F.col("key").alias("drift_key"),
                                             F.to_json("value").alias("drift_value"))


def q_ingest_hour_partitions(spark, d):
    return ingest.ingest_hour_partitions(_raw_table(spark, d), "_cdc_source_ts_ms")


def q_raw_keep_first(spark, d):
    kept = ingest.keep_first(_raw_table(spark, d, landed=True))
    return kept.select("event_id", "cell_region", "_source_object_key")


def _ledger_scenario(spark, d):
    """Objects of the first half of the month were loaded by earlier runs."""
    landed = _raw_table(spark, d, landed=True)
    objects = landed.select(F.col("_source_object_key").alias("object_key")).distinct()
    ledger = objects.where(ingest.object_date("object_key") < "2024-01-16")
    return landed, objects, ledger


def q_load_ledger_skip(spark, d):
    _, objects, ledger = _ledger_scenario(spark, d)
    return ingest.objects_to_load(objects, ledger)


def q_load_report(spark, d):
    landed, objects, ledger = _ledger_scenario(spark, d)
    in_ledger = landed.join(ledger.withColumnRenamed("object_key", "_source_object_key"),
                            "_source_object_key", "left_semi")
    batch = landed.join(ledger.withColumnRenamed("object_key", "_source_object_key"),
                        "_source_object_key", "left_anti")
    inserted = ingest.keep_first(batch, target=in_ledger)
    return ingest.load_report(objects, ledger, inserted)


def q_fct_incremental(spark, d):
    L = _staged_layers(spark, d)
    first_run = L.voice.where(F.col("event_time") < F.lit("2024-01-16 00:00:00").cast("timestamp"))
    states = [incremental.merge(first_run, L.voice, late=mode).select(F.lit(mode).alias("late_mode"), "*")
              for mode in ("drop", "upsert")]
    return states[0].unionByName(states[1])


def q_msisdn_mask(spark, d):
    # numbers as sources write them (derived from the user id), masked on the way out: the full
    # form, other spellings of it, one that is masked already and text that is no number
    digits = F.lpad((F.col("user_id") % 10000000).cast("string"), 7, "0")
    written = (F.when(F.col("event_id") % 6 == 1, F.concat(F.lit("99450"), digits))
               .when(F.col("event_id") % 6 == 2, F.concat(F.lit("0"), F.lit("50"), digits))
               .when(F.col("event_id") % 6 == 3, F.concat(F.lit("+99450 "), F.substring(digits, 1, 3), F.lit(" "),
                                                          F.substring(digits, 4, 4)))
               .when(F.col("event_id") % 6 == 4, F.concat(F.lit("+99450***"), F.substring(digits, 4, 4)))
               .when(F.col("event_id") % 6 == 5, F.concat(F.lit("sim-"), digits))
               .otherwise(F.concat(F.lit("+99450"), digits)))
    events = fixture.read_table(spark, d, "events")
    return events.select(F.col("event_id").cast("string").alias("event_id"),
                         X.mask_msisdn(written).alias("subscriber_msisdn_masked"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_events": q_stg_events,
    "stg_valid": q_stg_valid,
    "stg_rejected": q_stg_rejected,
    "stg_flag_counts": q_stg_flag_counts,
    "fct_voice_call": q_fct_voice_call,
    "fct_data_session": q_fct_data_session,
    "dim_cell_site": q_dim_cell_site,
    "reference_time": q_reference_time,
    "voice_agg": q_voice_agg,
    "data_agg": q_data_agg,
    "cell_quality_ranking": q_cell_quality_ranking,
    "dim_subscriber": q_dim_subscriber,
    "churn_signals": q_churn_signals,
    "subscriber_activity": q_subscriber_activity,
    "poor_experience": q_poor_experience,
    "plan_as_of_event": q_plan_as_of_event,
    "fct_by_date": q_fct_by_date,
    "cell_hourly_kpi": q_cell_hourly_kpi,
    "region_quality": q_region_quality,
    "cell_weekly_quality": q_cell_weekly_quality,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_relationships": q_dq_relationships,
    "dq_gate": q_dq_gate,
    "layer_counts": q_layer_counts,
    "dq_completeness": q_dq_completeness,
    "dq_summary": q_dq_summary,
    "dq_drift_keys": q_dq_drift_keys,
    "stg_volte": q_stg_volte,
    "dq_freshness": q_dq_freshness,
    "dq_reconcile": q_dq_reconcile,
    "cdc_latency": q_cdc_latency,
    "degraded_recall": q_degraded_recall,
    "cdc_unwrap": q_cdc_unwrap,
    "flatten_events": q_flatten_events,
    "epoch_day_decode": q_epoch_day_decode,
    "drift_extra": q_drift_extra,
    "ingest_hour_partitions": q_ingest_hour_partitions,
    "raw_keep_first": q_raw_keep_first,
    "load_ledger_skip": q_load_ledger_skip,
    "load_report": q_load_report,
    "fct_incremental": q_fct_incremental,
    "msisdn_mask": q_msisdn_mask,
}


def _corpus() -> tuple[dict, dict]:
    """Queries and reference SQL of the corpus operators and their pipeline, where present."""
    try:
        from cellscope.llm import queries as llm
    except ModuleNotFoundError as e:
        if not (e.name or "").startswith("cellscope.llm"):
            raise
        return {}, {}
    found, sql = dict(llm.QUERIES), dict(llm.ORACLE_SQL)
    try:
        import corpus_pipeline
    except ModuleNotFoundError as e:
        if e.name != "corpus_pipeline":
            raise
    else:
        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_corpus()[0]}


def oracle_sql() -> dict[str, str]:
    from cellscope.oracle_sql import QUERIES

    return {**{k: v for k, v in QUERIES.items() if k in _QUERIES}, **_corpus()[1]}
