"""Data-quality operators: declarative checks evaluated as one DataFrame, and the gate.

Every check reduces to a count of failing rows (or keys), computed with aggregates and
anti-joins; nothing is collected except the final check table (one row per check).
Null handling follows declarative-test conventions: `unique`, `accepted_values` and
`relationships` ignore NULL values, `not_null` counts them (T12).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope import schemas as S
from cellscope.operators.quantiles import exact_quantiles


class QualityGateError(RuntimeError):
    """Raised when a blocking check fails; nothing downstream is published."""


@dataclass(frozen=True)
class Check:
    name: str
    model: str
    column: str
    severity: str          # "error" blocks, "warn" reports
    failing: DataFrame     # one row, one bigint column `failing_rows`

    def as_row(self) -> DataFrame:
        return self.failing.select(
            F.lit(self.name).alias("check_name"), F.lit(self.model).alias("model"),
            F.lit(self.column).alias("column_name"), F.lit(self.severity).alias("severity"),
            F.col("failing_rows").cast("long").alias("failing_rows"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failing_rows"))


def unique(df: DataFrame, model: str, column: str, severity: str = "error") -> Check:
    """Number of key values that occur more than once (NULL ignored). The per-key count
    combines map-side, so a hot key is one partial row per task."""
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1))
    return Check(f"unique_{model}_{column}", model, column, severity, _count(dup))


def accepted_values(df: DataFrame, model: str, column: str, values, severity: str = "error") -> Check:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return Check(f"accepted_values_{model}_{column}", model, column, severity,
                 df.agg(F.count_if(bad).alias("failing_rows")))


def relationships(child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str,
                  parent_model: str, severity: str = "error") -> Check:
    """Child rows whose non-NULL key has no parent row (D6). Left-anti join; the parent side
    is reduced to its distinct keys first."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")
    return Check(f"relationships_{model}_{column}_to_{parent_model}", model, column, severity,
                 _count(orphans))


def equal_counts(total: DataFrame, parts: list[DataFrame], name: str, model: str) -> Check:
    """Completeness identity: rows(total) - sum(rows(parts)) must be 0 (E13). Signed counts
    are unioned and summed, so no join is needed."""
    signed = [total.agg(F.count(F.lit(1)).alias("n"))]
    signed += [p.agg((-F.count(F.lit(1))).alias("n")) for p in parts]
    gap = reduce(DataFrame.unionByName, signed).agg(F.abs(F.sum("n")).alias("failing_rows"))
    return Check(name, model, "*", "error", gap)


def model_checks(df: DataFrame, model: str, not_null: tuple[str, ...] = (), unique: str | None = None,
                 severity: str = "error", accepted: dict | None = None) -> DataFrame:
    """Every not-null and accepted-values check of a model plus its unique-key check from ONE pass over it.

    With a unique key the model is grouped once by that key (the per-key count combines
    map-side); the other counts ride along as per-key sums. One row per check comes out.
    """
    specs = [(f"not_null_{model}_{c}", c, F.col(c).isNull()) for c in not_null]
    specs += [(f"accepted_values_{model}_{c}", c, F.col(c).isNotNull() & ~F.col(c).isin(*values))
              for c, values in (accepted or {}).items()]
    bad = [F.count_if(x).alias(f"f{i}") for i, (_, _, x) in enumerate(specs)]
    named = [(name, c) for name, c, _ in specs]
    if unique is None:
        return _check_rows(df.agg(*bad), [(*x, model, severity) for x in named])
    per_key = df.groupBy(unique).agg(F.count(F.lit(1)).alias("_n"), *bad)
    totals = per_key.agg(*[F.sum(f"f{i}").alias(f"f{i}") for i in range(len(specs))],
                         F.count_if(F.col(unique).isNotNull() & (F.col("_n") > 1)).alias(f"f{len(specs)}"))
    return _check_rows(totals, [(*x, model, severity) for x in [*named, (f"unique_{model}_{unique}", unique)]])


def _check_rows(totals: DataFrame, checks: list[tuple[str, str, str, str]]) -> DataFrame:
    """One row with the counts f0, f1, ... -> a row for each check (name, column, model, severity)."""
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(model).alias("model"),
                              F.lit(column).alias("column_name"), F.lit(severity).alias("severity"),
                              F.coalesce(F.col(f"f{i}"), F.lit(0)).cast("long").alias("failing_rows"))
                     for i, (name, column, model, severity) in enumerate(checks)])
    return totals.select(F.inline(rows))


def all_relationships(children: dict[str, tuple[DataFrame, dict[str, str]]], parents: dict[str, tuple[DataFrame, str]],
                      severity: str = "error") -> DataFrame:
    """Q7 for many foreign keys from ONE pass over each table and one join.

    `children` maps a model to its rows and {foreign key: parent model}, `parents` a parent model to its rows and
    key. Each child counts its non-NULL key values, tagged with the parent, map-side; the tagged counts meet the tagged
    keys of all parents in one anti-join, so a hot key is one row and no check reads a table again."""
    checks, counts = [], []
    for model, (df, keys) in children.items():
        first = len(checks)
        checks += [(f"relationships_{model}_{c}_to_{parent}", c, model, severity) for c, parent in keys.items()]
        links = F.array(*[F.struct(F.lit(first + i).alias("check"), F.lit(parent).alias("parent"), F.col(c).cast("string").alias("key"))
                          for i, (c, parent) in enumerate(keys.items())])
        counts.append(df.select(F.inline(links)).where("key IS NOT NULL").groupBy("check", "parent", "key")
                      .agg(F.count(F.lit(1)).alias("n")))
    known = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("parent"), F.col(key).cast("string").alias("key")).distinct()
                                           for name, (df, key) in parents.items()])
    orphans = reduce(DataFrame.unionByName, counts).join(known, ["parent", "key"], "left_anti")
    return _check_rows(orphans.agg(*[F.sum(F.when(F.col("check") == i, F.col("n"))).alias(f"f{i}") for i in range(len(checks))]), checks)


def checks_table(checks: list) -> DataFrame:
    """All checks (Check objects or ready check rows) as one DataFrame with a status."""
    rows = reduce(DataFrame.unionByName, [c.as_row() if isinstance(c, Check) else c for c in checks])
    status = (F.when(F.col("failing_rows") == 0, "pass")
              .when(F.col("severity") == "error", "fail").otherwise("warn"))
    return rows.withColumn("status", status)


def staging_checks(stg: DataFrame) -> list:
    """Q1: event id not null and unique on staging (blocks curated)."""
    return [model_checks(stg, "stg_network_events", ("event_id",), "event_id")]


def stored_key_checks(ids: DataFrame, raw_rows: int) -> DataFrame | None:
    """Q1 of staging from the stored ids of the raw table (plans/keys.py), which lie in buckets: no shuffle.

    Ids are only ever stored from raw rows, and every raw row's id is. So as many of them as raw rows, none of them
    twice and none NULL, means that the key holds. None if it doesn't: then `staging_checks` says where."""
    per_id = ids.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    seen = per_id.agg(F.count("event_id").alias("different"), F.sum("n").alias("stored")).first()
    if not seen["different"] == (seen["stored"] or 0) == raw_rows:
        return None
    model = "stg_network_events"
    return _check_rows(ids.sparkSession.createDataFrame([(0, 0)], "f0 long, f1 long"),
                       [(f"{kind}_{model}_event_id", "event_id", model, "error") for kind in ("not_null", "unique")])


def event_key_checks(stg: DataFrame, models: tuple[str, ...] = ("stg_network_events", "fct_voice_call",
                                                                "fct_data_session")) -> DataFrame:
    """Q1 and Q12 on the event id of staging and of both facts, from ONE pass over staging (the
    facts are its valid rows by event type): one count per id and model, combined map-side."""
    et, valid = F.col("event_type"), F.col("is_valid")
    rows_of = {"stg_network_events": F.lit(True), "fct_voice_call": valid & (et == "voice_call"),
               "fct_data_session": valid & (et == "data_session")}
    per_key = stg.groupBy("event_id").agg(*[F.count_if(rows_of[m]).alias(m) for m in models])
    given = F.col("event_id").isNotNull()
    totals = per_key.agg(*[c for i, m in enumerate(models) for c in (
        F.sum(F.when(~given, F.col(m))).alias(f"f{2 * i}"), F.count_if(given & (F.col(m) > 1)).alias(f"f{2 * i + 1}"))])
    return _check_rows(totals, [(f"{kind}_{m}_event_id", "event_id", m, "error") for m in models for kind in ("not_null", "unique")])


def dimension_key_checks(dim_cell: DataFrame, dim_sub: DataFrame) -> list:
    """Q12 on the dimensions."""
    return [model_checks(dim_cell, "dim_cell_site", ("cell_id",), "cell_id"),
            model_checks(dim_sub, "dim_subscriber", ("subscriber_id", "valid_from"))]


def relationship_checks(dim_cell: DataFrame, dim_sub: DataFrame, voice: DataFrame, data: DataFrame) -> list:
    """Q7: every fact key has its dimension row."""
    keys = {"cell_id": "dim_cell_site", "subscriber_id": "dim_subscriber"}
    return [all_relationships({"fct_voice_call": (voice, keys), "fct_data_session": (data, keys)},
                              {"dim_cell_site": (dim_cell, "cell_id"), "dim_subscriber": (dim_sub, "subscriber_id")})]


def curated_checks(dim_cell: DataFrame, dim_sub: DataFrame, voice: DataFrame, data: DataFrame) -> list:
    """Q6, Q7, Q12 on the curated model (block serving): each fact is read twice, by its id and by its foreign keys."""
    return [*dimension_key_checks(dim_cell, dim_sub),
            model_checks(voice, "fct_voice_call", ("event_id",), "event_id", accepted={"call_result": S.CALL_RESULTS}),
            model_checks(data, "fct_data_session", ("event_id",), "event_id"),
            *relationship_checks(dim_cell, dim_sub, voice, data)]


def serving_checks(ranking: DataFrame, churn: DataFrame) -> list:
    """Q12/Q14 on the two views (reported, not blocking in the pipeline)."""
    return [
        model_checks(ranking, "vw_cell_quality_ranking", ("cell_id", "quality_rank"), "cell_id"),
        model_checks(churn, "vw_subscriber_churn_signals", ("subscriber_id",), "subscriber_id"),
    ]


def gate(checks: DataFrame, layer: str) -> list:
    """Write-audit-publish gate (Q13): raise if any blocking check fails.

    Runs the checks once and returns their rows (one per check) for reporting.
    """
    rows = checks.collect()
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        names = ", ".join(f"{r['check_name']}={r['failing_rows']}" for r in failed)
        raise QualityGateError(f"{layer}: blocking checks failed: {names}")
    return rows


def gate_decision(checks: DataFrame, layer: str) -> DataFrame:
    """The gate's decision as a DataFrame: one row with the blocking failures and `publish`."""
    return checks.agg(
        F.lit(layer).alias("layer"),
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("status") == "fail").alias("checks_failed"),
        F.count_if(F.col("status") == "warn").alias("checks_warned"),
        (F.count_if(F.col("status") == "fail") == 0).alias("publish"))


def drift_keys(stg: DataFrame, known=S.KNOWN_DRIFT_KEYS) -> DataFrame:
    """Unrecognised keys in `extra` with their row counts (Q8, warn-level)."""
    keys = stg.select(F.explode(F.json_object_keys("extra")).alias("drift_key"))
    return (keys.where(~F.col("drift_key").isin(*known))
            .groupBy("drift_key").agg(F.count(F.lit(1)).alias("row_count")))


def drift_report(stg: DataFrame, most: int = 100) -> DataFrame:
    """The `most` frequent unrecognised keys with their exact counts, and one row (drift_key NULL) for all
    others: how many keys, and in how many places. Producers choose the keys, so their number has no bound; the
    report has one."""
    counts = drift_keys(stg)
    top = counts.orderBy(F.desc("row_count"), "drift_key").limit(most) \
        .select("drift_key", F.lit(1).cast("long").alias("n_keys"), "row_count")
    # all keys count once towards the rest, the listed ones are taken off again: exact, one row
    taken = top.select((-F.col("n_keys")).alias("n_keys"), (-F.col("row_count")).alias("row_count"))
    rest = counts.select(F.lit(1).cast("long").alias("n_keys"), "row_count").unionByName(taken) \
        .agg(F.sum("n_keys").alias("n_keys"), F.sum("row_count").alias("row_count")).where("n_keys > 0")
    return top.unionByName(rest.select(F.lit(None).cast("string").alias("drift_key"), "n_keys", "row_count"))


def volte_counts(stg: DataFrame) -> DataFrame:
    """Distribution of the promoted drift column."""
    return stg.groupBy("volte_enabled").agg(F.count(F.lit(1)).alias("row_count"))


def freshness(raw: DataFrame, as_of: Column, warn_hours: int = S.FRESHNESS_WARN_HOURS) -> DataFrame:
    """Newest `_loaded_at` against a supplied clock (Q9): lag in seconds and pass/warn."""
    agg = raw.agg(F.max("_loaded_at").alias("newest_loaded_at"))
    lag = (F.unix_micros(as_of) - F.unix_micros(F.col("newest_loaded_at"))) / F.lit(1_000_000)
    return agg.select("newest_loaded_at", as_of.alias("as_of"), lag.cast("double").alias("lag_seconds"),
                      F.when(lag <= warn_hours * 3600, "pass").otherwise("warn").alias("status"))


def reconcile(source: DataFrame, raw: DataFrame, source_time: str, raw_time: str,
              warn_ratio: float = S.RECONCILE_WARN_RATIO, fail_ratio: float = S.RECONCILE_FAIL_RATIO,
              closed_before: Column | None = None) -> DataFrame:
    """Source vs raw row counts per day window (Q10): warn above 0.5 %, fail above 2 %.

    With `closed_before` (a timestamp, e.g. the newest source change), only windows that
    ended by then are compared: rows of an open window may still be in flight.
    Both sides are reduced to one row per day before they meet, so the join is tiny.
    """
    s = source.groupBy(F.to_date(source_time).alias("window_date")).agg(F.count(F.lit(1)).alias("source_rows"))
    r = raw.where(F.col(raw_time).isNotNull()).groupBy(F.to_date(raw_time).alias("window_date")).agg(
        F.count(F.lit(1)).alias("raw_rows"))
    j = s.join(r, "window_date", "full").na.fill(0, ["source_rows", "raw_rows"])
    if closed_before is not None:
        j = j.where(F.date_add("window_date", 1).cast("timestamp") <= closed_before)
    gap = F.try_divide((F.col("source_rows") - F.col("raw_rows")).cast("double"), F.col("source_rows").cast("double"))
    return j.select("window_date", F.col("source_rows").cast("long").alias("source_rows"),
                    F.col("raw_rows").cast("long").alias("raw_rows"),
                    F.round(gap, 6).alias("gap_ratio"),
                    F.when(F.abs(gap) > fail_ratio, "fail").when(F.abs(gap) > warn_ratio, "warn")
                    .otherwise("pass").alias("status"))


def cdc_latency(raw: DataFrame) -> DataFrame:
    """End-to-end CDC latency per load date: `_loaded_at` minus the source change time (Q15).

    Rows are counted per date and latency first, which combines map-side; the percentiles are then
    selected from the distinct latencies (quantiles.py) in three steps of 16 bits, so that no task
    holds the latencies of a day."""
    lat = ((F.unix_micros("_loaded_at") - F.col("_cdc_source_ts_ms") * 1000) / F.lit(1_000_000)).cast("double")
    counted = (raw.where(F.col("_cdc_source_ts_ms").isNotNull())
               .groupBy(F.to_date("_loaded_at").alias("load_date"), lat.alias("lat")).agg(F.count(F.lit(1)).alias("n")))
    totals = counted.groupBy("load_date").agg(F.sum("n").alias("row_count"), F.max("lat").alias("top"))
    both = (exact_quantiles(counted, ["load_date"], "lat", "n", (0.5, 0.95), 1e-6, (32, 16))
            .select(F.col("load_date").alias("_date"), "quantiles"))
    return (totals.join(both, F.col("load_date").eqNullSafe(F.col("_date")), "left")
            .select("load_date", "row_count", F.round(F.col("quantiles")[0], 3).alias("p50_latency_s"),
                    F.round(F.col("quantiles")[1], 3).alias("p95_latency_s"), F.round("top", 3).alias("max_latency_s")))


def flag_summary(flag_counts: DataFrame, checks: DataFrame) -> DataFrame:
    """dq_summary (Q11): rows per staging flag, plus failing rows per declarative check."""
    flags = flag_counts.select(F.lit("flag").alias("kind"), F.col("flag").alias("name"),
                               F.col("row_count").cast("long").alias("failing_rows"),
                               F.lit("reject").alias("status"))
    tests = checks.select(F.lit("test").alias("kind"), F.col("check_name").alias("name"),
                          "failing_rows", "status")
    return flags.unionByName(tests)


def degraded_recall(ranking: DataFrame, ground_truth: DataFrame, k: int = 6) -> DataFrame:
    """Precision@k of the ranking against a ground-truth set of degraded cells (Q16).

    `ground_truth` has `cell_id` and boolean `degraded`. The top-k slice is the feature
    here (a worst-k report), taken by rank.
    """
    top = ranking.where(F.col("quality_rank") <= k).select("cell_id")
    joined = top.join(ground_truth, "cell_id", "left")
    return joined.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("ranked_cells"),
                      F.count_if(F.col("degraded")).alias("degraded_in_top_k"),
                      F.round(F.count_if(F.col("degraded")) / F.lit(float(k)), 4).alias("precision_at_k"))


def layer_counts(models: dict) -> DataFrame:
    """Row count per (layer, model), as one union-all report."""
    parts = [df.agg(F.lit(layer).alias("layer"), F.lit(model).alias("model"),
                    F.count(F.lit(1)).alias("row_count"))
             for (layer, model), df in models.items()]
    return reduce(DataFrame.unionByName, parts)


def staging_layer_counts(stg: DataFrame) -> DataFrame:
    """Row counts of staging, its valid/rejected split and the two facts, from ONE pass over
    staging (the split and the facts are filters of it)."""
    valid, et = F.col("is_valid"), F.col("event_type")
    parts = [("staging", "stg_network_events", F.count(F.lit(1))),
             ("staging", "stg_network_events_valid", F.count_if(valid)),
             ("staging", "stg_network_events_rejected", F.count_if(~valid)),
             ("curated", "fct_voice_call", F.count_if(valid & (et == "voice_call"))),
             ("curated", "fct_data_session", F.count_if(valid & (et == "data_session")))]
    totals = stg.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(parts)])
    rows = F.array(*[F.struct(F.lit(layer).alias("layer"), F.lit(model).alias("model"),
                              F.col(f"c{i}").cast("long").alias("row_count"))
                     for i, (layer, model, _) in enumerate(parts)])
    return totals.select(F.inline(rows))
