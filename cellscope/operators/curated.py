"""Curated model: cell dimension (latest state), subscriber dimension (plan history), facts.

Skew notes. A single cell or subscriber may carry a third of all events, so nothing here puts
all rows of one key into one task:
* latest-per-cell is a `max(struct)` aggregate, which combines map-side before the shuffle;
* the plan history reduces time slices to their runs of equal plan and passes only a slice's
  first and last run on, hour -> 30 days -> whole history: an associative reduction, in which no window
  holds a subscriber's history; slices of a hot subscriber are cut finer until each holds a
  bounded number of events;
* the plan at an event is looked up inside such slices too, each with the version that was valid
  when it began: no event meets more than one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope import schemas as S


def fct_voice_call(valid: DataFrame) -> DataFrame:
    """Voice calls of the valid split."""
    return valid.where(F.col("event_type") == "voice_call").select(*S.VOICE_FACT_COLUMNS)


def fct_data_session(valid: DataFrame) -> DataFrame:
    """Data sessions of the valid split."""
    return valid.where(F.col("event_type") == "data_session").select(*S.DATA_FACT_COLUMNS)


def _cell_candidates(valid: DataFrame) -> DataFrame:
    return valid.select("cell_id", F.struct(
        F.col("_loaded_at").alias("t"), F.col("event_time").alias("et"), F.col("event_id").alias("id"),
        F.col("cell_region").alias("region"), F.col("cell_radio_tech").alias("tech")).alias("c"))


def _latest_cells(candidates: DataFrame, keep_state: bool) -> DataFrame:
    m = candidates.groupBy("cell_id").agg(F.max("c").alias("m"))
    cols = ["cell_id", F.col("m.region").alias("cell_region"), F.col("m.tech").alias("cell_radio_tech"),
            F.col("m.t").alias("last_seen_at")]
    if keep_state:
        cols += [F.col("m.et").alias("_event_time"), F.col("m.id").alias("_event_id")]
    return m.select(*cols)


def dim_cell_site(valid: DataFrame, keep_state: bool = False) -> DataFrame:
    """Latest observed attributes per cell (E7, I2; SCD type 1).

    Latest = greatest (`_loaded_at`, `event_time`, `event_id`): the load time alone ties across
    one object, so the event time and id decide deterministically (T4). `keep_state` also
    returns the tie-break fields, so that the table can later be merged incrementally.
    """
    return _latest_cells(_cell_candidates(valid), keep_state)


def merge_dim_cell_site(state: DataFrame, valid_new: DataFrame) -> DataFrame:
    """Incremental SCD1: previous latest state + this run's rows -> new latest state.

    Exact: `max` is associative and the raw table is append-only, so merging the stored
    maxima with the new rows equals recomputing over the whole history - without reading it.
    """
    prev = state.select("cell_id", F.struct(
        F.col("last_seen_at").alias("t"), F.col("_event_time").alias("et"), F.col("_event_id").alias("id"),
        F.col("cell_region").alias("region"), F.col("cell_radio_tech").alias("tech")).alias("c"))
    return _latest_cells(prev.unionByName(_cell_candidates(valid_new)), keep_state=True)


#: Slices of one hour, and how many of them the next level takes together (30 days).
CHUNK_SECONDS = 3600
CHUNKS_TOGETHER = 720
MAX_ROWS_PER_GROUP = 2_000_000

_VERSION = ("subscriber_id", "subscriber_msisdn_masked", "plan", "subscriber_activation_date", "valid_from", "valid_to", "is_current")
#: What a stored history needs besides for merging: the versions' first and last event.
VERSION_STATE = ("_first_id", "_last_time", "_last_id")


def _hot_chunks(counts: DataFrame, max_rows: int) -> DataFrame:
    """(subscriber_id, chunk, k): time slices with more than `max_rows` rows and how many parts they need,
    from their counts n; at most rows / `max_rows` results."""
    return (counts.where(F.col("n") > max_rows)
            .select("subscriber_id", "chunk", F.ceil(F.col("n") / F.lit(max_rows)).alias("k")))


def _chunk(time: str, chunk_us: int):
    return F.floor(F.unix_micros(time) / F.lit(chunk_us))


def _sliced(df: DataFrame, time: str, chunk_us: int, hot: DataFrame | None) -> DataFrame:
    """`df` (with `chunk`) plus `sub`: the equal part of a hot chunk that the row's time lies in."""
    if hot is None:
        return df.withColumn("sub", F.lit(0).cast("bigint"))
    offset = F.unix_micros(time) - F.col("chunk") * F.lit(chunk_us)
    return (df.join(hot, ["subscriber_id", "chunk"], "left")
            .withColumn("sub", F.coalesce(F.floor(offset * F.col("k") / F.lit(chunk_us)), F.lit(0))).drop("k"))


def _runs_of(runs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Collapse neighbouring runs of equal plan inside each group of `keys`.

    A run: `start` (time of its first event), `order` (what tells runs of the same start apart), `plan`, the
    attributes' maxima, `next_start` (where the next run begins, if known) and `done` (nothing
    outside its slice can extend it); with `_first_id`, `_last` (time and id of the last event) if
    there. Runs whose successor is known aren't extended on that side. Afterwards only a
    group's first and last run are open; the others are done and pass through later levels as groups
    of their own, so a level's windows hold two runs for each slice below it. `seq` numbers the
    runs of a group, `_after` is the start of the next one.
    """
    state = "_last" in runs.columns
    if "done" not in runs.columns:
        runs = runs.withColumns({"done": F.lit(False), "next_start": F.lit(None).cast("timestamp")})
    else:
        keys = [*keys, "_alone"]
        runs = runs.withColumn("_alone", F.when(F.col("done"), F.col("start")))
    inside = Window.partitionBy(*keys).orderBy("start", order)
    starts = (F.col("done") | F.lag(F.lit(True)).over(inside).isNull() | F.lag("next_start").over(inside).isNotNull()
              | ~F.lag("plan").over(inside).eqNullSafe(F.col("plan")))
    runs = runs.withColumn("_new", starts.cast("int"))
    runs = runs.withColumn("seq", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    outer = [F.min(F.struct("start", "_first_id"))["_first_id"].alias("_first_id"), F.max("_last").alias("_last")] if state else []
    whole = (runs.groupBy(*keys, "seq")
             .agg(F.min("start").alias("start"), F.max("plan").alias("plan"),
                  F.max("subscriber_msisdn_masked").alias("subscriber_msisdn_masked"),
                  F.max("subscriber_activation_date").alias("subscriber_activation_date"),
                  F.max("next_start").alias("next_start"), F.bool_and("done").alias("done"), *outer))
    after = lambda c: F.lead(c).over(Window.partitionBy(*keys).orderBy("seq"))
    whole = whole.withColumn("_after", F.struct(after("start").alias("t"), after("_first_id").alias("id")) if state else after("start"))
    start_after = F.col("_after.t") if state else F.col("_after")
    return (whole.withColumn("next_start", F.coalesce("next_start", start_after))
            .withColumn("done", F.col("done") | ((F.col("seq") > 1) & start_after.isNotNull())).drop("_alone"))


def _versions(runs: DataFrame, *more) -> DataFrame:
    kept = ["_first_id", F.col("_last.t").alias("_last_time"), F.col("_last.id").alias("_last_id")] if "_last" in runs.columns else []
    return runs.select("subscriber_id", "subscriber_msisdn_masked", "plan", "subscriber_activation_date",
                       F.col("start").alias("valid_from"), F.col("next_start").alias("valid_to"),
                       F.col("next_start").isNull().alias("is_current"), *kept, *more)


def dim_subscriber(valid: DataFrame, chunk_seconds: int = CHUNK_SECONDS, max_rows_per_group: int | None = MAX_ROWS_PER_GROUP,
                   keep_state: bool = False) -> DataFrame:
    """Plan history per subscriber (I4; SCD type 2 keyed by subscriber_id, valid_from).

    A new version starts at every event whose plan differs (null-safe) from the subscriber's
    previous event in (event_time, event_id) order; a leading NULL plan is version 0 (F1-F4,
    E6). Events are reduced to runs of equal plan in three levels: inside a slice of
    `chunk_seconds`, inside 720 slices, over the whole history. A level sees only the first and
    last run of the slices below; the runs between are complete, since they
    know where their successor begins. So no window holds the events, or the versions, of a subscriber.

    A slice with more than `max_rows_per_group` events - a hot subscriber - is cut into equal
    parts. `max_rows_per_group=None` skips the counting pass for that where there is no hot
    subscriber. (All events of one subscriber at the very same microsecond share a slice.)
    `keep_state` adds what `merge_dim_subscriber` needs.
    """
    chunk_us = chunk_seconds * 1_000_000
    obs = (valid.where(F.col("subscriber_id").isNotNull())
           .select("subscriber_id", "subscriber_msisdn_masked", "subscriber_plan",
                   "subscriber_activation_date", "event_time", "event_id", _chunk("event_time", chunk_us).alias("chunk")))
    counts = obs.groupBy("subscriber_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    hot = None if max_rows_per_group is None else _hot_chunks(counts, max_rows_per_group)
    event = F.struct(F.col("event_time").alias("t"), F.col("event_id").alias("id"))
    runs = _sliced(obs, "event_time", chunk_us, hot).select(
        "subscriber_id", "chunk", "sub", "subscriber_msisdn_masked", F.col("subscriber_plan").alias("plan"),
        "subscriber_activation_date", F.col("event_time").alias("start"), "event_id",
        *([F.col("event_id").alias("_first_id"), event.alias("_last")] if keep_state else []))
    runs = _runs_of(runs, ["subscriber_id", "chunk", "sub"], "event_id")
    runs = runs.withColumn("chunk", F.expr(f"chunk div {CHUNKS_TOGETHER}"))
    runs = _runs_of(runs.withColumnRenamed("seq", "below"), ["subscriber_id", "chunk"], "below")
    return _versions(_runs_of(runs.withColumnRenamed("seq", "below"), ["subscriber_id"], "below"))


def current_plans(valid: DataFrame) -> DataFrame:
    """(subscriber_id, plan, is_current=true) of each subscriber's current version.

    The current version of the plan history is the run that contains the subscriber's latest
    event, so its plan is that event's plan: one latest-per-key aggregate (map-side combined)
    instead of the full history when only the current plan is needed.
    """
    latest = F.max(F.struct(F.col("event_time").alias("t"), F.col("event_id").alias("id"),
                            F.col("subscriber_plan").alias("plan")))
    return (valid.where(F.col("subscriber_id").isNotNull()).groupBy("subscriber_id")
            .agg(latest.alias("m")).select("subscriber_id", F.col("m.plan").alias("plan"),
                                           F.lit(True).alias("is_current")))


def tail_of_history(state: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, untouched): the stored versions that new ones may touch, merged with them, and the
    rest of the stored history.

    `fresh` is the history of the run's events alone. A stored version can only change if it was
    still valid when the subscriber's first new event happened. `merged` has `_clash` for versions that
    a differing one interrupts: a late event fell between two events of a stored version, and where the
    second part begins isn't stored.
    """
    lows = fresh.groupBy("subscriber_id").agg(F.min("valid_from").alias("_low"))
    marked = state.join(lows, "subscriber_id", "left")
    touched = F.col("_low").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_low")))
    untouched = marked.where(~touched).drop("_low")
    parts = marked.where(touched).drop("_low").unionByName(fresh)
    runs = parts.select("subscriber_id", "subscriber_msisdn_masked", "plan", "subscriber_activation_date",
                        F.col("valid_from").alias("start"), "_first_id",
                        F.struct(F.col("_last_time").alias("t"), F.col("_last_id").alias("id")).alias("_last"))
    merged = _runs_of(runs, ["subscriber_id"], "_first_id")
    clash = F.col("_after.t").isNotNull() & (F.col("_last") > F.col("_after"))
    return _versions(merged, clash.alias("_clash")), untouched


def merge_dim_subscriber(state: DataFrame, valid_all: DataFrame, valid_new: DataFrame, stage=None, **kw) -> DataFrame:
    """Incremental SCD2: the stored history merged with the history of the run's events.

    New events extend the open version, open new ones, or fall into older ones without changing where they
    begin and end; all of that follows from the stored versions and their first and last events. Only
    subscribers of whom a late event splits a stored version are rebuilt from all their events,
    and only then is `valid_all` read. `stage` (a function of a DataFrame and a name) materialises the
    merged part, which is read twice. Merging the same events again changes nothing.
    """
    stage = stage or (lambda df, name: df)
    fresh = stage(dim_subscriber(valid_new, keep_state=True, **kw), "sub-new")
    merged, untouched = tail_of_history(state, fresh)
    merged = stage(merged, "sub-merged")
    split = merged.where("_clash").select("subscriber_id").distinct()
    if split.isEmpty():
        return untouched.unionByName(merged.drop("_clash"))
    split = stage(split, "sub-split")
    whole = dim_subscriber(valid_all.join(split, "subscriber_id", "left_semi"), keep_state=True, **kw)
    kept = untouched.unionByName(merged.drop("_clash")).join(split, "subscriber_id", "left_anti")
    return kept.unionByName(whole.select(*kept.columns))


def voice_and_data_events(voice: DataFrame, data: DataFrame) -> DataFrame:
    """Both facts aligned on one schema, NULL-padded."""
    v = voice.select("event_id", "event_time", "subscriber_id", "cell_id", "call_result",
                     F.lit(None).cast("double").alias("latency_ms"),
                     F.lit("voice_call").alias("event_type"))
    d = data.select("event_id", "event_time", "subscriber_id", "cell_id",
                    F.lit(None).cast("string").alias("call_result"), "latency_ms",
                    F.lit("data_session").alias("event_type"))
    return v.unionByName(d)


def plan_as_of_event(voice: DataFrame, data: DataFrame, dim_sub: DataFrame, chunk_seconds: int = CHUNK_SECONDS * 24,
                     max_rows_per_group: int | None = MAX_ROWS_PER_GROUP) -> DataFrame:
    """The subscriber's plan at the time of each voice/data event (D8, as-of lookup).

    Events and versions are one sorted stream in time slices: an event's version is the last one
    before it in its slice, or the one carried into the slice. Carried versions come from one row
    for each slice (its last version), not from the events. So an event is compared with its
    neighbour only, never joined with its subscriber's versions, and a hot subscriber's events are as many tasks' work
    as its slices (a day, or a part of one with at most `max_rows_per_group` events).
    Events before the first seen version keep a NULL plan (T18).
    """
    chunk_us = chunk_seconds * 1_000_000
    ev = voice_and_data_events(voice, data).where(F.col("subscriber_id").isNotNull()) \
        .select("event_id", "event_type", "event_time", "subscriber_id", _chunk("event_time", chunk_us).alias("chunk"))
    # one count of events by chunk tells the hot ones and lists the slices that need a carried version
    counts = ev.groupBy("subscriber_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    parts = F.lit(1) if max_rows_per_group is None else F.ceil(F.col("n") / F.lit(max_rows_per_group))
    hot = None if max_rows_per_group is None else _hot_chunks(counts, max_rows_per_group)
    version = F.struct("valid_from", "plan")
    d = dim_sub.where(F.col("subscriber_id").isNotNull()).select(
        "subscriber_id", F.col("valid_from").alias("event_time"), _chunk("valid_from", chunk_us).alias("chunk"), version.alias("version"))
    ev, d = _sliced(ev, "event_time", chunk_us, hot), _sliced(d, "event_time", chunk_us, hot)

    # what each slice inherits: the last version of those before it
    slices = ["subscriber_id", "chunk", "sub"]
    earlier = Window.partitionBy("subscriber_id").orderBy("chunk", "sub").rowsBetween(Window.unboundedPreceding, -1)
    listed = counts.select("subscriber_id", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)).alias("sub"))
    carried = (listed.unionByName(d.select(*slices, "version"), allowMissingColumns=True)
               .groupBy(*slices).agg(F.max("version").alias("own"))
               .select(*slices, F.last("own", ignorenulls=True).over(earlier).alias("version")).where("version IS NOT NULL"))

    # carried versions first, then by time, versions before events of the same time
    rows = (ev.withColumn("rank", F.lit(2)).unionByName(d.withColumn("rank", F.lit(1)), allowMissingColumns=True)
            .unionByName(carried.withColumn("rank", F.lit(0)), allowMissingColumns=True))
    before = Window.partitionBy(*slices).orderBy(F.expr("rank > 0"), "event_time", "rank").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("version", F.last("version", ignorenulls=True).over(before)).where("rank = 2")
            .select("event_id", "event_type", "event_time", "subscriber_id",
                    F.col("version.plan").alias("plan"), F.col("version.valid_from").alias("valid_from")))


def fct_by_date(fact: DataFrame) -> DataFrame:
    """Rows of a fact per event date."""
    return (fact.groupBy(F.to_date("event_time").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("row_count")))
