"""Decoding change records: envelope unwrap, nested-event flatten, drift catch-all.

Each message is parsed once into a VARIANT (`parse_json`). The contract's columns are read from it
as one typed struct and all its keys as one `map<string, variant>` (no schema inference), so
unknown keys keep their JSON types. Each of these values is computed once, in a projection of its
own. Row-local: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope import schemas as S
from cellscope.functions import expressions as X

ANY_MAP = "map<string,variant>"
NESTED_KNOWN_KEYS = ("event_id", "event_type", "event_time", "subscriber", "cell", "signal_dbm",
                     "duration_sec", "call_result", "data_volume_mb", "avg_throughput_mbps",
                     "latency_ms")
ENVELOPE = f"struct<op:string,after:variant,source:struct<ts_ms:bigint>,{S.SOURCE_TS_FIELD}:bigint>"
NESTED_EVENT = ("struct<event_id:string,event_type:string,event_time:string,"
                "subscriber:struct<subscriber_id:string,msisdn_masked:string,plan:string,activation_date:string>,"
                "cell:struct<cell_id:string,region:string,radio_tech:string>,signal_dbm:double,duration_sec:bigint,"
                "call_result:string,data_volume_mb:double,avg_throughput_mbps:double,latency_ms:double>")


def drop_tombstones(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """A2: null-valued messages (deletes' tombstones) carry nothing to land."""
    return messages.where(F.col(value_col).isNotNull())


def _parse(text: Column, on_malformed: str) -> Column:
    """JSON text -> VARIANT, parsed once per record. FAILFAST raises on malformed text (the
    reference aborts the object, T7); "quarantine" yields NULL and keeps the line."""
    return F.parse_json(text) if on_malformed == "failfast" else F.try_parse_json(text)


def unwrap(messages: DataFrame, value_col: str = "value", on_malformed: str = "failfast") -> DataFrame:
    """A3: change envelope -> the new-row record plus its source change time.

    Accepts both shapes: a full envelope (`after` holds the new row, `source.ts_ms` the change
    time) and an already-unwrapped flat record carrying `__source_ts_ms`. Delete events (no
    `after`) are dropped, as the unwrap step of the source connector does.
    Adds `record` (VARIANT, the message parsed once), `_line` (its text) and `cdc_ts_ms`.
    """
    text = F.col(value_col).cast("string")
    rows = messages.select("*", text.alias("_line"), _parse(text, on_malformed).alias("_message"))
    rows = rows.withColumn("_head", F.try_variant_get("_message", "$", ENVELOPE))
    is_envelope = F.coalesce(F.col("_head.op").isNotNull(), F.lit(False))
    after = F.when(~F.is_variant_null("_head.after"), F.col("_head.after"))     # JSON null -> SQL NULL
    found = F.struct(is_envelope.alias("enveloped"), F.when(is_envelope, after).otherwise(F.col("_message")).alias("record"),
                     F.when(is_envelope, F.col("_head.source.ts_ms")).otherwise(F.col(f"_head.{S.SOURCE_TS_FIELD}")).alias("ts"))
    # as the only element of an array: a filter on what a generator made stays behind it, where the
    # parsed value is at hand; behind a projection it would move to the scan and parse once more
    return (rows.select(*messages.columns, "_line", F.explode(F.array(found)).alias("_found"))
            .where("NOT _found.enveloped OR _found.record IS NOT NULL")
            .select(*messages.columns, F.col("_found.record").alias("record"), "_line", F.col("_found.ts").alias("cdc_ts_ms")))


def _as_object_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", ANY_MAP)


def drift_extra(every: Column, known: tuple[str, ...]) -> Column:
    """B2 + T2: every key outside `known` as one JSON object, nothing dropped.

    `every` is the record as a map of its keys. A nested `extra` (an object, or an object encoded
    as a JSON string by the CDC converter) is merged in; top-level keys win on a clash.
    `__source_ts_ms` and `inserted_at` are delivery metadata, not drift, and are removed.
    """
    skip = sorted(set(known) | set(S.NON_DRIFT_KEYS))
    top = F.map_filter(every, lambda k, v: ~k.isin(*skip))
    nested_raw = every["extra"]
    nested = F.coalesce(_as_object_map(nested_raw),
                        _as_object_map(F.try_parse_json(F.try_variant_get(nested_raw, "$", "string"))))
    clash = lambda k: k.isin(*skip) | F.map_contains_key(every, k)
    nested = F.map_filter(F.coalesce(nested, F.create_map().cast(ANY_MAP)), lambda k, v: ~clash(k))
    return F.coalesce(F.to_json(F.map_concat(nested, top)), F.lit("{}"))


#: Contract columns that can't take every value; text columns take any.
TYPED_COLUMNS = tuple(c for c in S.RECORD_COLUMNS if c in S.RAW_DECIMALS or c in ("duration_sec", "subscriber_activation_date"))


def _given(every: Column) -> Column:
    """How many typed columns the record holds a value for; NULL if it is no JSON object."""
    return F.when(every.isNotNull(), F.size(F.map_filter(every, lambda k, v: k.isin(*TYPED_COLUMNS) & ~F.is_variant_null(v))))


def _stored() -> Column:
    """How many typed columns got a value that their fixed-point types can hold."""
    fits = [F.col(c).try_cast(S.RAW_DECIMALS[c]) if c in S.RAW_DECIMALS else F.col(c) for c in TYPED_COLUMNS]
    return sum((x.isNotNull().cast("int") for x in fits), F.lit(0))


def record_to_raw(records: DataFrame, record_col: str = "record", ts_col: str = "cdc_ts_ms",
                  object_key: Column | None = None, loaded_at: Column | None = None,
                  on_malformed: str = "failfast") -> DataFrame:
    """Flat record -> raw.network_events columns.

    `record_col` is the parsed record (VARIANT, from `unwrap`) or its JSON text. The known columns
    are one typed struct read from the parsed value in one pass (an absent key gives NULL), all keys are one
    map, from which drift (B2) and the count of given values come; each is computed once, in a projection
    of its own, so that the generated code of every step stays small. The activation date is decoded
    from epoch days (B4), the object key and CDC time are
    attached. A line is rejected if it is not a JSON object, has no event id (the raw key) or
    holds a value that its column can't take (wrong type, out of the contract's range): it fails
    the read, or with `on_malformed="quarantine"` keeps its text in `_corrupt_record`.
    """
    if isinstance(records.schema[record_col].dataType, T.VariantType):
        rec = F.col(record_col)
    else:
        rec = _parse(F.col(record_col).cast("string"), on_malformed)
    line = F.col("_line") if "_line" in records.columns else F.col(record_col).cast("string")
    ts = F.col(ts_col) if ts_col in records.columns else F.lit(None).cast("bigint")
    rows = records.select(
        rec.alias("_rec"), line.alias("_text"), ts.alias("_ts"),
        (object_key if object_key is not None else F.lit(None).cast("string")).alias("_source_object_key"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("_loaded_at"))
    rows = rows.select("*", F.try_variant_get("_rec", "$", S.RECORD_SCHEMA.simpleString()).alias("_known"),
                       _as_object_map(F.col("_rec")).alias("_every")).drop("_rec")
    rows = rows.select("_known", "_text", "_source_object_key", "_loaded_at",
                       F.coalesce("_ts", F.col(f"_known.{S.SOURCE_TS_FIELD}")).alias("_cdc_source_ts_ms"),
                       drift_extra(F.col("_every"), S.RECORD_COLUMNS).alias("extra"), _given(F.col("_every")).alias("_given"))
    decoded = {"subscriber_activation_date": X.epoch_day_to_date("_known.subscriber_activation_date"),
               "duration_sec": F.col("_known.duration_sec").try_cast("int")}
    out = rows.select(*[decoded.get(c, F.col(f"_known.{c}")).alias(c) for c in S.RECORD_COLUMNS],
                      "extra", "_source_object_key", "_cdc_source_ts_ms", "_loaded_at", "_given", "_text")
    # a value that is given but not stored has the wrong type or is out of range
    bad = F.col("_given").isNull() | F.col("event_id").isNull() | (F.col("_given") > _stored())
    if on_malformed == "quarantine":
        return out.withColumn("_corrupt_record", F.when(bad, F.col("_text"))).drop("_given", "_text")
    why = F.concat(F.lit("record does not fit the raw contract: "), F.col("_text"))
    return out.withColumn("event_id", F.when(bad, F.raise_error(why)).otherwise(F.col("event_id"))).drop("_given", "_text")


def flatten_nested(events: DataFrame, value_col: str = "value", on_malformed: str = "failfast") -> DataFrame:
    """B1: nested event JSON (subscriber and cell as objects) -> flat source record columns.

    Parsed once and read as one typed struct; `event_time` becomes `event_time_raw`, subscriber/cell
    fields get their prefixes, keys outside the nested contract are collected into `extra`.
    """
    rows = events.select(_parse(F.col(value_col).cast("string"), on_malformed).alias("_event"))
    rows = rows.select(F.try_variant_get("_event", "$", NESTED_EVENT).alias("_known"), _as_object_map(F.col("_event")).alias("_every"))
    rows = rows.select("_known", drift_extra(F.col("_every"), NESTED_KNOWN_KEYS).alias("extra"))
    known = lambda path: F.col(f"_known.{path}")
    return rows.select(
        known("event_id").alias("event_id"), known("event_type").alias("event_type"),
        known("event_time").alias("event_time_raw"),
        known("subscriber.subscriber_id").alias("subscriber_id"),
        known("subscriber.msisdn_masked").alias("subscriber_msisdn_masked"),
        known("subscriber.plan").alias("subscriber_plan"),
        X.epoch_day_to_date(known("subscriber.activation_date")).alias("subscriber_activation_date"),
        known("cell.cell_id").alias("cell_id"), known("cell.region").alias("cell_region"),
        known("cell.radio_tech").alias("cell_radio_tech"),
        known("signal_dbm").alias("signal_dbm"), known("duration_sec").try_cast("int").alias("duration_sec"),
        known("call_result").alias("call_result"), known("data_volume_mb").alias("data_volume_mb"),
        known("avg_throughput_mbps").alias("avg_throughput_mbps"), known("latency_ms").alias("latency_ms"), "extra")


def record_json(raw: DataFrame, activation_as_epoch_days: bool = True, envelope: Column | None = None,
                extra_encoded: bool = True) -> Column:
    """Render raw rows back into the flat change-record text a CDC stream would carry.

    The activation date becomes epoch days (the connector's DATE encoding) and `extra`
    becomes a JSON-encoded string (its JSONB encoding). With `envelope` (a boolean column)
    the record is wrapped as `{"before":null,"after":{...},"source":{"ts_ms":...},"op":"c"}`
    for rows where it is true; other rows carry `__source_ts_ms` at the top level.
    """
    act = (F.unix_date("subscriber_activation_date") if activation_as_epoch_days
           else F.col("subscriber_activation_date").cast("string"))
    fields = [F.col(c) for c in S.RECORD_COLUMNS if c != "subscriber_activation_date"]
    fields.insert(S.RECORD_COLUMNS.index("subscriber_activation_date"), act.alias("subscriber_activation_date"))
    extra = F.col("extra") if extra_encoded else F.from_json("extra", ANY_MAP)
    after = F.struct(*fields, extra.alias("extra"))
    flat = F.to_json(F.struct(*fields, extra.alias("extra"),
                              F.col("_cdc_source_ts_ms").alias(S.SOURCE_TS_FIELD)))
    if envelope is None:
        return flat
    wrapped = F.to_json(F.struct(F.lit(None).cast("string").alias("before"), after.alias("after"),
                                 F.struct(F.col("_cdc_source_ts_ms").alias("ts_ms")).alias("source"),
                                 F.lit("c").alias("op")))
    return F.when(envelope, wrapped).otherwise(flat)
