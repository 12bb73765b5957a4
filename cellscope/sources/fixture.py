"""The driver's `events` table seen as the raw network-event table.

`events(event_id, ts, user_id, ...)` carries no telecom columns, so every column of the raw
contract is derived from `event_id`, `ts` and `user_id` with integer arithmetic (see
FIXTURES.md section 2). Only the first three columns are read, so the scan prunes the rest.
The view is deterministic and row-local: no shuffle, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.session import table_path

REPLAY_KEY = "raw/network_events/dt=2024-12-31/hr=00/p0_replay.jsonl"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def network_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.network_events built from `events` (one row per event)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    n, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    # usage decay for a fifth of the users in the last week, so churn signals exist: two thirds of
    # their events are sms, which feed no activity
    decayed = (u % 5 == 0) & (ts >= _ntz("2024-01-24 00:00:00")) & (n % 3 != 0)
    tm, dm, kd = F.when(decayed, 17 + n % 3).otherwise(n % 20), n % 21, n % 11
    rl = (n * 31 + u * 17) % 101
    c = F.when((u % 5 == 0) & (n % 2 == 0), (u % 6) * 10 + 3).otherwise((n * 7 + u) % 60)
    ev = ev.select(
        n.alias("n"), u.alias("u"), ts.alias("ts"), tm.alias("tm"), dm.alias("dm"),
        kd.alias("kd"), rl.alias("rl"), c.alias("c"))
    n, u, ts = F.col("n"), F.col("u"), F.col("ts")
    tm, dm, kd, rl, c = F.col("tm"), F.col("dm"), F.col("kd"), F.col("rl"), F.col("c")
    deg = (c % 10 == 3)
    event_type = (F.when(tm < 7, "voice_call").when(tm < 17, "data_session").otherwise("sms"))
    tech = F.when(c % 5 == 0, "3G").when(c % 5 == 4, "5G").otherwise("4G")
    dirt = (F.when(dm != 0, "clean")
            .when(kd < 3, "null_subscriber")
            .when(kd < 5, "bad_timestamp")
            .when(kd < 7, "impossible_signal")
            .when((kd < 9) & (tm < 17), "negative_duration")
            .when((kd >= 9) & tm.between(7, 16), "negative_volume")
            .otherwise("null_subscriber"))
    ev = ev.select("*", deg.alias("deg"), event_type.alias("event_type"),
                   tech.alias("cell_radio_tech"), dirt.alias("dirt"))
    deg, et, dirt, tech = F.col("deg"), F.col("event_type"), F.col("dirt"), F.col("cell_radio_tech")
    voice, data, sms = et == "voice_call", et == "data_session", et == "sms"

    call_result = (F.when(voice & (rl < F.when(deg, 8).otherwise(1)), "failed_setup")
                   .when(voice & (rl < F.when(deg, 33).otherwise(3)), "dropped")
                   .when(voice, "completed"))
    signal = (F.when(dirt == "impossible_signal", 1 + rl % 30)
              .when(deg, -104 - rl % 17)
              .otherwise(-84 - rl % 17)).cast("double")
    duration = (F.when(sms, F.lit(None))
                .when(dirt == "negative_duration", -1 - rl)
                .when(call_result == "failed_setup", 0)
                .otherwise(1 + rl * 3)).cast("int")
    volume = (F.when(~data, F.lit(None))
              .when(dirt == "negative_volume", F.lit(-0.01) - rl)
              .otherwise((rl * 37 + 25) / 100))
    tp_base = F.when(tech == "3G", 3).when(tech == "4G", 25).otherwise(150)
    lat_base = F.when(tech == "3G", 90).when(tech == "4G", 40).otherwise(15)
    throughput = F.when(data, tp_base * F.when(deg, 3).otherwise(10) * (60 + rl) / 1000)
    latency = F.when(data, lat_base * F.when(deg, 25).otherwise(10) * (60 + rl) / 1000)
    extra = (F.when(n % 100 == 0, F.lit('{"volte_enabled": true}'))
             .when(n % 100 == 50, F.lit('{"volte_enabled": false}'))
             .when(n % 499 == 0, F.lit('{"promo_code": "SPRING26"}'))
             .otherwise(F.lit("{}")))
    first = n - n % 200
    object_key = F.concat(
        F.lit("raw/network_events/dt="), F.date_format(ts, "yyyy-MM-dd"),
        F.lit("/hr="), F.date_format(ts, "HH"),
        F.lit("/p0_"), first.cast("string"), F.lit("-"), (first + 199).cast("string"),
        F.lit(".jsonl"))
    plan = (F.when((u % 7 == 3) & (ts >= _ntz("2024-01-16 00:00:00")), "postpaid")
            .when(u % 10 < 6, "prepaid")
            .when(u % 10 < 9, "postpaid")
            .otherwise("corporate"))

    cols = [
        n.cast("string").alias("event_id"),
        et.alias("event_type"),
        F.when(dirt == "bad_timestamp", F.lit("not-a-timestamp"))
         .otherwise(F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))).alias("event_time_raw"),
        F.when(dirt == "null_subscriber", F.lit(None)).otherwise(u.cast("string")).alias("subscriber_id"),
        F.concat(F.lit("+99450***"), F.lpad((u % 10000).cast("string"), 4, "0")).alias("subscriber_msisdn_masked"),
        plan.alias("subscriber_plan"),
        F.date_from_unix_date((18000 + u % 2000).cast("int")).alias("subscriber_activation_date"),
        F.concat(F.lit("CELL-"), F.lpad(c.cast("string"), 4, "0")).alias("cell_id"),
        F.concat(F.lit("R"), (c % 8).cast("string")).alias("cell_region"),
        tech.alias("cell_radio_tech"),
        signal.alias("signal_dbm"),
        duration.alias("duration_sec"),
        call_result.alias("call_result"),
        volume.cast("double").alias("data_volume_mb"),
        throughput.cast("double").alias("avg_throughput_mbps"),
        latency.cast("double").alias("latency_ms"),
        extra.alias("extra"),
        object_key.alias("_source_object_key"),
        (F.lit(1704067200000) + n * 1000).alias("_cdc_source_ts_ms"),
        (ts + F.expr("INTERVAL 1 HOUR")).cast("timestamp").alias("_loaded_at"),
    ]
    return ev.select(*cols)


def landed_events(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """The view plus re-delivered copies (every 97th event, from a later replay object):
    the input of keep-first loading. `raw` reuses an already derived raw table."""
    base = network_events(spark, sf_dir) if raw is None else raw
    replay = (base.where(F.col("event_id").cast("bigint") % 97 == 0)
              .withColumn("cell_region", F.lit("REPLAY"))
              .withColumn("_source_object_key", F.lit(REPLAY_KEY)))
    return base.unionByName(replay)


def degraded_cells(dim_cell: DataFrame) -> DataFrame:
    """Hidden ground truth of the fixture: cells whose index ends in 3 are degraded."""
    idx = F.substring("cell_id", 6, 4).cast("int")
    return dim_cell.select("cell_id", (idx % 10 == 3).alias("degraded"))
