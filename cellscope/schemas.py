"""Schemas, column lists and value domains of the network-event model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# These must equal the source system's contract for results to match.
# ---------------------------------------------------------------------------------------
EVENT_TYPES = ("voice_call", "data_session", "sms")
PLANS = ("prepaid", "postpaid", "corporate")
RADIO_TECHS = ("3G", "4G", "5G")
CALL_RESULTS = ("completed", "dropped", "failed_setup")
BAD_CALL_RESULTS = ("dropped", "failed_setup")
DQ_FLAGS = ("bad_timestamp", "missing_subscriber", "negative_duration", "negative_volume",
            "signal_out_of_range")
SIGNAL_MIN_DBM, SIGNAL_MAX_DBM = -140, -44
TIMESTAMP_PREFIX_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
KNOWN_DRIFT_KEYS = ("volte_enabled",)
SOURCE_TS_FIELD = "__source_ts_ms"
LAKE_PREFIX = "raw/network_events"
# Columns copied from a flat change record into the raw table, in contract order.
RECORD_COLUMNS = (
    "event_id", "event_type", "event_time_raw", "subscriber_id", "subscriber_msisdn_masked",
    "subscriber_plan", "subscriber_activation_date", "cell_id", "cell_region", "cell_radio_tech",
    "signal_dbm", "duration_sec", "call_result", "data_volume_mb", "avg_throughput_mbps",
    "latency_ms",
)
# Keys that never go into `extra` although they are not record columns: the CDC time (kept in
# its own column) and the source table's insert time (not part of the raw contract).
NON_DRIFT_KEYS = (SOURCE_TS_FIELD, "inserted_at", "extra")
# Serving heuristics.
RANKING_WINDOW_DAYS = 7
DROP_RATE_WEIGHT = 100
LATENCY_DIVISOR = 10.0
THROUGHPUT_DIVISOR = 10.0
ACTIVITY_WINDOW_DAYS = 7
BASELINE_WINDOW_DAYS = 35
BASELINE_WEEKS = 4
POOR_WINDOW_DAYS = 14
POOR_LATENCY_MS = 100
POOR_LATENCY_TECHS = ("4G", "5G")
USAGE_DROP_RATIO_NUM, USAGE_DROP_RATIO_DEN = 3, 5   # last-7 <= 0.6 * weekly baseline
POOR_EVENTS_THRESHOLD = 3
# Data-quality thresholds.
FRESHNESS_WARN_HOURS = 2
RECONCILE_WARN_RATIO = 0.005
RECONCILE_FAIL_RATIO = 0.02
# ---------------------------------------------------------------------------------------

# Flat change record as landed in the lake. Everything is read as text or a wide numeric so
# that no value is lost before the typed casts of the raw table; the activation date may be
# an epoch-day integer or an ISO string, so it stays a string here.
RECORD_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time_raw", T.StringType()),
    T.StructField("subscriber_id", T.StringType()),
    T.StructField("subscriber_msisdn_masked", T.StringType()),
    T.StructField("subscriber_plan", T.StringType()),
    T.StructField("subscriber_activation_date", T.StringType()),
    T.StructField("cell_id", T.StringType()),
    T.StructField("cell_region", T.StringType()),
    T.StructField("cell_radio_tech", T.StringType()),
    T.StructField("signal_dbm", T.DoubleType()),
    T.StructField("duration_sec", T.LongType()),
    T.StructField("call_result", T.StringType()),
    T.StructField("data_volume_mb", T.DoubleType()),
    T.StructField("avg_throughput_mbps", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField(SOURCE_TS_FIELD, T.LongType()),
])

# raw.network_events: the contract of the whole pipeline. Measures are DOUBLE here (the fixture
# view keeps them so); the lake loader stores them as the fixed-point types of RAW_DECIMALS.
RAW_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_time_raw", T.StringType(), False),
    T.StructField("subscriber_id", T.StringType()),
    T.StructField("subscriber_msisdn_masked", T.StringType()),
    T.StructField("subscriber_plan", T.StringType()),
    T.StructField("subscriber_activation_date", T.DateType()),
    T.StructField("cell_id", T.StringType(), False),
    T.StructField("cell_region", T.StringType()),
    T.StructField("cell_radio_tech", T.StringType()),
    T.StructField("signal_dbm", T.DoubleType()),
    T.StructField("duration_sec", T.IntegerType()),
    T.StructField("call_result", T.StringType()),
    T.StructField("data_volume_mb", T.DoubleType()),
    T.StructField("avg_throughput_mbps", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("extra", T.StringType(), False),
    T.StructField("_source_object_key", T.StringType()),
    T.StructField("_cdc_source_ts_ms", T.LongType()),
    T.StructField("_loaded_at", T.TimestampType(), False),
])
RAW_COLUMNS = tuple(f.name for f in RAW_SCHEMA.fields)

# Decimal types of the warehouse contract; the ingest path casts to them on request.
RAW_DECIMALS = {
    "signal_dbm": T.DecimalType(6, 1),
    "data_volume_mb": T.DecimalType(12, 2),
    "avg_throughput_mbps": T.DecimalType(8, 2),
    "latency_ms": T.DecimalType(8, 1),
}

STAGING_COLUMNS = (
    "event_id", "event_type", "event_time", "subscriber_id", "subscriber_msisdn_masked",
    "subscriber_plan", "subscriber_activation_date", "cell_id", "cell_region", "cell_radio_tech",
    "signal_dbm", "duration_sec", "call_result", "data_volume_mb", "avg_throughput_mbps",
    "latency_ms", "volte_enabled", "extra", "dq_flags", "_source_object_key",
    "_cdc_source_ts_ms", "_loaded_at",
)

VOICE_FACT_COLUMNS = ("event_id", "event_time", "subscriber_id", "cell_id", "call_result",
                      "duration_sec", "signal_dbm")
DATA_FACT_COLUMNS = ("event_id", "event_time", "subscriber_id", "cell_id", "data_volume_mb",
                     "avg_throughput_mbps", "latency_ms", "signal_dbm")
