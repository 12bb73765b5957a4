"""Column expressions shared by the operators. All are built-in Spark functions (JVM side,
whole-stage codegen); nothing here is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellscope import schemas as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_timestamp(raw) -> Column:
    """Text -> TIMESTAMP only when the text starts like an ISO date-time.

    The prefix test keeps bare years such as '2026' out (try_cast would accept them); the
    try_cast turns impossible dates such as '2026-02-30T00:00:00' into NULL instead of
    failing the query. Offsets are honoured, zone-less values use the session zone (UTC).
    """
    raw = col(raw)
    return F.when(raw.rlike(S.TIMESTAMP_PREFIX_PATTERN), raw.try_cast("timestamp"))


def epoch_day_to_date(raw) -> Column:
    """Epoch-day integer (CDC DATE encoding) -> DATE; ISO text passes; anything else -> NULL."""
    raw = col(raw).cast("string")
    as_int = F.when(raw.rlike(r"^-?\d+$"), raw.try_cast("int"))
    return F.coalesce(F.date_from_unix_date(as_int), raw.try_cast("date"))


def dq_flags(event_time, subscriber_id, duration_sec, data_volume_mb, signal_dbm) -> Column:
    """Array of every data-quality rule the row breaks (B8); empty array when clean."""
    event_time, subscriber_id = col(event_time), col(subscriber_id)
    duration_sec, data_volume_mb, signal_dbm = col(duration_sec), col(data_volume_mb), col(signal_dbm)
    return F.array_compact(F.array(
        F.when(event_time.isNull(), F.lit("bad_timestamp")),
        F.when(subscriber_id.isNull(), F.lit("missing_subscriber")),
        F.when(duration_sec < 0, F.lit("negative_duration")),
        F.when(data_volume_mb < 0, F.lit("negative_volume")),
        F.when((signal_dbm < S.SIGNAL_MIN_DBM) | (signal_dbm > S.SIGNAL_MAX_DBM),
               F.lit("signal_out_of_range")),
    ))


def json_bool(json_text, key: str) -> Column:
    """`(extra ->> key)::boolean` (B7); a value that is not a boolean becomes NULL."""
    return F.get_json_object(col(json_text), f"$.{key}").try_cast("boolean")


def exact_ratio(numerator, denominator) -> Column:
    """Integer counts -> exact DECIMAL ratio (38,18), NULL when the denominator is 0.

    Matches the source system's `numeric` division, so later rounding is decided on exact
    digits rather than on binary floating-point noise.
    """
    return F.try_divide(col(numerator).cast("decimal(20,0)"), col(denominator).cast("decimal(20,0)"))


def exact_avg(measure, scale: int = 6) -> Column:
    """Mean of a measure in fixed-point DECIMAL (T5): the sum is exact and independent of the
    order in which partial aggregates are merged, so rounding the mean is deterministic."""
    return F.avg(col(measure).cast(f"decimal(18,{scale})"))


def round_half_up(value, digits: int) -> Column:
    """Round half away from zero on the exact value, returned as DOUBLE."""
    return F.round(col(value), digits).cast("double")


def in_trailing_window(ts, reference, days: int, end_days: int = 0) -> Column:
    """Half-open window (reference - days, reference - end_days]."""
    ts, reference = col(ts), col(reference)
    upper = reference if end_days == 0 else reference - F.make_interval(days=F.lit(end_days))
    return (ts > reference - F.make_interval(days=F.lit(days))) & (ts <= upper)


def mask_msisdn(msisdn, country: str = "994") -> Column:
    """Keep country code, operator prefix and last four digits: '+994501234567' ->
    '+99450***4567' (X22).

    Blanks, dots, dashes and brackets are ignored; '00' and a missing '+' are read as an
    international number, a single leading '0' as a national one of `country`. Values that are
    masked already pass unchanged. Whatever cannot be read as a number becomes NULL: an unmasked
    number never leaves.
    """
    bare = F.regexp_replace(col(msisdn), r"[\s().-]", "")
    full = (F.when(bare.rlike(r"^0[1-9]\d{8}$"), F.concat(F.lit(country), F.substring(bare, 2, 9)))
            .otherwise(F.regexp_extract(bare, r"^(?:\+|00)?([1-9]\d{9,14})$", 1)))
    return (F.when(bare.rlike(r"^\+\d{5}\*{3}\d{4}$"), bare)
            .when(full != "", F.concat(F.lit("+"), F.substring(full, 1, 5), F.lit("***"), F.right(full, F.lit(4)))))


def ingest_partition_columns(ts_ms) -> list[Column]:
    """UTC ingestion date and two-digit hour from a message time in epoch ms."""
    ts = F.timestamp_millis(col(ts_ms))
    return [F.date_format(ts, "yyyy-MM-dd").alias("dt"), F.date_format(ts, "HH").alias("hr")]
