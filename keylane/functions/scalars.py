"""Scalar expressions over messages, timers and attempts. All run JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_TIMER_SECOND = 2**32 - 1
# doubling beyond this many attempts is far above every cap and would overflow
MAX_DOUBLINGS = 40


def message_task_id(topic: Column, partition: Column, offset: Column) -> Column:
    """``topic/partition:offset``."""
    return F.format_string("%s/%d:%d", topic, partition, offset)


def timer_task_id(key: Column, fire_s: Column) -> Column:
    """``timer/key/time`` with the time in ISO seconds, UTC."""
    instant = F.date_format(F.timestamp_seconds(fire_s), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat(F.lit("timer/"), key, F.lit("/"), instant)


def round_to_second(micros: Column, strict: bool = False) -> Column:
    """Nearest whole second, halves up; null outside the unsigned 32-bit range.

    With ``strict`` an instant out of range raises instead. The range is checked
    before and after rounding, so rounding past the end is out of range too.
    """
    whole = F.floor(micros / F.lit(1_000_000)).cast("bigint")
    rounded = whole + F.when(F.pmod(micros, F.lit(1_000_000)) >= 500_000, 1).otherwise(0)
    valid = (whole >= 0) & (rounded <= MAX_TIMER_SECOND)
    if not strict:
        return F.when(valid, rounded)
    message = F.concat(F.lit("time outside 1970-2106: "), micros.cast("string"))
    return F.when(valid, rounded).when(micros.isNotNull(), F.raise_error(message).cast("bigint"))


def invalid_time(micros: Column) -> Column:
    """True for an instant a timer cannot take."""
    return micros.isNotNull() & round_to_second(micros).isNull()


def payload_get(payload: Column, path: str, type_: str = "string") -> Column:
    """A field of a variant payload, or null when absent or of another type."""
    return F.try_variant_get(payload, path, type_)


def payload_to_json(payload: Column) -> Column:
    return F.to_json(payload)


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def telemetry_time(micros: Column) -> Column:
    """UTC text with milliseconds and a ``Z``."""
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def backoff_delay(attempt: Column, base_ms: int, cap_ms: int) -> Column:
    """Exponential delay in ms before retry ``attempt`` (from 1), at most the cap."""
    doublings = F.least(F.greatest(attempt - 1, F.lit(0)), F.lit(MAX_DOUBLINGS))
    return F.least(F.lit(float(base_ms)) * F.pow(F.lit(2.0), doublings), F.lit(float(cap_ms))).cast("bigint")


def timed_out(duration_ms: Column, timeout_ms: int) -> Column:
    """True when an execution ran longer than its deadline."""
    return duration_ms > F.lit(timeout_ms)


def wait_boost(wait_ms: Column, max_wait_ms: int, weight_ms: int) -> Column:
    """Priority boost in ms of virtual time: quadratic in the wait, full at ``max_wait``."""
    share = F.least(F.greatest(wait_ms, F.lit(0)) / F.lit(float(max_wait_ms)), F.lit(1.0))
    return F.round(F.lit(float(weight_ms)) * share * share).cast("bigint")
