"""Failure handling as tables: classes, retries, routes, deferral."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keylane.functions.scalars import backoff_delay, timed_out
from keylane.operators.health import throughput
from keylane.operators.ordered import Slices, sliding_sum
from keylane.options import PipelineOptions

CANCELLED = "Cancelled"


def classify(df: DataFrame, rules: Mapping[str, str], error_class: str = "error_class") -> DataFrame:
    """Add ``outcome`` and ``cancelled``: success, permanent or transient.

    Only classes the rules call permanent are permanent; everything unlisted,
    cancellations and closed channels included, is transient.
    """
    error = F.col(error_class)
    lasting = [name for name, kind in rules.items() if kind == "permanent"]
    outcome = F.when(error.isNull(), "success")
    if lasting:
        outcome = outcome.when(error.isin(*lasting), "permanent")
    return df.select(
        "*",
        outcome.otherwise("transient").alias("outcome"),
        F.coalesce(error == CANCELLED, F.lit(False)).alias("cancelled"),
    )


def retry_plan(attempts: DataFrame, options: PipelineOptions | None = None) -> DataFrame:
    """When a failed attempt runs again, or that its retries are used up."""
    options = options or PipelineOptions()
    exhausted = F.col("attempt") > options.max_retries
    delay = backoff_delay(F.col("attempt"), _ms(options.retry_base), _ms(options.max_retry_delay))
    retried = (F.col("outcome") == "transient") & ~exhausted
    return attempts.select(
        "*",
        exhausted.alias("exhausted"),
        F.when(retried, delay).alias("delay_ms"),
        F.when(retried, F.col("end_us") + delay * 1000).alias("next_attempt_us"),
    )


def route(outcomes: DataFrame, mode: str, max_retries: int = 3) -> DataFrame:
    """Add ``route``: done, retry, dead_letter or skip, by outcome and mode.

    Transient failures are retried for ever in pipeline mode, up to
    ``max_retries`` and then sent to the dead letters in low-latency mode, and
    skipped in best-effort mode. Permanent failures are never retried: dead
    letter in low-latency mode, else logged and skipped.
    """
    mode = PipelineOptions(mode=mode).mode
    outcome = F.col("outcome")
    if mode == "pipeline":
        failed = F.when(outcome == "transient", "retry").otherwise("skip")
    elif mode == "low_latency":
        failed = F.when((outcome == "transient") & (F.col("attempt") <= max_retries), "retry").otherwise("dead_letter")
    else:
        failed = F.lit("skip")
    return outcomes.withColumn("route", F.when(outcome == "success", "done").otherwise(failed))


def defer_plan(outcomes: DataFrame, options: PipelineOptions | None = None) -> DataFrame:
    """The deferred messages: their offset, and when each is loaded and tried again."""
    options = options or PipelineOptions()
    delay = backoff_delay(F.col("attempt"), _ms(options.defer_base), _ms(options.defer_max_delay))
    return outcomes.filter(F.col("outcome") == "transient").select(
        "topic", "part", "off", "key", "attempt",
        delay.alias("delay_ms"),
        (F.col("end_us") + delay * 1000).alias("next_retry_us"),
    )


def failure_rate(
    outcomes: DataFrame,
    options: PipelineOptions | None = None,
    *,
    by: Sequence[str] = ("topic",),
    at: str = "start_us",
    slices: Slices | None = None,
) -> DataFrame:
    """Failed and all messages of the last window before each message, and whether
    deferral is allowed: not while the share is above the threshold.

    The scope may be a whole topic, so the window is a sliced running sum.
    """
    options = options or PipelineOptions()
    window_us = round(options.defer_failure_window * 1_000_000)
    failed = F.when(F.col("outcome") != "success", 1).otherwise(0)
    counted = sliding_sum(outcomes, by, at, window_us, {"window_failed": failed, "window_all": F.lit(1)}, slices)
    share = F.col("window_failed") / F.col("window_all")
    return counted.withColumn("defer_allowed", F.lit(options.defer_enabled) & (share <= options.defer_failure_threshold))


def windowed_failure_rate(
    outcomes: DataFrame,
    options: PipelineOptions | None = None,
    *,
    slide: str = "1 minute",
    by: Sequence[str] = ("topic",),
    delay: str | None = None,
) -> DataFrame:
    """The failure share of sliding windows: the form that also runs on a stream."""
    options = options or PipelineOptions()
    counted = throughput(outcomes, f"{options.defer_failure_window} seconds", slide, by, delay=delay)
    share = F.col("failures") / F.col("messages")
    return counted.withColumn("defer_allowed", F.lit(options.defer_enabled) & (share <= options.defer_failure_threshold))


def deferred_backlog(deferred: DataFrame) -> DataFrame:
    """Deferred keys and messages per partition."""
    per_key = deferred.groupBy("topic", "part", "key").agg(
        F.count("*").alias("_n"), F.min("next_retry_us").alias("_next")
    )
    return per_key.groupBy("topic", "part").agg(
        F.sum("_n").alias("messages"), F.count("*").alias("keys"), F.min("_next").alias("next_retry_us")
    )


def execution_timeouts(execs: DataFrame, options: PipelineOptions | None = None) -> DataFrame:
    """Executions past their deadline: cancelled, hence transient."""
    options = options or PipelineOptions()
    timeout_ms = _ms(options.handler_timeout)
    late = timed_out(F.col("dur_ms"), timeout_ms)
    return execs.filter(late).select(
        "*",
        (F.col("start_us") + timeout_ms * 1000).alias("cancelled_us"),
        F.lit(CANCELLED).alias("timeout_class"),
        F.lit("transient").alias("timeout_outcome"),
    )


def resolution(
    attempts: DataFrame, by: Sequence[str] = ("topic", "key"), order: Sequence[str] = ("start_us", "event_id")
) -> DataFrame:
    """Final outcome per message (or key), attempts used, first and last attempt."""
    return attempts.groupBy(*by).agg(
        F.max_by("outcome", F.struct(*order)).alias("outcome"),
        F.count("*").alias("attempts"),
        F.min("start_us").alias("first_us"),
        F.max("start_us").alias("last_us"),
    )


def _ms(seconds: float) -> int:
    return round(seconds * 1000)
