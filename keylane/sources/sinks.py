"""What leaves the system: dead letters, telemetry, failure records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keylane.functions.scalars import message_task_id, telemetry_time, timer_task_id
from keylane.sources.messages import to_records


def dead_letters(routed: DataFrame, failure_topic: str, source_system: str | None, payload) -> DataFrame:
    """Records for the failure topic: the rows whose route is ``dead_letter``."""
    return to_records(routed.filter(F.col("route") == "dead_letter"), failure_topic, "key", payload, source_system)


def message_telemetry(outcomes: DataFrame) -> DataFrame:
    """Start and end events of executions, one row each."""
    place = ["topic", "part", "off", "key"]
    steps = F.array(
        F.struct(F.col("start_us").alias("at"), F.lit("message.started").alias("event_type"),
                 F.lit(None).cast("string").alias("detail")),
        F.struct(F.col("end_us").alias("at"),
                 F.when(F.col("outcome") == "success", "message.succeeded").otherwise("message.failed")
                 .alias("event_type"),
                 F.col("error_class").alias("detail")),
    )
    return outcomes.select(*place, F.inline(steps)).select(
        telemetry_time(F.col("at")).alias("event_time"), "event_type", *place, "detail"
    )


def timer_telemetry(ops: DataFrame) -> DataFrame:
    """One event per timer operation."""
    return ops.select(
        telemetry_time(F.col("ts_us")).alias("event_time"),
        F.concat(F.lit("timer."), F.col("op")).alias("event_type"),
        F.lit(None).cast("string").alias("topic"),
        F.lit(None).cast("int").alias("part"),
        F.lit(None).cast("bigint").alias("off"),
        "key",
        F.col("at_s").cast("string").alias("detail"),
    )


def result_telemetry(results: DataFrame) -> DataFrame:
    """One event per handler call of a stream: which kind of call, and how it ended."""
    ended = F.when(F.col("outcome") == "success", "succeeded").otherwise("failed")
    return results.select(
        telemetry_time(F.col("at_us")).alias("event_time"),
        F.concat_ws(".", "kind", ended).alias("event_type"),
        "topic", "part", "off", "key",
        F.coalesce("error_class", F.col("fire_s").cast("string")).alias("detail"),
    )


def telemetry(outcomes: DataFrame, timer_ops: DataFrame | None = None, enabled: bool = True) -> DataFrame:
    """All telemetry events; none when switched off."""
    events = message_telemetry(outcomes)
    if timer_ops is not None:
        events = events.unionByName(timer_telemetry(timer_ops))
    return events if enabled else events.limit(0)


def telemetry_records(events: DataFrame, topic: str, source_system: str | None) -> DataFrame:
    return to_records(events, topic, "key", F.struct(*events.columns), source_system)


def failure_records(outcomes: DataFrame, timer: bool = False) -> DataFrame:
    """Error reports with event context. A cancelled execution is not reported.

    The ``event_type`` tag is left out (null) where the context has none.
    """
    failed = outcomes.filter((F.col("outcome") != "success") & ~F.col("cancelled"))
    if timer:
        task = timer_task_id(F.col("key"), F.col("fire_s"))
        context = {"event_type": F.lit("timer"), "key": F.col("key"), "time": F.col("fire_s")}
    else:
        task = message_task_id(F.col("topic"), F.col("part"), F.col("off"))
        context = {
            "event_type": F.lit("message"),
            "topic": F.col("topic"),
            "partition": F.col("part"),
            "key": F.col("key"),
            "offset": F.col("off"),
        }
    return failed.select(
        task.alias("task_id"),
        F.col("error_class"),
        F.col("outcome"),
        F.struct(*[c.cast("string").alias(n) for n, c in context.items()]).alias("context"),
        F.struct(F.col("error_class").alias("class"), F.col("error_message").alias("message"),
                 F.col("error_cause").alias("cause")).alias("error"),
        context["event_type"].alias("event_type_tag"),
    )
