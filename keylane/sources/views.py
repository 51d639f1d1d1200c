"""Keyed-event views over the ``events`` table, so that stored events can be
replayed through every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keylane.operators.failures import classify
from keylane.operators.ordered import by_number, previous, row_position

TOPIC = "events"
GROUP = "shop-svc"
PREFIXES = ("user.", "account.")

# Event type names, timer operations and error classes of the views.
TYPES = {"click": "user.click", "view": "user.view", "signup": "account.signup", "purchase": "order.user.purchase"}
TIMER_OPS = {"click": "schedule", "purchase": "schedule", "view": "clear_and_schedule", "error": "unschedule",
             "signup": "clear_scheduled"}
ERROR_RULES = {"IOError": "transient", "ValueError": "permanent"}


def _lookup(column, table):
    found = F.lit(None).cast("string")
    for value, name in table.items():
        found = F.when(column == value, name).otherwise(found)
    return found


def _base(events: DataFrame):
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("part"),
        F.col("user_id").cast("string").alias("key"),
        ts.alias("ts"),
        F.unix_micros(ts).alias("ts_us"),
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "event_type",
        "value",
    )


def with_offsets(df: DataFrame) -> DataFrame:
    """Number the rows of each partition from 0 in event order."""
    numbered = row_position(df, ["part"], ["event_id"], by_number("event_id"), "_n")
    return numbered.withColumn("off", F.col("_n") - 1).drop("_n")


def messages(events: DataFrame, offsets: bool = True) -> DataFrame:
    """Messages with type, id and origin; offsets cost a shuffle, so ask for them."""
    k = F.col("k")
    rows = _base(events).select(
        "topic", "part", "key", "ts", "ts_us", "event_id", "k",
        F.when(F.col("event_id") % 10 == 0, GROUP).when(F.col("event_id") % 10 == 1, "billing").alias("source_system"),
        _lookup(F.col("event_type"), TYPES).alias("type"),
        F.when(k % 5 != 0, F.concat(F.lit("msg-"), k.cast("string"))).alias("id"),
        "value",
    )
    return with_offsets(rows) if offsets else rows


def records(events: DataFrame) -> DataFrame:
    """The messages as a broker would store them."""
    header = F.struct(F.lit("source-system").alias("key"), F.col("source_system").cast("binary").alias("value"))
    return messages(events).select(
        "topic",
        F.col("part").alias("partition"),
        F.col("off").alias("offset"),
        F.col("ts").alias("timestamp"),
        "key",
        F.to_json(F.struct("type", "id", "k")).alias("value"),
        F.when(F.col("source_system").isNotNull(), F.array(header)).otherwise(F.array()).alias("headers"),
    )


def executions(events: DataFrame, offsets: bool = False) -> DataFrame:
    """The processing log: one execution per event, with class and outcome."""
    rows = _base(events).withColumn("dur_ms", F.round(F.col("value") * 1000).cast("bigint"))
    event_id, kind = F.col("event_id"), F.col("event_type")
    rows = rows.select(
        "topic", "event_id", "part", "key", "ts",
        F.concat(F.lit("msg-"), F.col("k").cast("string")).alias("id"),
        F.col("ts_us").alias("start_us"),
        "dur_ms",
        (F.col("ts_us") + F.col("dur_ms") * 1000).alias("end_us"),
        F.when(kind == "error", "failure").otherwise("normal").alias("demand"),
        (event_id % 5 + 1).cast("int").alias("attempt"),
        F.when(kind == "error", "IOError")
        .when((kind == "signup") & (event_id % 7 == 0), "ValueError")
        .when((kind == "view") & (event_id % 11 == 0), "Cancelled")
        .alias("error_class"),
    )
    return with_offsets(rows) if offsets else rows


def outcomes(events: DataFrame, offsets: bool = False) -> DataFrame:
    return classify(executions(events, offsets), ERROR_RULES)


def timer_ops(events: DataFrame) -> DataFrame:
    """Timer operations per key; an unschedule names the previous row's instant."""
    base = _base(events)
    ops = base.select(
        "key",
        F.col("event_id").alias("seq"),
        "ts_us",
        _lookup(F.col("event_type"), TIMER_OPS).alias("op"),
        F.floor((F.col("ts_us") + F.col("k").cast("bigint") * 600_000_000 + 500_000) / F.lit(1_000_000))
        .cast("bigint").alias("fire_s"),
    )
    near = previous(ops, ["key"], ["seq"], by_number("seq"), {"_before": "fire_s"})
    op = F.col("op")
    return near.withColumn(
        "at_s",
        F.when(op == "unschedule", F.col("_before"))
        .when(op.isin("schedule", "clear_and_schedule"), F.col("fire_s")),
    ).drop("_before")


def spans(events: DataFrame) -> DataFrame:
    """Spans of each event with their cause: send, receive, handler and, where
    the handler set a timer, the scheduling and the timer's run."""
    event = F.col("event_id").cast("string")
    trace = F.concat(F.lit("t"), event)

    def span(prefix, cause, name, kind):
        caused = F.concat(F.lit(cause), event) if cause else F.lit(None).cast("string")
        return F.struct(
            F.concat(F.lit(prefix), event).alias("span_id"),
            F.lit(name).alias("name"),
            F.lit(kind).alias("kind"),
            trace.alias("cause_trace_id"),
            caused.alias("cause_span_id"),
        )

    chain = [
        span("s", None, "send", "producer"),
        span("e", "s", "on_message", "message"),
        span("h", "e", "handler", "internal"),
    ]
    timer = [span("m", "h", "schedule", "internal"), span("f", "m", "on_timer", "timer")]
    sets_timer = F.col("event_type").isin("click", "view", "purchase")
    return events.select(F.inline(F.when(sets_timer, F.array(*chain, *timer)).otherwise(F.array(*chain))))
