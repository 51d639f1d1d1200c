"""Timers in batch, from an operations log ``(key, seq, ts_us, op, fire_s, at_s)``.

The timers of a key are a set of whole seconds. A timer whose time has come by
the time of an operation has already fired when that operation runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keylane.operators.ordered import Running, Slices, even_slices, previous, running

CLEARING = ("clear_and_schedule", "clear_scheduled")
SCHEDULING = ("schedule", "clear_and_schedule")
SECOND_US = 1_000_000


def surviving(ops: DataFrame, slices: Slices | None = None) -> DataFrame:
    """Scheduled instants no later operation removed before they were due.

    One row per (key, instant). An instant survives a clear or an unschedule
    that comes at or after it. Both look-aheads are running minima over the
    following rows, so there is no range join and no hot key.
    """
    slices = even_slices(ops, "ts_us", tie="seq") if slices is None else slices
    cleared = running(
        ops, ["key"], ["ts_us", "seq"], slices,
        {"next_clear_us": Running("min", F.when(F.col("op").isin(*CLEARING), F.col("ts_us")))},
        reverse=True,
    )
    named = cleared.filter(F.col("at_s").isNotNull() & (F.col("op") != "clear_scheduled"))
    dropped = running(
        named, ["key", "at_s"], ["ts_us", "seq"], slices,
        {"next_drop_us": Running("min", F.when(F.col("op") == "unschedule", F.col("ts_us")))},
        reverse=True,
    )
    due = F.col("at_s") * SECOND_US
    return (
        dropped.filter(F.col("op").isin(*SCHEDULING))
        .filter(_not_before(F.col("next_clear_us"), due) & _not_before(F.col("next_drop_us"), due))
        .select("key", F.col("at_s").alias("fire_s"))
        .distinct()
    )


def _not_before(at: Column, due: Column) -> Column:
    return at.isNull() | (at >= due)


def timer_firings(ops: DataFrame, now_us: int, slices: Slices | None = None) -> DataFrame:
    """Timers that have fired by ``now``: one row per key and instant."""
    return surviving(ops, slices).filter(F.col("fire_s") * SECOND_US <= now_us)


def pending_timers(ops: DataFrame, now_us: int, slices: Slices | None = None) -> DataFrame:
    """Timers still scheduled at ``now``."""
    return surviving(ops, slices).filter(F.col("fire_s") * SECOND_US > now_us)


def scheduled_counts(ops: DataFrame, now_us: int) -> DataFrame:
    """Pending timers per key, counted, also for keys that have none."""
    pending = pending_timers(ops, now_us).groupBy("key").agg(
        F.count("*").alias("pending"), F.min("fire_s").alias("next_fire_s")
    )
    keys = ops.select("key").distinct()
    return keys.join(pending, "key", "left").select(
        "key", F.coalesce("pending", F.lit(0)).alias("pending"), "next_fire_s"
    )


def operation_effects(ops: DataFrame, slices: Slices | None = None) -> DataFrame:
    """What each operation of the log did: rows (key, seq, op, added, removed).

    ``added`` is 1 for a scheduling operation whose instant was not pending,
    ``removed`` counts the pending instants that a clear or an unschedule took.
    Whether an instant is pending follows from the last operation that named it
    and the last clear before; what a clear takes, from the next clear after
    each added instant. All are running values of the key or of the instant.
    """
    slices = even_slices(ops, "ts_us", tie="seq") if slices is None else slices
    order, clears = ["ts_us", "seq"], F.when(F.col("op").isin(*CLEARING), F.col("seq"))
    before = running(ops, ["key"], order, slices, {"_last_clear": Running("max", clears)})
    around = running(before, ["key"], order, slices, {
        "_next_clear": Running("min", clears), "_next_clear_us": Running("min", F.when(clears.isNotNull(), F.col("ts_us")))}, reverse=True)
    named = around.filter(F.col("at_s").isNotNull() & (F.col("op") != "clear_scheduled"))
    after = previous(named, ["key", "at_s"], order, slices, {"_op": "op", "_seq": "seq"})
    known = running(after, ["key", "at_s"], order, slices, {
        "_next_drop": Running("min", F.when(F.col("op") == "unschedule", F.col("seq")))}, reverse=True)
    due = F.col("at_s") * SECOND_US
    held = F.coalesce(F.col("_op").isin(*SCHEDULING) & (F.col("_seq") >= F.coalesce("_last_clear", "_seq")) & (due > F.col("ts_us")),
                      F.lit(False))
    added = F.col("op").isin(*SCHEDULING) & (~held | (F.col("op") == "clear_and_schedule"))
    single = known.select("*", added.cast("int").alias("added"), (held & (F.col("op") == "unschedule")).cast("int").alias("_dropped"))
    taken = single.filter((F.col("added") == 1) & (F.col("_next_clear_us") < due) & (
        F.col("_next_drop").isNull() | (F.col("_next_drop") > F.col("_next_clear")))).groupBy(
        "key", F.col("_next_clear").alias("seq")).agg(F.count("*").alias("_taken"))
    return ops.select("key", "seq", "op").join(single.select("key", "seq", "added", "_dropped"), ["key", "seq"], "left").join(
        taken, ["key", "seq"], "left").select(
        "key", "seq", "op", F.coalesce("added", F.lit(0)).alias("added"),
        (F.coalesce("_taken", F.lit(0)) + F.coalesce("_dropped", F.lit(0))).alias("removed"))


def only_operations(ops: DataFrame, *names: str) -> DataFrame:
    """The log reduced to some operations."""
    return ops.filter(F.col("op").isin(*names))


def timer_accuracy(fired: DataFrame, tolerance_us: int = SECOND_US, slices: Slices | None = None) -> DataFrame:
    """Lateness of each firing, whether it is within tolerance and in order."""
    near = previous(fired, ["key"], ["fire_s", "fired_us"], slices, {"_before_us": "fired_us"})
    late = F.col("fired_us") - F.col("fire_s") * SECOND_US
    return near.select(
        *fired.columns,
        late.alias("late_us"),
        (F.abs(late) <= tolerance_us).alias("on_time"),
        F.coalesce(F.col("_before_us") <= F.col("fired_us"), F.lit(True)).alias("in_order"),
    )


def timer_slabs(timers: DataFrame, slab_s: int = 3600) -> DataFrame:
    """Backlog report: timers per slab of time."""
    slab = F.floor(F.col("fire_s") / F.lit(slab_s)).cast("bigint")
    return timers.groupBy(slab.alias("slab")).agg(
        F.count("*").alias("timers"), F.min("fire_s").alias("first_s"), F.max("fire_s").alias("last_s")
    )
