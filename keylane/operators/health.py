"""Concurrency, backpressure, progress and stalls of partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keylane.operators.ordered import Running, Slices, following, running
from keylane.options import PipelineOptions

PARTITION = ("topic", "part")


def in_flight(execs: DataFrame, by: Sequence[str] = PARTITION, slices: Slices | None = None) -> DataFrame:
    """Executions running at each start, per group: one row per execution.

    An execution ends just before another that starts at the same time.
    """
    def step(at: str, change: int, late: int) -> Column:
        return F.struct(
            F.col(at).alias("at_us"), F.lit(change).alias("change"), (F.col(at) * 2 + late).alias("_step")
        )

    steps = execs.select(*by, F.inline(F.array(step("start_us", 1, 1), step("end_us", -1, 0))))
    counts = running(
        steps, by, ["_step"], slices, {"running": Running("sum", F.col("change"))}, peers=True
    )
    return counts.filter(F.col("change") == 1).select(*by, "at_us", "running")


def concurrency_peak(execs: DataFrame, options: PipelineOptions | None = None,
                     by: Sequence[str] = ("topic",)) -> DataFrame:
    """Highest concurrency per group, against the allowed one."""
    options = options or PipelineOptions()
    peak = in_flight(execs, by).groupBy(*by).agg(F.max("running").alias("peak"))
    return peak.withColumn("over_limit", F.col("peak") > options.max_concurrency)


def backpressure(execs: DataFrame, options: PipelineOptions | None = None) -> DataFrame:
    """Work in flight at each start per partition, and whether it is paused there."""
    options = options or PipelineOptions()
    return in_flight(execs).withColumn("paused", F.col("running") >= options.max_uncommitted)


def commit_frontier(done: DataFrame) -> DataFrame:
    """Highest offset with every lower one done, per partition: one aggregation."""
    open_ = F.min(F.when(~F.col("done"), F.col("off")))
    return done.groupBy(*PARTITION).agg(
        F.coalesce(open_ - 1, F.max("off")).alias("frontier"), F.max("off").alias("last_off")
    )


def stalled_partitions(progress: DataFrame, now_us: int, options: PipelineOptions | None = None) -> DataFrame:
    """Time since the last message per partition; stalled above the threshold."""
    options = options or PipelineOptions()
    threshold = round(options.stall_threshold * 1_000_000)
    last = progress.groupBy(*PARTITION).agg(F.max("ts_us").alias("last_us"))
    idle = F.lit(now_us) - F.col("last_us")
    return last.select("*", idle.alias("idle_us"), (idle > threshold).alias("stalled"))


def is_stalled(progress: DataFrame, now_us: int, options: PipelineOptions | None = None) -> DataFrame:
    """One row: whether any partition stalled."""
    flags = stalled_partitions(progress, now_us, options)
    return flags.agg(F.coalesce(F.bool_or("stalled"), F.lit(False)).alias("is_stalled"))


def stall_gaps(progress: DataFrame, options: PipelineOptions | None = None,
               order: Sequence[str] = ("ts_us", "event_id"), slices: Slices | None = None) -> DataFrame:
    """Past gaps between messages of a partition above the threshold."""
    options = options or PipelineOptions()
    threshold = round(options.stall_threshold * 1_000_000)
    near = following(progress.select(*PARTITION, *order), PARTITION, order, slices,
                     {"next_us": "ts_us"})
    gap = F.col("next_us") - F.col("ts_us")
    return near.select(*PARTITION, "ts_us", "next_us", gap.alias("gap_us")).filter(F.col("gap_us") > threshold)


def assigned_partitions(progress: DataFrame) -> DataFrame:
    """One row: assigned partitions, and ready when there is one."""
    partitions = progress.select(*PARTITION).distinct()
    return partitions.agg(F.count("*").alias("assigned")).withColumn("is_ready", F.col("assigned") > 0)


def throughput(df: DataFrame, width: str = "1 hour", slide: str | None = None, by: Sequence[str] = (),
               at: str = "ts", delay: str | None = None) -> DataFrame:
    """Messages and failures per window; tumbling, or sliding with ``slide``.

    The same plan runs on a stream, where ``delay`` sets the watermark.
    """
    if delay is not None:
        df = df.withWatermark(at, delay)
    window = F.window(at, width, slide) if slide else F.window(at, width)
    failed = F.sum(F.when(F.col("outcome") != "success", 1).otherwise(0)).alias("failures")
    counted = df.groupBy(window.alias("_w"), *by).agg(F.count("*").alias("messages"), failed)
    return counted.select(F.col("_w.start").alias("window_start"), *by, "messages", "failures")
