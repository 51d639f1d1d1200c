"""Who used the execution time, who runs next, and who takes too much."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keylane.functions.scalars import wait_boost
from keylane.operators.ordered import Running, Slices, running, sliding_sum
from keylane.options import PipelineOptions

# The two kinds of work.
CLASSES = ("normal", "failure")
HOUR_US = 3_600_000_000


def virtual_time(execs: DataFrame, by: Sequence[str] = ("demand", "key"),
                 order: Sequence[str] = ("start_us", "event_id"), slices: Slices | None = None) -> DataFrame:
    """Execution time a key had used in its class before each execution."""
    return running(execs, by, order, slices, {"virtual_ms": Running("sum", F.col("dur_ms"))})


def used_time(execs: DataFrame) -> DataFrame:
    """Virtual time per class and key after the whole log."""
    return execs.groupBy("demand", "key").agg(F.sum("dur_ms").alias("virtual_ms"))


def class_share(execs: DataFrame, options: PipelineOptions | None = None) -> DataFrame:
    """Time per class, its share, and whether retries exceed their budget."""
    options = options or PipelineOptions()
    weight = options.scheduler_failure_weight
    budget = F.when(F.col("demand") == "failure", F.lit(weight)).otherwise(F.lit(1.0 - weight))
    # one row per class remains, so the total is a window over two rows
    spent = execs.groupBy("demand").agg(F.sum("dur_ms").alias("spent_ms"))
    total = F.sum("spent_ms").over(Window.partitionBy(F.lit(1)))
    return spent.select(
        "demand",
        "spent_ms",
        F.round(F.col("spent_ms") / total, 6).alias("share"),
        ((F.col("spent_ms") / total) > budget).alias("over_budget"),
    )


def boosted(df: DataFrame, now_us: int, options: PipelineOptions | None = None, since: str = "ts_us") -> DataFrame:
    """Add the wait of each message and its priority boost."""
    options = options or PipelineOptions()
    wait = F.floor((F.lit(now_us) - F.col(since)) / F.lit(1000)).cast("bigint")
    boost = wait_boost(wait, round(options.scheduler_max_wait * 1000), round(options.scheduler_wait_weight * 1000))
    return df.select("*", wait.alias("wait_ms"), boost.alias("boost_ms"))


def fair_order(
    queue: DataFrame,
    history: DataFrame,
    now_us: int,
    k: int | None = None,
    options: PipelineOptions | None = None,
    order: Sequence[str] = ("ts_us", "event_id"),
) -> DataFrame:
    """The next ``k`` messages to run per class, ranked by virtual time less boost.

    Only the oldest waiting message of a key may run. Each class is a top-k, so
    the ranking is over ``k`` rows and no class is sorted in one task. A head
    of any other class, or of none, fails the job: it would never run.
    """
    options = options or PipelineOptions()
    k = options.max_concurrency if k is None else k
    rest = [c for c in queue.columns if c != "key"]
    heads = queue.groupBy("key").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_head"))
    heads = heads.select("key", *[F.col(f"_head.{c}").alias(c) for c in rest])
    unknown = F.raise_error(F.concat(F.lit("unknown demand: "), F.coalesce(F.col("demand").cast("string"), F.lit("null"))))
    heads = heads.withColumn("demand", F.when(F.col("demand").isin(*CLASSES), F.col("demand")).otherwise(unknown.cast("string")))
    ranked = (
        boosted(heads, now_us, options, order[0])
        .join(used_time(history), ["demand", "key"], "left")
        .withColumn("virtual_ms", F.coalesce("virtual_ms", F.lit(0)))
        .withColumn("priority_ms", F.col("virtual_ms") - F.col("boost_ms"))
    )
    tops = [
        ranked.filter(F.col("demand") == c).orderBy("priority_ms", *order, "key").limit(k) for c in CLASSES
    ]
    place = Window.partitionBy("demand").orderBy("priority_ms", *order, "key")
    return reduce(DataFrame.unionByName, tops).withColumn("place", F.row_number().over(place))


def monopolization(execs: DataFrame, options: PipelineOptions | None = None, *, by: Sequence[str] = ("key",),
                   slices: Slices | None = None) -> DataFrame:
    """Time a key's executions started in the rolling window, and the rejection.

    Counts an execution in full when it started within the window, the present
    one included. The threshold itself is still allowed.
    """
    options = options or PipelineOptions()
    window_us = round(options.monopolization_window * 1_000_000)
    counted = sliding_sum(execs, by, "start_us", window_us, {"window_ms": F.col("dur_ms")}, slices=slices)
    return _rejected(counted, F.col("window_ms") * 1000, window_us, options)


def monopolization_clipped(execs: DataFrame, options: PipelineOptions | None = None, *, by: Sequence[str] = ("key",),
                           slices: Slices | None = None) -> DataFrame:
    """As :func:`monopolization`, with executions cut at the window's edges.

    The time executions spent inside ``[t - w, t]`` is the difference of two
    sums of ramps ``max(x - a, 0)``: up at a start, level from the end, and the
    same again ``w`` later with the sign turned. One running sum over these four
    steps gives it exactly, without pairing executions with each other.
    """
    options = options or PipelineOptions()
    window_us = round(options.monopolization_window * 1_000_000)

    def step(at: Column, sign: int) -> Column:
        return F.struct(at.alias("at_us"), F.lit(sign).cast("bigint").alias("slope"))

    start, end = F.col("start_us"), F.col("end_us")
    ramps = execs.select(
        *by,
        F.inline(F.array(step(start, 1), step(end, -1), step(start + window_us, -1), step(end + window_us, 1))),
    )
    probes = execs.withColumn("at_us", start).withColumn("slope", F.lit(0).cast("bigint")).withColumn("_row", F.lit(True))
    steps = probes.unionByName(ramps, allowMissingColumns=True)
    # positions are split into hours and the rest, so that the sums stay small
    number = F.floor(F.col("at_us") / F.lit(HOUR_US)).cast("bigint")
    inside = F.col("at_us") - number * HOUR_US
    swept = running(
        steps, by, ["at_us"], slices,
        {
            "_slope": Running("sum", F.col("slope")),
            "_inside": Running("sum", F.col("slope") * inside),
            "_number": Running("sum", F.col("slope") * number),
        },
        peers=True,
    )
    spent = (
        F.col("_slope") * inside - F.col("_inside") - (F.col("_number") - F.col("_slope") * number) * HOUR_US
    )
    counted = swept.filter("_row").select(*execs.columns, spent.alias("window_us"))
    return _rejected(counted, F.col("window_us"), window_us, options)


def _rejected(counted: DataFrame, used_us: Column, window_us: int, options: PipelineOptions) -> DataFrame:
    over = used_us > F.lit(round(window_us * options.monopolization_threshold))
    rejected = F.lit(options.monopolization_enabled) & over
    return counted.withColumn("rejected", rejected).withColumn(
        "verdict", F.when(rejected, "transient").otherwise("accepted")
    )


def hot_keys(execs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` keys with the most execution time."""
    spent = execs.groupBy("key").agg(F.sum("dur_ms").alias("spent_ms"), F.count("*").alias("executions"))
    return spent.orderBy(F.col("spent_ms").desc(), "key").limit(k)
