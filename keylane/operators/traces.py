"""Span relations between sending, handling and timers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keylane.options import PipelineOptions
from keylane.session import stored


def link_spans(df: DataFrame, options: PipelineOptions | None = None) -> DataFrame:
    """Connect spans to the span that caused them.

    Rows have ``span_id``, ``kind`` and the cause as ``cause_trace_id`` and
    ``cause_span_id``. A child shares the trace of its cause; one that follows
    starts a trace of its own with a link back. ``message`` and ``timer`` spans
    relate as the options say, all others are children.
    """
    options = options or PipelineOptions()
    kind = F.col("kind")
    follows = F.lit(False)
    if options.message_spans == "follows_from":
        follows = follows | (kind == "message")
    if options.timer_spans == "follows_from":
        follows = follows | (kind == "timer")
    follows = follows & F.col("cause_span_id").isNotNull()
    cause = ("cause_trace_id", "cause_span_id")
    return df.select(
        *[c for c in df.columns if c not in cause],
        F.when(follows, F.concat(F.lit("t-"), F.col("span_id"))).otherwise(F.col("cause_trace_id")).alias("trace_id"),
        F.when(~follows, F.col("cause_span_id")).alias("parent_span_id"),
        F.when(follows, F.col("cause_trace_id")).alias("link_trace_id"),
        F.when(follows, F.col("cause_span_id")).alias("link_span_id"),
    )


def trace_context(headers: Column) -> Column:
    """Trace and span id from the ``traceparent`` header, null when malformed."""
    carrier = F.try_element_at(headers, F.lit("traceparent"))
    # version-trace-span-flags, in lower-case hex; all-zero ids are invalid
    pattern = "^[0-9a-f]{2}-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})$"
    valid = carrier.rlike(pattern) & ~carrier.rlike("^(ff-|[0-9a-f]{2}-(0{32}|[0-9a-f]{32}-0{16})-)")
    parts = F.split(carrier, "-")
    return F.when(
        valid,
        F.struct(
            parts[1].alias("trace_id"),
            parts[2].alias("span_id"),
            (F.conv(parts[3], 16, 10).cast("int").bitwiseAND(1) == 1).alias("sampled"),
        ),
    )


def assemble_traces(spans: DataFrame) -> DataFrame:
    """The root of every span's tree and its distance, over parents and links, however deep the tree is.

    Each span points to the one above it. In a round every pointer takes over
    the pointer it points to, which doubles its reach, so a chain of n spans
    needs log2(n) joins. Children of one parent may be many, but the parent's
    side has one row, so a split of the children keeps the join balanced.
    Pointers that never end lie on a cycle; that is an error, and raised.
    """
    above = (
        F.when(F.col("parent_span_id").isNotNull(), F.col("trace_id")).otherwise(F.col("link_trace_id")),
        F.coalesce("parent_span_id", "link_span_id"),
    )
    pointers = stored(
        spans.select(F.col("trace_id").alias("_t"), F.col("span_id").alias("_s"), above[0].alias("_up_t"), above[1].alias("_up_s"),
                     F.lit(1).alias("_far"), F.lit(True).alias("_moved"))
        .filter(F.col("_up_s").isNotNull()).dropDuplicates(["_t", "_s"]), "pointers")
    rounds = pointers.count().bit_length() + 1
    while not pointers.filter("_moved").isEmpty():
        if rounds == 0:
            raise ValueError("spans cause each other in a cycle")
        rounds -= 1
        beyond = pointers.select(F.col("_t").alias("_up_t"), F.col("_s").alias("_up_s"), F.col("_up_t").alias("_over_t"),
                                 F.col("_up_s").alias("_over_s"), F.col("_far").alias("_more"))
        pointers = stored(pointers.join(beyond, ["_up_t", "_up_s"], "left").select(
            "_t", "_s", F.coalesce("_over_t", "_up_t").alias("_up_t"), F.coalesce("_over_s", "_up_s").alias("_up_s"),
            (F.col("_far") + F.coalesce("_more", F.lit(0))).alias("_far"), F.col("_over_s").isNotNull().alias("_moved")), "pointers")
    rooted = spans.join(pointers, (F.col("trace_id") == F.col("_t")) & (F.col("span_id") == F.col("_s")), "left")
    return rooted.select(
        *spans.columns,
        F.coalesce("_up_t", "trace_id").alias("root_trace_id"),
        F.coalesce("_up_s", "span_id").alias("root_span_id"),
        F.coalesce("_far", F.lit(0)).alias("depth"),
    )


def trace_sizes(assembled: DataFrame) -> DataFrame:
    """Spans and depth of each tree."""
    return assembled.groupBy("root_trace_id", "root_span_id").agg(
        F.count("*").alias("spans"), F.max("depth").alias("depth")
    )


def span_status(outcomes: DataFrame) -> DataFrame:
    """Error status of failed executions; an expected cancellation is no error."""
    failed = (F.col("outcome") != "success") & ~F.col("cancelled")
    return outcomes.withColumn("span_status", F.when(failed, "error").otherwise("unset"))
