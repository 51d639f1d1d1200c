"""Span relations."""

from pyspark.sql import functions as F

from keylane.operators import traces as X
from keylane.options import PipelineOptions
from keylane.plans.base import EXECS, QUERIES, query, with_
from keylane.plans.base import SQL as RECORDED_SQL
from keylane.sources import views

SPANS = """
spans AS (
  SELECT concat(p, e) AS span_id, name, kind, concat('t', e) AS cause_trace_id,
    CASE WHEN c IS NOT NULL THEN concat(c, e) END AS cause_span_id
  FROM (SELECT CAST(event_id AS VARCHAR) AS e, event_type IN ('click', 'view', 'purchase') AS timed FROM events),
    (VALUES ('s', NULL, 'send', 'producer', false), ('e', 's', 'on_message', 'message', false),
      ('h', 'e', 'handler', 'internal', false), ('m', 'h', 'schedule', 'internal', true),
      ('f', 'm', 'on_timer', 'timer', true)) v(p, c, name, kind, needs_timer)
  WHERE timed OR NOT needs_timer)
"""


def _linked(following: str) -> str:
    follows = f"(kind IN ({following}) AND cause_span_id IS NOT NULL)"
    return f"""
linked AS (
  SELECT span_id, name, kind, CASE WHEN {follows} THEN concat('t-', span_id) ELSE cause_trace_id END AS trace_id,
    CASE WHEN NOT {follows} THEN cause_span_id END AS parent_span_id,
    CASE WHEN {follows} THEN cause_trace_id END AS link_trace_id,
    CASE WHEN {follows} THEN cause_span_id END AS link_span_id
  FROM spans)
"""


@query(with_(SPANS, _linked("'timer'")) + "SELECT * FROM linked")
def link_spans(events):
    return X.link_spans(views.spans(events))


@query(with_(SPANS, _linked("'message'")) + "SELECT * FROM linked")
def link_spans_swapped(events):
    return X.link_spans(views.spans(events), PipelineOptions(message_spans="follows_from", timer_spans="child"))


@query("""
SELECT event_id, CASE WHEN ok THEN lpad(lower(to_hex(event_id)), 32, '0') END AS trace_id,
  CASE WHEN ok THEN lpad(lower(to_hex(event_id * 7 + 1)), 16, '0') END AS span_id,
  CASE WHEN ok THEN event_id % 2 = 1 END AS sampled
FROM (SELECT *, event_id > 0 AND event_id % 13 <> 5 AS ok FROM events)""")
def trace_context(events):
    """Contexts from the carrier; the zero trace id and a malformed text give none."""
    event = F.col("event_id")
    carrier = F.when(event % 13 == 5, "not a context").otherwise(
        F.concat_ws(
            "-", F.lit("00"), F.lpad(F.lower(F.hex(event)), 32, "0"), F.lpad(F.lower(F.hex(event * 7 + 1)), 16, "0"),
            F.lpad((event % 2).cast("string"), 2, "0"),
        )
    )
    found = X.trace_context(F.create_map(F.lit("traceparent"), carrier))
    return events.select("event_id", found.alias("_c")).select(
        "event_id", F.col("_c.trace_id").alias("trace_id"), F.col("_c.span_id").alias("span_id"),
        F.col("_c.sampled").alias("sampled"),
    )


ROOTED = """
SELECT span_id, name, concat('t', substr(span_id, 2)) AS root_trace_id, concat('s', substr(span_id, 2)) AS root_span_id,
  CAST(CASE name WHEN 'send' THEN 0 WHEN 'on_message' THEN 1 WHEN 'handler' THEN 2 WHEN 'schedule' THEN 3 ELSE 4 END
    AS INT) AS depth FROM linked"""


@query(with_(SPANS, _linked("'timer'")) + ROOTED)
def assemble_traces(events):
    trees = X.assemble_traces(X.link_spans(views.spans(events)))
    return trees.select("span_id", "name", "root_trace_id", "root_span_id", "depth")


@query(with_(SPANS, _linked("'timer'")) + f"""
SELECT root_trace_id, root_span_id, count(*) AS spans, max(depth) AS depth FROM ({ROOTED})
GROUP BY root_trace_id, root_span_id""")
def trace_sizes(events):
    return X.trace_sizes(X.assemble_traces(X.link_spans(views.spans(events))))


CONVERSED = """
WITH RECURSIVE spans AS (
  SELECT concat('c', conv_id, '-', turn) AS span_id, concat('t', conv_id) AS cause_trace_id, turn,
    CASE WHEN turn > 0 THEN concat('c', conv_id, '-', turn - 1) END AS cause_span_id,
    CASE WHEN role = 'user' THEN 'message' ELSE 'timer' END AS kind FROM conversations),
linked AS (
  SELECT span_id, CASE WHEN kind = 'timer' AND cause_span_id IS NOT NULL THEN concat('t-', span_id) ELSE cause_trace_id END
      AS trace_id,
    cause_span_id AS up FROM spans),
walked AS (
  SELECT span_id, trace_id, span_id AS place, 0 AS depth FROM linked
  UNION ALL
  SELECT w.span_id, w.trace_id, l.up, w.depth + 1 FROM walked w JOIN linked l ON w.place = l.span_id WHERE l.up IS NOT NULL)
SELECT span_id, max_by(place, depth) AS root_span_id, CAST(max(depth) AS INT) AS depth FROM walked GROUP BY span_id
"""


def conversation_traces(spark, sf_dir):
    """Each turn of a conversation is caused by the one before: answers start a trace that links back, questions do not."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    named = F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn")
    before = F.concat(F.lit("c"), "conv_id", F.lit("-"), F.col("turn") - 1)
    spans = turns.select(
        named.alias("span_id"), F.when(F.col("role") == "user", "message").otherwise("timer").alias("kind"),
        F.concat(F.lit("t"), "conv_id").alias("cause_trace_id"), F.when(F.col("turn") > 0, before).alias("cause_span_id"))
    linked = X.link_spans(spans)
    # a cause is named with the trace of its conversation; the trace it was given is looked up
    own = linked.select(F.col("span_id").alias("_s"), F.col("trace_id").alias("_t"))
    above = F.coalesce("parent_span_id", "link_span_id")
    known = linked.join(own, above == F.col("_s"), "left").withColumn(
        "link_trace_id", F.coalesce("_t", "link_trace_id")).withColumn("link_span_id", above).withColumn(
        "parent_span_id", F.lit(None).cast("string")).drop("_s", "_t")
    return X.assemble_traces(known).select("span_id", "root_span_id", "depth")


QUERIES["conversation_traces"] = conversation_traces
RECORDED_SQL["conversation_traces"] = CONVERSED


@query(with_(EXECS) + """
SELECT event_id, CASE WHEN outcome <> 'success' AND NOT cancelled THEN 'error' ELSE 'unset' END AS span_status FROM execs""")
def span_status(events):
    return X.span_status(views.outcomes(events)).select("event_id", "span_status")
