"""Handler calls in batch and the order of keyed work."""

from pyspark.sql import functions as F

from keylane.handlers import EventHandler, permanent
from keylane.operators import keyed as K
from keylane.operators.failures import execution_timeouts
from keylane.operators.ordered import by_number
from keylane.options import PipelineOptions
from keylane.plans.base import EXECS, MESSAGES, query, with_
from keylane.sources import views


@permanent("on_message", ValueError)
class ShopHandler(EventHandler):
    """Fails for good on a bad number, and for now when the type is missing."""

    def on_message(self, context, message):
        if message.payload["k"] % 7 == 0:
            raise ValueError(f"bad number {message.payload['k']}")
        if "type" not in message.payload:
            raise OSError("no type yet")


@query(with_(MESSAGES) + """
SELECT part, off, key, CASE WHEN k % 7 = 0 THEN 'permanent' WHEN type IS NULL THEN 'transient' ELSE 'success' END
  AS outcome, CASE WHEN k % 7 = 0 THEN 'ValueError' WHEN type IS NULL THEN 'OSError' END AS error_class,
  CASE WHEN k % 7 = 0 THEN concat('bad number ', CAST(k AS VARCHAR)) WHEN type IS NULL THEN 'no type yet' END
  AS error_message FROM messages""")
def handler_calls(events):
    rows = views.messages(events).withColumn("payload", F.to_json(F.struct("type", "id", "k")))
    calls = K.process(rows, ShopHandler, independent=True)
    return calls.select("part", "off", "key", "outcome", "error_class", "error_message")


class OrderedHandler(EventHandler):
    """Refuses a number below the one before it under the same key."""

    def __init__(self):
        self.key = self.number = None

    def on_message(self, context, message):
        before = self.number if self.key == message.key else None
        self.key, self.number = message.key, message.payload["k"]
        if before is not None and self.number < before:
            raise LookupError(f"{self.number} after {before}")


@query(with_(MESSAGES) + """
SELECT part, off, key, CASE WHEN k < before THEN 'transient' ELSE 'success' END AS outcome,
  CASE WHEN k < before THEN concat(CAST(k AS VARCHAR), ' after ', CAST(before AS VARCHAR)) END AS error_message
FROM (SELECT *, LAG(k) OVER (PARTITION BY key ORDER BY part, off) AS before FROM messages)""")
def handler_calls_in_order(events):
    """A handler that relies on serial, ordered calls per key."""
    rows = views.messages(events).withColumn("payload", F.to_json(F.struct("type", "id", "k")))
    return K.process(rows, OrderedHandler).select("part", "off", "key", "outcome", "error_message")


@query(with_(EXECS) + "SELECT event_id, error_class, outcome, cancelled FROM execs")
def error_classes(events):
    return views.outcomes(events).select("event_id", "error_class", "outcome", "cancelled")


@query(with_(EXECS) + """
SELECT event_id, CASE WHEN dur_ms > 48000 THEN start_us + 48000000 ELSE end_us END AS completed_us,
  CASE WHEN dur_ms > 48000 THEN 'transient' ELSE outcome END AS outcome FROM execs""")
def result_once(events):
    """A deadline cancels; whichever result comes first counts."""
    outcomes = views.outcomes(events)
    cancelled = execution_timeouts(outcomes, PipelineOptions(stall_threshold=60)).select(
        "event_id", F.col("cancelled_us").alias("completed_us"), F.col("timeout_outcome").alias("outcome")
    )
    results = outcomes.select("event_id", F.col("end_us").alias("completed_us"), "outcome").unionByName(cancelled)
    return K.result_once(results, "event_id")


@query(with_(MESSAGES) + """
SELECT event_id, key, ROW_NUMBER() OVER (PARTITION BY key ORDER BY part, off) AS position FROM messages""")
def sequence_per_key(events):
    rows = views.messages(events, offsets=False).select("topic", "part", "key", "event_id")
    return K.sequence_per_key(rows, order="event_id").select("event_id", "key", "position")


@query(with_(MESSAGES) + """
SELECT event_id, key, k, previous_sequence FROM (
  SELECT *, LAG(k) OVER (PARTITION BY key ORDER BY part, off) AS previous_sequence FROM messages)
WHERE k < previous_sequence""")
def ordering_violations(events):
    rows = views.messages(events, offsets=False).select("topic", "part", "key", "event_id", "k")
    return K.ordering_violations(rows, "k", order="event_id").select("event_id", "key", "k", "previous_sequence")


@query(with_(EXECS) + """
SELECT event_id, key, start_us, busy_until_us FROM (
  SELECT *, max(end_us) OVER (PARTITION BY key ORDER BY start_us, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy_until_us FROM execs)
WHERE busy_until_us > start_us""")
def overlap_violations(events):
    return K.overlap_violations(views.executions(events).select("event_id", "key", "start_us", "end_us")).drop("end_us")


@query(with_(MESSAGES) + """
SELECT key, (position - 1) // 25 AS page, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY position) AS messages
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY part, off) AS position FROM messages)
GROUP BY ALL""")
def grouped_messages(events):
    rows = views.messages(events, offsets=False).select("topic", "part", "key", "event_id")
    paged = K.group_messages_by_key(rows, [], order="event_id", page_rows=25, slice_by=by_number("event_id"))
    listed = F.array_join(F.transform("messages", lambda m: m["event_id"].cast("string")), ",")
    return paged.select("key", "page", listed.alias("messages"))
