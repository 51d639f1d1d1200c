"""Sources and sinks."""

from pyspark.sql import functions as F

from keylane.functions.scalars import payload_get
from keylane.operators.failures import route
from keylane.operators.filters import expire
from keylane.plans.base import EXECS, MESSAGES, NOW, TIMER_OPS, last_us, query, with_
from keylane.sources import views
from keylane.sources.messages import decode, header_map, reload, to_records, with_reserved_fields
from keylane.sources.sinks import dead_letters, failure_records, telemetry

DECODED = with_(MESSAGES) + "SELECT topic, part, off, key, ts_us, type, id, k, source_system FROM messages"
DAY_S = 86_400


def decoded(messages):
    """The decoded columns that the SQL form has too."""
    return with_reserved_fields(messages).select(
        "topic", "part", "off", "key", "ts_us", "type", "id",
        payload_get(F.col("payload"), "$.k", "int").alias("k"), "source_system",
    )


@query(DECODED)
def keyed_source(events):
    return decoded(decode(views.records(events)))


@query(with_(MESSAGES, EXECS) + f"""
SELECT x.part, x.off, m.event_id, m.type, m.off IS NULL AS offset_deleted
FROM execs x LEFT JOIN (SELECT * FROM messages WHERE ts_us >= {NOW} - 20 * 86400000000) m
  ON x.topic = m.topic AND x.part = m.part AND x.off = m.off
WHERE x.outcome = 'transient'""")
def offset_reload(events):
    deferred = views.outcomes(events, offsets=True).filter(F.col("outcome") == "transient").select("topic", "part", "off")
    log = expire(views.messages(events), last_us(events), 20 * DAY_S).select("topic", "part", "off", "event_id", "type")
    return reload(deferred, log).select("part", "off", "event_id", "type", "offset_deleted")


@query(with_(MESSAGES) + """
SELECT 'outgoing' AS topic, key, concat('{', CASE WHEN type IS NULL THEN '' ELSE concat('"type":"', type, '",') END,
  CASE WHEN id IS NULL THEN '' ELSE concat('"id":"', id, '",') END,
  '"k":', CAST(k AS VARCHAR), ',"event_id":', CAST(event_id AS VARCHAR), '}') AS value,
  'shop-svc' AS source_system FROM messages""")
def keyed_sink(events):
    records = to_records(
        views.messages(events, offsets=False), "outgoing", "key", F.struct("type", "id", "k", "event_id"), views.GROUP
    )
    return _named_origin(records)


def _named_origin(records):
    origin = F.try_element_at(header_map(F.col("headers")), F.lit("source-system"))
    return records.select("topic", "key", "value", origin.alias("source_system"))


@query(with_(EXECS) + """
SELECT 'failed-messages' AS topic, key, 'shop-svc' AS source_system,
  concat('{"event_id":', CAST(event_id AS VARCHAR), ',"error_class":"', error_class, '"}') AS value
FROM execs WHERE outcome = 'permanent' OR (outcome = 'transient' AND attempt > 3)""")
def dead_letter_sink(events):
    routed = route(views.outcomes(events), "low_latency")
    return _named_origin(
        dead_letters(routed, "failed-messages", views.GROUP, F.struct("event_id", "error_class"))
    )


@query(with_(EXECS, TIMER_OPS) + """
SELECT strftime(make_timestamp(start_us), '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time, 'message.started' AS event_type,
  topic, part, off, key, CAST(NULL AS VARCHAR) AS detail FROM execs
UNION ALL
SELECT strftime(make_timestamp(end_us), '%Y-%m-%dT%H:%M:%S.%gZ'),
  CASE WHEN outcome = 'success' THEN 'message.succeeded' ELSE 'message.failed' END,
  topic, part, off, key, error_class FROM execs
UNION ALL
SELECT strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%gZ'), concat('timer.', op),
  NULL, NULL, NULL, key, CAST(at_s AS VARCHAR) FROM ops""")
def telemetry_events(events):
    return telemetry(views.outcomes(events, offsets=True), views.timer_ops(events))


@query(with_(EXECS) + """
SELECT concat(topic, '/', CAST(part AS VARCHAR), ':', CAST(off AS VARCHAR)) AS task_id, error_class, outcome,
  'message' AS event_type, topic, CAST(part AS VARCHAR) AS "partition", key, CAST(off AS VARCHAR) AS "offset"
FROM execs WHERE outcome <> 'success' AND NOT cancelled""")
def failure_reports(events):
    failed = views.outcomes(events, offsets=True).select(
        "*", F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("string").alias("error_cause")
    )
    return failure_records(failed).select(
        "task_id", "error_class", "outcome", F.col("event_type_tag").alias("event_type"),
        *[F.col(f"context.{c}").alias(c) for c in ("topic", "partition", "key", "offset")],
    )
