"""Filters and scalar functions."""

from pyspark.sql import functions as F

from keylane.functions import scalars as S
from keylane.operators.filters import expire, filter_allowed_events, filter_own_messages, filter_topics
from keylane.options import PipelineOptions
from keylane.plans.base import EXECS, MESSAGES, NOW, TIMER_OPS, last_us, query, with_
from keylane.sources import views

ROW = ("event_id", "part", "key", "type")


@query(with_(MESSAGES) + """
SELECT event_id, part, key, type FROM messages
WHERE type IS NULL OR starts_with(type, 'user.') OR starts_with(type, 'account.')""")
def allowed_events(events):
    return filter_allowed_events(views.messages(events, offsets=False), views.PREFIXES).select(*ROW)


@query(with_(MESSAGES) + """
SELECT event_id, part, key, type, source_system FROM messages
WHERE source_system IS NULL OR source_system <> 'shop-svc'""")
def own_messages(events):
    return filter_own_messages(views.messages(events, offsets=False), views.GROUP).select(*ROW, "source_system")


@query(with_(MESSAGES) + """
SELECT topic, count(*) AS messages FROM (
  SELECT concat('events-', CAST(part AS VARCHAR)) AS topic FROM messages) WHERE topic IN ('events-1', 'events-3')
GROUP BY topic""")
def topic_filter(events):
    rows = views.messages(events, offsets=False).withColumn("topic", F.concat_ws("-", "topic", F.col("part")))
    return filter_topics(rows, ["events-1", "events-3"]).groupBy("topic").agg(F.count("*").alias("messages"))


@query(with_(MESSAGES) + f"""
SELECT event_id, part, key, type FROM messages WHERE ts_us >= {NOW} - 604800000000""")
def expired_rows(events):
    return expire(views.messages(events, offsets=False), last_us(events), 604_800).select(*ROW)


@query(with_(MESSAGES) + """
SELECT event_id, concat(topic, '/', CAST(part AS VARCHAR), ':', CAST(off AS VARCHAR)) AS task_id FROM messages""")
def message_task_ids(events):
    task = S.message_task_id(F.col("topic"), F.col("part"), F.col("off"))
    return views.messages(events).select("event_id", task.alias("task_id"))


@query(with_(TIMER_OPS) + """
SELECT seq, concat('timer/', key, '/', strftime(make_timestamp(at_s * 1000000), '%Y-%m-%dT%H:%M:%SZ')) AS task_id
FROM ops WHERE at_s IS NOT NULL""")
def timer_task_ids(events):
    ops = views.timer_ops(events).filter(F.col("at_s").isNotNull())
    return ops.select("seq", S.timer_task_id(F.col("key"), F.col("at_s")).alias("task_id"))


@query(with_(MESSAGES) + """
SELECT event_id, CASE WHEN whole >= 0 AND rounded <= 4294967295 THEN rounded END AS second,
  NOT (whole >= 0 AND rounded <= 4294967295) AS invalid_time
FROM (SELECT event_id, CAST(floor(moved / 1000000.0) AS BIGINT) AS whole,
        CAST(floor((moved + 500000) / 1000000.0) AS BIGINT) AS rounded
      FROM (SELECT event_id, (ts_us - 1704067200000000) * k - 1000000000000 AS moved FROM messages))""")
def rounded_seconds(events):
    rows = views.messages(events, offsets=False)
    at = (F.col("ts_us") - 1_704_067_200_000_000) * F.col("k") - 1_000_000_000_000
    return rows.select("event_id", S.round_to_second(at).alias("second"), S.invalid_time(at).alias("invalid_time"))


@query("""
SELECT event_id, CAST(props->>'$.k' AS INT) AS k, CAST(NULL AS VARCHAR) AS missing,
  concat('{"k":', props->>'$.k', '}') AS json FROM events""")
def payload_fields(events):
    payload = F.try_parse_json("props")
    return events.select(
        "event_id",
        S.payload_get(payload, "$.k", "int").alias("k"),
        S.payload_get(payload, "$.type").alias("missing"),
        S.payload_to_json(payload).alias("json"),
    )


@query("SELECT event_id, epoch_us(ts) AS ts_us, CAST(ts AS VARCHAR) = CAST(make_timestamp(epoch_us(ts)) AS VARCHAR) "
       "AS same FROM events")
def epoch_micros(events):
    micros = S.epoch_micros(F.col("ts"))
    same = S.from_epoch_micros(micros) == F.col("ts").cast("timestamp")
    return events.select("event_id", micros.alias("ts_us"), same.alias("same"))


@query(with_(EXECS) + """
SELECT event_id, CAST(least(20 * pow(2, attempt - 1), 300000) AS BIGINT) AS retry_ms,
  CAST(least(1000 * pow(2, least(dur_ms, 40)), 86400000) AS BIGINT) AS defer_ms FROM execs""")
def backoff_delays(events):
    return views.executions(events).select(
        "event_id",
        S.backoff_delay(F.col("attempt"), 20, 300_000).alias("retry_ms"),
        S.backoff_delay(F.col("dur_ms") + 1, 1000, 86_400_000).alias("defer_ms"),
    )


@query(with_(EXECS) + "SELECT event_id, dur_ms, dur_ms > 48000 AS timed_out FROM execs")
def handler_timeouts(events):
    options = PipelineOptions(stall_threshold=60)
    late = S.timed_out(F.col("dur_ms"), round(options.handler_timeout * 1000))
    return views.executions(events).select("event_id", "dur_ms", late.alias("timed_out"))
