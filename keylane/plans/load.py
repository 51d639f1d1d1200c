"""Fairness, concurrency and health."""

from pyspark.sql import functions as F

from keylane.operators import fairness as L
from keylane.operators import health as H
from keylane.options import PipelineOptions
from keylane.plans.base import EXECS, MESSAGES, NOW, last_us, query, with_
from keylane.sources import views

HOUR_US = 3_600_000_000


@query(with_(EXECS) + """
SELECT event_id, demand, key, dur_ms, CAST(coalesce(sum(dur_ms) OVER (PARTITION BY demand, key
  ORDER BY start_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS virtual_ms FROM execs""")
def virtual_time(events):
    rows = views.executions(events).select("event_id", "demand", "key", "start_us", "dur_ms")
    return L.virtual_time(rows).drop("start_us")


@query(with_(EXECS) + """
SELECT demand, spent_ms, round(spent_ms / t, 6) AS share,
  spent_ms / t > CASE WHEN demand = 'failure' THEN 0.3 ELSE 0.7 END AS over_budget
FROM (SELECT demand, CAST(sum(dur_ms) AS BIGINT) AS spent_ms, (SELECT CAST(sum(dur_ms) AS BIGINT) FROM execs) AS t
      FROM execs GROUP BY demand)""")
def class_share(events):
    return L.class_share(views.executions(events))


@query(with_(MESSAGES) + f"""
SELECT event_id, wait_ms, CAST(round(200000.0 * least(wait_ms / 1296000000.0, 1.0) * least(wait_ms / 1296000000.0, 1.0))
  AS BIGINT) AS boost_ms
FROM (SELECT event_id, ({NOW} - ts_us) // 1000 AS wait_ms FROM messages)""")
def wait_boost(events):
    """Half of the log has waited long enough for the full boost."""
    options = PipelineOptions(scheduler_max_wait=15 * 86_400)
    rows = views.messages(events, offsets=False)
    return L.boosted(rows, last_us(events), options).select("event_id", "wait_ms", "boost_ms")


@query(with_(EXECS) + f"""
, queue AS (SELECT demand, key, start_us AS ts_us, event_id FROM execs WHERE start_us >= {NOW} - 24 * {HOUR_US}),
heads AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts_us, event_id) AS rn FROM queue)
  WHERE rn = 1),
vt AS (SELECT demand, key, CAST(sum(dur_ms) AS BIGINT) AS virtual_ms FROM execs WHERE start_us < {NOW} - 24 * {HOUR_US}
  GROUP BY demand, key),
ranked AS (SELECT h.demand, h.key, h.event_id, coalesce(vt.virtual_ms, 0) AS virtual_ms,
    coalesce(vt.virtual_ms, 0) - CAST(round(200000.0 * least((({NOW} - h.ts_us) // 1000) / 86400000.0, 1.0)
      * least((({NOW} - h.ts_us) // 1000) / 86400000.0, 1.0)) AS BIGINT) AS priority_ms, h.ts_us
  FROM heads h LEFT JOIN vt ON vt.demand = h.demand AND vt.key = h.key)
SELECT * EXCLUDE (ts_us) FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY demand
  ORDER BY priority_ms, ts_us, event_id, key) AS INT) AS place FROM ranked) WHERE place <= 32""")
def fair_order(events):
    """The next 32 messages per class of the last day's queue."""
    now = last_us(events)
    waiting = F.col("start_us") >= now - 24 * HOUR_US
    execs = views.executions(events).select("event_id", "demand", "key", "start_us", "dur_ms")
    queue = execs.filter(waiting).select("demand", "key", F.col("start_us").alias("ts_us"), "event_id")
    options = PipelineOptions(scheduler_max_wait=86_400)
    ranked = L.fair_order(queue, execs.filter(~waiting), now, options=options)
    return ranked.select("demand", "key", "event_id", "virtual_ms", "priority_ms", "place")


@query(with_(EXECS) + """
SELECT event_id, key, window_ms, window_ms * 1000 > 270000000 AS rejected,
  CASE WHEN window_ms * 1000 > 270000000 THEN 'transient' ELSE 'accepted' END AS verdict
FROM (SELECT event_id, key, CAST(sum(dur_ms) OVER (PARTITION BY key ORDER BY start_us
  RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW) AS BIGINT) AS window_ms FROM execs)""")
def monopolization(events):
    rows = views.executions(events).select("event_id", "key", "start_us", "dur_ms")
    return L.monopolization(rows).drop("start_us", "dur_ms")


@query(with_(EXECS) + """
SELECT p.event_id, p.key, CAST(sum(greatest(least(e.end_us, p.start_us) - greatest(e.start_us, p.start_us - 300000000), 0))
    AS BIGINT) AS window_us,
  CAST(sum(greatest(least(e.end_us, p.start_us) - greatest(e.start_us, p.start_us - 300000000), 0)) AS BIGINT) > 30000000
    AS rejected,
  CASE WHEN CAST(sum(greatest(least(e.end_us, p.start_us) - greatest(e.start_us, p.start_us - 300000000), 0)) AS BIGINT)
    > 30000000 THEN 'transient' ELSE 'accepted' END AS verdict
FROM execs p JOIN execs e ON e.key = p.key GROUP BY p.event_id, p.key""")
def monopolization_clipped(events):
    rows = views.executions(events).select("event_id", "key", "start_us", "end_us")
    options = PipelineOptions(monopolization_threshold=0.1)
    return L.monopolization_clipped(rows, options).drop("start_us", "end_us")


@query(with_(EXECS) + """
SELECT key, CAST(sum(dur_ms) AS BIGINT) AS spent_ms, count(*) AS executions FROM execs GROUP BY key
ORDER BY spent_ms DESC, key LIMIT 10""")
def hot_keys(events):
    return L.hot_keys(views.executions(events))


IN_FLIGHT = """
SELECT p.part, p.start_us AS at_us, count(e.event_id) AS running FROM execs p LEFT JOIN execs e
  ON e.part = p.part AND e.start_us <= p.start_us AND e.end_us > p.start_us
GROUP BY p.part, p.event_id, p.start_us"""


@query(with_(EXECS) + IN_FLIGHT)
def in_flight(events):
    return H.in_flight(views.executions(events)).drop("topic")


@query(with_(EXECS) + """
SELECT 'events' AS topic, max(running) AS peak, max(running) > 2 AS over_limit FROM (
  SELECT p.event_id, count(e.event_id) AS running FROM execs p LEFT JOIN execs e
    ON e.start_us <= p.start_us AND e.end_us > p.start_us GROUP BY p.event_id)""")
def concurrency_peak(events):
    return H.concurrency_peak(views.executions(events), PipelineOptions(max_concurrency=2))


@query(with_(EXECS) + f"SELECT part, at_us, running, running >= 2 AS paused FROM ({IN_FLIGHT})")
def backpressure(events):
    return H.backpressure(views.executions(events), PipelineOptions(max_uncommitted=2)).drop("topic")


@query(with_(EXECS) + f"""
SELECT topic, part, coalesce(min(CASE WHEN end_us > {NOW} - {HOUR_US} THEN off END) - 1, max(off)) AS frontier,
  max(off) AS last_off FROM execs GROUP BY topic, part""")
def commit_frontier(events):
    """Offsets committed one hour before the end of the log."""
    rows = views.executions(events, offsets=True)
    return H.commit_frontier(rows.withColumn("done", F.col("end_us") <= last_us(events) - HOUR_US))


STALLED = f"""
SELECT 'events' AS topic, part, last_us, {NOW} - last_us AS idle_us, {NOW} - last_us > 300000000 AS stalled
FROM (SELECT part, max(ts_us) AS last_us FROM messages GROUP BY part)"""


@query(with_(MESSAGES) + STALLED)
def stalled_partitions(events):
    return H.stalled_partitions(views.messages(events, offsets=False), last_us(events))


@query(with_(MESSAGES) + f"SELECT bool_or(stalled) AS is_stalled FROM ({STALLED})")
def stall_state(events):
    return H.is_stalled(views.messages(events, offsets=False), last_us(events))


@query(with_(MESSAGES) + """
SELECT part, ts_us, next_us, next_us - ts_us AS gap_us FROM (
  SELECT part, ts_us, lead(ts_us) OVER (PARTITION BY part ORDER BY ts_us, event_id) AS next_us FROM messages)
WHERE next_us - ts_us > 300000000""")
def stall_gaps(events):
    return H.stall_gaps(views.messages(events, offsets=False)).drop("topic")


@query(with_(MESSAGES) + "SELECT count(DISTINCT part) AS assigned, count(DISTINCT part) > 0 AS is_ready FROM messages")
def assigned_partitions(events):
    return H.assigned_partitions(views.messages(events, offsets=False))


THROUGHPUT = """
SELECT window_start_us, count(*) AS messages, CAST(sum(CASE WHEN outcome <> 'success' THEN 1 ELSE 0 END) AS BIGINT)
  AS failures FROM (%s) GROUP BY window_start_us"""
TUMBLING = THROUGHPUT % "SELECT outcome, start_us // 3600000000 * 3600000000 AS window_start_us FROM execs"


def micros(df):
    return df.select(F.unix_micros("window_start").alias("window_start_us"), "messages", "failures")


@query(with_(EXECS) + TUMBLING)
def throughput(events):
    return micros(H.throughput(views.outcomes(events)))


@query(with_(EXECS) + THROUGHPUT % """SELECT outcome, (start_us // 900000000 - i) * 900000000 AS window_start_us
  FROM execs, (VALUES (0), (1), (2), (3)) v(i)""")
def throughput_sliding(events):
    return micros(H.throughput(views.outcomes(events), slide="15 minutes"))
