"""Retries, routes and deferral."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keylane.operators import failures as R
from keylane.options import MODES, PipelineOptions
from keylane.plans.base import EXECS, query, with_
from keylane.sources import views

DEFERRED = """
deferred AS (SELECT topic, part, off, key, attempt, d AS delay_ms, end_us + d * 1000 AS next_retry_us
  FROM (SELECT *, CAST(least(1000 * pow(2, attempt - 1), 86400000) AS BIGINT) AS d FROM execs WHERE outcome = 'transient'))
"""


@query(with_(EXECS) + """
SELECT event_id, attempt, outcome, attempt > 3 AS exhausted,
  CASE WHEN outcome = 'transient' AND attempt <= 3 THEN d END AS delay_ms,
  CASE WHEN outcome = 'transient' AND attempt <= 3 THEN end_us + d * 1000 END AS next_attempt_us
FROM (SELECT *, CAST(least(20 * pow(2, attempt - 1), 300000) AS BIGINT) AS d FROM execs)""")
def retry_plan(events):
    return R.retry_plan(views.outcomes(events)).select(
        "event_id", "attempt", "outcome", "exhausted", "delay_ms", "next_attempt_us"
    )


@query(with_(EXECS) + """
SELECT mode, event_id, outcome, attempt, CASE
  WHEN outcome = 'success' THEN 'done'
  WHEN mode = 'pipeline' AND outcome = 'transient' THEN 'retry'
  WHEN mode = 'low_latency' AND outcome = 'transient' AND attempt <= 3 THEN 'retry'
  WHEN mode = 'low_latency' THEN 'dead_letter'
  ELSE 'skip' END AS route
FROM execs, (VALUES ('pipeline'), ('low_latency'), ('best_effort')) v(mode)""")
def failure_routes(events):
    outcomes = views.outcomes(events).select("event_id", "outcome", "attempt")
    return reduce(DataFrame.unionByName, [R.route(outcomes, m).withColumn("mode", F.lit(m)) for m in MODES])


@query(with_(EXECS, DEFERRED) + "SELECT * FROM deferred")
def defer_plan(events):
    return R.defer_plan(views.outcomes(events, offsets=True))


@query(with_(EXECS, DEFERRED) + """
SELECT topic, part, count(*) AS messages, count(DISTINCT key) AS keys, min(next_retry_us) AS next_retry_us
FROM deferred GROUP BY topic, part""")
def deferred_backlog(events):
    return R.deferred_backlog(R.defer_plan(views.outcomes(events, offsets=True)))


@query(with_(EXECS) + """
SELECT event_id, window_failed, window_all, window_failed / window_all <= 0.5 AS defer_allowed FROM (
  SELECT event_id, CAST(sum(CASE WHEN outcome <> 'success' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS window_failed,
    count(*) OVER w AS window_all
  FROM execs WINDOW w AS (PARTITION BY topic ORDER BY start_us RANGE BETWEEN 1800000000 PRECEDING AND CURRENT ROW))""")
def failure_rate(events):
    options = PipelineOptions(defer_failure_window=1800, defer_failure_threshold=0.5)
    rows = views.outcomes(events).select("topic", "event_id", "start_us", "outcome")
    return R.failure_rate(rows, options).select("event_id", "window_failed", "window_all", "defer_allowed")


@query(with_(EXECS) + """
SELECT topic, window_start_us, messages, failures, failures / messages <= 0.5 AS defer_allowed FROM (
  SELECT topic, window_start_us, count(*) AS messages,
    CAST(sum(CASE WHEN outcome <> 'success' THEN 1 ELSE 0 END) AS BIGINT) AS failures
  FROM (SELECT topic, outcome, (start_us // 600000000 - i) * 600000000 AS window_start_us
        FROM execs, (VALUES (0), (1), (2)) v(i)) GROUP BY ALL)""")
def failure_rate_windows(events):
    options = PipelineOptions(defer_failure_window=1800, defer_failure_threshold=0.5)
    rated = R.windowed_failure_rate(views.outcomes(events), options, slide="10 minutes")
    return rated.select("topic", F.unix_micros("window_start").alias("window_start_us"), "messages", "failures",
                        "defer_allowed")


@query(with_(EXECS) + """
SELECT event_id, dur_ms, start_us + 48000000 AS cancelled_us, 'Cancelled' AS timeout_class,
  'transient' AS timeout_outcome FROM execs WHERE dur_ms > 48000""")
def execution_timeouts(events):
    late = R.execution_timeouts(views.executions(events), PipelineOptions(stall_threshold=60))
    return late.select("event_id", "dur_ms", "cancelled_us", "timeout_class", "timeout_outcome")


@query(with_(EXECS) + """
SELECT key, id, arg_max(outcome, event_id) AS outcome, count(*) AS attempts, min(start_us) AS first_us,
  max(start_us) AS last_us FROM execs GROUP BY key, id""")
def resolution(events):
    return R.resolution(views.outcomes(events), by=("key", "id"))
