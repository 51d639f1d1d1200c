"""Timers from the operations log."""

from pyspark.sql import functions as F

from keylane.operators import timers as T
from keylane.operators.ordered import even_slices
from keylane.options import PipelineOptions
from keylane.plans.base import NOW, TIMER_OPS, last_us, query, with_
from keylane.sources import views


def _alive(ops: str, due: str) -> str:
    return f"""
SELECT DISTINCT s.key, s.at_s AS fire_s FROM {ops} s
WHERE s.op IN ('schedule', 'clear_and_schedule') AND s.at_s * 1000000 {due} {NOW}
  AND NOT EXISTS (SELECT 1 FROM {ops} c WHERE c.key = s.key AND c.seq > s.seq
    AND c.op IN ('clear_and_schedule', 'clear_scheduled') AND c.ts_us < s.at_s * 1000000)
  AND NOT EXISTS (SELECT 1 FROM {ops} u WHERE u.key = s.key AND u.seq > s.seq
    AND u.op = 'unschedule' AND u.at_s = s.at_s AND u.ts_us < s.at_s * 1000000)"""


def _only(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return with_(TIMER_OPS, f"chosen AS (SELECT * FROM ops WHERE op IN ({listed}))") + _alive("chosen", ">")


def _pending(events, *names):
    return T.pending_timers(T.only_operations(views.timer_ops(events), *names), last_us(events))


@query(_only("schedule"))
def timer_schedule(events):
    """What is pending when only schedules ran."""
    return _pending(events, "schedule")


@query(_only("schedule", "clear_and_schedule"))
def timer_clear_and_schedule(events):
    return _pending(events, "schedule", "clear_and_schedule")


@query(_only("schedule", "unschedule"))
def timer_unschedule(events):
    return _pending(events, "schedule", "unschedule")


@query(_only("schedule", "clear_scheduled"))
def timer_clear_scheduled(events):
    return _pending(events, "schedule", "clear_scheduled")


@query(with_(TIMER_OPS) + f"""
SELECT k.key, coalesce(p.n, 0) AS pending, p.f AS next_fire_s FROM (SELECT DISTINCT key FROM ops) k
LEFT JOIN (SELECT key, count(*) AS n, min(fire_s) AS f FROM ({_alive("ops", ">")}) GROUP BY key) p ON p.key = k.key""")
def timer_scheduled(events):
    return T.scheduled_counts(views.timer_ops(events), last_us(events))


@query(with_(TIMER_OPS) + _alive("ops", "<="))
def timer_firings(events):
    return T.timer_firings(views.timer_ops(events), last_us(events))


@query(with_(TIMER_OPS) + _alive("ops", ">"))
def timer_pending(events):
    return T.pending_timers(views.timer_ops(events), last_us(events))


@query(with_(TIMER_OPS) + f"""
SELECT key, fire_s, fired_us, fired_us - fire_s * 1000000 AS late_us,
  abs(fired_us - fire_s * 1000000) <= 1000000 AS on_time,
  coalesce(lag(fired_us) OVER (PARTITION BY key ORDER BY fire_s) <= fired_us, true) AS in_order
FROM (SELECT key, fire_s, fire_s * 1000000 + (fire_s * 7919) % 1200000 AS fired_us FROM ({_alive("ops", "<=")}))""")
def timer_accuracy(events):
    """Firings with a lateness of up to 1.2 s, checked against 1 s."""
    late = (F.col("fire_s") * 7919) % 1_200_000
    ops = views.timer_ops(events)
    fired = T.timer_firings(ops, last_us(events)).withColumn("fired_us", F.col("fire_s") * 1_000_000 + late)
    return T.timer_accuracy(fired, slices=even_slices(ops, "fire_s"))


@query(with_(TIMER_OPS) + f"""
SELECT fire_s // 3600 AS slab, count(*) AS timers, min(fire_s) AS first_s, max(fire_s) AS last_s
FROM ({_alive("ops", ">")}) GROUP BY ALL""")
def timer_slabs(events):
    """Backlog of the timers that are still pending."""
    return T.timer_slabs(T.pending_timers(views.timer_ops(events), last_us(events)), round(PipelineOptions().slab_size))


_PENDING_BEFORE = """p.key = o.key AND p.seq < o.seq AND p.op IN ('schedule', 'clear_and_schedule') AND p.at_s * 1000000 > o.ts_us
  AND NOT EXISTS (SELECT 1 FROM ops r WHERE r.key = o.key AND r.seq > p.seq AND r.seq < o.seq
    AND (r.op IN ('clear_and_schedule', 'clear_scheduled') OR (r.op = 'unschedule' AND r.at_s = p.at_s)))"""


@query(with_(TIMER_OPS) + f"""
SELECT key, seq, op, CAST(CASE WHEN op = 'schedule' AND n = 0 OR op = 'clear_and_schedule' THEN 1 ELSE 0 END AS INT) AS added,
  CASE WHEN op = 'unschedule' THEN n WHEN op = 'schedule' THEN 0 ELSE n END AS removed
FROM (SELECT key, seq, op, (SELECT count(DISTINCT p.at_s) FROM ops p WHERE {_PENDING_BEFORE}
    AND (o.op IN ('clear_and_schedule', 'clear_scheduled') OR p.at_s = o.at_s)) AS n FROM ops o)""")
def timer_operations(events):
    """What every operation of the whole log added and removed."""
    return T.operation_effects(views.timer_ops(events))
