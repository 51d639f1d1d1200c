"""Deduplication and idempotence."""

from pyspark.sql import functions as F

from keylane.operators import dedup as D
from keylane.operators.filters import filter_allowed_events, filter_own_messages
from keylane.operators.keyed import sequence_per_key
from keylane.operators.ordered import by_number
from keylane.operators.saga import state_machine
from keylane.plans.base import MESSAGES, NOW, last_us, query, with_
from keylane.sources import views
from keylane.sources.messages import to_records

DAY_US = 86_400_000_000
EVENT_ORDER = ("ts_us", "event_id")
SEEN = ("event_id", "part", "key", "id")

TRANSITIONS = [
    ("new", "account.signup", "registered"),
    ("registered", "user.view", "browsing"),
    ("browsing", "user.click", "interested"),
    ("browsing", "user.view", "browsing"),
    ("interested", "order.user.purchase", "bought"),
    ("bought", "user.view", "browsing"),
    ("bought", "account.signup", "new"),
]


@query(with_(MESSAGES) + """
SELECT part, key, off, event_id, type, id, ROW_NUMBER() OVER (PARTITION BY key ORDER BY part, off) AS position
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY topic, key, id ORDER BY part, off) AS rn FROM messages
      WHERE (type IS NULL OR starts_with(type, 'user.') OR starts_with(type, 'account.'))
        AND coalesce(source_system <> 'shop-svc', true))
WHERE id IS NULL OR rn = 1""")
def keyed_chain(events):
    """Type filter, own-message filter, deduplication, position per key."""
    wanted = filter_own_messages(filter_allowed_events(views.messages(events), views.PREFIXES), views.GROUP)
    kept = D.dedup(wanted.select("topic", "part", "off", "key", "event_id", "type", "id"))
    return sequence_per_key(kept).drop("topic")


@query(with_(MESSAGES) + """
SELECT event_id, part, key, id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY topic, key, id ORDER BY part, off) AS rn FROM messages)
WHERE id IS NULL OR rn = 1""")
def dedup_unbounded(events):
    # within a partition the event number has the order of the offset
    rows = views.messages(events, offsets=False).select("topic", *SEEN)
    return D.dedup(rows, order=("part", "event_id")).select(*SEEN)


TTL_TABLES = """
WITH RECURSIVE """ + MESSAGES.strip() + """,
recorded AS (
  SELECT key, id, min(ts_us) AS ts_us FROM messages WHERE id IS NOT NULL GROUP BY key, id
  UNION ALL
  SELECT m.key, m.id, min(m.ts_us) FROM recorded r JOIN messages m
    ON m.key = r.key AND m.id = r.id AND m.ts_us > r.ts_us + 604800000000
  GROUP BY m.key, m.id, r.ts_us),
kept AS (
  SELECT m.* FROM messages m JOIN recorded r ON m.key = r.key AND m.id = r.id AND m.ts_us = r.ts_us
  UNION ALL SELECT * FROM messages WHERE id IS NULL)
"""


@query(TTL_TABLES + "SELECT event_id, part, key, id FROM kept")
def dedup_ttl(events):
    rows = views.messages(events, offsets=False).select("topic", *SEEN, "ts_us")
    return D.dedup(rows, ttl_s=604_800, order=("part", "event_id")).select(*SEEN)


@query(with_(MESSAGES) + """
SELECT event_id, part, key, id FROM (
  SELECT *, LAG(id) OVER (PARTITION BY key ORDER BY part, off) AS before FROM messages)
WHERE id IS NULL OR before IS NULL OR id <> before""")
def dedup_consecutive(events):
    rows = views.messages(events, offsets=False).select("topic", *SEEN)
    return D.dedup_consecutive(rows, order="event_id").select(*SEEN)


@query(with_(MESSAGES) + """
SELECT topic, key, id, count(*) AS copies FROM messages WHERE id IS NOT NULL GROUP BY ALL""")
def dedup_best_effort(events):
    return D.distinct_ids(views.messages(events, offsets=False))


@query(with_(MESSAGES) + f"""
, old AS (SELECT key, id, min(ts_us) AS t FROM messages WHERE id IS NOT NULL AND ts_us < {NOW} - 20 * {DAY_US}
  GROUP BY key, id),
 new AS (SELECT key, id, min(ts_us) AS t FROM messages WHERE id IS NOT NULL
  AND ts_us >= {NOW} - 20 * {DAY_US} AND ts_us < {NOW} - 10 * {DAY_US} GROUP BY key, id)
SELECT event_id, part, key, id FROM messages m WHERE ts_us >= {NOW} - 10 * {DAY_US}
  AND NOT EXISTS (SELECT 1 FROM new WHERE new.key = m.key AND new.id = m.id AND new.t >= {NOW} - 365 * {DAY_US})""")
def dedup_versions(events):
    """Entries recorded under an earlier version no longer count."""
    now = last_us(events)
    rows = views.messages(events, offsets=False).select("topic", *SEEN, "ts_us")
    cuts = F.col("ts_us") >= now - 20 * DAY_US, F.col("ts_us") >= now - 10 * DAY_US
    ledger = D.dedup_ledger(rows.filter(~cuts[0]), "1").unionByName(
        D.dedup_ledger(rows.filter(cuts[0] & ~cuts[1]), "2")
    )
    return D.ledger_filter(rows.filter(cuts[1]), ledger, now, 365 * 86_400, "2").select(*SEEN)


@query(with_(MESSAGES) + f"""
SELECT event_id, part, key, id FROM messages m WHERE ts_us >= {NOW} - 3 * {DAY_US} AND (id IS NULL OR NOT EXISTS (
  SELECT 1 FROM (SELECT key, id, min(ts_us) AS t FROM messages
    WHERE ts_us < {NOW} - 3 * {DAY_US} AND id IS NOT NULL GROUP BY key, id) l
  WHERE l.key = m.key AND l.id = m.id AND l.t >= {NOW} - 7 * {DAY_US}))""")
def dedup_ledger(events):
    """Messages after a restart, against the ledger of what ran before it."""
    now = last_us(events)
    rows = views.messages(events, offsets=False).select("topic", *SEEN, "ts_us")
    restarted = F.col("ts_us") >= now - 3 * DAY_US
    ledger = D.dedup_ledger(rows.filter(~restarted))
    return D.ledger_filter(rows.filter(restarted), ledger, now).select(*SEEN)


@query(with_(MESSAGES) + """
SELECT 'outgoing' AS topic, key, concat('{', CASE WHEN id IS NULL THEN '' ELSE concat('"id":"', id, '",') END,
  '"event_id":', CAST(event_id AS VARCHAR), '}') AS value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY topic, key, id ORDER BY part, off) AS rn FROM messages)
WHERE id IS NULL OR rn = 1""")
def producer_dedup(events):
    rows = views.messages(events, offsets=False).select("topic", *SEEN)
    once = D.producer_dedup(rows, order=("part", "event_id"))
    return to_records(once, "outgoing", "key", F.struct("id", "event_id"), views.GROUP).drop("headers")


@query(with_(MESSAGES) + f"""
SELECT event_id, part, off FROM messages JOIN (
  SELECT part, max(off) AS processed FROM messages WHERE ts_us < {NOW} - part * {DAY_US} AND part < 3 GROUP BY part) p
USING (part) WHERE off > processed
UNION ALL SELECT event_id, part, off FROM messages WHERE part = 3""")
def offset_filter(events):
    """Each partition resumes above its own last offset; one has none yet."""
    now = last_us(events)
    rows = views.messages(events)
    done = rows.filter((F.col("ts_us") < now - F.col("part") * DAY_US) & (F.col("part") < 3))
    return D.offset_filter(rows, D.processed_offsets(done)).select("event_id", "part", "off")


@query(with_(MESSAGES) + """
SELECT key, event_id, ts_us, type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts_us DESC, event_id DESC) AS rn FROM messages) WHERE rn = 1""")
def upsert_latest(events):
    rows = views.messages(events, offsets=False).select("key", "event_id", "ts_us", "type")
    return D.latest_per_key(rows, order=EVENT_ORDER)


def _saga_sql() -> str:
    table = ", ".join(f"('{s}', '{e}', '{t}')" for s, e, t in TRANSITIONS)
    return "WITH RECURSIVE " + MESSAGES.strip() + f""",
steps(state, type, target) AS (VALUES {table}),
m AS (SELECT key, event_id, type, ROW_NUMBER() OVER (PARTITION BY key ORDER BY event_id) AS n FROM messages),
run AS (
  SELECT m.key, m.event_id, m.n, 'new' AS from_state, coalesce(s.target, 'new') AS to_state, s.target IS NOT NULL AS applied
  FROM m LEFT JOIN steps s ON s.state = 'new' AND s.type = m.type WHERE m.n = 1
  UNION ALL
  SELECT m.key, m.event_id, m.n, run.to_state, coalesce(s.target, run.to_state), s.target IS NOT NULL
  FROM run JOIN m ON m.key = run.key AND m.n = run.n + 1
  LEFT JOIN steps s ON s.state = run.to_state AND s.type = m.type)
SELECT key, event_id, from_state, to_state, applied FROM run"""


@query(_saga_sql())
def saga_states(events):
    rows = views.messages(events, offsets=False).select("key", "event_id", "type")
    return state_machine(rows, TRANSITIONS, "new", order="event_id", slice_by=by_number("event_id")).drop("type")
