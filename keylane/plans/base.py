"""Registry of queries and the shared pieces of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(events) -> DataFrame`` under its name, with its SQL."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(events_table(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table; its zone-free times are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def last_us(events: DataFrame) -> int:
    """Time of the last event, used as "now": one aggregated row."""
    return events.agg(F.unix_micros(F.max(F.col("ts").cast("timestamp"))).alias("last")).first()["last"]


NOW = "(SELECT max(epoch_us(ts)) FROM events)"

MESSAGES = """
messages AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INT) AS part,
    ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS off,
    CAST(user_id AS VARCHAR) AS key, epoch_us(ts) AS ts_us, event_id, k,
    CASE event_id % 10 WHEN 0 THEN 'shop-svc' WHEN 1 THEN 'billing' END AS source_system,
    CASE event_type WHEN 'click' THEN 'user.click' WHEN 'view' THEN 'user.view'
      WHEN 'signup' THEN 'account.signup' WHEN 'purchase' THEN 'order.user.purchase' END AS type,
    CASE WHEN k % 5 <> 0 THEN concat('msg-', CAST(k AS VARCHAR)) END AS id, value
  FROM (SELECT *, CAST(props->>'$.k' AS INT) AS k FROM events) e)
"""

EXECS = """
execs AS (
  SELECT *, CASE WHEN error_class IS NULL THEN 'success' WHEN error_class = 'ValueError' THEN 'permanent'
    ELSE 'transient' END AS outcome, coalesce(error_class = 'Cancelled', false) AS cancelled
  FROM (
    SELECT 'events' AS topic, event_id, CAST(user_id % 4 AS INT) AS part,
      ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS off,
      CAST(user_id AS VARCHAR) AS key, epoch_us(ts) AS start_us,
      concat('msg-', CAST(CAST(props->>'$.k' AS INT) AS VARCHAR)) AS id,
      CAST(round(value * 1000) AS BIGINT) AS dur_ms,
      epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) * 1000 AS end_us,
      CASE WHEN event_type = 'error' THEN 'failure' ELSE 'normal' END AS demand,
      CAST(event_id % 5 + 1 AS INT) AS attempt,
      CASE WHEN event_type = 'error' THEN 'IOError'
           WHEN event_type = 'signup' AND event_id % 7 = 0 THEN 'ValueError'
           WHEN event_type = 'view' AND event_id % 11 = 0 THEN 'Cancelled' END AS error_class
    FROM events) x)
"""

TIMER_OPS = """
ops AS (
  SELECT *, CASE WHEN op = 'unschedule' THEN LAG(fire_s) OVER (PARTITION BY key ORDER BY seq)
                 WHEN op IN ('schedule', 'clear_and_schedule') THEN fire_s END AS at_s
  FROM (SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq, epoch_us(ts) AS ts_us,
    CASE event_type WHEN 'click' THEN 'schedule' WHEN 'purchase' THEN 'schedule'
      WHEN 'view' THEN 'clear_and_schedule' WHEN 'error' THEN 'unschedule' ELSE 'clear_scheduled' END AS op,
    (epoch_us(ts) + CAST(CAST(props->>'$.k' AS INT) AS BIGINT) * 600000000 + 500000) // 1000000 AS fire_s
  FROM events) o)
"""


def with_(*tables: str) -> str:
    return "WITH " + ",".join(t.strip() for t in tables) + "\n"
