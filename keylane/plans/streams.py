"""The same operators run as streams; each result must equal its batch form."""

from pyspark.sql import functions as F

from keylane.handlers import EventHandler
from keylane.operators.health import stalled_partitions, throughput
from keylane.operators.keyed import process
from keylane.options import PipelineOptions
from keylane.plans import timing, transport  # noqa: F401
from keylane.plans.base import EXECS, MESSAGES, NOW, SQL, last_us, query, with_
from keylane.plans.dedups import TRANSITIONS, TTL_TABLES
from keylane.plans.keyed import ShopHandler
from keylane.plans.load import TUMBLING, micros
from keylane.session import run_folder
from keylane.sources import views
from keylane.sources.messages import read_messages
from keylane.streaming.cache import dedup_cached
from keylane.streaming.client import run_to_table
from keylane.streaming.dedup import dedup_stream, dedup_within_watermark, read_upserted, upsert_batch
from keylane.streaming.gate import FailureGate
from keylane.streaming.processor import RESULT, process_stream
from keylane.streaming.saga import state_machine_stream
from keylane.streaming.stalls import stall_transitions


BATCHES = 6
#: Files of a micro-batch: so many tasks write it.
FILES = 4


def as_stream(df, name, order="ts_us"):
    """Write a table to the shared folder in ranges of a column, nulls first, and stream them, a range a micro-batch."""
    spark = df.sparkSession
    shares = [i / BATCHES for i in range(1, BATCHES)]
    cuts = sorted(set(df.approxQuantile(order, shares, 0.01)))
    low, parts = None, []
    for high in [*cuts, None]:
        above = F.lit(True) if low is None else F.col(order) > low
        parts.append(df.filter(above if high is None else above & ((F.col(order) <= high) | F.col(order).isNull())))
        low = high
    return in_batches(spark, parts, name)


def in_batches(spark, parts, name, files=FILES):
    """A stream of tables of one schema, one a micro-batch, and the folder of the run. A table that fills fewer files than others shares a batch."""
    folder = run_folder(spark, name)
    # written one after the other: the source takes files by age
    for part in parts:
        part.repartition(files).write.mode("append").parquet(f"{folder}/input")
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/input")
    return stream, folder


@query(SQL["keyed_source"])
def keyed_source_stream(events):
    spark = events.sparkSession
    folder = run_folder(spark, "source")
    views.records(events).write.parquet(f"{folder}/input")
    return run_to_table(transport.decoded(read_messages(spark, f"{folder}/input")), folder)


@query(SQL["dedup_ttl"])
def dedup_ttl_stream(events):
    rows = views.messages(events, offsets=False).select("topic", "part", "key", "id", "event_id", "ts", "ts_us")
    stream, folder = as_stream(rows, "dedup")
    kept = dedup_stream(stream, delay_s=31 * 86_400, order=("ts_us", "event_id"))
    return run_to_table(kept, folder).select("event_id", "part", "key", "id")


@query(SQL["upsert_latest"])
def upsert_latest_stream(events):
    order = ("ts_us", "event_id")
    rows = views.messages(events, offsets=False).select("key", "event_id", "ts_us", "type")
    stream, folder = as_stream(rows, "upsert")
    query = (
        stream.writeStream.foreachBatch(upsert_batch(f"{folder}/table", order=order))
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return read_upserted(events.sparkSession, f"{folder}/table", order=order)


@query(with_(EXECS) + TUMBLING)
def throughput_stream(events):
    """Window counts kept up by a stream, as the last state of each window."""
    spark = events.sparkSession
    stream, folder = as_stream(views.outcomes(events).select("ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "outcome"), "throughput")
    counted = micros(throughput(stream, delay="10 minutes"))
    order = ("batch_id",)

    def write(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{folder}/table/batch={batch_id}")

    query = (
        counted.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return read_upserted(spark, f"{folder}/table", ("window_start_us",), order).drop("batch_id")


@query(SQL["saga_states"])
def saga_states_stream(events):
    rows = views.messages(events, offsets=False).select("key", "event_id", "type")
    stream, folder = as_stream(rows, "saga", "event_id")
    return run_to_table(state_machine_stream(stream, TRANSITIONS, "new", order="event_id"), folder).drop("type")


@query(SQL["stalled_partitions"])
def stalled_partitions_stream(events):
    """Each micro-batch leaves the last message per partition; the check reads those."""
    rows = views.messages(events, offsets=False).select("topic", "part", "ts_us")
    stream, folder = as_stream(rows, "stalls")
    by, order = ("topic", "part"), ("ts_us",)
    query = (
        stream.writeStream.foreachBatch(upsert_batch(f"{folder}/table", by, order))
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    progress = read_upserted(events.sparkSession, f"{folder}/table", by, order)
    return stalled_partitions(progress, last_us(events))


class LoggedTimers(EventHandler):
    """Runs the timer operations a message names."""

    def on_message(self, context, message):
        op = message.payload["op"]
        if op == "clear_scheduled":
            context.clear_scheduled()
        elif "at_s" in message.payload:
            getattr(context, op)(message.payload["at_s"])

    def on_timer(self, context, timer):
        pass


def _operations(events):
    return views.timer_ops(events).select(
        F.lit(views.TOPIC).alias("topic"), F.lit(0).alias("part"), F.col("seq").alias("off"), "key",
        F.timestamp_micros("ts_us").alias("ts"), "ts_us", F.lit(None).cast("string").alias("id"),
        F.to_json(F.struct("op", "at_s")).alias("payload"),
    )


@query(SQL["timer_firings"])
def timer_firings_replay(events):
    """Timers set, replaced and removed by a handler in batch, fired by the messages' time."""
    results = process(_operations(events), LoggedTimers, until_us=last_us(events))
    return results.filter(F.col("fire_s").isNotNull()).select("key", "fire_s")


@query(SQL["timer_firings"])
def timer_firings_stream(events):
    """Timers set, replaced and removed by a handler, fired by event time."""
    stream, folder = as_stream(_operations(events), "timers")
    # the log comes in order of time, so nothing can come late
    results = process_stream(stream, LoggedTimers, PipelineOptions(watermark_delay=0))
    fired = run_to_table(results, folder).filter(F.col("kind") == "timer")
    return fired.select("key", "fire_s")


def attempts_sql(tables, rows, fails, base_ms, most=None):
    """All attempts of the rows of a table, one key's after the other: a failing one is tried again after a doubled
    delay, up to ``most`` times, and what is behind it waits. ``fails`` speaks of the row ``q`` and the time ``t.at_us``."""
    again = "failed" if most is None else f"failed AND tries < {most}"
    retry_ms = f"(t.at_us // 1000 + {base_ms} * CAST(2 ** (t.tries - 1) AS BIGINT))"
    return f"""{tables},
queued AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_id) AS i FROM {rows}),
tried AS (
  SELECT key, CAST(1 AS BIGINT) AS i, 1 AS tries, ts_us AS at_us FROM queued WHERE i = 1
  UNION ALL
  SELECT key, CASE WHEN {again} THEN i ELSE i + 1 END, CASE WHEN {again} THEN tries + 1 ELSE 1 END,
    CASE WHEN {again} THEN retry_us ELSE greatest(at_us, next_us) END
  FROM (SELECT t.*, {fails} AS failed, n.ts_us AS next_us,
      ({retry_ms} + CASE WHEN {retry_ms} % 1000 = 0 THEN 1 ELSE 0 END) * 1000 AS retry_us
    FROM tried t JOIN queued q ON q.key = t.key AND q.i = t.i LEFT JOIN queued n ON n.key = t.key AND n.i = t.i + 1)
  WHERE CASE WHEN {again} THEN retry_us <= {NOW} ELSE next_us IS NOT NULL END)"""


@query(attempts_sql(TTL_TABLES, "kept", "q.type IS NULL AND q.k % 7 <> 0", 20, 3) + """
SELECT q.event_id, t.tries AS attempt, t.at_us,
  CASE WHEN k % 7 = 0 THEN 'permanent' WHEN type IS NULL THEN 'transient' ELSE 'success' END AS outcome,
  CASE WHEN k % 7 = 0 OR (type IS NULL AND t.tries = 3) THEN 'dead_letter' WHEN type IS NULL THEN 'retry' ELSE 'done' END AS route
FROM tried t JOIN queued q ON q.key = t.key AND q.i = t.i""")
def handler_calls_stream(events):
    """Dedup, handler and paced retries in one stateful operator, in low-latency mode: when every attempt ran, and what became of it."""
    rows = views.messages(events, offsets=False).select(
        "topic", "part", F.col("event_id").alias("off"), "key", "ts", "ts_us", "id",
        F.to_json(F.struct("type", "id", "k")).alias("payload"),
    )
    stream, folder = as_stream(rows, "handler")
    options = PipelineOptions(mode="low_latency", watermark_delay=0)
    results = run_to_table(process_stream(stream, ShopHandler, options), folder)
    return results.select(F.col("off").alias("event_id"), "attempt", "at_us", "outcome", "route")


@query(with_(MESSAGES) + """
SELECT 'events' AS topic, key, id FROM messages WHERE id IS NOT NULL GROUP BY key, id""")
def dedup_watermark_stream(events):
    """Best-effort dedup with a watermark longer than the log: one message per id is kept, whichever came first."""
    rows = views.messages(events, offsets=False).select("topic", "key", "id", "ts", "ts_us")
    stream, folder = as_stream(rows, "best-effort")
    kept = run_to_table(dedup_within_watermark(stream, 31 * 86_400), folder)
    return kept.filter(F.col("id").isNotNull()).select("topic", "key", "id")


class TwoTopics(EventHandler):
    def on_message(self, context, message):
        pass


@query(with_(MESSAGES) + """
SELECT 'first' AS topic, key, id FROM messages WHERE id IS NOT NULL GROUP BY key, id
UNION ALL SELECT 'second', key, id FROM messages WHERE id IS NOT NULL AND event_id % 2 = 0 GROUP BY key, id""")
def two_topics_stream(events):
    """An id is remembered under its topic: the second topic's copies of the first one's messages are handled too."""
    rows = views.messages(events, offsets=False).filter(F.col("id").isNotNull()).select(
        "part", F.col("event_id").alias("off"), "key", "ts", "ts_us", "id", F.to_json(F.struct("k")).alias("payload"))
    both = rows.withColumn("topic", F.lit("first")).unionByName(rows.filter("off % 2 = 0").withColumn("topic", F.lit("second")))
    stream, folder = as_stream(both, "topics")
    options = PipelineOptions(watermark_delay=0, idempotence_ttl=31 * 86_400)
    done = run_to_table(process_stream(stream, TwoTopics, options), folder)
    return done.join(rows.select("off", "id"), "off").select("topic", "key", "id")


class SlowTypes(EventHandler):
    """A message without a type only succeeds three seconds after it was sent."""

    def on_message(self, context, message):
        if "type" not in message.payload and (context.now - message.timestamp).total_seconds() < 3:
            raise OSError("no type yet")


DEFERRED = attempts_sql("WITH RECURSIVE" + with_(MESSAGES).removeprefix("WITH"), "messages",
                        "q.type IS NULL AND t.at_us - q.ts_us < 3000000", 1000) + """
SELECT q.event_id, q.key, max(t.tries) AS attempts, max(t.at_us) AS last_us,
  CASE WHEN q.type IS NULL AND max(t.at_us) - q.ts_us < 3000000 THEN 'transient' ELSE 'success' END AS outcome
FROM tried t JOIN queued q ON q.key = t.key AND q.i = t.i GROUP BY q.event_id, q.key, q.type, q.ts_us"""


@query(DEFERRED)
def deferral_stream(events):
    """Deferred retries per message: tries, and when the last one ran."""
    rows = views.messages(events, offsets=False).select(
        "topic", "part", F.col("event_id").alias("off"), "key", "ts", "ts_us", F.lit(None).cast("string").alias("id"),
        F.to_json(F.struct("type", "id", "k")).alias("payload"),
    )
    stream, folder = as_stream(rows, "deferral")
    results = run_to_table(process_stream(stream, SlowTypes, PipelineOptions(watermark_delay=0)), folder)
    return results.groupBy(F.col("off").alias("event_id"), "key").agg(
        F.max("attempt").alias("attempts"),
        F.max_by("outcome", "attempt").alias("outcome"),
        F.max("at_us").alias("last_us"),
    )


class Marked(EventHandler):
    """A marked message fails until ten milliseconds after it was sent."""

    def on_message(self, context, message):
        if message.payload["fails"] and (context.now - message.timestamp).total_seconds() < 0.01:
            raise OSError("not yet")


@query(with_(MESSAGES) + f"""
, cut AS (SELECT *, event_id * 6 // (SELECT max(event_id) + 1 FROM events) AS batch FROM messages),
marked AS (SELECT *, batch % 2 = 0 OR type IS NULL AS fails FROM cut),
newest AS (SELECT batch, max(ts_us // 1000000) AS second FROM marked GROUP BY batch),
rates AS (SELECT n.batch, count(*) AS messages, sum(CASE WHEN fails THEN 1 ELSE 0 END) AS failed
  FROM newest n JOIN marked m ON m.batch <= n.batch AND m.ts_us // 1000000 > n.second - 86400 GROUP BY n.batch),
gated AS (SELECT m.*, coalesce(r.failed / r.messages > 0.9, false) AS closed FROM marked m LEFT JOIN rates r ON r.batch = m.batch - 1),
again AS (SELECT *, ts_us // 1000 + CASE WHEN closed THEN 20 ELSE 1000 END AS ms FROM gated WHERE fails)
SELECT event_id, 1 AS attempt, ts_us AS at_us, CASE WHEN fails THEN 'transient' ELSE 'success' END AS outcome FROM gated
UNION ALL
SELECT event_id, 2, (ms + CASE WHEN ms % 1000 = 0 THEN 1 ELSE 0 END) * 1000, 'success' FROM again
WHERE (ms + CASE WHEN ms % 1000 = 0 THEN 1 ELSE 0 END) * 1000 <= {NOW}""")
def deferral_gate_stream(events):
    """Retries are deferred by a second, or follow at the short pace in a micro-batch before which the topic failed too often."""
    last = events.agg(F.max("event_id")).first()[0]
    batch = F.floor(F.col("event_id") * BATCHES / ((last or 0) + 1))
    rows = views.messages(events, offsets=False).withColumn("batch", batch).select(
        "topic", "part", F.col("event_id").alias("off"), F.col("event_id").cast("string").alias("key"), "ts", "ts_us",
        F.lit(None).cast("string").alias("id"),
        F.to_json(F.struct(((F.col("batch") % 2 == 0) | F.col("type").isNull()).alias("fails"))).alias("payload"), "batch")
    # one file a micro-batch, as the check counts on where each ends
    stream, folder = in_batches(events.sparkSession, [rows.filter(F.col("batch") == b).drop("batch") for b in range(BATCHES)], "gate", 1)
    options = PipelineOptions(watermark_delay=0, defer_failure_window=86_400, monopolization_enabled=False)
    gate = FailureGate(f"{folder}/gate", options)
    gate.resume(events.sparkSession, f"{folder}/checkpoint")

    def write(results, batch_id):
        results.write.mode("overwrite").parquet(f"{folder}/table/batch={batch_id}")
        gate.update(events.sparkSession.read.schema(RESULT).parquet(f"{folder}/table/batch={batch_id}"), batch_id)

    query = (
        process_stream(stream, Marked, options).writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    done = events.sparkSession.read.schema(RESULT).parquet(f"{folder}/table")
    return done.select(F.col("off").alias("event_id"), "attempt", "at_us", "outcome")


class Quiet(EventHandler):
    def on_message(self, context, message):
        pass


#: The window is a day of 300 parts of 288 seconds; a key may use 0.002 of it, 172.8 seconds.
RATIONED = "WITH RECURSIVE" + with_(EXECS).removeprefix("WITH") + f""",
queued AS (SELECT key, event_id, start_us AS ts_us, dur_ms * 1000 AS us, row_number() OVER (PARTITION BY key ORDER BY event_id) AS i FROM execs),
tried AS (
  SELECT key, CAST(1 AS BIGINT) AS i, 1 AS tries, ts_us AS at_us, [{{'slot': CAST(0 AS BIGINT), 'us': CAST(0 AS BIGINT)}}] AS used, false AS failed
    FROM queued WHERE i = 0
  UNION ALL
  SELECT key, i, 1, ts_us, [{{'slot': ts_us // 288000000, 'us': us}}], false FROM queued WHERE i = 1
  UNION ALL
  SELECT key, i, tries, at_us, CASE WHEN over THEN used ELSE list_append(list_filter(used, lambda x: x.slot > at_us // 288000000 - 300),
      {{'slot': at_us // 288000000, 'us': us}}) END, over
  FROM (SELECT s.*, coalesce(list_sum(list_transform(list_filter(s.used, lambda x: x.slot > s.at_us // 288000000 - 300), lambda x: x.us)), 0) > 172800000 AS over
    FROM (SELECT t.key, q.i, q.us, CASE WHEN t.failed THEN t.tries + 1 ELSE 1 END AS tries, t.used,
        CASE WHEN t.failed THEN (t.ms + CASE WHEN t.ms % 1000 = 0 THEN 1 ELSE 0 END) * 1000 ELSE greatest(t.at_us, q.ts_us) END AS at_us
      FROM (SELECT *, at_us // 1000 + 1000 * CAST(2 ** (tries - 1) AS BIGINT) AS ms FROM tried) t
      JOIN queued q ON q.key = t.key AND q.i = CASE WHEN t.failed THEN t.i ELSE t.i + 1 END) s
    WHERE s.tries = 1 OR s.at_us <= {NOW}))
SELECT q.event_id, t.tries AS attempt, t.at_us, CASE WHEN t.failed THEN 'transient' ELSE 'success' END AS outcome,
  CASE WHEN t.failed THEN 'Monopolized' END AS error_class
FROM tried t JOIN queued q ON q.key = t.key AND q.i = t.i"""


@query(RATIONED)
def monopolization_stream(events):
    """A key that used more than its share of the rolling window is turned away, and tried again later, with the rest of the key behind."""
    rows = views.executions(events).select(
        "topic", "part", F.col("event_id").alias("off"), "key", F.timestamp_micros("start_us").alias("ts"), F.col("start_us").alias("ts_us"),
        F.lit(None).cast("string").alias("id"), F.lit("{}").alias("payload"), (F.col("dur_ms") * 1000).alias("took_us"))
    stream, folder = as_stream(rows, "rationed")
    options = PipelineOptions(watermark_delay=0, monopolization_window=86_400, monopolization_threshold=0.002)
    results = run_to_table(process_stream(stream, Quiet, options, took="took_us"), folder)
    return results.select(F.col("off").alias("event_id"), "attempt", "at_us", "outcome", "error_class")


@query(with_(MESSAGES) + f"""
, gaps AS (SELECT topic, part, ts_us, lead(ts_us) OVER (PARTITION BY topic, part ORDER BY ts_us, event_id) AS next_us FROM messages)
SELECT topic, part, 'stalled' AS state, ts_us + 900000001 AS at_us, ts_us AS since_us FROM gaps
WHERE next_us - ts_us > 900000000 OR (next_us IS NULL AND (ts_us + 900000000) // 1000 + 1 <= {NOW} // 1000)
UNION ALL SELECT topic, part, 'recovered', next_us, ts_us FROM gaps WHERE next_us - ts_us > 900000000""")
def stall_transitions_stream(events):
    """When each partition stalled and recovered, told by a timer of the partition."""
    rows = views.messages(events, offsets=False).select("topic", "part", "ts", "ts_us")
    stream, folder = as_stream(rows, "stall-transitions")
    return run_to_table(stall_transitions(stream, PipelineOptions(stall_threshold=900, watermark_delay=0)), folder)


@query(with_(MESSAGES) + """
, seen AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY event_id) AS pos FROM messages WHERE id IS NOT NULL),
near AS (SELECT *, lag(pos) OVER (PARTITION BY part, key, id ORDER BY pos) AS before, lead(pos) OVER (PARTITION BY part, key, id ORDER BY pos) AS next FROM seen),
between_ AS (SELECT n.event_id, count(o.event_id) AS others FROM near n LEFT JOIN near o
  ON o.part = n.part AND o.pos > n.before AND o.pos < n.pos AND (o.next IS NULL OR o.next > n.pos) GROUP BY n.event_id)
SELECT n.event_id, part, key, id FROM near n JOIN between_ b ON b.event_id = n.event_id WHERE before IS NULL OR others >= 200
UNION ALL SELECT event_id, part, key, id FROM messages WHERE id IS NULL""")
def dedup_cache_stream(events):
    """A cache of 200 names a partition: a name is known as long as fewer others were seen since."""
    rows = views.messages(events, offsets=False).select("topic", "part", "event_id", "key", "id")
    stream, folder = as_stream(rows, "cache", "event_id")
    return run_to_table(dedup_cached(stream, 200, order=("event_id",)), folder).select("event_id", "part", "key", "id")
