"""Tables that outlive a run, bounded replays and the client, stopped half-way and resumed."""

from pyspark.sql import functions as F

from keylane.functions.scalars import message_task_id
from keylane.plans import dedups, transport  # noqa: F401
from keylane.plans.base import EXECS, MESSAGES, NOW, SQL, last_us, query, with_
from keylane.plans.keyed import ShopHandler
from keylane.plans.streams import BATCHES
from keylane.session import run_folder, stored
from keylane.sources import views
from keylane.sources.replay import reload_ranges
from keylane.streaming.client import EventClient
from keylane.streaming.tables import Ledger, UpsertTable

DAY_US = 86_400_000_000


def in_two_runs(df, name, start, batches=BATCHES):
    """Write a table in ranges of event_id, a file each; run a bounded stream over the first half, then, from its checkpoint, over all.

    ``start(stream, folder)`` starts a query over the files so far, one a micro-batch. Returns the folder of the run.
    """
    spark = df.sparkSession
    folder = run_folder(spark, name)
    last = df.agg(F.max("event_id")).first()[0] or 0
    share = F.floor(F.col("event_id") * batches / (last + 1))
    for half in (range(batches // 2), range(batches // 2, batches)):
        for number in half:
            df.filter(share == number).coalesce(1).write.mode("append").parquet(f"{folder}/input")
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/input")
        start(stream, folder).awaitTermination()
    return folder


def bounded(writer, folder):
    return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


@query(SQL["upsert_latest"])
def upsert_compacted_stream(events):
    """Upserts in levels of folders that are merged as they fill up, over a restart."""
    spark, order = events.sparkSession, ("ts_us", "event_id")
    rows = views.messages(events, offsets=False).select("key", "event_id", "ts_us", "type")

    def start(stream, folder):
        table = UpsertTable(spark, f"{folder}/table", order=order, fan=2)
        return bounded(stream.writeStream.foreachBatch(table.write), folder)

    return UpsertTable(spark, f"{in_two_runs(rows, 'upserts', start)}/table", order=order).read()


@query(SQL["dedup_ttl"])
def dedup_ledger_stream(events):
    """Dedup against a ledger that each micro-batch extends, over a restart."""
    spark = events.sparkSession
    rows = views.messages(events, offsets=False).select("topic", "event_id", "part", "key", "id", "ts_us")

    def start(stream, folder):
        ledger = Ledger(spark, f"{folder}/ledger", buckets=8)
        return bounded(stream.writeStream.foreachBatch(ledger.batch(f"{folder}/kept", ("part", "event_id"))), folder)

    folder = in_two_runs(rows, "ledger", start)
    return spark.read.schema(rows.schema).parquet(f"{folder}/kept").select("event_id", "part", "key", "id")


@query(with_(MESSAGES, EXECS) + f"""
SELECT x.part, x.off, m.event_id, m.type, m.off IS NULL AS offset_deleted
FROM execs x LEFT JOIN (SELECT * FROM messages WHERE ts_us >= {NOW} - 20 * {DAY_US}) m
  ON x.topic = m.topic AND x.part = m.part AND x.off = m.off
WHERE x.outcome = 'transient' AND x.start_us % (7 * {DAY_US}) < {DAY_US}""")
def offset_reload_ranges(events):
    """Deferred messages of every seventh day, read again from the ranges of the log that hold them."""
    outcomes = views.outcomes(events, offsets=True).withColumn("start_us", F.unix_micros(F.col("ts").cast("timestamp")))
    deferred = outcomes.filter((F.col("outcome") == "transient") & (F.col("start_us") % (7 * DAY_US) < DAY_US)).select("topic", "part", "off")
    now = last_us(events)
    log = stored(views.messages(events).filter(F.col("ts_us") >= now - 20 * DAY_US).select(
        "topic", "part", "off", "event_id", "type").repartitionByRange("part", "off").sortWithinPartitions("part", "off"), "log")
    return reload_ranges(deferred, log, gap=50).select("part", "off", "event_id", "type", "offset_deleted")


@query(with_(MESSAGES) + """
SELECT part, off, CASE WHEN k % 7 = 0 THEN 'permanent' WHEN type IS NULL THEN 'transient' ELSE 'success' END AS outcome,
  CASE WHEN k % 7 = 0 OR type IS NULL THEN 'skip' ELSE 'done' END AS route, k % 7 = 0 OR type IS NULL AS reported,
  CASE WHEN k % 7 = 0 OR type IS NULL THEN 'message.failed' ELSE 'message.succeeded' END AS told
FROM messages WHERE (type IS NULL OR type LIKE 'user.%' OR type LIKE 'account.%') AND (source_system IS NULL OR source_system <> 'shop-svc')""")
def client_stream(events):
    """A client over half of the log, stopped, and resumed from its checkpoint: outcomes, failure records and telemetry it left."""
    spark = events.sparkSession
    client = EventClient(spark, group_id="shop-svc", subscribed_topics="events", allowed_events=["user.", "account."], mode="best_effort",
                         mock=True, idempotence_cache_size=0, watermark_delay=0)
    folder = run_folder(spark, "client")
    records = views.records(events)
    cut = records.agg(((F.unix_micros(F.min("timestamp")) + F.unix_micros(F.max("timestamp"))) / 2).cast("bigint")).first()[0] or 0
    for part in (F.unix_micros("timestamp") <= cut, F.unix_micros("timestamp") > cut):
        records.filter(part).write.mode("append").parquet(f"{folder}/log")
        client.subscribe(ShopHandler, f"{folder}/out", f"{folder}/progress", f"{folder}/log", event_time=True, bounded=True).awaitTermination()
        client.unsubscribe()
    done = spark.read.parquet(f"{folder}/out/outcomes").select("topic", "part", "off", "outcome", "route")
    failed = spark.read.parquet(f"{folder}/out/failures").select("task_id", F.lit(True).alias("failed"))
    told = spark.read.parquet(f"{folder}/out/telemetry").select(F.from_json("value", "event_type string, part int, off bigint").alias("t")).select(
        "t.part", "t.off", F.col("t.event_type").alias("told"))
    named = done.withColumn("task_id", message_task_id(F.col("topic"), F.col("part"), F.col("off")))
    return named.join(failed, "task_id", "left").join(told, ["part", "off"], "left").select(
        "part", "off", "outcome", "route", F.coalesce("failed", F.lit(False)).alias("reported"), "told")
