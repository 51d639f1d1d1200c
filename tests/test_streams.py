"""Streams give the batch result, whatever the batches, and survive a restart."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keylane.handlers import Cancelled, EventHandler, permanent, transient
from keylane.operators import dedup as D
from keylane.operators.health import throughput
from keylane.operators.saga import state_machine
from keylane.operators.timers import timer_firings
from keylane.options import PipelineOptions
from keylane.plans.base import events_table
from keylane.plans.dedups import TRANSITIONS
from keylane.plans.streams import LoggedTimers, SlowTypes
from keylane.sources import views
from keylane.streaming.client import EventClient, run_to_table
from keylane.streaming.dedup import dedup_stream, dedup_within_watermark, read_upserted, upsert_batch
from keylane.streaming.processor import delay_ms, process_stream
from keylane.streaming.saga import state_machine_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_S = 86_400
SCHEMA = ("topic string, part int, off bigint, key string, ts timestamp, ts_us bigint, id string, payload string")


def in_files(df, folder, order, files=4):
    """Write rows as several files, in order of their modification times."""
    cut = df.approxQuantile(order, [i / files for i in range(1, files)], 0.0) if files > 1 else []
    edges = [float("-inf"), *cut, float("inf")]
    for number, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        part = df.filter((F.col(order) > low) & (F.col(order) <= high)).repartition(1)
        part.write.mode("append").parquet(f"{folder}/file={number}")
    return df


def stream_of(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/file=*")


def log(spark, rows):
    """rows: (off, key, second, payload)."""
    df = spark.createDataFrame([("t", 0, o, k, round(s * 1_000_000), None, p) for o, k, s, p in rows],
                               "topic string, part int, off bigint, key string, ts_us bigint, id string, payload string")
    return df.withColumn("ts", F.timestamp_micros("ts_us")).select(
        "topic", "part", "off", "key", "ts", "ts_us", "id", "payload")


def processed(spark, tmp_path, rows, handler, options=None, files=1):
    df = log(spark, rows)
    in_files(df, tmp_path / "in", "off", files)
    stream = stream_of(spark, tmp_path / "in", df.schema)
    return run_to_table(process_stream(stream, handler, options or PipelineOptions(watermark_delay=0)), str(tmp_path / "run"))


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return events_table(spark, sf_dir)


def test_dedup_over_many_batches(spark, tmp_path, events):
    rows = views.messages(events, offsets=False).select("topic", "part", "key", "id", "event_id", "ts", "ts_us")
    in_files(rows, tmp_path / "in", "event_id")
    stream = stream_of(spark, tmp_path / "in", rows.schema)
    got = run_to_table(dedup_stream(stream, 3 * DAY_S, delay_s=600, order=("ts_us", "event_id")), str(tmp_path / "run"))
    expected = D.dedup(rows, 3 * DAY_S, order=("event_id",))
    assert {r[0] for r in got.select("event_id").collect()} == {r[0] for r in expected.select("event_id").collect()}
    assert got.count() == expected.count()


def test_dedup_with_shuffled_files(spark, tmp_path, events):
    """Rows out of order across batches, within the watermark delay."""
    rows = views.messages(events, offsets=False).select("topic", "part", "key", "id", "event_id", "ts", "ts_us")
    in_files(rows.withColumn("turn", (F.col("event_id") * 7919) % 1000), tmp_path / "in", "turn", 3)
    stream = stream_of(spark, tmp_path / "in", rows.schema, files=10)
    got = run_to_table(dedup_stream(stream, 3 * DAY_S, delay_s=31 * DAY_S, order=("ts_us", "event_id")), str(tmp_path / "run"))
    assert got.count() == D.dedup(rows, 3 * DAY_S, order=("event_id",)).count()


def test_best_effort_dedup(spark, tmp_path, events):
    rows = views.messages(events, offsets=False).select("topic", "key", "id", "event_id", "ts")
    in_files(rows, tmp_path / "in", "event_id", 2)
    got = run_to_table(dedup_within_watermark(stream_of(spark, tmp_path / "in", rows.schema), 31 * DAY_S), str(tmp_path / "run"))
    assert got.filter("id is not null").count() == D.distinct_ids(rows).count()
    assert got.filter("id is null").count() == rows.filter("id is null").count()


def test_restart_resumes(spark, tmp_path, events):
    """Stop after some files, add more, resume from the checkpoint."""
    rows = views.messages(events, offsets=False).select("topic", "part", "key", "id", "event_id", "ts", "ts_us")
    first, second = rows.filter("event_id < 500"), rows.filter("event_id >= 500")
    for number, part in enumerate((first, second)):
        in_files(part, tmp_path / "in" / str(number), "event_id", 2)
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in/*/file=*")
        got = run_to_table(dedup_stream(stream, 3 * DAY_S, order=("ts_us", "event_id")), str(tmp_path / "run"))
    expected = D.dedup(rows, 3 * DAY_S, order=("event_id",))
    assert sorted(r[0] for r in got.select("event_id").collect()) == sorted(r[0] for r in expected.select("event_id").collect())


def test_timers_over_many_batches(spark, tmp_path, events):
    ops = views.timer_ops(events)
    rows = ops.select(
        F.lit("t").alias("topic"), F.lit(0).alias("part"), F.col("seq").alias("off"), "key",
        F.timestamp_micros("ts_us").alias("ts"), "ts_us", F.lit(None).cast("string").alias("id"),
        F.to_json(F.struct("op", "at_s")).alias("payload"))
    in_files(rows, tmp_path / "in", "off")
    stream = stream_of(spark, tmp_path / "in", rows.schema)
    results = run_to_table(process_stream(stream, LoggedTimers, PipelineOptions(watermark_delay=60)), str(tmp_path / "run"))
    got = {(r["key"], r["fire_s"]) for r in results.filter("kind = 'timer'").collect()}
    last = ops.agg(F.max("ts_us")).first()[0]
    assert got == {tuple(r) for r in timer_firings(ops, last - 60_000_000).collect()}


class Actions(EventHandler):
    """Timer operations by the name of the action; reports how many remain."""

    def on_message(self, context, message):
        action, now = message.payload["action"], context.now.timestamp()
        if action == "schedule":
            for delay in (30, 60, 90, 90):
                context.schedule(now + delay)
        elif action == "unschedule":
            context.schedule(now + 40)
            context.schedule(now + 80)
            context.unschedule(now + 40)
            context.unschedule(now + 41)
        elif action == "clear_and_schedule":
            context.schedule(now + 50)
            context.schedule(now + 100)
            context.clear_and_schedule(now + 150)
        elif action == "clear_scheduled":
            context.schedule(now + 70)
            context.schedule(now + 140)
            context.clear_scheduled()
        raise LookupError(str(len(context.scheduled())))


def test_context_operations(spark, tmp_path):
    actions = ["schedule", "unschedule", "clear_and_schedule", "clear_scheduled", "nothing"]
    rows = [(i, f"timer-ops-{i}", 1000, f'{{"action": "{a}"}}') for i, a in enumerate(actions)]
    results = processed(spark, tmp_path, rows, Actions, PipelineOptions(mode="best_effort", watermark_delay=0))
    got = {r["off"]: (r["error_message"], r["route"]) for r in results.collect()}
    assert got == {i: (n, "skip") for i, n in enumerate(["3", "1", "1", "0", "0"])}


def test_deferral_keeps_the_order_of_a_key(spark, tmp_path):
    """The failing head is tried after 1 and 2 more seconds; the rest of the key waits."""
    rows = [(0, "a", 100, "{}"), (1, "a", 100.5, '{"type":"x"}'), (2, "b", 101, '{"type":"x"}'), (3, "a", 200, '{"type":"x"}'),
            (4, "c", 300, "{}")]
    results = processed(spark, tmp_path, rows, SlowTypes, files=2)
    a = [(r["off"], r["attempt"], r["outcome"]) for r in results.filter("key = 'a'").orderBy("at_us", "off", "attempt").collect()]
    assert a == [(0, 1, "transient"), (0, 2, "transient"), (0, 3, "success"), (1, 1, "success"), (3, 1, "success")]
    assert [r["route"] for r in results.filter("key = 'c'").collect()] == ["retry"]
    assert results.filter("key = 'b' and route = 'done'").count() == 1


class Impatient(EventHandler):
    def on_message(self, context, message):
        if context.should_cancel():
            raise Cancelled("past the deadline")


def test_deadline(spark, tmp_path):
    options = PipelineOptions(mode="best_effort", timeout=0, watermark_delay=0)
    result = processed(spark, tmp_path, [(0, "a", 1000, "{}")], Impatient, options).first()
    assert (result["outcome"], result["error_class"]) == ("transient", "Cancelled")


def test_saga_over_many_batches(spark, tmp_path, events):
    rows = views.messages(events, offsets=False).select("key", "event_id", "type")
    in_files(rows, tmp_path / "in", "event_id")
    stream = stream_of(spark, tmp_path / "in", rows.schema)
    got = run_to_table(state_machine_stream(stream, TRANSITIONS, "new", order="event_id"), str(tmp_path / "run"))
    expected = state_machine(rows, TRANSITIONS, "new", order="event_id")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


@permanent("on_message", ValueError)
@transient("on_message", OSError)
class Failing(EventHandler):
    def on_message(self, context, message):
        raise (ValueError if message.payload["bad"] else OSError)("no")


@pytest.mark.parametrize("mode, expected", [
    ("low_latency", {(0, 1): ("permanent", "dead_letter"), (1, 1): ("transient", "retry"), (1, 2): ("transient", "retry"),
                     (1, 3): ("transient", "dead_letter")}),
    ("best_effort", {(0, 1): ("permanent", "skip"), (1, 1): ("transient", "skip")}),
])
def test_modes(spark, tmp_path, mode, expected):
    rows = [(0, "a", 1000, '{"bad": true}'), (1, "b", 1000, '{"bad": false}'), (2, "c", 1100, '{"bad": true}')]
    results = processed(spark, tmp_path, rows, Failing, PipelineOptions(mode=mode, watermark_delay=0))
    got = {(r["off"], r["attempt"]): (r["outcome"], r["route"]) for r in results.filter("off < 2").collect()}
    assert got == expected


def test_delays():
    assert [delay_ms(n, 1.0, 86_400.0) for n in (1, 2, 3, 17, 18, 500)] == [1000, 2000, 4000, 65_536_000, 86_400_000, 86_400_000]


class Relay(EventHandler):
    def on_message(self, context, message):
        if message.payload["type"] == "user.bad":
            raise ValueError("bad")

    def on_timer(self, context, timer):
        pass


def test_client_lifecycle(spark, tmp_path):
    assert EventClient(spark).consumer_state == "unconfigured"
    client = EventClient(spark, PipelineOptions(
        group_id="shop", subscribed_topics="orders", allowed_events=["user."], mode="low_latency",
        failure_topic="failed", mock=True, watermark_delay=0))
    assert client.consumer_state == "configured"
    rows = [("orders", 0, 0, "k", '{"type":"user.ok","id":"1"}', []), ("orders", 0, 1, "k", '{"type":"user.ok","id":"1"}', []),
            ("orders", 0, 2, "k", '{"type":"admin.ok"}', []), ("orders", 0, 3, "k", '{"type":"user.bad"}', []),
            ("orders", 0, 4, "k", '{"type":"user.ok"}', [("source-system", bytearray(b"shop"))]),
            ("other", 0, 0, "k", '{"type":"user.ok"}', []), ("orders", 0, 5, "later", '{"type":"user.ok"}', [])]
    records = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string, "
                                          "headers array<struct<key:string,value:binary>>")
    records.withColumn("timestamp", F.timestamp_seconds(F.col("offset") + 1000)).repartition(1).write.parquet(str(tmp_path / "in"))
    sink = str(tmp_path / "out")
    query = client.subscribe(Relay, sink, str(tmp_path / "progress"), str(tmp_path / "in"), event_time=True, bounded=True)
    assert client.consumer_state in ("running", "configured")
    query.awaitTermination(120)
    client.unsubscribe()
    assert client.consumer_state == "configured"
    done = {(r["off"], r["route"]) for r in spark.read.parquet(f"{sink}/outcomes").collect()}
    assert done == {(0, "done"), (3, "retry"), (3, "dead_letter"), (5, "done")}
    letter = spark.read.parquet(f"{sink}/dead_letters").first()
    assert (letter["topic"], letter["key"], letter["value"]) == ("failed", "k", '{"type":"user.bad"}')
    told = {json.loads(r["value"])["event_type"] for r in spark.read.parquet(f"{sink}/telemetry").collect()}
    assert told == {"message.succeeded", "message.failed"}
    failure = spark.read.parquet(f"{sink}/failures").first()
    assert (failure["task_id"], failure["error_class"]) == ("orders/0:3", "ValueError")


def test_client_stops_a_running_stream(spark, tmp_path):
    log(spark, []).write.parquet(str(tmp_path / "in"))
    client = EventClient(spark, group_id="g", subscribed_topics="t", mock=True, commit_interval=0.2)
    with pytest.raises(ValueError):
        EventClient(spark).subscribe(Relay, "x", "y")
    client.subscribe(Relay, str(tmp_path / "out"), str(tmp_path / "progress"), str(tmp_path / "in"))
    assert client.consumer_state == "running"
    with pytest.raises(RuntimeError):
        client.subscribe(Relay, str(tmp_path / "out"), str(tmp_path / "progress"), str(tmp_path / "in"))
    client.unsubscribe()
    assert client.consumer_state == "configured"


def test_upserts_over_many_batches(spark, tmp_path, events):
    rows = views.messages(events, offsets=False).select("key", "event_id", "ts_us", "type")
    in_files(rows, tmp_path / "in", "event_id")
    order = ("ts_us", "event_id")
    query = (stream_of(spark, tmp_path / "in", rows.schema).writeStream
             .foreachBatch(upsert_batch(str(tmp_path / "table"), order=order))
             .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    got = read_upserted(spark, str(tmp_path / "table"), order=order)
    assert sorted(r["event_id"] for r in got.collect()) == sorted(r["event_id"] for r in D.latest_per_key(rows, order=order).collect())


def test_sliding_throughput_stream(spark, tmp_path, events):
    rows = views.outcomes(events).select("ts", "outcome", "event_id")
    in_files(rows, tmp_path / "in", "event_id", 2)
    stream = throughput(stream_of(spark, tmp_path / "in", rows.schema), "1 hour", "30 minutes", delay="5 minutes")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    query.awaitTermination(120)
    expected = throughput(rows, "1 hour", "30 minutes")
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, expected.collect()))


def test_a_stream_of_a_table_keeps_rows_without_an_order(spark):
    from keylane.plans.streams import as_stream

    rows = spark.range(60).selectExpr("id", "if(id % 10 = 0, null, id) as ts_us")
    _, folder = as_stream(rows, "nulls")
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/input").collect()) == list(range(60))
