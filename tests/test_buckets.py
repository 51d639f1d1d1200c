"""Many keys in a call: a bucket gives each key what calls of its own would, with few accesses to Spark's states."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from keylane.handlers import EventHandler
from keylane.options import PipelineOptions
from keylane.streaming import buckets
from keylane.streaming.buckets import Buckets, Keys
from keylane.streaming.dedup import TtlDedup, dedup_stream
from keylane.streaming.processor import KeyedProcessor, process_stream
from keylane.streaming.saga import Steps, state_machine_stream
from tests.test_keyed_state import Clock, Expiry, Handle, State


class Mixed(EventHandler):
    """Sets timers, fails for a while, removes timers."""

    def on_message(self, context, message):
        number = message.off % 7
        if number == 0:
            context.clear_and_schedule(message.timestamp.timestamp() + 5)
        elif number < 4:
            context.schedule(message.timestamp.timestamp() + 3 * number)
        elif number == 4 and (context.now - message.timestamp).total_seconds() < 2:
            raise OSError("not yet")

    def on_timer(self, context, timer):
        pass


def processor(name):
    if name == "handler":
        return ["key"], lambda: KeyedProcessor(Mixed, PipelineOptions(idempotence_ttl=4, monopolization_window=60), True)
    if name == "dedup":
        return ["key", "id"], lambda: TtlDedup(3_000_000, ["ts_us", "off"], ["off"])
    return ["key"], lambda: Steps({("a", "x"): "b", ("b", "y"): "a"}, "a", "off", "id", ["off"])


def drive(make, by, batches, one):
    """Results of micro-batches, and the handle: of a bucket, or of one handle a key."""
    handles, calls, out = {}, {}, []
    for clock, rows in [*batches, (10**9, [])]:
        groups = {}
        for row in rows:
            groups.setdefault(("all",) if one else tuple(row[c] for c in by), []).append(row)
        for name, group in groups.items():
            if name not in calls:
                handles[name] = Handle()
                calls[name] = Buckets(make(), by, "EventTime") if one else make()
                calls[name].init(handles[name])
            out += calls[name].handleInputRows(name, iter(group), Clock(clock))
        for name, call in calls.items():
            timers = handles[name].timers
            while timers and min(timers) <= clock:
                ms = min(timers)
                timers.remove(ms)
                out += call.handleExpiredTimer(name, Clock(clock), Expiry(ms))
    return sorted(map(repr, out)), handles


def messages(seed, n, keys):
    chance, at = random.Random(seed), 0
    rows = []
    for off in range(n):
        at += chance.randrange(900_000)
        rows.append(Row(topic="t", part=0, off=off, key=chance.choice([None, *map(str, range(keys))]), ts_us=at,
                        id=chance.choice(["x", "y", "z"]), payload="{}", took_us=chance.randrange(2_000_000)))
    size = chance.randrange(1, n)
    parts = [rows[i: i + size] for i in range(0, n, size)]
    return [(part[-1]["ts_us"] // 1000, part) for part in parts]


@pytest.mark.parametrize("most", [1, 3, 1024])
@pytest.mark.parametrize("name", ["handler", "dedup", "steps"])
@settings(max_examples=15, deadline=None)
@given(seed=st.integers(0, 10**6))
def test_a_bucket_gives_what_its_keys_give(name, most, seed):
    by, make = processor(name)
    batches = messages(seed, 60, 5)
    before, buckets.MOST_ENTRIES = buckets.MOST_ENTRIES, most
    try:
        one, _ = drive(make, by, batches, True)
    finally:
        buckets.MOST_ENTRIES = before
    assert one == drive(make, by, batches, False)[0]


@pytest.mark.parametrize("name", ["handler", "dedup", "steps"])
def test_a_bucket_costs_the_same_whatever_keys_it_holds(name):
    costs = []
    for keys in (2, 400):
        by, make = processor(name)
        _, handles = drive(make, by, messages(5, 2_000, keys)[:1], True)
        costs.append(handles[("all",)].touched)
    assert max(costs) <= 2 * 2_000 / 100 and costs[0] >= costs[1] - 20


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["put", "drop", "clear", "leave"]), st.integers(0, 9)), max_size=60), st.integers(0, 5))
def test_a_map_that_outgrows_its_bucket_is_the_same_map(operations, most):
    before, buckets.MOST_ENTRIES = buckets.MOST_ENTRIES, most
    try:
        keys = Keys(State())
        held, known = keys.getMapState("m", "n bigint", "v bigint"), {}
        keys.take(("k",))
        for number, (name, entry) in enumerate(operations):
            if name == "put":
                held.updateValue((entry,), (number,))
                known[(entry,)] = (number,)
            elif name == "drop":
                held.removeKey((entry,))
                known.pop((entry,), None)
            elif name == "clear":
                held.clear()
                known = {}
            else:
                keys.leave()
                keys.take(("other",))
                held.updateValue((entry,), (-1,))
                keys.leave()
                keys.take(("k",))
            assert dict(held.iterator()) == known
            assert held.getValue((entry,)) == known.get((entry,))
    finally:
        buckets.MOST_ENTRIES = before


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.fixture(scope="module")
def stream(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("buckets"))
    rows = spark.createDataFrame([Row(**{**messages(1, 2, 2)[0][1][0].asDict(), "key": "k"})]).withColumn("ts", F.timestamp_micros("ts_us"))
    rows.write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).parquet(folder)


def test_the_handler_is_called_by_buckets(stream):
    assert buckets.BUCKET in plan_of(process_stream(stream, Mixed))


def test_keys_that_python_compares_otherwise_are_called_one_by_one(stream):
    doubles = stream.withColumn("key", F.col("took_us").cast("double"))
    assert buckets.BUCKET not in plan_of(process_stream(doubles, Mixed))


def test_ids_are_called_by_buckets(stream):
    assert buckets.BUCKET in plan_of(dedup_stream(stream))


def test_state_machines_are_called_by_buckets(stream):
    assert buckets.BUCKET in plan_of(state_machine_stream(stream, [("a", "x", "b")], "a", event="id"))
