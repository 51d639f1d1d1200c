import json
import sys
from datetime import datetime, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keylane.handlers import (
    EventHandler, Message, PermanentError, TransientError, attempt, permanent, timer_second, transient,
)
from keylane.operators import keyed as K

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def handler(*decorators, raises=None):
    class Handler(EventHandler):
        def on_message(self, context, message):
            if raises is not None:
                raise raises

    for decorate in decorators:
        Handler = decorate(Handler)
    return Handler()


def outcome(h):
    return attempt(h.on_message, None, None)


def test_errors_know_whether_they_are_permanent():
    assert PermanentError.permanent and not TransientError.permanent


@pytest.mark.parametrize("error, kind", [(ValueError("bad"), "permanent"), (RuntimeError("busy"), "transient"),
                                         (KeyError("other"), "transient")])
def test_listed_types(error, kind):
    h = handler(permanent("on_message", ValueError), transient("on_message", RuntimeError), raises=error)
    got = outcome(h)
    assert (got.outcome, got.error_class) == (kind, type(error).__name__)


def test_message_and_cause_are_kept():
    h = handler(permanent("on_message", ValueError), raises=ValueError("bad"))
    with pytest.raises(PermanentError, match="bad") as caught:
        h.on_message(None, None)
    assert isinstance(caught.value.__cause__, ValueError)


def test_unlisted_errors_pass_through():
    with pytest.raises(KeyError):
        handler(permanent("on_message", ValueError), raises=KeyError("x")).on_message(None, None)


def test_the_later_declaration_is_outermost():
    h = handler(permanent("on_message", ValueError), transient("on_message", Exception), raises=ValueError("x"))
    assert outcome(h).outcome == "transient"


def test_bad_declarations():
    with pytest.raises(ValueError):
        permanent("on_message")
    with pytest.raises(NameError):
        handler(transient("on_nothing", ValueError))


def test_success_and_missing_methods():
    assert outcome(handler()).outcome == "success"
    with pytest.raises(NotImplementedError):
        EventHandler().on_message(None, None)
    with pytest.raises(NotImplementedError):
        EventHandler().on_timer(None, None)


def test_a_payload_that_is_not_json_fails_in_the_handler():
    class Reads(EventHandler):
        def on_message(self, context, message):
            return message.payload["n"]

    h = permanent("on_message", ValueError)(Reads)()
    assert attempt(h.on_message, None, Message("t", 0, 0, "k", 0, "{broken")).outcome == "permanent"
    message = Message("t", 0, 0, "k", 1_500_000, '{"n": [1]}')
    assert message.payload is message.payload and message.timestamp.microsecond == 500_000
    assert Message("t", 0, 0, "k", 0, None).payload is None


def test_timer_second():
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert timer_second(at.replace(microsecond=499_999)) == int(at.timestamp())
    assert timer_second(at.replace(microsecond=500_000)) == int(at.timestamp()) + 1
    assert timer_second(10.5) == 11
    for bad in (-1, 2**32 - 0.5, datetime(1969, 12, 31, 23, 59, 59, tzinfo=timezone.utc)):
        with pytest.raises(ValueError):
            timer_second(bad)


ORDERED = [("key1", 1), ("key2", 1), ("key1", 2), ("key3", 1), ("key2", 2)]


@pytest.fixture(scope="module")
def ordered(spark):
    rows = [("t", i % 1, i, key, i, seq) for i, (key, seq) in enumerate(ORDERED)]
    return spark.createDataFrame(rows, "topic string, part int, off bigint, key string, ts_us bigint, sequence int")


class Recorder(EventHandler):
    """Reports what it saw before, to prove the order of calls."""

    def __init__(self):
        self.seen = []

    def on_message(self, context, message):
        before = [s for k, s in self.seen if k == message.key]
        self.seen.append((message.key, message.payload["sequence"]))
        if before:
            raise RuntimeError(f"after {before}")


def test_calls_are_in_order_per_key(ordered):
    df = ordered.withColumn("payload", F.to_json(F.struct("sequence"))).repartition(3)
    got = {(r["key"], r["off"]): r["error_message"] for r in K.process(df, Recorder).collect()}
    assert got == {("key1", 0): None, ("key1", 2): "after [1]", ("key2", 1): None, ("key2", 4): "after [1]",
                   ("key3", 3): None}


def test_sequence_and_violations(ordered):
    placed = {r["off"]: r["position"] for r in K.sequence_per_key(ordered).collect()}
    assert placed == {0: 1, 1: 1, 2: 2, 3: 1, 4: 2}
    assert K.ordering_violations(ordered, "sequence").count() == 0
    turned = ordered.withColumn("sequence", -F.col("sequence"))
    assert K.ordering_violations(turned, "sequence").count() == 2


def test_pages_hold_every_message(ordered):
    paged = K.group_messages_by_key(ordered, ["sequence"], page_rows=1)
    assert paged.count() == 5
    whole = {r["key"]: [m["sequence"] for m in r["messages"]] for r in K.group_messages_by_key(ordered, ["sequence"]).collect()}
    assert whole == {"key1": [1, 2], "key2": [1, 2], "key3": [1]}


def test_first_result_wins(spark):
    df = spark.createDataFrame([("a", 2, "success"), ("a", 1, "transient"), ("b", 3, "success")],
                               "task_id string, completed_us bigint, outcome string")
    assert {r["task_id"]: r["outcome"] for r in K.result_once(df).collect()} == {"a": "transient", "b": "success"}


def test_touching_executions_do_not_overlap(spark):
    df = spark.createDataFrame([(1, "a", 0, 10), (2, "a", 10, 20), (3, "a", 19, 30), (4, "b", 5, 6)],
                               "event_id bigint, key string, start_us bigint, end_us bigint")
    assert [r["event_id"] for r in K.overlap_violations(df).collect()] == [3]


def test_a_replay_fires_timers_in_message_time(spark):
    class Twice(EventHandler):
        def on_message(self, context, message):
            if message.payload["set"]:
                context.schedule(message.payload["set"])

        def on_timer(self, context, timer):
            if timer.time.timestamp() == 5:
                context.schedule(7)

    rows = [("t", 0, i, "k", at * 1_000_000, json.dumps({"set": s})) for i, (at, s) in enumerate([(1, 5), (6, 100), (9, None)])]
    frame = spark.createDataFrame(rows, "topic string, part int, off long, key string, ts_us long, payload string")
    got = [(r["off"], r["fire_s"]) for r in K.process(frame, Twice, until_us=50_000_000).collect()]
    assert got == [(0, None), (None, 5), (1, None), (None, 7), (2, None)]


def test_timers_of_rows_handled_where_they_are_fail_the_job(spark):
    class Sets(EventHandler):
        def on_message(self, context, message):
            context.schedule(5)

    frame = spark.createDataFrame([("t", 0, 0, "k", 0, "{}")], "topic string, part int, off long, key string, ts_us long, payload string")
    with pytest.raises(Exception, match="replay them in order"):
        K.process(frame, Sets, independent=True).collect()
