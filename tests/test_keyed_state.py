"""What the stateful operators do to a key's state, on states held in memory: orders, boundaries and flat costs."""

import random
from collections import OrderedDict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keylane.handlers import EventHandler
from keylane.options import PipelineOptions
from keylane.streaming import gate as gates
from keylane.streaming.cache import RecentNames
from keylane.streaming.dedup import TtlDedup
from keylane.streaming.instants import Instants
from keylane.streaming.processor import SLOTS, KeyedProcessor
from keylane.streaming.stalls import StallDetector


class State:
    """A value or map state that counts what is read and written."""

    def __init__(self):
        self.value, self.map, self.touched = None, {}, 0

    def get(self):
        self.touched += 1
        return self.value

    def update(self, value):
        self.touched += 1
        self.value = value

    def clear(self):
        self.touched += 1
        self.value, self.map = None, {}

    def getValue(self, name):
        self.touched += 1
        return self.map.get(tuple(name))

    def updateValue(self, name, value):
        self.touched += 1
        self.map[tuple(name)] = value

    def removeKey(self, name):
        self.touched += 1
        self.map.pop(tuple(name), None)

    def iterator(self):
        self.touched += len(self.map)
        return iter(list(self.map.items()))


class Handle:
    """States by name and at most one timer; timers cannot be listed."""

    def __init__(self):
        self.states, self.timers = {}, set()

    def _state(self, name, *_):
        return self.states.setdefault(name, State())

    getValueState = getMapState = _state

    def registerTimer(self, ms):
        self.timers.add(ms)
        assert len(self.timers) == 1

    def deleteTimer(self, ms):
        self.timers.remove(ms)

    @property
    def touched(self):
        return sum(s.touched for s in self.states.values())


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getCurrentProcessingTimeInMs = getCurrentWatermarkInMs


class Expiry:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms


class Key:
    """One key of a processor, driven by hand."""

    def __init__(self, handler, **options):
        self.handle = Handle()
        self.event_time = options.pop("event_time", True)
        self.processor = KeyedProcessor(handler, PipelineOptions(**options), self.event_time)
        self.processor.init(self.handle)
        self.next = 0

    def send(self, *messages, now_ms=0):
        """messages: (second, payload or None, took in seconds or None)."""
        rows = []
        for second, payload, *took in messages:
            rows.append({"topic": "t", "part": 0, "off": self.next, "key": "k", "ts_us": round(second * 1_000_000), "id": None,
                         "payload": payload, "took_us": round(took[0] * 1_000_000) if took else None})
            self.next += 1
        random.Random(3).shuffle(rows)
        return list(self.processor.handleInputRows(("k",), iter(rows), Clock(now_ms)))

    def until(self, second):
        """Let Spark's timer wake the key, as long as it is due."""
        out = []
        while self.handle.timers and min(self.handle.timers) <= second * 1000:
            ms = min(self.handle.timers)
            self.handle.timers.remove(ms)
            out += self.processor.handleExpiredTimer(("k",), Clock(round(second * 1000)), Expiry(ms))
        return out

    def cost(self, act):
        before = self.handle.touched
        act()
        return self.handle.touched - before


class Nothing(EventHandler):
    def on_message(self, context, message):
        pass

    def on_timer(self, context, timer):
        pass


class Broken(EventHandler):
    def on_message(self, context, message):
        raise OSError("no")


class Sets(EventHandler):
    """The payload is a list of instants to schedule."""

    def on_message(self, context, message):
        for second in message.payload:
            context.schedule(second)

    def on_timer(self, context, timer):
        pass


seconds = st.one_of(st.integers(0, 600), st.integers(0, 2**32 - 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["add", "discard", "clear", "save"]), seconds), max_size=60))
def test_instants_are_an_ordered_set(operations):
    state, known = State(), set()
    held = Instants(state)
    for name, second in operations:
        if name == "add":
            held.add(second)
            known.add(second)
        elif name == "discard":
            held.discard(second)
            known.discard(second)
        elif name == "clear":
            held.clear()
            known.clear()
        else:
            held.save()
            held = Instants(state)
        assert held.first() == min(known, default=None)
        assert (second in held) == (second in known)
    assert list(held) == sorted(known)
    held.save()
    assert list(Instants(state)) == sorted(known)
    if not known:
        assert not state.map


def test_a_message_costs_the_same_whatever_is_pending():
    costs = []
    for pending in (10, 10_000):
        key = Key(Sets)
        key.send((0, str([100_000 + 7 * i for i in range(pending)])))
        quiet = key.cost(lambda: key.send((1, "[]")))
        sets = key.cost(lambda: key.send((2, "[100003]")))
        fires = key.cost(lambda: key.until(100_000))
        costs.append((quiet, sets, fires))
        assert len(key.handle.timers) == 1
    few, many = costs
    assert few[0] == many[0]
    assert all(b <= a + 8 for a, b in zip(few, many))


def test_a_retry_costs_the_same_whatever_waits():
    costs = []
    for waiting in (10, 10_000):
        key = Key(Broken, monopolization_enabled=False)
        key.send(*[(0, "{}")] * waiting)
        costs.append(key.cost(lambda: key.until(1.5)))
        assert key.processor.tail - key.processor.head == waiting
    assert costs[0] == costs[1] <= 6


def test_all_due_timers_fire_in_order_and_once():
    key = Key(Sets)
    key.send((0, "[5, 3, 3, 9, 4.5, 100000]"))
    fired = [(r["fire_s"], r["at_us"]) for r in key.until(10)]
    assert fired == [(s, s * 1_000_000) for s in (3, 5, 9)]
    assert key.until(99_999) == []
    assert [r["fire_s"] for r in key.send((100_001, "[]")) if r["kind"] == "timer"] == [100_000]
    assert not key.handle.timers and key.handle.states["meta"].value is None


def test_low_latency_retries_are_paced_and_hold_the_key_back():
    key = Key(Broken, mode="low_latency", retry_base=0.25, max_retry_delay=0.4, max_retries=4)
    rows = key.send((1, '{"n": 1}'), (1.1, '{"n": 2}'))
    assert [(r["off"], r["attempt"], r["route"]) for r in rows] == [(0, 1, "retry")]
    rows = key.until(60)
    assert [(r["off"], r["attempt"], r["at_us"] // 1000, r["route"]) for r in rows] == [
        (0, 2, 1250, "retry"), (0, 3, 1650, "retry"), (0, 4, 2050, "dead_letter"),
        (1, 1, 2050, "retry"), (1, 2, 2300, "retry"), (1, 3, 2700, "retry"), (1, 4, 3100, "dead_letter")]
    assert [r["payload"] for r in rows if r["route"] == "dead_letter"] == ['{"n": 1}', '{"n": 2}']
    assert not key.handle.timers and not key.handle.states["queue"].map


def test_what_waits_longer_than_it_is_kept_is_given_up():
    class Late(EventHandler):
        """Fails until eight seconds after the start."""

        def on_message(self, context, message):
            if context.now.timestamp() < 8:
                raise OSError("no")

    key = Key(Late, retention=10, defer_base=11)
    key.send((0, "{}"), (5, "{}"))
    assert [(r["off"], r["outcome"], r["route"]) for r in key.until(12)] == [(0, "expired", "skip"), (1, "success", "done")]
    assert not key.handle.timers and not key.handle.states["queue"].map


@pytest.mark.parametrize("closed, delay_ms", [((), 1000), (("t",), 20), (("other",), 1000)])
def test_a_closed_gate_shortens_the_pace(monkeypatch, closed, delay_ms):
    monkeypatch.setattr("keylane.streaming.processor.closed_topics", lambda: frozenset(closed))
    key = Key(Broken)
    key.send((1.5, "{}"))
    assert key.handle.timers == {1500 + delay_ms}


@pytest.mark.parametrize("used, turned_away", [(269.999999, False), (270, False), (270.000001, True)])
def test_the_share_of_the_window_at_its_boundary(used, turned_away):
    key = Key(Nothing)
    key.send((1000, "{}", used))
    (row,) = key.send((1299, "{}", 1))
    assert (row["error_class"] == "Monopolized") == turned_away
    assert row["route"] == ("retry" if turned_away else "done")
    (row,) = key.until(1400) if turned_away else key.send((1300, "{}", 1))
    assert (row["outcome"], row["at_us"] >= 1_300_000_000) == ("success", True)


def test_the_window_rolls_with_bounded_state():
    key = Key(Nothing, monopolization_threshold=2.0)
    for i in range(2000):
        key.send((i * 0.7, "{}", 0.5))
    slots, spent = key.handle.states["used"].value
    assert len(slots) <= SLOTS and slots == sorted(slots)
    assert sum(spent) == pytest.approx(0.5e6 * 300 / 0.7, rel=0.01)


def test_processing_time_runs_what_is_due_now():
    key = Key(Sets, event_time=False)
    key.send((5, "[7, 8]"), now_ms=5_000)
    rows = key.until(9)
    assert [(r["fire_s"], r["at_us"]) for r in rows] == [(7, 9_000_000), (8, 9_000_000)]


def test_closed_topics_without_a_task():
    assert gates.closed_topics() == frozenset()


@pytest.mark.parametrize("fails, allowed", [(8, True), (9, True), (10, False)])
def test_gate_at_its_boundary(spark, tmp_path, fails, allowed):
    """Nine of ten failing messages still pass; retries and messages before the window count for nothing."""
    gate = gates.FailureGate(str(tmp_path), PipelineOptions())
    schema = "kind string, topic string, attempt int, at_us bigint, outcome string"
    old = [("message", "t", 1, 10_000_000, "success")] * 50
    now = [("message", "t", 1, 400_000_000 + i, "transient" if i < fails else "success") for i in range(10)]
    other = [("message", "t", 2, 400_000_000, "success"), ("timer", None, 1, 400_000_000, "success"), ("message", "u", 1, 0, "success")]
    try:
        gate.update(spark.createDataFrame(old, schema), 0)
        gate.update(spark.createDataFrame(now + other, schema), 1)
        rates = {r["topic"]: (r["messages"], r["failed"], r["defer_allowed"]) for r in gate.rates(gate.ring(spark, 1)).collect()}
        assert rates == {"t": (10, fails, allowed), "u": (1, 0, True)}
        assert spark.sparkContext.getLocalProperty(gates.CLOSED) == ("[]" if allowed else '["t"]')
        gate.update(spark.createDataFrame(now, schema), 1)  # a batch that runs again replaces its ring
        assert {r["topic"]: r["messages"] for r in gate.rates(gate.ring(spark, 1)).collect()} == {"t": 10}
        gate.resume(spark, str(tmp_path / "nothing"))
        assert spark.sparkContext.getLocalProperty(gates.CLOSED) is None
    finally:
        spark.sparkContext.setLocalProperty(gates.CLOSED, None)


def transitions(batches, threshold, end):
    """Stalls of one partition whose timer fires whenever the clock passes it."""
    handle, out = Handle(), []
    detector = StallDetector(threshold, True)
    detector.init(handle)

    def wake(now_us):
        while handle.timers and min(handle.timers) * 1000 <= now_us:
            ms = handle.timers.pop()
            out.extend(detector.handleExpiredTimer(("t", 0), Clock(now_us // 1000), Expiry(ms)))

    for clock, times in batches:
        wake(clock)
        out.extend(detector.handleInputRows(("t", 0), iter([{"ts_us": t} for t in times]), Clock(clock // 1000)))
    wake(end)
    return [(r["state"], r["at_us"], r["since_us"]) for r in out]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=30), st.integers(1, 20), st.integers(1, 6))
def test_stalls_are_told_once_however_the_batches_fall(gaps, threshold, size):
    times, at = [], 0
    for gap in gaps:
        at += gap * 1000
        times.append(at)
    threshold *= 1000
    expected = []
    for a, b in zip(times, [*times[1:], None]):
        if b is None or b - a > threshold:
            expected.append(("stalled", a + threshold + 1, a))
            if b is not None:
                expected.append(("recovered", b, a))
    batches = [times[i: i + size] for i in range(0, len(times), size)]
    # the clock stands at the end of the batch before, or just before the first message of this one
    for clocks in ([b[-1] for b in [[0], *batches[:-1]]], [max(b[0] - 1, 0) for b in batches]):
        assert transitions(zip(clocks, batches), threshold, 10**9) == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=80), st.integers(1, 6), st.integers(1, 9))
def test_the_cache_forgets_the_least_recent(ids, size, batch):

    class Field:
        class dataType:
            @staticmethod
            def simpleString():
                return "bigint"

    handle = Handle()
    cache = RecentNames(size, ["id"], ["n"], ["id", "n"], {"id": Field})
    cache.init(handle)
    got = []
    rows = [{"id": i, "n": n} for n, i in enumerate(ids)]
    for low in range(0, len(rows), batch):
        got += [r["n"] for r in cache.handleInputRows(("t", 0), iter(rows[low: low + batch][::-1]), Clock(0))]
    known, expected = OrderedDict(), []
    for row in rows:
        if row["id"] not in known:
            expected.append(row["n"])
        known.pop(row["id"], None)
        known[row["id"]] = True
        if len(known) > size:
            known.popitem(last=False)
    assert got == expected
    assert len(handle.states["numbers"].map) == len(handle.states["names"].map) <= size


def ttl_dedup(batches, ttl, event_time):
    """batches: (clock in ms, times in microseconds). Returns the kept times; at most one timer is ever set."""
    handle, kept = Handle(), []
    dedup = TtlDedup(ttl, ["ts_us"], ["ts_us"], event_time)
    dedup.init(handle)
    for clock, times in batches:
        while handle.timers and min(handle.timers) <= clock:
            list(dedup.handleExpiredTimer(("id",), Clock(clock), Expiry(handle.timers.pop())))
        kept += [r["ts_us"] for r in dedup.handleInputRows(("id",), iter([{"ts_us": t} for t in times]), Clock(clock))]
    return kept


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 8000), min_size=1, max_size=40), st.integers(0, 3000), st.integers(1, 7))
def test_ttl_dedup_over_batches(gaps, ttl, size):
    times, at = [], 0
    for gap in gaps:
        at += gap
        times.append(at)
    expected, last = [], None
    for t in times:
        if last is None or t > last + ttl:
            expected.append(t)
            last = t
    batches = [times[i: i + size] for i in range(0, len(times), size)]
    clocks = [0, *(b[-1] // 1000 for b in batches[:-1])]
    assert ttl_dedup(zip(clocks, batches), ttl, True) == expected


def test_late_rows_are_kept_without_a_watermark():
    second = 1_000_000
    batches = [(0, [100 * second]), (1, [50 * second, 95 * second]), (2, [105 * second, 200 * second]), (3, [100 * second])]
    assert ttl_dedup(batches, 10 * second, False) == [100 * second, 50 * second, 200 * second, 100 * second]
    assert ttl_dedup([(0, [0]), (20_000, [0])], 10 * second, False) == [0, 0]  # forgotten by the wall clock


class BrokenAtFirst(EventHandler):
    """Fails until two seconds after the message was sent."""

    def on_message(self, context, message):
        if (context.now - message.timestamp).total_seconds() < 2:
            raise OSError("no")


def test_what_comes_and_goes_within_a_call_never_reaches_the_queue():
    key = Key(BrokenAtFirst, monopolization_enabled=False)
    cost = key.cost(lambda: key.send(*[(i * 4, "{}") for i in range(50)]))
    assert key.handle.states["queue"].touched == 1 and cost <= 4  # the last message waits
    assert [(r["off"], r["attempt"], r["route"]) for r in key.until(300)] == [(49, 2, "retry"), (49, 3, "done")]
    assert not key.handle.states["queue"].map and key.handle.states["meta"].value is None


@pytest.mark.parametrize("held", [1, 3, 10_000])
def test_how_many_messages_are_held_changes_nothing(monkeypatch, held):
    monkeypatch.setattr("keylane.streaming.processor.MOST_HELD", held)
    key = Key(BrokenAtFirst, monopolization_enabled=False)
    rows = []
    for batch in range(3):
        rows += key.send(*[(batch * 10 + i / 10, "{}") for i in range(40)])
    rows += key.until(1000)
    assert [r["off"] for r in rows if r["route"] == "done"] == list(range(120))
    assert [r["at_us"] for r in rows] == sorted(r["at_us"] for r in rows)
    assert not key.handle.states["queue"].map and key.handle.states["meta"].value is None
