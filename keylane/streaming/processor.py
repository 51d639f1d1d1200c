"""The handler surface on a stream: ordered calls, timers, deferral, paced retries, hot keys, dedup.

One stateful operator holds everything a key needs, so a stream is shuffled
once by buckets of keys and keeps one state store. A call reads what it needs of the key's
state and no more, once, and writes what remains at the end: waiting messages
are a queue in a map by number, pending instants a tree, and one Spark timer
wakes the key for whatever comes first.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keylane.handlers import EventHandler, Message, Outcome, Timer, attempt, instant, timer_second
from keylane.options import PipelineOptions
from keylane.session import ensure_state_store
from keylane.streaming.buckets import BUCKETS, transform_in_buckets
from keylane.streaming.gate import closed_topics
from keylane.streaming.instants import Instants

QUEUED = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("off", T.LongType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("fire_s", T.LongType()),
        T.StructField("took_us", T.LongType()),
    ]
)

RESULT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("off", T.LongType()),
        T.StructField("fire_s", T.LongType()),
        T.StructField("at_us", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("error_class", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("error_cause", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

MAX_DOUBLINGS = 40


def delay_ms(tries: int, base_s: float, cap_s: float) -> int:
    """Exponential delay before the next try, at most the cap."""
    return min(round(base_s * 1000) * 2 ** min(max(tries - 1, 0), MAX_DOUBLINGS), round(cap_s * 1000))


def process_stream(
    messages: DataFrame,
    handler: Callable[[], EventHandler],
    options: PipelineOptions | None = None,
    *,
    payload: str = "payload",
    event_time: bool = True,
    took: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Run a handler over a stream of messages, serially per key.

    ``messages`` has topic, part, off, key, ts, ts_us, an ``id`` (may be null)
    and ``payload`` as JSON text. With ``event_time`` timers follow the message
    times and a watermark, and rows later than its delay are dropped; without
    it timers follow the wall clock and nothing is dropped. How long a call took
    is measured, or in a replay read from the column ``took``, in microseconds.
    Spark calls once for each of ``buckets`` buckets of keys that a micro-batch touches.
    """
    options = options or PipelineOptions()
    ensure_state_store(messages.sparkSession)
    spent = F.lit(None) if took is None else F.col(took)
    rows = messages.select("topic", "part", "off", "key", "ts", "ts_us", "id", F.col(payload).alias("payload"),
                           spent.cast("bigint").alias("took_us"))
    if event_time:
        rows = rows.withWatermark("ts", f"{options.watermark_delay} seconds")
    return transform_in_buckets(
        rows, ["key"], KeyedProcessor(handler, options, event_time), RESULT, "EventTime" if event_time else "ProcessingTime", buckets)


#: What a key keeps in one value: when Spark wakes it; first and next number of the queue; tries of the queue's head and
#: when it is tried again; the first pending instant; when ids are dropped.
META = ("wake_ms bigint, head bigint, tail bigint, tries int, retry_ms bigint, next_s bigint, purge_ms bigint")
#: Messages of a key's queue that are held before they are written.
MOST_HELD = 10_000
#: Parts of the rolling window of a key's execution time.
SLOTS = 300


class KeyedProcessor(StatefulProcessor):
    """Calls the user's handler for one key at a time.

    A transient failure that is to be tried again puts the message at the head of
    the key's queue and sets a time for it: later messages and timers of the key
    wait behind it, and other keys go on. In pipeline mode that is deferral, or, where
    the topic fails too often or deferral is off, a retry at the shorter pace, without end;
    in low-latency mode a retry up to ``max_retries`` attempts in all. In
    pipeline mode a key that used more than its share of the rolling window is
    not called but fails transiently, and so waits.
    """

    def __init__(self, handler: Callable[[], EventHandler], options: PipelineOptions, event_time: bool):
        self.make = handler
        self.event_time = event_time
        self.mode = options.mode
        self.max_retries = options.max_retries
        self.dedup = options.dedup_enabled
        self.version = str(options.idempotence_version)
        self.ttl_us = round(options.idempotence_ttl * 1_000_000)
        self.timeout = options.handler_timeout
        # what waits longer than it is kept is given up
        self.retention_us = round(options.retention * 1_000_000)
        self.retry_pace = (options.retry_base, options.max_retry_delay)
        self.defer_pace = (options.defer_base, options.defer_max_delay)
        self.defers = options.mode == "pipeline" and options.defer_enabled
        self.rations = options.mode == "pipeline" and options.monopolization_enabled
        self.window_us = round(options.monopolization_window * 1_000_000)
        self.most_us = options.monopolization_threshold * self.window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.handler = self.make()
        self.meta = handle.getValueState("meta", META)
        self.queue = handle.getMapState("queue", "number bigint", QUEUED)
        self.pending = handle.getMapState("pending", "level int, prefix bigint", "bits binary")
        self.seen = handle.getMapState("seen", "topic string, id string, version string", "recorded_us bigint")
        self.used = handle.getValueState("used", "slots array<bigint>, spent_us array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._load()
        for row in sorted(rows, key=lambda r: (r["topic"], r["part"], r["off"])):
            at_us = row["ts_us"] if self.event_time else timerValues.getCurrentProcessingTimeInMs() * 1000
            if self.event_time:
                yield from self._catch_up(key[0], at_us)
            if self._duplicate(row["topic"], row["id"], row["ts_us"]):
                continue
            item = (row["topic"], row["part"], row["off"], row["ts_us"], row["payload"], None, row["took_us"])
            yield from self._accept(key[0], item, at_us)
        self._save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load()
        self.woken = expiredTimerInfo.getExpiryTimeInMs()
        now_ms = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        now_ms = max(now_ms, self.woken)
        yield from self._catch_up(key[0], now_ms * 1000)
        if self.purge_ms is not None and self.purge_ms <= now_ms:
            self._forget(now_ms * 1000)
        self._save()

    def close(self) -> None:
        pass

    # -- the key's state: its few numbers are read at the start of a call, the
    # -- rest when it is needed, and what changed is written at the end.

    def _load(self) -> None:
        self.saved = self.meta.get()
        wake, head, tail, tries, retry, second, purge = self.saved or (None, 0, 0, 0, None, None, None)
        self.wake_ms, self.head, self.tail, self.tries = wake, head, tail, tries
        self.retry_ms, self.next_s, self.purge_ms = retry, second, purge
        self.woken: int | None = None
        self.instants = Instants(self.pending)
        self.ring: list[tuple[int, int]] | None = None
        self.ring_changed = False
        self.known: dict[tuple, int | None] = {}
        self.fresh: set[tuple] = set()
        self.closed: frozenset[str] | None = None
        # messages of the queue that were read, and those that were not written yet
        self.items: dict[int, tuple] = {}
        self.unwritten: set[int] = set()

    def _save(self) -> None:
        self.instants.save()
        self._write_queue()
        times = [ms for ms in (self.retry_ms, self.purge_ms, None if self.next_s is None else self.next_s * 1000) if ms is not None]
        wake = min(times, default=None)
        # Spark removes the timer that just expired
        registered = None if self.wake_ms == self.woken else self.wake_ms
        if registered != wake:
            if registered is not None:
                self.handle.deleteTimer(registered)
            if wake is not None:
                self.handle.registerTimer(wake)
        now = (wake, self.head, self.tail, self.tries, self.retry_ms, self.next_s, self.purge_ms)
        if now == (None, self.tail, self.tail, 0, None, None, None):
            if self.saved is not None:  # nothing waits: the key needs no numbers
                self.meta.clear()
        elif self.saved is None or now != tuple(self.saved):
            self.meta.update(now)
        for name in self.fresh:
            self.seen.updateValue(name, (self.known[name],))
        if self.ring_changed:
            if self.ring:
                self.used.update(tuple(map(list, zip(*self.ring))))
            else:
                self.used.clear()

    # -- order of work -------------------------------------------------------

    def _catch_up(self, key: str, at_us: int) -> Iterator[Row]:
        """Everything due by ``at_us`` runs before the message of that time: in event time at its own time, else now."""
        while True:
            second = self.next_s if self.next_s is not None and self.next_s * 1_000_000 <= at_us else None
            if self.retry_ms is not None and self.retry_ms * 1000 <= at_us and (second is None or self.retry_ms < second * 1000):
                yield from self._retry(key, self.retry_ms * 1000 if self.event_time else at_us)
            elif second is not None:
                self._drop(second)
                now_us = second * 1_000_000 if self.event_time else at_us
                yield from self._accept(key, (None, None, None, now_us, None, second, None), now_us)
            else:
                return

    def _accept(self, key: str, item: tuple, now_us: int) -> Iterator[Row]:
        if self.retry_ms is not None:
            self._enqueue(item)
            return
        result, waits = self._run(key, item, 1, now_us)
        yield result
        if waits:
            self._enqueue(item)

    def _enqueue(self, item: tuple) -> None:
        self.items[self.tail] = item
        self.unwritten.add(self.tail)
        self.tail += 1
        if len(self.unwritten) >= MOST_HELD:
            self._write_queue()

    def _write_queue(self) -> None:
        for number in sorted(self.unwritten):
            self.queue.updateValue((number,), self.items.pop(number))
        self.unwritten.clear()

    def _head(self) -> tuple:
        if self.head not in self.items:
            self.items[self.head] = tuple(self.queue.getValue((self.head,)))
        return self.items[self.head]

    def _dequeue(self) -> None:
        """The head leaves; one that came and went within a call of Spark never reaches the state."""
        del self.items[self.head]
        if self.head in self.unwritten:
            self.unwritten.discard(self.head)
        else:
            self.queue.removeKey((self.head,))
        self.head += 1

    def _retry(self, key: str, now_us: int) -> Iterator[Row]:
        """Work through the queue from its head until it is empty or the head fails again; the rest is not touched."""
        tries, self.retry_ms = self.tries, None
        while self.head < self.tail:
            item = self._head()
            if now_us - item[3] > self.retention_us:
                yield self._row(key, item, now_us, tries, Outcome("expired"), "skip")
            else:
                result, waits = self._run(key, item, tries + 1, now_us)
                yield result
                if waits:
                    return
            self._dequeue()
            tries = 0
        self.head = self.tail = self.tries = 0

    def _run(self, key: str, item: tuple, tries: int, now_us: int) -> tuple[Row, bool]:
        """Call the handler; the flag says that the item must be tried again later."""
        if self._monopolizes(now_us):
            outcome = Outcome("transient", "Monopolized", "the key used more than its share of the window")
        else:
            outcome = self._called(key, item, now_us)
        route = self._route(outcome, tries)
        if route == "retry":
            ms = now_us // 1000 + delay_ms(tries, *self._pace(item[0]))
            # never on a whole second: there the key's timers are first
            self.tries, self.retry_ms = tries, ms + (ms % 1000 == 0)
        return self._row(key, item, now_us, tries, outcome, route), route == "retry"

    def _called(self, key: str, item: tuple, now_us: int) -> Outcome:
        context = StreamContext(self, key, now_us)
        topic, part, off, ts_us, payload, fire_s, took_us = item
        if fire_s is None:
            call, event = self.handler.on_message, Message(topic, part, off, key, ts_us, payload)
        else:
            call, event = self.handler.on_timer, Timer(key, instant(fire_s * 1_000_000))
        began = time.perf_counter_ns()
        outcome = attempt(call, context, event)
        if self.rations:
            self._spend(now_us, (time.perf_counter_ns() - began) // 1000 if took_us is None else took_us)
        return outcome

    def _row(self, key: str, item: tuple, now_us: int, tries: int, outcome: Outcome, route: str) -> Row:
        topic, part, off, _, payload, fire_s, _ = item
        kind = "message" if fire_s is None else "timer"
        letter = payload if route == "dead_letter" else None
        values = (key, kind, topic, part, off, fire_s, now_us, tries, *outcome, route, letter)
        return Row(**dict(zip(RESULT.names, values)))

    def _route(self, outcome: Outcome, tries: int) -> str:
        if outcome.outcome == "success":
            return "done"
        if self.mode == "low_latency":
            return "retry" if outcome.outcome == "transient" and tries < self.max_retries else "dead_letter"
        return "retry" if self.mode == "pipeline" and outcome.outcome == "transient" else "skip"

    def _pace(self, topic: str | None) -> tuple[float, float]:
        """Base and cap of the delay: that of deferral where the topic's gate is open."""
        if not self.defers:
            return self.retry_pace
        if self.closed is None:
            self.closed = closed_topics()
        return self.retry_pace if topic in self.closed else self.defer_pace

    # -- the key's timers ----------------------------------------------------

    def _set(self, second: int) -> None:
        self.instants.add(second)
        self.next_s = second if self.next_s is None else min(self.next_s, second)

    def _drop(self, second: int) -> None:
        self.instants.discard(second)
        if second == self.next_s:
            self.next_s = self.instants.first()

    def _wipe(self) -> None:
        if self.next_s is not None:
            self.instants.clear()
            self.next_s = None

    # -- execution time in the rolling window ---------------------------------

    def _monopolizes(self, now_us: int) -> bool:
        if not self.rations:
            return False
        if self.ring is None:
            found = self.used.get()
            self.ring = [] if found is None else list(zip(found[0], found[1]))
        first = now_us * SLOTS // self.window_us - SLOTS + 1
        return sum(spent for slot, spent in self.ring if slot >= first) > self.most_us

    def _spend(self, now_us: int, spent_us: int) -> None:
        slot = now_us * SLOTS // self.window_us
        held = {s: spent for s, spent in self.ring if s > slot - SLOTS}
        held[slot] = held.get(slot, 0) + spent_us
        self.ring, self.ring_changed = sorted(held.items()), True

    # -- remembered ids ------------------------------------------------------

    def _duplicate(self, topic: str, id_: str | None, ts_us: int) -> bool:
        """Whether the id was kept under this topic, key and version within the ttl."""
        if id_ is None or not self.dedup:
            return False
        name = (topic, id_, self.version)
        if name not in self.known:
            found = self.seen.getValue(name)
            self.known[name] = None if found is None else found[0]
        recorded = self.known[name]
        if recorded is not None and ts_us <= recorded + self.ttl_us:
            return True
        self.known[name] = ts_us
        self.fresh.add(name)
        if self.purge_ms is None:
            self.purge_ms = (ts_us + self.ttl_us) // 1000 + 1
        return False

    def _forget(self, now_us: int) -> None:
        """Drop ids that no longer matter, a few times per ttl."""
        self.purge_ms = None
        kept = []
        for name, (recorded,) in list(self.seen.iterator()):
            if recorded + self.ttl_us < now_us:
                self.seen.removeKey(tuple(name))
            else:
                kept.append(recorded)
        if kept:
            later = max(min(kept) + self.ttl_us, now_us + self.ttl_us // 16)
            self.purge_ms = later // 1000 + 1


class StreamContext:
    """What a handler may do with the timers of its key."""

    def __init__(self, processor: KeyedProcessor, key: str, now_us: int):
        self._processor = processor
        self.key = key
        self._now_us = now_us
        self._deadline = time.monotonic() + processor.timeout

    @property
    def now(self) -> datetime:
        """Time of the message or timer; the wall clock in processing time."""
        return instant(self._now_us)

    def should_cancel(self) -> bool:
        """Whether the call has run past its deadline and should give up."""
        return time.monotonic() >= self._deadline

    def schedule(self, at: datetime | float) -> None:
        """Add an instant; scheduling it twice keeps one."""
        self._processor._set(timer_second(at))

    def clear_and_schedule(self, at: datetime | float) -> None:
        """Replace all instants by one; an invalid instant changes nothing."""
        second = timer_second(at)
        self._processor._wipe()
        self._processor._set(second)

    def unschedule(self, at: datetime | float) -> None:
        """Remove an instant; no effect when it is not scheduled."""
        self._processor._drop(timer_second(at))

    def clear_scheduled(self) -> None:
        self._processor._wipe()

    def scheduled(self) -> list[datetime]:
        """The pending instants in order."""
        return [instant(s * 1_000_000) for s in self._processor.instants]
