"""Many keys in one call of Spark: the state of a bucket of keys is read and written as one value.

A stateful operator that Spark calls for every key pays for each call and for
each state it reads or writes with a message to the JVM, and each key's rows
come back as a batch of their own. Here keys are dealt to buckets by a hash;
Spark calls once for a bucket of a micro-batch, and the processor of a key
works on states in memory. What a bucket holds is one value. A map of a key
that outgrows ``MOST_ENTRIES`` moves to a map state of Spark, where a call
touches the entries it needs and no others.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Buckets of a stream. More of them are smaller, so a small micro-batch rewrites less; fewer of them need fewer calls.
BUCKETS = 16_384
#: Entries of a key's map that are part of its bucket's value.
MOST_ENTRIES = 1_024
BUCKET = "_bucket"
#: Keys of these types are equal in Python when they are equal in Spark.
PLAIN = (T.StringType, T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.BinaryType, T.DecimalType)


def transform_in_buckets(rows: DataFrame, by: Sequence[str], processor: StatefulProcessor, schema: T.StructType, time_mode: str,
                         buckets: int = BUCKETS) -> DataFrame:
    """``rows.groupBy(*by).transformWithState(...)`` with the keys of a bucket in one call. Other than plain keys get a call each."""
    types = [rows.schema[c].dataType for c in by]
    if not all(isinstance(t, PLAIN) and (not isinstance(t, T.StringType) or t == T.StringType()) for t in types):
        return rows.groupBy(*by).transformWithState(processor, schema, "Append", time_mode)
    dealt = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"))
    return dealt.groupBy(BUCKET).transformWithState(Buckets(processor, list(by), time_mode), schema, "Append", time_mode)


class Buckets(StatefulProcessor):
    """Calls the processor of a key for each key of a bucket, with that key's states and timers."""

    def __init__(self, processor: StatefulProcessor, by: list[str], time_mode: str):
        self.processor, self.by, self.event_time = processor, by, time_mode == "EventTime"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "wake_ms bigint, keys binary")
        self.large = handle.getMapState("large", "name string", "entry binary")
        self.keys = Keys(self.large)
        self.processor.init(self.keys)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        groups: dict[tuple, list[Row]] = {}
        for row in rows:
            groups.setdefault(tuple(row[c] for c in self.by), []).append(row)
        wake = self._load()
        for name in list(groups):
            self.keys.take(name)
            yield from self.processor.handleInputRows(name, iter(groups.pop(name)), timerValues)
            self.keys.leave()
        self._save(wake, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wake, woken = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        for ms, name in self.keys.due(max(now, woken)):
            self.keys.take(name)
            if self.keys.expire(ms):
                yield from self.processor.handleExpiredTimer(name, timerValues, Expired(ms))
            self.keys.leave()
        self._save(wake, woken)

    def close(self) -> None:
        self.processor.close()

    def _load(self) -> int | None:
        wake, packed = self.held.get() or (None, None)
        self.keys.open({} if packed is None else pickle.loads(packed))
        return wake

    def _save(self, before: int | None, woken: int | None) -> None:
        wake = self.keys.first()
        if wake is not None and woken is not None and wake <= woken:
            wake = woken + 1  # Spark removes the timer that just expired, after the call
        registered = None if before == woken else before
        if registered != wake:
            if registered is not None:
                self.handle.deleteTimer(registered)
            if wake is not None:
                self.handle.registerTimer(wake)
        if self.keys.records:
            if self.keys.changed or wake != before:
                self.held.update((wake, pickle.dumps(self.keys.records, pickle.HIGHEST_PROTOCOL)))
        elif self.keys.changed:
            self.held.clear()
        self.keys.open({})


class Expired:
    """The timer of a key that expired."""

    def __init__(self, ms: int):
        self.ms = ms

    def getExpiryTimeInMs(self) -> int:
        return self.ms


class Keys:
    """The handle a key's processor sees: states and timers of the key that was taken, out of those of its bucket."""

    def __init__(self, large):
        self.large = large
        self.open({})

    def open(self, records: dict[tuple, tuple[dict, set]]) -> None:
        self.records, self.changed = records, False
        self.name: tuple | None = None

    def take(self, name: tuple) -> None:
        self.name = name
        self.states, self.timers = self.records.get(name) or ({}, set())

    def leave(self) -> None:
        if self.states or self.timers:
            self.records[self.name] = (self.states, self.timers)
        else:
            self.records.pop(self.name, None)

    def due(self, now_ms: int) -> list[tuple[int, tuple]]:
        found = [(ms, name) for name, (_, timers) in self.records.items() for ms in timers if ms <= now_ms]
        return sorted(found, key=lambda f: f[0])

    def first(self) -> int | None:
        return min((ms for _, timers in self.records.values() for ms in timers), default=None)

    def expire(self, ms: int) -> bool:
        """Whether the timer is still set; it is no longer."""
        if ms not in self.timers:
            return False
        self.deleteTimer(ms)
        return True

    # -- what a processor calls --------------------------------------------

    def getValueState(self, name: str, schema: str) -> KeyValue:
        return KeyValue(self, name)

    def getMapState(self, name: str, key_schema: str, value_schema: str) -> KeyMap:
        return KeyMap(self, name)

    def registerTimer(self, ms: int) -> None:
        self.timers.add(ms)
        self.changed = True

    def deleteTimer(self, ms: int) -> None:
        self.timers.discard(ms)
        self.changed = True


class KeyValue:
    """A value state of the key that was taken."""

    def __init__(self, keys: Keys, name: str):
        self.keys, self.name = keys, name

    def exists(self) -> bool:
        return self.name in self.keys.states

    def get(self) -> tuple | None:
        return self.keys.states.get(self.name)

    def update(self, value: tuple) -> None:
        self.keys.states[self.name] = value
        self.keys.changed = True

    def clear(self) -> None:
        if self.keys.states.pop(self.name, None) is not None:
            self.keys.changed = True


class KeyMap:
    """A map state of the key that was taken: a dict, or the number of its entries if they are in the bucket's map of large ones."""

    def __init__(self, keys: Keys, name: str):
        self.keys, self.name = keys, name

    def _place(self, entry: tuple) -> tuple[str]:
        return (repr((self.keys.name, self.name, entry)),)

    def _put(self, entry: tuple, value: tuple) -> None:
        self.keys.large.updateValue(self._place(entry), (pickle.dumps((self.keys.name, self.name, entry, value)),))

    def _entries(self) -> Iterator[tuple[tuple, tuple]]:
        for _, (packed,) in self.keys.large.iterator():
            owner, state, entry, value = pickle.loads(packed)
            if (owner, state) == (self.keys.name, self.name):
                yield entry, value

    def getValue(self, name: tuple) -> tuple | None:
        held = self.keys.states.get(self.name)
        if not isinstance(held, int):
            return held.get(tuple(name)) if held else None
        found = self.keys.large.getValue(self._place(tuple(name)))
        return None if found is None else pickle.loads(found[0])[3]

    def containsKey(self, name: tuple) -> bool:
        return self.getValue(name) is not None

    def updateValue(self, name: tuple, value: tuple) -> None:
        name, held = tuple(name), self.keys.states.setdefault(self.name, {})
        self.keys.changed = True
        if isinstance(held, int):
            new = self.keys.large.getValue(self._place(name)) is None
            self._put(name, value)
            self.keys.states[self.name] = held + new
            return
        held[name] = value
        if len(held) > MOST_ENTRIES:
            for entry, known in held.items():
                self._put(entry, known)
            self.keys.states[self.name] = len(held)

    def removeKey(self, name: tuple) -> None:
        name, held = tuple(name), self.keys.states.get(self.name)
        if isinstance(held, int):
            if self.keys.large.getValue(self._place(name)) is None:
                return
            self.keys.large.removeKey(self._place(name))
            held = self.keys.states[self.name] = held - 1
        elif held is None or held.pop(name, None) is None:
            return
        self.keys.changed = True
        if not held:
            del self.keys.states[self.name]

    def iterator(self) -> Iterator[tuple[tuple, tuple]]:
        held = self.keys.states.get(self.name)
        return self._entries() if isinstance(held, int) else iter(list((held or {}).items()))

    def clear(self) -> None:
        held = self.keys.states.pop(self.name, None)
        if held is None:
            return
        self.keys.changed = True
        if isinstance(held, int):
            for entry, _ in list(self._entries()):
                self.keys.large.removeKey(self._place(entry))
