"""Deduplication with a bounded cache in keyed state."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keylane.operators.health import PARTITION
from keylane.session import ensure_state_store


def dedup_cached(messages: DataFrame, size: int = 8192, by: Sequence[str] = PARTITION, name: Sequence[str] = ("key", "id"),
                 order: Sequence[str] = ("ts_us", "part", "off")) -> DataFrame:
    """Best-effort dedup with a cache of ``size`` names per group, the least recently seen one forgotten first.

    A row whose name is in its group's cache is dropped; every sighting makes the
    name the most recent one. Rows with a null id (the last part of the name) pass by. ``size`` 0 drops nothing. Nothing depends on time, so no row is late.
    """
    if size <= 0:
        return messages
    ensure_state_store(messages.sparkSession)
    known = F.col(name[-1]).isNotNull()
    kept = messages.filter(known).groupBy(*by).transformWithState(
        RecentNames(size, list(name), list(order), messages.columns, messages.schema), messages.schema, "Append", "None")
    return kept.unionByName(messages.filter(~known))


class RecentNames(StatefulProcessor):
    """A bounded cache: the number of each name's last sighting, and the names by that number.

    A call reads the cache once, at most ``size`` names, works in memory and
    writes what changed, so that a message costs the state nothing.
    """

    def __init__(self, size: int, name: list[str], order: list[str], columns: list[str], schema):
        self.size, self.name, self.order, self.columns = size, name, order, columns
        self.fields = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in name)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.numbers = handle.getMapState("numbers", self.fields, "number bigint")
        self.names = handle.getMapState("names", "number bigint", self.fields)
        self.counts = handle.getValueState("counts", "next bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        following, = self.counts.get() or (0,)
        # the names with the numbers of their last sightings, the oldest first
        before = {tuple(name): number for (number,), name in self.names.iterator()}
        held = OrderedDict(sorted(before.items(), key=lambda pair: pair[1]))
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            name = tuple(row[c] for c in self.name)
            if held.pop(name, None) is None:
                yield Row(**{c: row[c] for c in self.columns})
                if len(held) == self.size:
                    held.popitem(last=False)
            held[name] = following
            following += 1
        for name, number in before.items():
            if held.get(name) != number:
                self.names.removeKey((number,))
                if name not in held:
                    self.numbers.removeKey(name)
        for name, number in held.items():
            if before.get(name) != number:
                self.numbers.updateValue(name, (number,))
                self.names.updateValue((number,), name)
        self.counts.update((following,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter([])

    def close(self) -> None:
        pass
