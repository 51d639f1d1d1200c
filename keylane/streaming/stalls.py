"""Stalls of partitions as they begin and end, told by a timer while no message comes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keylane.operators.health import PARTITION
from keylane.options import PipelineOptions
from keylane.session import ensure_state_store


def stall_transitions(messages: DataFrame, options: PipelineOptions | None = None, *, event_time: bool = True) -> DataFrame:
    """Rows (topic, part, state, at_us, since_us): a partition ``stalled`` or ``recovered``.

    It stalls when no message came for longer than the threshold after the one at
    ``since_us``: at the first microsecond beyond it, told by a timer or, at the
    latest, by the next message. That message's time is when it recovers. In event time the
    other partitions' messages move the clock, and rows behind the watermark are dropped; without
    it the wall clock does, arrival is what counts, and nothing is dropped.
    """
    options = options or PipelineOptions()
    ensure_state_store(messages.sparkSession)
    rows = messages.select(*PARTITION, "ts", "ts_us")
    if event_time:
        rows = rows.withWatermark("ts", f"{options.watermark_delay} seconds")
    return rows.groupBy(*PARTITION).transformWithState(
        StallDetector(round(options.stall_threshold * 1_000_000), event_time),
        "topic string, part int, state string, at_us bigint, since_us bigint", "Append",
        "EventTime" if event_time else "ProcessingTime")


class StallDetector(StatefulProcessor):
    """The time of a partition's last message, whether it is stalled, and one timer."""

    def __init__(self, threshold_us: int, event_time: bool):
        self.threshold_us = threshold_us
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_us bigint, stalled boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.last.get()
        times = [row["ts_us"] for row in rows] if self.event_time else [timerValues.getCurrentProcessingTimeInMs() * 1000]
        last, stalled = (min(times), False) if held is None else held
        if held is not None and not stalled:
            self.handle.deleteTimer(self._due(last))
        for at_us in sorted(times):
            if at_us - last > self.threshold_us and not stalled:
                yield self._row(key, "stalled", last + self.threshold_us + 1, last)
                stalled = True
            if stalled:
                yield self._row(key, "recovered", at_us, last)
                stalled = False
            last = max(last, at_us)
        self.last.update((last, False))
        self.handle.registerTimer(self._due(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, stalled = self.last.get()
        if not stalled:
            self.last.update((last, True))
            yield self._row(key, "stalled", last + self.threshold_us + 1, last)

    def _due(self, last_us: int) -> int:
        return (last_us + self.threshold_us) // 1000 + 1

    def _row(self, key: tuple, state: str, at_us: int, since_us: int) -> Row:
        return Row(topic=key[0], part=key[1], state=state, at_us=at_us, since_us=since_us)

    def close(self) -> None:
        pass
