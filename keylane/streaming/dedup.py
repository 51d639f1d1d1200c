"""Time-limited deduplication and upserts on a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keylane.operators.dedup import KEYS, WEEK_S, latest_per_key
from keylane.session import ensure_state_store
from keylane.streaming.buckets import BUCKETS, transform_in_buckets


def dedup_stream(messages: DataFrame, ttl_s: float = WEEK_S, delay_s: float = 600.0, by: Sequence[str] = KEYS,
                 order: Sequence[str] = ("ts_us", "part", "off"), *, event_time: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of the time-limited dedup, with the same result.

    State is held per id, not per key, so the copies of a busy key spread over
    all tasks; Spark calls once for each of ``buckets`` buckets of ids that a micro-batch touches. Rows without an id need no state and pass by. In event time rows
    later than ``delay_s`` are dropped. Without it no row is dropped for being late: an id
    is kept in mind for ``ttl_s`` of the wall clock, and a row that comes late
    is a duplicate if it lies within the ttl of the last one kept, before or after it.
    """
    ensure_state_store(messages.sparkSession)
    with_id = messages.filter(F.col(by[-1]).isNotNull())
    if event_time:
        with_id = with_id.withWatermark("ts", f"{delay_s} seconds")
    kept = transform_in_buckets(
        with_id, by, TtlDedup(round(ttl_s * 1_000_000), list(order), messages.columns, event_time), messages.schema,
        "EventTime" if event_time else "ProcessingTime", buckets)
    return kept.unionByName(messages.filter(F.col(by[-1]).isNull()))


class TtlDedup(StatefulProcessor):
    """Remembers when the id was last kept, and until when that matters: one timer an id."""

    def __init__(self, ttl_us: int, order: list[str], columns: list[str], event_time: bool = True):
        self.ttl_us = ttl_us
        self.order = order
        self.columns = columns
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recorded = handle.getValueState("recorded", "us bigint, until_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        recorded, until = self.recorded.get() or (None, None)
        changed = False
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            at_us = row["ts_us"]
            if recorded is not None and recorded - self.ttl_us <= at_us <= recorded + self.ttl_us:
                continue
            if recorded is None or at_us > recorded:
                recorded, changed = at_us, True
            elif self.event_time:
                continue
            yield Row(**{c: row[c] for c in self.columns})
        if changed:
            if until is not None:
                self.handle.deleteTimer(until)
            start_us = recorded if self.event_time else timerValues.getCurrentProcessingTimeInMs() * 1000
            until = (start_us + self.ttl_us) // 1000 + 1
            self.recorded.update((recorded, until))
            self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.recorded.clear()
        return iter([])

    def close(self) -> None:
        pass


def dedup_within_watermark(stream: DataFrame, delay_s: float, by: Sequence[str] = KEYS, at: str = "ts") -> DataFrame:
    """Streaming best-effort dedup with state bounded by the watermark."""
    with_id = stream.filter(F.col(by[-1]).isNotNull())
    kept = with_id.withWatermark(at, f"{delay_s} seconds").dropDuplicatesWithinWatermark(list(by))
    return kept.unionByName(stream.filter(F.col(by[-1]).isNull()))


def upsert_batch(path: str, by: Sequence[str] = ("key",), order: Sequence[str] = ("ts_us", "part", "off")):
    """A ``foreachBatch`` function: each micro-batch adds its last write per key.

    A batch writes its own folder and overwrites it when it runs again, so a
    restart repeats nothing, and no batch rewrites the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, by, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_upserted(spark: SparkSession, path: str, by: Sequence[str] = ("key",),
                  order: Sequence[str] = ("ts_us", "part", "off")) -> DataFrame:
    """The current value per key over all batches written so far."""
    return latest_per_key(spark.read.parquet(path).drop("batch"), by, order)
