"""Work per key, in order: the handler surface in batch, and checks of order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keylane.functions.scalars import message_task_id
from keylane.handlers import EventHandler, Message, ReplayContext, Timer, attempt, instant
from keylane.operators.ordered import Running, Slices, by_number, previous, row_position, running

PARTITION_KEY = ("topic", "part", "key")


def process(
    df: DataFrame, handler: Callable[[], EventHandler], payload: str = "payload", *, independent: bool = False,
    until_us: int | None = None,
) -> DataFrame:
    """Call ``handler().on_message`` once per message, serially and in order per key.

    ``payload`` names a column of JSON text. One handler is made per task. Rows
    stream through sorted, so a hot key is never held in memory, but its calls
    run one after the other, as the contract says. Timers that the handler sets
    follow the messages' time: what is due by a message's time fires before it,
    and what is due by ``until_us`` after the key's last message; the results
    of ``on_timer`` are rows with a ``fire_s``. A handler whose calls do not
    depend on each other may give all that up with ``independent``: then rows
    are handled where they are, without a shuffle, and a hot key costs nothing.
    """
    rows = df.select("topic", "part", "off", "key", "ts_us", F.col(payload).alias("payload"))
    if not independent:
        rows = rows.repartition("key").sortWithinPartitions("key", "topic", "part", "off")
    return rows.mapInArrow(
        _handled(handler, not independent, until_us),
        "topic string, part int, off bigint, key string, outcome string, error_class string, "
        "error_message string, error_cause string, fire_s bigint",
    )


RESULT = ["topic", "part", "off", "key", "outcome", "error_class", "error_message", "error_cause", "fire_s"]
RESULT_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]


def _handled(make: Callable[[], EventHandler], keyed: bool, until_us: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handler = make()
        now_key, timers = None, set()
        out: list[tuple] = []

        def fire(by_us: int | None) -> None:
            """Fire what is due, in order; a timer may set another one that is due as well."""
            while by_us is not None and timers and (second := min(timers)) * 1_000_000 <= by_us:
                timers.remove(second)
                at_us = second * 1_000_000
                result = attempt(handler.on_timer, ReplayContext(now_key, at_us, timers), Timer(now_key, instant(at_us)))
                out.append((None, None, None, now_key, *result, second))

        def results() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(RESULT)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, RESULT_TYPES)], names=RESULT)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("topic", "part", "off", "key", "ts_us", "payload")]
            for topic, part, off, key, ts_us, text in zip(*columns):
                if keyed and key != now_key:
                    fire(until_us)
                    timers.clear()
                now_key = key
                fire(ts_us)
                context = ReplayContext(key, ts_us, timers if keyed else None)
                result = attempt(handler.on_message, context, Message(topic, part, off, key, ts_us, text))
                out.append((topic, part, off, key, *result, None))
            yield results()
        fire(until_us)
        yield results()

    return run


def result_once(results: DataFrame, task: str = "task_id", order: Sequence[str] = ("completed_us",)) -> DataFrame:
    """The first result of a task wins; later ones are discarded."""
    rest = [c for c in results.columns if c != task]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return results.groupBy(task).agg(first).select(task, *[F.col(f"_first.{c}") for c in rest])


def sequence_per_key(df: DataFrame, by: Sequence[str] = PARTITION_KEY, order: str = "off",
                     slice_by: Column | None = None, name: str = "position") -> DataFrame:
    """Position of a message within its key, from 1.

    A key lives in one partition, so (topic, part, key) in offset order is the
    key's order.
    """
    return row_position(df, by, [order], _offset_slices(order, slice_by), name)


def ordering_violations(df: DataFrame, sequence: str, by: Sequence[str] = PARTITION_KEY, order: str = "off",
                        slice_by: Column | None = None) -> DataFrame:
    """Messages whose own sequence is below that of the message before them."""
    near = previous(df, by, [order], _offset_slices(order, slice_by), {"previous_sequence": sequence})
    return near.filter(F.col(sequence) < F.col("previous_sequence"))


def overlap_violations(execs: DataFrame, by: Sequence[str] = ("key",), order: Sequence[str] = ("start_us", "event_id"),
                       slices: Slices | None = None) -> DataFrame:
    """Executions that start while an earlier one of the same key still runs."""
    swept = running(execs, by, order, slices, {"busy_until_us": Running("max", F.col("end_us"))})
    return swept.filter(F.col("busy_until_us") > F.col("start_us"))


def group_messages_by_key(df: DataFrame, values: Sequence[str], by: Sequence[str] = PARTITION_KEY, order: str = "off",
                          page_rows: int = 1000, slice_by: Column | None = None) -> DataFrame:
    """The messages of each key in order, in pages of at most ``page_rows``.

    All pages together hold every message; a key with more than one page never
    becomes a single row.
    """
    placed = sequence_per_key(df, by, order, slice_by, "_position")
    paged = placed.withColumn("page", F.floor((F.col("_position") - 1) / F.lit(page_rows)).cast("bigint"))
    listed = F.array_sort(F.collect_list(F.struct(order, *values))).alias("messages")
    return paged.groupBy(*by, "page").agg(listed)


def task_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("task_id", message_task_id(F.col("topic"), F.col("part"), F.col("off")))


def _offset_slices(order: str, slice_by: Column | None) -> Column:
    return by_number(order) if slice_by is None else slice_by
