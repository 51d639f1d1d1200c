"""The per-key state machine on a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keylane.operators.saga import Transition
from keylane.session import ensure_state_store
from keylane.streaming.buckets import BUCKETS, transform_in_buckets


def state_machine_stream(
    messages: DataFrame,
    transitions: Sequence[Transition],
    initial: str,
    *,
    by: str = "key",
    order: str = "off",
    event: str = "type",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming form of the state machine: one state per key, kept for good, in ``buckets`` buckets of keys."""
    ensure_state_store(messages.sparkSession)
    added = [("from_state", T.StringType()), ("to_state", T.StringType()), ("applied", T.BooleanType())]
    schema = T.StructType([*messages.schema.fields, *[T.StructField(n, t) for n, t in added]])
    moves = {(state, step): target for state, step, target in transitions}
    return transform_in_buckets(messages, [by], Steps(moves, initial, order, event, messages.columns), schema, "None", buckets)


class Steps(StatefulProcessor):
    """Applies the messages of a key in order; a step without a transition is ignored."""

    def __init__(self, moves: dict[tuple[str, str], str], initial: str, order: str, event: str, columns: list[str]):
        self.moves, self.initial = moves, initial
        self.order, self.event, self.columns = order, event, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "state string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.state.get()
        before = now = self.initial if found is None else found[0]
        for row in sorted(rows, key=lambda r: r[self.order]):
            target = self.moves.get((now, row[self.event]))
            values = {c: row[c] for c in self.columns}
            yield Row(**values, from_state=now, to_state=target or now, applied=target is not None)
            now = target or now
        if now != before:
            self.state.update((now,))

    def close(self) -> None:
        pass
