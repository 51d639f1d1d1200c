"""A per-key state machine advanced by messages, in order.

A step depends on all steps before it, but a finite machine makes that work
parallel: a run of messages acts on the states as one function, and functions
compose. So each ``(key, slice)`` is reduced to the function it applies, the
few functions of a key are applied in order to find the state each slice
starts in, and then every slice is replayed on its own. A hot key spreads over
as many tasks as it has slices. Rows stream through in sorted order, so no
group is held in memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keylane.operators.ordered import SLICE, by_number

Transition = tuple[str, str, str]


class Machine:
    """A transition list as arrays: ``target[event][state]`` and ``legal[event][state]``."""

    def __init__(self, transitions: Sequence[Transition], initial: str):
        self.states = sorted({initial, *[s for s, _, _ in transitions], *[t for _, _, t in transitions]})
        events = sorted({e for _, e, _ in transitions})
        self.code = {e: i for i, e in enumerate(events)}
        self.unknown = len(events)
        number = {s: i for i, s in enumerate(self.states)}
        self.initial = number[initial]
        # an event that is not listed moves no state
        self.target = [list(range(len(self.states))) for _ in range(len(events) + 1)]
        self.legal = [[False] * len(self.states) for _ in range(len(events) + 1)]
        for state, event, result in transitions:
            self.target[self.code[event]][number[state]] = number[result]
            self.legal[self.code[event]][number[state]] = True

    def codes(self, events: pa.Array) -> list[int]:
        return [self.code.get(e, self.unknown) for e in events.to_pylist()]


def state_machine(
    df: DataFrame,
    transitions: Sequence[Transition],
    initial: str,
    *,
    by: str = "key",
    order: str = "off",
    event: str = "type",
    slice_by: Column | None = None,
) -> DataFrame:
    """Add ``from_state``, ``to_state`` and ``applied`` to every message.

    A message without a transition from the current state (illegal, or a step
    taken before) changes nothing and is not ``applied``.
    """
    machine = Machine(transitions, initial)
    rows = df.withColumn(SLICE, by_number(order) if slice_by is None else slice_by)
    runs = (
        rows.select(by, SLICE, order, event)
        .repartition(by, SLICE)
        .sortWithinPartitions(by, SLICE, order)
        .mapInArrow(_compose(machine, by, event), f"`{by}` string, {SLICE} bigint, _applies array<int>")
    )
    starts = (
        runs.repartition(by)
        .sortWithinPartitions(by, SLICE)
        .mapInArrow(_starts(machine, by), f"`{by}` string, {SLICE} bigint, _start int")
    )
    # a slice's start state travels as a row ahead of its messages: no join, one shuffle
    staged = rows.withColumn("_start", F.lit(None).cast("int")).unionByName(starts, allowMissingColumns=True)
    replayed = staged.repartition(by, SLICE).sortWithinPartitions(
        F.col(by), F.col(SLICE), F.col("_start").desc_nulls_last(), F.col(order)
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return replayed.mapInArrow(
        _replay(machine, by, event, df.columns), f"{fields}, from_state string, to_state string, applied boolean"
    )


def _compose(machine: Machine, by: str, event: str):
    size = len(machine.states)

    def emit(done):
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.list_(pa.int32()))],
            names=[by, SLICE, "_applies"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, applies = None, None
        for batch in batches:
            done = []
            groups = zip(batch[by].to_pylist(), batch[SLICE].to_pylist())
            for found, code in zip(groups, machine.codes(batch[event])):
                if found != group:
                    if group is not None:
                        done.append((*group, applies))
                    group, applies = found, list(range(size))
                target = machine.target[code]
                applies = [target[s] for s in applies]
            if done:
                yield emit(done)
        if group is not None:
            yield emit([(*group, applies)])

    return run


def _starts(machine: Machine, by: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, machine.initial
        for batch in batches:
            starts = []
            for found, applies in zip(batch[by].to_pylist(), batch["_applies"].to_pylist()):
                if found != key:
                    key, state = found, machine.initial
                starts.append(state)
                state = applies[state]
            yield pa.RecordBatch.from_arrays(
                [batch[by], batch[SLICE], pa.array(starts, pa.int32())], names=[by, SLICE, "_start"]
            )

    return run


def _replay(machine: Machine, by: str, event: str, columns: list[str]):
    names = machine.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = machine.initial
        for batch in batches:
            before, after, legal = [], [], []
            starts = batch["_start"].to_pylist()
            for start, code in zip(starts, machine.codes(batch[event])):
                if start is not None:
                    state = start
                    continue
                before.append(names[state])
                legal.append(machine.legal[code][state])
                state = machine.target[code][state]
                after.append(names[state])
            rows = batch.filter(batch["_start"].is_null())
            yield pa.RecordBatch.from_arrays(
                [*[rows[c] for c in columns], pa.array(before, pa.string()), pa.array(after, pa.string()),
                 pa.array(legal, pa.bool_())],
                names=[*columns, "from_state", "to_state", "applied"],
            )

    return run
