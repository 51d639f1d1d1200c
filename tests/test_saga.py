import random

import pytest

from keylane.operators.ordered import by_number
from keylane.operators.saga import state_machine

STEPS = [("new", "pay", "paid"), ("paid", "ship", "sent"), ("sent", "pay", "new"), ("paid", "note", "paid")]


def fold(rows):
    state, out, moves = {}, [], {(s, e): t for s, e, t in STEPS}
    for off, key, event in sorted(rows):
        now = state.get(key, "new")
        state[key] = moves.get((now, event), now)
        out.append((off, now, state[key], (now, event) in moves))
    return out


@pytest.mark.parametrize("slice_rows", [1000, 7])
def test_matches_a_sequential_fold(spark, slice_rows):
    rng = random.Random(4)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice("abcd"), rng.choice(["pay", "ship", "note", "other", None]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "off bigint, key string, type string").repartition(6)
    got = state_machine(df, STEPS, "new", slice_by=by_number("off", slice_rows))
    assert got.columns == ["off", "key", "type", "from_state", "to_state", "applied"]
    found = sorted((r["off"], r["from_state"], r["to_state"], r["applied"]) for r in got.collect())
    assert found == fold(rows)


def test_a_repeated_step_changes_nothing(spark):
    df = spark.createDataFrame([(0, "a", "pay"), (1, "a", "pay"), (2, "a", "ship")], "off bigint, key string, type string")
    got = [(r["off"], r["to_state"], r["applied"]) for r in state_machine(df, STEPS, "new").collect()]
    assert sorted(got) == [(0, "paid", True), (1, "paid", False), (2, "sent", True)]
