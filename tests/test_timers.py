import random

import pytest

from keylane.operators import timers as T
from keylane.operators.ordered import even_slices

SCHEMA = "key string, seq bigint, ts_us bigint, op string, at_s bigint"
S = 1_000_000


def log(spark, rows):
    """rows: (key, second of the operation, op, instant)."""
    return spark.createDataFrame([(k, i, round(t * S), op, at) for i, (k, t, op, at) in enumerate(rows)], SCHEMA)


def simulate(rows, now):
    """Operations one after the other; what is due by then has fired before."""
    fired, sets = set(), {}

    def fire(key, until):
        due = {s for s in sets.setdefault(key, set()) if s <= until}
        sets[key] -= due
        fired.update((key, s) for s in due)

    for key, at, op, instant in sorted(rows, key=lambda r: r[1]):
        fire(key, at)
        if op in T.CLEARING:
            sets[key].clear()
        if op in T.SCHEDULING:
            sets[key].add(instant)
        if op == "unschedule":
            sets[key].discard(instant)
    for key in list(sets):
        fire(key, now)
    return fired, {(k, s) for k, pending in sets.items() for s in pending}


def pairs(df):
    return {(r["key"], r["fire_s"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("slice_rows", [7, None])
def test_matches_a_simulation(spark, seed, slice_rows):
    rng = random.Random(seed)
    times = sorted(rng.sample(range(1000), 240))
    rows = []
    for i, t in enumerate(times):
        op = rng.choice(["schedule", "schedule", "unschedule", "clear_and_schedule", "clear_scheduled"])
        instant = None if op == "clear_scheduled" else t + rng.randrange(-5, 60)
        rows.append(("hot" if i % 3 == 0 else rng.choice("abc"), t, op, instant))
    ops = log(spark, rows).repartition(4)
    slices = None if slice_rows is None else even_slices(ops, "ts_us", slice_rows)
    fired, pending = simulate(rows, 990)
    assert pairs(T.timer_firings(ops, 990 * S, slices)) == fired
    assert pairs(T.pending_timers(ops, 990 * S, slices)) == pending


def test_context_operations(spark):
    """One key per action: 3, 1, 1, 0 and 0 timers remain."""
    rows = [("schedule", 0, "schedule", s) for s in (30, 60, 90)]
    rows += [("unschedule", 0, "schedule", 40), ("unschedule", 0, "schedule", 80), ("unschedule", 1, "unschedule", 40)]
    rows += [("replace", 0, "schedule", 50), ("replace", 0, "schedule", 100), ("replace", 1, "clear_and_schedule", 150)]
    rows += [("clear", 0, "schedule", 70), ("clear", 0, "schedule", 140), ("clear", 1, "clear_scheduled", None)]
    rows += [("nothing", 0, "clear_scheduled", None)]
    counts = {r["key"]: r["pending"] for r in T.scheduled_counts(log(spark, rows), 2 * S).collect()}
    assert counts == {"schedule": 3, "unschedule": 1, "replace": 1, "clear": 0, "nothing": 0}


def test_removal_at_the_due_time_comes_too_late(spark):
    ops = log(spark, [("a", 0, "schedule", 5), ("a", 5, "clear_scheduled", None),
                      ("b", 0, "schedule", 5), ("b", 5, "unschedule", 5),
                      ("c", 0, "schedule", 5), ("c", 4.999999, "unschedule", 5),
                      ("d", 0, "schedule", 5), ("d", 1, "schedule", 5),
                      ("e", 0, "unschedule", 9), ("e", 1, "schedule", 9)])
    assert pairs(T.timer_firings(ops, 9 * S)) == {("a", 5), ("b", 5), ("d", 5), ("e", 9)}


def test_accuracy(spark):
    fired = spark.createDataFrame([("a", 1, 1 * S), ("a", 2, 3 * S), ("a", 3, 2_999_999)],
                                  "key string, fire_s bigint, fired_us bigint")
    got = {r["fire_s"]: (r["late_us"], r["on_time"], r["in_order"]) for r in T.timer_accuracy(fired).collect()}
    assert got == {1: (0, True, True), 2: (S, True, True), 3: (-1, True, False)}


def test_slabs(spark):
    timers = spark.createDataFrame([("a", 3599), ("a", 3600), ("b", 7199)], "key string, fire_s bigint")
    assert sorted(tuple(r) for r in T.timer_slabs(timers).collect()) == [(0, 1, 3599, 3599), (1, 2, 3600, 7199)]
