import random

import pytest
from pyspark.sql import functions as F

from keylane.operators import fairness as L
from keylane.operators import health as H
from keylane.operators.ordered import even_slices
from keylane.options import PipelineOptions

SCHEMA = "event_id bigint, topic string, part int, key string, demand string, start_us bigint, dur_ms bigint, end_us bigint"


def execs(spark, rows):
    """rows: (key, start ms, duration ms)."""
    return spark.createDataFrame(
        [(i, "t", 0, k, "normal", s * 1000, d, (s + d) * 1000) for i, (k, s, d) in enumerate(rows)], SCHEMA)


def random_rows(seed):
    rng = random.Random(seed)
    return [("hot" if i % 3 == 0 else rng.choice("abc"), rng.randrange(5000), rng.randrange(0, 400)) for i in range(200)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("many", [True, False])
def test_monopolization_matches_brute_force(spark, seed, many):
    rows, window = random_rows(seed), 700
    df = execs(spark, rows).repartition(3)
    options = PipelineOptions(monopolization_window=window / 1000, monopolization_threshold=0.5)
    cut = even_slices(df, "start_us", 9) if many else None
    doubled = even_slices(df.withColumn("s", F.col("start_us") * 2), "s", 9) if many else None
    started = {r["event_id"]: r["window_ms"] for r in L.monopolization(df, options, slices=doubled).collect()}
    clipped = {r["event_id"]: r["window_us"] for r in L.monopolization_clipped(df, options, slices=cut).collect()}
    for i, (key, start, _) in enumerate(rows):
        same = [(s, d) for k, s, d in rows if k == key]
        assert started[i] == sum(d for s, d in same if start - window <= s <= start)
        spent = sum(max(min(s + d, start) - max(s, start - window), 0) for s, d in same)
        assert clipped[i] == spent * 1000


def test_monopolization_threshold_is_exclusive(spark):
    df = execs(spark, [("a", 0, 270_000), ("b", 0, 270_001)])
    assert {r["key"]: r["verdict"] for r in L.monopolization(df).collect()} == {"a": "accepted", "b": "transient"}
    off = L.monopolization(df, PipelineOptions(monopolization_enabled=False))
    assert off.filter("rejected").count() == 0


@pytest.mark.parametrize("many", [True, False])
def test_in_flight_matches_brute_force(spark, many):
    rows = random_rows(3) + [("z", 100, 0), ("z", 100, 50), ("z", 150, 10)]
    df = execs(spark, rows)
    cut = even_slices(df.withColumn("s", F.col("start_us") * 2), "s", 9) if many else None
    got = sorted((r["at_us"], r["running"]) for r in H.in_flight(df, slices=cut).collect())
    expected = sorted((s * 1000, sum(1 for _, t, d in rows if t <= s < t + d)) for _, s, _ in rows)
    assert got == expected


def test_virtual_time_and_shares(spark):
    df = execs(spark, [("a", 0, 500), ("a", 600, 100), ("b", 700, 400)])
    assert [r["virtual_ms"] for r in L.virtual_time(df).orderBy("event_id").collect()] == [0, 500, 0]
    mixed = df.withColumn("demand", F.when(F.col("key") == "b", "failure").otherwise("normal"))
    got = {r["demand"]: (r["share"], r["over_budget"]) for r in L.class_share(mixed).collect()}
    assert got == {"normal": (0.6, False), "failure": (0.4, True)}


@pytest.mark.parametrize("demand", ["urgent", None])
def test_fair_order_fails_on_a_class_it_does_not_rank(spark, demand):
    queue = spark.createDataFrame([("a", "normal", 1, 1), ("b", demand, 2, 2)], "key string, demand string, ts_us long, event_id long")
    history = spark.createDataFrame([("a", "normal", 5)], "key string, demand string, dur_ms long")
    with pytest.raises(Exception, match="unknown demand"):
        L.fair_order(queue, history, 60_000_000).collect()


def test_fair_order_takes_heads_and_boosts_waiting_keys(spark):
    queue = spark.createDataFrame(
        [("normal", "busy", 0, 1), ("normal", "busy", 5, 2), ("normal", "idle", 50_000_000, 3), ("failure", "sick", 0, 4)],
        "demand string, key string, ts_us bigint, event_id bigint")
    history = execs(spark, [("busy", 0, 300_000)])
    soon = L.fair_order(queue, history, 60_000_000)
    assert [(r["event_id"], r["place"]) for r in soon.orderBy("demand", "place").collect()] == [(4, 1), (3, 1), (1, 2)]
    assert L.fair_order(queue, history, 60_000_000, k=1).count() == 2
    later = L.fair_order(queue, history, 60_000_000, options=PipelineOptions(scheduler_wait_weight=2000.0))
    assert later.filter("demand = 'normal' and place = 1").first()["key"] == "busy"


def test_hot_keys(spark):
    top = L.hot_keys(execs(spark, [("a", 0, 5), ("b", 0, 9), ("a", 9, 5)]), 1).first()
    assert (top["key"], top["spent_ms"], top["executions"]) == ("a", 10, 2)


def test_frontier(spark):
    df = spark.createDataFrame([("t", 0, 0, True), ("t", 0, 1, False), ("t", 0, 2, True), ("t", 1, 0, True),
                                ("t", 2, 0, False)], "topic string, part int, off bigint, done boolean")
    assert {r["part"]: r["frontier"] for r in H.commit_frontier(df).collect()} == {0: 0, 1: 0, 2: -1}


def test_stalls(spark):
    df = spark.createDataFrame([("t", 0, 0, 1), ("t", 0, 400_000_000, 2), ("t", 1, 100_000_000, 3)],
                               "topic string, part int, ts_us bigint, event_id bigint")
    got = {r["part"]: r["stalled"] for r in H.stalled_partitions(df, 400_000_001).collect()}
    assert got == {0: False, 1: True}
    assert not H.stalled_partitions(df, 400_000_000).filter("part = 1").first()["stalled"]
    assert H.is_stalled(df, 400_000_001).first()[0] and not H.is_stalled(df.limit(0), 5).first()[0]
    assert [r["gap_us"] for r in H.stall_gaps(df).collect()] == [400_000_000]
    assert tuple(H.assigned_partitions(df).first()) == (2, True)
    assert tuple(H.assigned_partitions(df.limit(0)).first()) == (0, False)


def test_limits(spark):
    df = execs(spark, [("a", 0, 10), ("b", 5, 10)])
    assert H.concurrency_peak(df, PipelineOptions(max_concurrency=1)).first()["over_limit"]
    assert not H.concurrency_peak(df, PipelineOptions(max_concurrency=2)).first()["over_limit"]
    assert [r["paused"] for r in H.backpressure(df, PipelineOptions(max_uncommitted=2)).orderBy("at_us").collect()] == [False, True]
