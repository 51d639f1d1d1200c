import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from keylane.operators import dedup as D

SCHEMA = "topic string, part int, off bigint, key string, id string, ts_us bigint"
S = 1_000_000


def messages(spark, rows):
    """rows: (off, key, id, second)."""
    return spark.createDataFrame([("t", 0, o, k, i, round(s * S)) for o, k, i, s in rows], SCHEMA)


def kept(df):
    return sorted(r["off"] for r in df.select("off").collect())


def test_same_id_and_key_is_processed_once(spark):
    df = messages(spark, [(0, "key1", "msg-123", 0), (1, "key1", "msg-123", 1), (2, "key2", "msg-123", 2)])
    assert kept(D.dedup(df)) == [0, 2]
    assert kept(D.dedup_consecutive(df)) == [0, 2]


def test_missing_and_empty_ids(spark):
    df = messages(spark, [(0, "a", None, 0), (1, "a", None, 1), (2, "a", "", 2), (3, "a", "", 3)])
    assert kept(D.dedup(df)) == [0, 1, 2]
    assert kept(D.dedup(df, ttl_s=60)) == [0, 1, 2]
    assert kept(D.dedup_consecutive(df)) == [0, 1, 2]


def test_cache_size_zero_disables(spark):
    df = messages(spark, [(0, "a", "x", 0), (1, "a", "x", 1)])
    assert kept(D.dedup(df, cache_size=0)) == [0, 1]
    assert kept(D.producer_dedup(df, cache_size=0)) == [0, 1]


def test_ttl_is_inclusive_and_not_refreshed(spark):
    df = messages(spark, [(0, "a", "x", 0), (1, "a", "x", 6), (2, "a", "x", 10), (3, "a", "x", 10.000001),
                          (4, "a", "x", 15), (5, "a", "x", 25)])
    assert kept(D.dedup(df, ttl_s=10)) == [0, 3, 5]


def test_ttl_longer_than_the_log(spark):
    df = messages(spark, [(0, "a", "x", 0), (1, "a", "x", 6), (2, "b", "x", 10)])
    assert kept(D.dedup(df, ttl_s=10)) == [0, 2]
    assert kept(D.dedup(df.limit(0), ttl_s=10)) == []


def greedy(rows, ttl):
    recorded, out = {}, []
    for off, key, id_, second in sorted(rows, key=lambda r: (r[3], r[0])):
        if id_ is None or (key, id_) not in recorded or second > recorded[key, id_] + ttl:
            out.append(off)
            recorded[key, id_] = second
    return sorted(out)


@pytest.mark.parametrize("seed, hot_from", [(1, 100_000), (2, 5)])
def test_ttl_matches_a_sequential_fold(spark, monkeypatch, seed, hot_from):
    """With hot groups (a third of the rows is one id) and without."""
    monkeypatch.setattr(D, "FOLD_ROWS", hot_from)
    rng = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice("abc"), "one" if i % 3 == 0 else rng.choice(["x", "y", "", None]),
             rng.randrange(200)) for i in range(240)]
    df = messages(spark, rows).repartition(5)
    once = D.dedup(df, ttl_s=31)
    assert kept(once) == greedy(rows, 31)
    assert kept(D.dedup(once, ttl_s=31)) == kept(once)
    assert once.columns == df.columns


def test_unbounded_is_idempotent(spark):
    rng = random.Random(5)
    df = messages(spark, [(i, rng.choice("ab"), rng.choice(["x", "y", None]), i) for i in range(60)])
    once = D.dedup(df)
    assert rows_of(D.dedup(once).fillna("-")) == rows_of(once.fillna("-"))


def test_ledger_versions_and_expiry(spark):
    old = messages(spark, [(0, "a", "x", 0), (1, "a", "y", 100)])
    new = messages(spark, [(2, "a", "x", 107), (3, "a", "y", 107), (4, "a", None, 107)])
    ledger = D.dedup_ledger(old, "1")
    assert kept(D.ledger_filter(new, ledger, 107 * S, ttl_s=107)) == [4]
    assert kept(D.ledger_filter(new, ledger, 107 * S, ttl_s=7)) == [2, 4]
    assert kept(D.ledger_filter(new, ledger, 107 * S, ttl_s=107, version="2")) == [2, 3, 4]


def test_offset_filter_past_the_broadcast_bound(spark):
    df = messages(spark, [(i, "a", None, i) for i in range(5)])
    done = D.processed_offsets(df.filter("off <= 2"))
    assert kept(D.offset_filter(df, done)) == [3, 4]
    assert kept(D.offset_filter(df, done, max_partitions=0)) == [3, 4]
    assert kept(D.offset_filter(df, done.limit(0))) == [0, 1, 2, 3, 4]


def test_latest_per_key(spark):
    df = messages(spark, [(0, "a", "x", 5), (1, "a", "y", 5), (2, "a", "z", 4), (3, "b", None, 1)])
    latest = D.latest_per_key(df)
    assert kept(latest) == [1, 3]
    assert kept(D.latest_per_key(latest.union(df))) == [1, 3]
    assert latest.filter(F.col("key") == "b").first()["id"] is None


def test_null_keys_are_a_key_like_any_other(spark):
    day = 86_400_000_000
    rows = [("t", key, "x", 0, i, i * day) for key in (None, "a") for i in range(12)] + [(None, None, "x", 0, 99, 0)]
    df = spark.createDataFrame(rows, "topic string, key string, id string, part int, off long, ts_us long")
    kept = D.dedup(df, ttl_s=5 * 86_400)
    assert sorted((r["topic"] or "", r["key"] or "", r["off"]) for r in kept.collect()) == [
        ("", "", 99), ("t", "", 0), ("t", "", 6), ("t", "a", 0), ("t", "a", 6)]


def test_ledger_knows_null_keys(spark):
    df = spark.createDataFrame([("t", None, "x", 0, 0), ("t", "a", "x", 0, 0), ("t", None, "y", 0, 0)],
                               "topic string, key string, id string, off long, ts_us long")
    ledger = D.dedup_ledger(df.filter("id = 'x'"))
    assert [r["id"] for r in D.ledger_filter(df, ledger, 1).collect()] == ["y"]


def test_a_short_ttl_takes_few_jobs(spark, monkeypatch):
    """Thousands of ttl-long slices, a third of the rows in one group: rounds follow the kept rows' logarithm."""
    monkeypatch.setattr(D, "FOLD_ROWS", 50)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}", "x", i * 1000) for i in range(1500)]
    df = messages(spark, rows)
    spark.sparkContext.setJobGroup("short-ttl", "dedup")
    found = kept(D.dedup(df, ttl_s=60))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("short-ttl"))
    spark.sparkContext.setJobGroup("", "")
    assert found == greedy(rows, 60)
    assert jobs < 250


def test_rows_that_stay_in_batches_of_any_size():
    import numpy as np

    from keylane.operators.dedup import _kept

    rng = random.Random(4)
    for _ in range(300):
        groups = [sorted(rng.randrange(60) for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 5))]
        times = np.array([t for g in groups for t in g])
        new = np.array([i == 0 for g in groups for i in range(len(g))])
        ttl, expected = rng.randrange(12), []
        for g in groups:
            last = None
            for t in g:
                expected.append(last is None or t > last + ttl)
                last = t if expected[-1] else last
        got, recorded, low = [], 0, 0
        while low < len(times):
            high = min(len(times), low + rng.randrange(1, 9))
            keep, recorded = _kept(times[low:high], new[low:high], recorded, ttl)
            got += keep.tolist()
            low = high
        assert got == expected
