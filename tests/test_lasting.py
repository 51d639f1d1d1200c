"""Compacted upserts, the ledger and replays by ranges: repeated batches, crashes, and what is read."""

import json
import random

import pytest
from pyspark.sql import functions as F

from keylane.sources.messages import reload
from keylane.sources.replay import few_ranges, kafka_offsets, reload_ranges, replay_ranges
from keylane.streaming.tables import Ledger, UpsertTable

SCHEMA = "key string, ts_us bigint, part int, off bigint, v int"


def batches(n, size=12, keys=20, seed=1):
    rng = random.Random(seed)
    return [[(rng.choice([None, *(f"k{i}" for i in range(keys))]), b * 100 + i, 0, b * 100 + i, rng.randrange(99)) for i in range(size)] for b in range(n)]


def latest(rows):
    last = {}
    for r in sorted(rows, key=lambda r: r[1:4]):
        last[r[0]] = r
    return sorted(last.values(), key=str)


def held(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def test_upserts_are_merged_in_levels(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), fan=2)
    assert table.read() is None
    rows, most = [], 0
    for number, batch in enumerate(batches(9)):
        rows += batch
        table.write(spark.createDataFrame(batch, SCHEMA), number)
        most = max(most, len(table.manifest()[1]))
        if number in (0, 3, 8):
            assert held(table) == latest(rows)
    assert most <= 4  # one folder a level, whatever the number of batches
    kept = {p.name for p in (tmp_path / "t" / "data").iterdir() if p.is_dir()}
    assert set(table.manifest()[1]) <= kept and len(kept) <= most + 4


def test_upserts_survive_a_crash_between_merge_and_switch(spark, tmp_path, monkeypatch):
    table = UpsertTable(spark, str(tmp_path / "t"), fan=2)
    first, second, third = batches(3)
    table.write(spark.createDataFrame(first, SCHEMA), 0)
    switch, calls = table._switch, []

    def crash(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("crash")
        return switch(*args)

    monkeypatch.setattr(table, "_switch", crash)
    with pytest.raises(OSError):
        table.write(spark.createDataFrame(second, SCHEMA), 1)
    again = UpsertTable(spark, str(tmp_path / "t"), fan=2)
    assert held(again) == latest(first + second)
    again.write(spark.createDataFrame(second, SCHEMA), 1)  # the stream repeats the batch
    again.write(spark.createDataFrame(third, SCHEMA), 2)
    assert held(again) == latest(first + second + third)


def test_an_unfinished_manifest_does_not_count(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"))
    table.write(spark.createDataFrame(batches(1)[0], SCHEMA), 0)
    (tmp_path / "t" / "manifest" / "version=7").mkdir()
    assert table.manifest()[0] == 0 and held(table) == latest(batches(1)[0])


SEEN = "topic string, key string, id string, ts_us bigint, n bigint"


def test_ledger_over_batches_and_repeats(spark, tmp_path):
    ttl, rng = 10, random.Random(2)
    rows = [("t", rng.choice([None, "a", "b"]), rng.choice([None, "", "x", "y", "z"]), 1_000_000 * i, i) for i in range(120)]
    recorded, expected = {}, []
    for row in rows:
        _, key, id_, at, n = row
        if id_ is None:
            expected.append(n)
        elif at > recorded.get((key, id_), -10**18) + ttl * 1_000_000:
            recorded[key, id_] = at
            expected.append(n)
    ledger = Ledger(spark, str(tmp_path / "ledger"), ttl, buckets=4)
    write = ledger.batch(str(tmp_path / "out"), ("n",))
    for number in range(4):
        frame = spark.createDataFrame(rows[number * 30: number * 30 + 30], SEEN)
        write(frame, number)
        if number % 2:
            write(frame, number)  # a crash before the commit repeats the batch
    got = spark.read.parquet(str(tmp_path / "out")).select("n").collect()
    assert sorted(r["n"] for r in got) == sorted(expected)
    write(spark.createDataFrame([], SEEN), 4)
    other = Ledger(spark, str(tmp_path / "ledger"), ttl, version="2", buckets=4)
    assert other.admit(spark.createDataFrame([rows[-1][:2] + ("x",) + rows[-1][3:]], SEEN), 9, ("n",)).count() == 1


def test_ledger_reads_touched_buckets_and_live_days(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), 2 * 86_400, buckets=16)
    day = 86_400_000_000
    rows = [("t", "k", f"id{i}", (i % 10) * day, i) for i in range(400)]
    ledger.append(spark.createDataFrame(rows, SEEN), 0)
    entries = ledger.entries(1, 7 * day, [3])
    files = {tuple(p.split("/")[-3:-1]) for p in entries.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert files == {(f"day={d}", "bucket=3") for d in (7, 8, 9)}
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    ledger.forget(9 * day)
    left = {int(p.name.removeprefix("day=")) for p in (tmp_path / "ledger" / "batch=0").iterdir() if p.name.startswith("day=")}
    assert left == {7, 8, 9}


PLACES = "topic string, part int, off bigint"


@pytest.mark.parametrize("gap", [1, 5, 40])
def test_ranges_against_brute_force(spark, gap, monkeypatch):
    monkeypatch.setattr("keylane.operators.ordered.SLICE_ROWS", 16)
    rng = random.Random(gap)
    rows = [(rng.choice(["a", "b"]), rng.choice([0, 1, None]), rng.choice([None, rng.randrange(300)])) for _ in range(150)]
    expected = set()
    for topic, part in {r[:2] for r in rows}:
        offsets = sorted({r[2] for r in rows if r[:2] == (topic, part) and r[2] is not None})
        runs = []
        for off in offsets:
            if runs and off - runs[-1][-1] <= gap:
                runs[-1].append(off)
            else:
                runs.append([off])
        expected |= {(topic, part, r[0], r[-1], len(r)) for r in runs}
    got = replay_ranges(spark.createDataFrame(rows, PLACES), gap).select("topic", "part", "first_off", "last_off", "wanted").collect()
    assert {tuple(r) for r in got} == expected


def test_few_ranges_hold_all_offsets(spark):
    rows = [("t", p, i * 1000) for p in range(3) for i in range(50)]
    deferred = spark.createDataFrame(rows, PLACES)
    assert len(few_ranges(deferred, gap=1, most=200)) == 150
    few = few_ranges(deferred, gap=1, most=20)
    assert len(few) == 3
    assert len(few_ranges(deferred, gap=1, most=2)) == 3  # never fewer than the partitions
    first, last = map(json.loads, kafka_offsets(few))
    assert first == {"t": {"0": 0, "1": 0, "2": 0}} and last == {"t": {str(p): 49_001 for p in range(3)}}


def test_reload_by_ranges_reads_little_and_gives_the_same(spark, tmp_path):
    log = spark.range(40_000).selectExpr("'t' AS topic", "int(id % 4) AS part", "id div 4 AS off", "id AS event_id").filter("event_id % 13 <> 0")
    log.repartitionByRange(16, "part", "off").sortWithinPartitions("part", "off").write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    wanted = [("t", 1, o) for o in (100, 101, 120, 7000)] + [("t", 3, 50), ("t", 9, 1), ("u", 1, 100), ("t", 1, None), ("t", 1, 100)]
    deferred = spark.createDataFrame(wanted, PLACES)
    ranged = reload_ranges(deferred, stored, gap=30)
    assert sorted(map(str, ranged.collect())) == sorted(map(str, reload(deferred, stored).collect()))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(off" in plan.split("PushedFilters")[1]
    nothing = reload_ranges(deferred.limit(0), stored)
    assert nothing.count() == 0
