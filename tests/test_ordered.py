"""Two-level windows against brute force, with many slices and a hot group."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from keylane.operators.ordered import (
    Running, Slices, by_number, even_slices, following, previous, row_position, running, sliding_sum,
)


def sample(seed, n=300, span=500):
    """Rows (id, key, t, v); key "hot" has a third of them, and times repeat."""
    rng = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(9)}", rng.randrange(span),
             rng.choice([None, rng.randrange(-9, 9)])) for i in range(n)]
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return sample(request.param)


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, key string, t bigint, v int")


def grouped(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


def test_even_slices_bound_the_rows(frame):
    slices = even_slices(frame, "t", rows=20)
    assert len(slices.bounds) >= 10
    largest = slices.add(frame, "t").groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert largest <= 40
    assert even_slices(frame, "t").bounds == ()


def test_even_slices_cut_a_burst(spark):
    burst = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.col("id") * 1_000_000)
                                      .otherwise(5_000_000 + F.col("id"))).alias("t"))
    slices = even_slices(burst, "t", rows=100)
    assert slices.add(burst, "t").groupBy("_slice").count().agg(F.max("count")).first()[0] <= 200


@pytest.mark.parametrize("slicing", ["number", "even", "one"])
def test_running_before(frame, rows, slicing):
    cut = {"number": by_number("t", 17), "even": even_slices(frame, "t", 11), "one": Slices(())}[slicing]
    got = running(frame, ["key"], ["t", "id"], cut, {
        "total": Running("sum", F.col("v")), "low": Running("min", F.col("v")),
        "high": Running("max", F.col("v")), "recent": Running("last", F.col("v")),
    }).select("id", "total", "low", "high", "recent")
    expected = []
    for group in grouped(rows).values():
        seen = []
        for row in group:
            known = [v for v in seen if v is not None]
            expected.append((row[0], sum(known), min(known, default=None), max(known, default=None),
                             known[-1] if known else None))
            seen.append(row[3])
    assert rows_of(got) == sorted(expected)


def test_running_reverse(frame, rows):
    got = running(frame, ["key"], ["t", "id"], by_number("t", 13), {"low": Running("min", F.col("v"))}, reverse=True)
    expected = []
    for group in grouped(rows).values():
        for i, row in enumerate(group):
            expected.append((row[0], min((r[3] for r in group[i + 1:] if r[3] is not None), default=None)))
    assert rows_of(got.select("id", "low")) == sorted(expected)


def test_neighbours_see_null_values(frame, rows):
    before = previous(frame, ["key"], ["t", "id"], by_number("t", 13), {"p": "v", "pid": "id"})
    after = following(frame, ["key"], ["t", "id"], even_slices(frame, "t", 13), {"n": "v", "nid": "id"})
    exp_before, exp_after = [], []
    for group in grouped(rows).values():
        for i, row in enumerate(group):
            b = group[i - 1] if i else (None,) * 4
            a = group[i + 1] if i + 1 < len(group) else (None,) * 4
            exp_before.append((row[0], b[3], b[0]))
            exp_after.append((row[0], a[3], a[0]))
    assert rows_of(before.select("id", "p", "pid")) == sorted(exp_before)
    assert rows_of(after.select("id", "n", "nid")) == sorted(exp_after)


def test_row_position(frame, rows):
    got = row_position(frame, ["key"], ["t", "id"], by_number("t", 29), "n").select("id", "n")
    expected = [(r[0], i + 1) for g in grouped(rows).values() for i, r in enumerate(g)]
    assert rows_of(got) == sorted(expected)


@pytest.mark.parametrize("width", [0, 7, 100])
@pytest.mark.parametrize("many", [True, False])
def test_sliding_sum(frame, rows, width, many):
    doubled = even_slices(frame.withColumn("s", F.col("t") * 2), "s", 9) if many else None
    got = sliding_sum(frame, ["key"], "t", width, {"n": F.lit(1), "total": F.coalesce("v", F.lit(0))}, doubled)
    expected = []
    for group in grouped(rows).values():
        for row in group:
            near = [r for r in group if row[2] - width <= r[2] <= row[2]]
            expected.append((row[0], len(near), sum(r[3] or 0 for r in near)))
    assert rows_of(got.select("id", "n", "total")) == sorted(expected)


def test_rows_with_a_null_key_are_one_group_in_any_number_of_slices(spark):
    df = spark.createDataFrame([(None if i % 3 else "a", None if i % 2 else 1, i) for i in range(60)], "g string, h int, t long")
    found = []
    for rows in (1000, 7):
        placed = row_position(df, ["g", "h"], ["t"], even_slices(df, "t", rows), "n")
        found.append(sorted((r["t"], r["n"]) for r in placed.collect()))
    assert found[0] == found[1]
    assert max(n for _, n in found[0]) == 20


def crowded(n=400, seed=7):
    """Three quarters of the rows at one instant, a few more at another."""
    rng = random.Random(seed)
    return [(i, rng.choice(["hot", "hot", "k1", None]), 500 if i % 4 else (700 if i % 8 else rng.randrange(1000)),
             rng.choice([None, rng.randrange(-9, 9)])) for i in range(n)]


def test_an_instant_with_most_rows_is_cut_by_ties(spark):
    frame = spark.createDataFrame(crowded(), "id int, key string, t bigint, v int")
    slices = even_slices(frame, "t", rows=20, tie="id")
    assert 500.0 in slices.hot and slices.fine
    sizes = [r["count"] for r in slices.add(frame, "t", "id").groupBy("_slice").count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == 400
    order = slices.add(frame, "t", "id").orderBy("t", "id").select("_slice").collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)


def test_slices_beyond_the_first_cuts(spark, monkeypatch):
    monkeypatch.setattr("keylane.operators.ordered.MAX_SLICES", 5)
    frame = spark.range(400).selectExpr("id", "id * id as t")
    slices = even_slices(frame, "t", rows=20)
    sizes = [r["count"] for r in slices.add(frame, "t").groupBy("_slice").count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == 400


@pytest.mark.parametrize("most", [5, 10_000])
def test_running_with_a_crowded_instant(spark, monkeypatch, most):
    monkeypatch.setattr("keylane.operators.ordered.SLICE_ROWS", 20)
    monkeypatch.setattr("keylane.operators.ordered.MAX_SLICES", most)
    rows = crowded()
    frame = spark.createDataFrame(rows, "id int, key string, t bigint, v int")
    aggregates = {"total": Running("sum", F.col("v")), "high": Running("max", F.col("v"))}
    got = {r["id"]: (r["total"], r["high"], r["recent"]) for r in running(
        frame, ["key"], ["t", "id"], None, {**aggregates, "recent": Running("last", F.col("v"))}).collect()}
    alike = {r["id"]: (r["total"], r["high"]) for r in running(frame, ["key"], ["t"], None, aggregates, peers=True).collect()}
    for i, key, t, _ in rows:
        same = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        before = [r[3] for r in same if (r[2], r[0]) < (t, i) and r[3] is not None]
        until = [r[3] for r in same if r[2] <= t and r[3] is not None]
        assert got[i] == (sum(before), max(before, default=None), before[-1] if before else None)
        assert alike[i] == (sum(until), max(until, default=None))


def test_sliding_sums_over_a_crowded_instant(spark, monkeypatch):
    monkeypatch.setattr("keylane.operators.ordered.SLICE_ROWS", 20)
    rows = crowded()
    frame = spark.createDataFrame(rows, "id int, key string, t bigint, v int")
    got = {r["id"]: r["n"] for r in sliding_sum(frame, ["key"], "t", 100, {"n": F.lit(1)}).collect()}
    for i, key, t, _ in rows:
        assert got[i] == sum(1 for r in rows if r[1] == key and t - 100 <= r[2] <= t)
