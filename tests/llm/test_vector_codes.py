"""Vector codes against the method as it is worded, in plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keylane.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, sha) of each kept row, and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    width = max(1, -(-max(len(r[1]) for r in kept) // parts))
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, list(map(float, kept[i][1]))))
    cut = [[w[p * width: (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        away = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return min(range(len(book)), key=lambda e: (away[e], e)), min(away)

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for c in cut:
                held[nearest(c[p], books[p])[0]].append(c[p])
            books[p] = [[sum(x[j] for x in h) // len(h) for j in range(width)] if h else e for h, e in zip(held, books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [min(sum(d for _, d in f), 2**63 - 1) for f in found]
    total = {}
    for r, e in zip(kept, errors):
        total[r[2]] = total.get(r[2], 0) + e
    return sorted(((r[0], "".join(f"{e:02x}" for e, _ in f), x, min(total[r[2]], 2**63 - 1), sha)
                   for r, f, x in zip(kept, found, errors)), key=str)


def got(spark, rows, schema=SCHEMA, **how):
    frame = spark.createDataFrame(rows, schema)
    return sorted((tuple(r)[:5] for r in vector_codes.encoded(frame, vector_codes.train(frame, **how)).collect()), key=str)


def some(n, width=16, seed=0, scale=1.0):
    draw = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in draw.normal(0, scale, width)], int(draw.integers(0, 3))) for i in range(n)]


def test_rows_of_all_kinds(spark):
    rows = some(60) + [(None, [0.5] * 16, None), (None, [0.25] * 16, 1), (3, [0.1] * 16, None), (3, [0.1] * 16, None), (200, None, 1),
                       (201, [0.1] * 15 + [None], 1), (202, [NAN] + [0.1] * 15, 1), (203, [INF] * 16, 1), (204, [-INF] * 16, None),
                       (205, [], 2), (206, [1.5] * 5, 2), (-9, [-0.0001] * 16, 2)]
    assert got(spark, rows) == brute(rows)


def test_hot_vector_ties_and_few_rows(spark):
    same = [(i, [0.5, -0.5] * 8, i % 2) for i in range(40)]
    assert got(spark, same) == brute(same)
    few = some(5)
    assert got(spark, few) == brute(few)


def test_vectors_of_unlike_and_odd_lengths(spark):
    rows = [(i, [float(i % 7) / 3] * (i % 11), None) for i in range(50)]
    assert got(spark, rows) == brute(rows)


def test_huge_components_stay_exact(spark):
    rows = some(30, scale=1e6, seed=1) + some(10, scale=1e30, seed=2) + [(90, [3e38] * 16, 1), (91, [-3e38] * 16, 1)]
    assert got(spark, rows) == brute(rows)


def test_owners_with_salts_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "OWNER_MEMBERS", 7)
    monkeypatch.setattr(vector_codes, "ROWS", 10)
    rows = some(120, seed=3) + [(500 + i, [0.25] * 16, 9) for i in range(60)]
    assert got(spark, rows) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, 1)]) == []
    names = "position int, entry int, salt int, members string, code string, error long, v int, k int, l int, round int"
    rows = some(20)
    extra = [(*r, 1, 2, 3, "x", "y", 4, 5, 6, 7, 8) for r in rows]
    assert got(spark, extra, f"{SCHEMA}, {names}") == brute(rows)


def test_members_move_only_when_their_entry_changes(spark, monkeypatch):
    """What the rounds write: all members once, then the movers, and together exactly the members."""
    written = []
    monkeypatch.setattr(vector_codes, "discard", lambda _, folder: written.append(folder))
    rows = some(300, seed=5)
    frame = spark.createDataFrame(rows, SCHEMA)
    vector_codes.train(frame)
    sizes = {r["round"]: r["bytes"] // 4 for r in spark.read.parquet(written[0]).selectExpr("round", "length(members) bytes").groupBy(
        "round").sum("bytes").withColumnRenamed("sum(bytes)", "bytes").collect()}
    assert sizes[0] == 300 * 8
    assert all(0 < n < 300 * 8 for r, n in sizes.items() if r)
    assert max(sizes) <= vector_codes.ROUNDS - 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-2**70, 2**70), min_size=2, max_size=2), min_size=1, max_size=5),
       st.lists(st.lists(st.integers(-2**70, 2**70), min_size=2, max_size=2), min_size=1, max_size=4))
def test_nearest(x, book):
    x = [[int(float(v)) for v in row] for row in x]
    at, away = vector_codes.nearest(np.array(x, np.float64), tuple(map(tuple, book)))
    for row, i, d in zip(x, at, away, strict=True):
        apart = [sum((a - b) ** 2 for a, b in zip(row, e)) for e in book]
        assert int(d) == min(apart) and i == apart.index(min(apart))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_against_wording(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in vector_codes.op13_vector_codes(spark, folder).collect()), key=str) == brute(rows)
