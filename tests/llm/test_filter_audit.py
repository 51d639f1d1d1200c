"""The filter audit against removing documents one filter after the other."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keylane.llm import filter_audit
from tests.llm.conftest import ODD, words

LABELS = "doc_id long, quality int, toxic int"


def failed(docs):
    """Each row's failed filters, by the wording."""
    first = {}
    for d, text, *_ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    out = []
    for d, text, *_ in docs:
        t, w = text or "", words(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": d is not None and first[t] < d}
        out.append({f for f, bad in fails.items() if bad})
    return out


def brute(docs, labels):
    known = defaultdict(lambda: [0, 0])
    for d, q, t in labels:
        if d is not None:
            known[d] = [max(known[d][0], int(q == 1)), max(known[d][1], int(t == 1))]
    fails, rows = failed(docs), {}
    parts = {d[3] or "" for d in docs}
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    for part in parts:
        shapley = Counter()
        for order in orders:
            left = [i for i, d in enumerate(docs) if (d[3] or "") == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [i for i in left if f in fails[i]]
                redundant = sum(f in fails[i] for i in gone)
                left = [i for i in left if f not in fails[i]]
                gone += out
                shapley[f] += len(out)
                alone = sum(fails[i] == {f} for i, d in enumerate(docs) if (d[3] or "") == part)
                rows[part, order, step] = [len(left), len(out), redundant, alone, sum(known[docs[i][0]][0] for i in out),
                                           sum(known[docs[i][0]][1] for i in out)]
        for order in orders:
            for step, f in enumerate(order, 1):
                rows[part, order, step].append(shapley[f])
    return {k: tuple(v) for k, v in rows.items()}


def got(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def test_odd_rows(spark, odd, wide):
    labels = [(1, 1, 1), (1, 0, 0), (2, 1, None), (3, None, 1), (None, 1, 1), (6, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame(labels, LABELS)
    expected = brute(ODD, labels)
    assert got(filter_audit.audit(filter_audit.masks(odd, table))) == expected
    assert got(filter_audit.audit(filter_audit.masks(wide, table))) == expected


def test_long_texts_and_many_copies(spark):
    long = "Word and word | " * 60_000
    docs = [(i, long if i % 3 else f"text {i} " * 150, "en", "a", 0) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(filter_audit.audit(filter_audit.masks(frame, spark.createDataFrame([], LABELS)))) == brute(docs, [])


def test_empty_table(spark, empty):
    result = filter_audit.audit(filter_audit.masks(empty, spark.createDataFrame([], LABELS)))
    assert result.count() == 0
    assert result.columns == [c.split()[0] for c in filter_audit.AUDIT.split(", ")]


@pytest.mark.parametrize("mask", range(filter_audit.MASKS))
def test_removal_step_is_the_first_failed_filter(mask):
    for order, step in zip(filter_audit.ORDERS, filter_audit.STEP[mask], strict=True):
        steps = [i for i, f in enumerate(order, 1) if mask >> "ABCDE".index(f) & 1]
        assert step == (steps[0] if steps else filter_audit.NEVER)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**40), min_size=96, max_size=96), min_size=1, max_size=3))
def test_counts_add_up(weights):
    weights = np.array(weights, np.int64).reshape(-1, 3, 32)
    kept, removed, redundant, unique, good, toxic, shapley = filter_audit.audit_of(weights)
    total = weights[:, 0].sum(axis=1)[:, None]
    assert (kept[:, :, -1] + removed.sum(axis=2) == total).all()
    assert (kept[:, :, -1] == weights[:, 0, 0][:, None]).all()
    assert (good.sum(axis=2) == weights[:, 1, 1:].sum(axis=1)[:, None]).all()
    fails = np.stack([weights[:, 0][:, filter_audit.FAILS[:, f]].sum(axis=1) for f in range(5)], axis=1)
    assert (removed + redundant == fails[:, filter_audit.APPLIED]).all()
    assert (unique <= removed).all()
    assert (shapley[:, 0].sum(axis=1) == removed.sum(axis=(1, 2))).all()
