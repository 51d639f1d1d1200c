"""Toxicity: the lattice against all its paths, scores against a plain reading, held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keylane.llm import toxicity
from tests.llm.conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def model(spark, docs):
    return toxicity.character_model(docs)


def paths(piece, at=0):
    """Every meaning of a piece with the cost of its liberties."""
    if at == len(piece):
        yield "", 0.0
        return
    for many, meaning, price in toxicity.choices(piece, at, toxicity.run_lengths(piece)[at]):
        for rest, more in paths(piece, at + many):
            yield meaning + rest, price + more


def cost_of(model, meaning):
    """The model's cost of a meaning between blanks, character by character."""
    group = toxicity.kinds()[1]
    said = re.sub(" +", " ", "".join(c if group[ord(c)] else " " for c in f" {meaning} "))
    numbers = [0, 0] + [int(group[ord(c)]) for c in said]
    return sum(float(model[((numbers[i - 3] * 32 + numbers[i - 2]) * 32 + numbers[i - 1]) * 32 + numbers[i]]) for i in range(3, len(numbers)))


def cheapest(model, piece):
    return min(price + cost_of(model, meaning) for meaning, price in paths(piece))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aeiouts1!0$. -x9é", min_size=1, max_size=5))
def test_restores_the_cheapest_path(model, piece):
    said = toxicity.Restorer(model).restore(piece)
    prices = [price for meaning, price in paths(piece) if meaning == said]
    assert prices and min(prices) + cost_of(model, said) == pytest.approx(cheapest(model, piece), abs=1e-4)


def test_counts_of_character_runs(spark, docs, model):
    counts = Counter()
    group = toxicity.kinds()[1]
    for r in docs.collect():
        flat = re.sub(r"[\W\d_]+", " ", f" {(r['text'] or '').lower()} ")
        numbers = [int(group[ord(c)]) for c in flat]
        counts.update(tuple(numbers[i: i + 4]) for i in range(len(numbers) - 3))
    table = np.zeros((32,) * 4)
    for run, n in counts.items():
        # runs over the end of a text meet the next text there, so only those inside texts are compared
        table[run] = n
    inside = table * 1.0
    total = inside.sum()
    assert np.isfinite(model).all()
    p = np.exp(-model.reshape((32,) * 4).astype(np.float64))
    for run, n in counts.most_common(200):
        if 0 in run:
            continue
        share = [0.05 * (inside.sum(axis=(0, 1, 2))[run[3]] + 1) / (total + 32)]
        for length, weight in ((2, 0.15), (3, 0.3), (4, 0.5)):
            held = inside.sum(axis=tuple(range(4 - length)))
            share.append(weight * held[run[-length:]] / held[run[-length:-1]].sum())
        assert p[run] == pytest.approx(sum(share), rel=2e-3)


def test_language_model_grows_with_the_corpus(spark, docs):
    few, all_ = (spark.createDataFrame(list(rows), "text string") for rows in ([("aa bb",)], [("aa bb",)] * 1000))
    def total(frame):
        return frame.mapInArrow(toxicity._counted, "run long, n long").agg(F.sum("n")).first()[0]
    assert total(all_) >= 999 * total(few)


def bulk(texts, restorer):
    """Words per text as the numpy form sees them."""
    out = [Counter() for _ in texts]
    for text, hashes, _ in toxicity.meant_words(restorer, texts):
        for t, h in zip(text.tolist(), hashes[:, 0].tolist()):
            out[t][h] += 1
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab1! .\né$-x漢", max_size=25), max_size=4))
def test_numpy_words_are_those_of_the_restored_text(model, texts):
    restorer = toxicity.Restorer(model)
    plain = [toxicity.restored_text(restorer, t) for t in texts]
    expected = []
    for t in plain:
        codes, first = toxicity.code_points([t])
        words = Counter()
        for _, hashes, _ in toxicity._words(codes, toxicity.kinds()[0][codes], first):
            words.update(hashes[:, 0].tolist())
        expected.append(words)
        assert sum(words.values()) == len(re.findall(r"[^\W\d_]+", t))
    assert bulk(texts, restorer) == expected


def test_disguises():
    words = ["idiot", "moron", "loser"] * 200 + ["the", "and", "house", "river"] * 300
    codes = toxicity.runs(toxicity.code_points([" ".join(words)])[0])
    model = toxicity.costs(np.bincount(codes, minlength=toxicity.CLASSES**toxicity.ORDER))
    restorer = toxicity.Restorer(model)
    for seen, meant in {"id1ot": "idiot", "1d10t!": "idiot", "i d i o t": "idiot", "m.o.r.o.n": "moron", "m-0-r-0-n": "moron",
                        "looooser": "loser", "l0s3r": "loser", "the river": "the river", "2024": "2024", "Hello": "hello"}.items():
        assert toxicity.restored_text(restorer, seen) == meant


def learned(words, base=0.1):
    """A model whose marks are whole words."""
    names = {w: toxicity.code_points([w]) for w in words}
    marks = [next(toxicity._words(c, toxicity.kinds()[0][c], f))[1][0, 0] for c, f in names.values()]
    order = np.argsort(marks)
    return np.array(marks, np.uint64)[order], np.array(list(words.values()))[order]


def test_scores(model):
    weights = {"idiot": 0.9, "clown": 0.8, "fool": 0.45}
    judge = toxicity.Judge(toxicity.ToxicityModel(model, *learned(weights), 0.1))
    texts = ["", "nothing here", "an idiot", "Idiot, idiot IDIOT", "idiot clown", "fool", "fool fool clown", "x" * 100_000, "idiotic"]
    expected = [0.1, 0.1, 0.9, 0.9, 1 - 0.1 * 0.2, 0.45, 0.8, 0.1, 0.1]
    assert judge.scores(texts).tolist() == pytest.approx(expected)
    assert judge.scores([]).tolist() == []


def test_odd_rows(spark, odd, wide, empty, model):
    learned_ = toxicity.ToxicityModel(model, *learned({"seven": 0.9}), 0.1)
    for frame in (odd, wide):
        rows = sorted(((r["doc_id"], round(r["score"], 6), r["predicted"]) for r in toxicity.scored(frame, learned_).collect()), key=str)
        assert rows == sorted(((d, 0.9, 1) if t and "seven" in t else (d, 0.1, 0) for d, t, *_ in ODD), key=str)
    assert toxicity.scored(empty, learned_).count() == 0
    assert toxicity.restored(odd, model).filter("text is null").count() == 0
    nothing = toxicity.character_model(empty)
    assert np.isfinite(nothing).all()
    trained = toxicity.train(empty, spark.createDataFrame([], LABELS), nothing)
    assert len(trained.marks) == 0 and trained.base < toxicity.THRESHOLD
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, None), (None, 1, 1), (5, 0, 0), (6, None, 0)], LABELS)
    assert toxicity.train(odd, labels, model).base < toxicity.THRESHOLD


def test_very_long_texts(model):
    judge = toxicity.Judge(toxicity.ToxicityModel(model, *learned({"idiot": 0.9}), 0.1))
    texts = ["a b c " * 50_000, "!" * 300_000, "a1" * 2_000 + " id1ot", "word " * 200_000 + "id1ot", "x." * 100_000, "a" * 200_000]
    assert judge.scores(texts).tolist() == pytest.approx([0.1, 0.1, 0.9, 0.9, 0.1, 0.1])


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = toxicity.op11_toxicity(spark, folder).collect()
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [(toxic[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    # some 300 toxic documents to learn from; all are found on a table five times as large
    assert sum(p for t, p in held if t) >= 0.9 * sum(t for t, _ in held)
    assert sum(p for t, p in held if not t) <= 0.01 * len(held)


def test_held_out_labels_are_not_read(spark, sf_dir, docs, model):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.fold() == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, rows.filter(toxicity.fold() != 1), model) for rows in (labels, flipped))
    assert (a.marks == b.marks).all() and (a.shares == b.shares).all() and a.base == b.base
    assert math.isfinite(a.base)
