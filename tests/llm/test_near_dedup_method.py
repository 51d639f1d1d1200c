"""Near dedup takes candidates from the fingerprints, and verifies them."""

import random

import pyarrow as pa

from keylane.llm import fingerprints, simhash
from tests.llm.test_text_operators import exactly_alike


def near_copies(spark):
    chance = random.Random(4)
    base = [chance.choice("abcdefgh") + str(chance.randrange(900)) for _ in range(400)]
    texts = [" ".join(base), " ".join([*base[:200], "other", *base[201:]]), " ".join(base[::-1]), " ".join([*base, "more"]), "one two"]
    rows = list(enumerate(texts))
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_groups_of_fingerprints_are_the_links_of_the_strict_rule(spark):
    rows, docs = near_copies(spark)
    groups = simhash.grouped(fingerprints.named(docs.select("doc_id", "text")))
    found = {}
    for r in groups.join(fingerprints.named(docs), "k").collect():
        found.setdefault(r["group"], set()).add(r["doc_id"])
    linked = {}
    for r in simhash.near_duplicates(simhash.fingerprinted(docs)).collect():
        linked.setdefault(r["component_id"], set()).add(r["doc_id"])
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, linked.values()))
    assert {0, 3} <= linked[0]


def test_fingerprints_alone_lead_to_verified_links(spark, monkeypatch):
    """Bands that find nothing: what the fingerprints link is still compared, and only what is alike is linked."""
    rows, docs = near_copies(spark)
    banded = fingerprints._banded

    def apart(bands, size):
        def run(batches):
            for batch in banded(bands, size)(batches):
                names = pa.array([[k] for k in batch.column(0).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], names], batch.schema.names)
        return run

    monkeypatch.setattr(fingerprints, "_banded", apart)
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect())
    assert 3 not in kept and {0, 2, 4} <= set(kept)
    monkeypatch.undo()
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == exactly_alike(rows)
