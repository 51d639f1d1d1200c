"""The corpus pipeline, stage by stage, against brute-force versions on the stage's own input."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

import __spark_entry__ as entry_module
import corpus_pipeline
from keylane.llm import bpe, quality
from keylane.llm.texts import Texts
from tests.llm.conftest import words
from tests.llm.test_text_operators import base, dedup_lines, exactly_alike


@pytest.fixture(scope="module")
def stages(spark, docs, sf_dir, tmp_path_factory):
    """Input and output rows of each stage."""
    folder, held, out = tmp_path_factory.mktemp("pipeline"), docs, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = held.collect()
        stage(spark, held, sf_dir).write.parquet(f"{folder}/{number}")
        held = spark.read.parquet(f"{folder}/{number}")
        out.append((name, before, held.collect(), held.columns))
    return out


def test_columns(stages, docs):
    assert [name for name, *_ in stages] == ["quality rules", "line dedup", "near dedup", "source mix", "byte bpe"]
    assert all(columns == docs.columns for *_, columns in stages[:-1])


def test_quality_keeps_what_its_rules_keep(stages):
    _, before, after, _ = stages[0]
    found = quality.measure(Texts(pa.array([r["text"] for r in before])))
    rules = quality.Rules()
    keep = []
    for i, r in enumerate(before):
        n, chars, *_, repeats = base(r["text"])
        covered = all(found[f"dup_{k}gram_chars"][i] <= most * chars for k, most in rules.covered.items())
        if n >= 50 and 100 * repeats <= 50 * n and covered and found["dup_line_chars"][i] <= rules.dup_lines * chars:
            keep.append(tuple(r))
    assert sorted(keep) == sorted(map(tuple, after))


def test_line_dedup_takes_effect(stages):
    _, before, after, _ = stages[1]
    expected = {d: sha for d, _, _, sha in dedup_lines([(r["doc_id"], r["text"]) for r in before])}
    assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in after} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_one_document_of_each_group_stays(stages):
    """Of each group that pairs alike by 0.8 connect, in exact five-word shingles, the least id."""
    _, before, after, _ = stages[2]
    assert sorted(r["doc_id"] for r in after) == exactly_alike((r["doc_id"], r["text"]) for r in before)


def test_the_mix_takes_parts_of_documents(stages):
    _, before, after, _ = stages[3]
    known = {r["doc_id"]: r for r in before}
    taken = Counter()
    for r in after:
        taken[r["doc_id"]] += len(words(r["text"]))
        assert (r["source"], r["lang"]) == (known[r["doc_id"]]["source"], known[r["doc_id"]]["lang"])
    assert all(n <= 3 * len(words(known[d]["text"])) for d, n in taken.items())
    assert sum(taken.values()) == pytest.approx(sum(len(words(r["text"])) for r in before), rel=0.05)


def test_tokens_of_every_row(stages):
    _, before, after, _ = stages[4]
    ranks, pattern = bpe.public_ranks()
    encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for r in before:
        ids = encoder.encode_ordinary(r["text"])
        expected.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(r["text"].encode()).hexdigest()))
    assert sorted(map(tuple, after)) == sorted(expected)


def test_run_and_registration(spark, sf_dir, stages):
    names = entry_module.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert sorted(map(tuple, names["pipeline"](spark, sf_dir).collect())) == sorted(map(tuple, stages[-1][2]))


def test_odd_rows_pass_all_stages(spark, odd, empty, sf_dir, tmp_path):
    for number, table in enumerate((odd, empty)):
        table.write.parquet(f"{tmp_path}/{number}/documents.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{number}").count() == 0
        held = table
        for _, stage in corpus_pipeline.STAGES[1:]:
            held = stage(spark, held, sf_dir)
        assert set(held.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
        held.collect()
