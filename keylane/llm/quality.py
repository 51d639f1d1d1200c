"""Quality rules by repetition coverage.

A text that says the same thing over and over has few characters outside
repeated word sequences. Rolling hashes of several n-gram lengths mark every
word that lies in an n-gram found at least twice in its text; the share of
word characters so marked, per length, and the share in repeated lines decide.
No row needs another row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.shared import aside, documents, small_batches
from keylane.llm.texts import Texts, Words, blocks, mix

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_chars long, "
            "dup_5gram_chars long, dup_7gram_chars long, dup_10gram_chars long")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Least words, most words in repeated 3-word windows (percent), and most covered characters.

    ``covered`` maps an n-gram length to the largest share of word characters
    inside n-grams that occur at least twice; ``dup_lines`` is the largest share
    of word characters in lines equal to an earlier line.
    """

    least_words: int = 50
    repeat_percent: int = 50
    dup_lines: float = 0.30
    covered: dict[int, float] = field(default_factory=lambda: {5: 0.40, 7: 0.35, 10: 0.30})


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the values that occur more than once."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    marks = np.zeros(len(keys), bool)
    marks[order[1:][same]] = True
    marks[order[:-1][same]] = True
    return marks


def covered_words(words: Words, hashes: np.ndarray, n: int) -> np.ndarray:
    """Marks the words inside an n-word window found at least twice in the same text, the first included."""
    at, rolled = words.windows(n, hashes)
    twice = at[repeated(mix(rolled ^ mix(words.text[at].astype(np.uint64) + np.uint64(1))))]
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + n, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of :data:`MEASURES` for each text."""
    words = Words(texts)
    hashes = words.hashes()
    solid_chars = words.solid & texts.first_bytes()
    chars_to = np.concatenate(([0], np.cumsum(solid_chars, dtype=np.int64)))
    word_chars = chars_to[words.end] - chars_to[words.start]

    def per_text(marks: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(words.text[marks], None if weights is None else weights[marks], texts.count).astype(np.int64)

    # lines: between line feeds and the ends of texts
    feeds = np.flatnonzero(texts.data == 10)
    line_start = np.sort(np.concatenate((texts.start, feeds + 1)), kind="stable")
    line_end = np.sort(np.concatenate((texts.end, feeds)), kind="stable")
    line_text = np.searchsorted(texts.start, line_start, side="right") - 1
    line_chars = chars_to[line_end] - chars_to[line_start]
    real = np.flatnonzero(line_chars > 0)
    keys = mix(texts.hash_spans(line_start[real], line_end[real]) ^ mix(line_text[real].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")  # equal lines stay in their order, so all but the first are later copies
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    copies = real[later]
    out = {
        "n_words": words.per_text.astype(np.int64),
        "word_chars": texts.per_text(solid_chars),
        "n_symbols": texts.per_text(_SYMBOL[texts.data]),
        "n_dup_lines": np.bincount(line_text[copies], minlength=texts.count).astype(np.int64),
        "n_repeat_words": per_text(covered_words(words, hashes, 3)),
        "dup_line_chars": np.bincount(line_text[copies], line_chars[copies], texts.count).astype(np.int64),
    }
    for n in (5, 7, 10):
        out[f"dup_{n}gram_chars"] = per_text(covered_words(words, hashes, n), word_chars)
    return out


def _measured(column: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, column):
                found = measure(Texts(part.column(column)))
                kept = [part.column(i) for i, c in enumerate(part.schema.names) if c in names]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, found.values())], [*names, *found])
    return run


def repetition(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the counts of each text. Null and empty texts count nothing."""
    small_batches(docs.sparkSession)
    chosen = docs.select(*dict.fromkeys([*keep, text]))
    held = [f for f in chosen.schema.fields if f.name in keep]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in held], MEASURES])
    return chosen.mapInArrow(_measured(text, [f.name for f in held]), schema)


def judged(measures: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to the counts."""
    failed = ((F.col("n_words") < rules.least_words)
              | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")))
    passes = F.col("dup_line_chars") <= rules.dup_lines * F.col("word_chars")
    for n, most in rules.covered.items():
        passes = passes & (F.col(f"dup_{n}gram_chars") <= most * F.col("word_chars"))
    return measures.withColumn("base_failed", failed).withColumn("kept", ~failed & passes)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their columns as they were, whatever their names."""
    held, names = aside(docs)
    passed = judged(repetition(held, held.columns, names["text"]), rules).filter("kept")
    return passed.select(*held.columns).toDF(*docs.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(repetition(documents(spark, sf_dir), ["doc_id"])).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "dup_line_chars", "dup_5gram_chars", "dup_7gram_chars", "dup_10gram_chars")
