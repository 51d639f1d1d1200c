"""Language identification with interpolated Kneser-Ney models of characters.

Each language has a model of character n-grams up to ``ORDER``: absolute
discounting with the lower orders estimated from how many different characters
come before an n-gram. The n-grams of all languages lie in one sorted array of
64-bit hashes per order, with a row of probabilities and back-off weights, one
column a language. A text goes to the language with the lowest cross-entropy
per character.

Training takes a sample of bounded size, ``MOST_CHARS`` characters a language
in expectation, chosen by a hash of the document's id; a fifth of it is held
back to calibrate: the highest cross-entropy a text of the language may have,
and how far differences of cross-entropy are to be trusted. Prediction reads
every character of every text.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.shared import documents, small_batches
from keylane.llm.texts import Texts, blocks, mix

ORDER = 5
#: Characters of training text a language, in expectation.
MOST_CHARS = 2_000_000
#: Languages of a model: their columns are part of every task.
MOST_LANGUAGES = 500
UNKNOWN = "und"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK = 32


def letter_table() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else a blank."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for code in range(0x30000):  # no letters are assigned beyond the third plane but ideographs, set below
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    for code in range(0x30000, 0x33480):
        if unicodedata.category(chr(code)).startswith("L"):
            table[code] = code
    return table


def code_points(texts: Texts, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters, lower-cased, and single blanks of all texts, each text after ORDER-1 blanks, and the bounds of the texts."""
    points = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    sizes = texts.per_text(texts.first_bytes())
    low = table[np.minimum(points, 0x10FFFF)]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    blank = low == _BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    first = starts[sizes > 0]
    keep[first] = ~blank[first]
    total = np.concatenate(([0], np.cumsum(keep)))
    kept = total[ends] - total[starts]
    bounds = np.concatenate(([0], np.cumsum(kept + ORDER - 1)))
    out = np.full(int(bounds[-1]), _BLANK, np.uint32)
    out[np.arange(int(kept.sum())) + np.repeat((np.arange(len(kept)) + 1) * (ORDER - 1), kept)] = low[keep]
    return out, bounds


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n code points that end at each position from ORDER-1 on; points is (.., ORDER) or a line."""
    out = np.full(points.shape[:-1], n, np.uint64)
    for i in range(points.shape[-1] - n, points.shape[-1]):
        out = out * _STEP + points[..., i].astype(np.uint64)
    return mix(out)


def context_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-1 code points before the last."""
    return gram_hashes(points[..., :-1], n - 1) if n > 1 else np.zeros(points.shape[:-1], np.uint64)


@dataclass
class Model:
    """Sorted hashes and their rows, per order: discounted probabilities of n-grams, back-off weights of contexts."""

    languages: list[str]
    alphabet: int
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    limits: np.ndarray
    sharpness: float = 1.0

    def log_probabilities(self, points: np.ndarray) -> np.ndarray:
        """log2 of each language's probability of the last code point of each row after the ones before."""
        p = np.full((len(points), len(self.languages)), 1.0 / self.alphabet)
        for n in range(1, ORDER + 1):
            p = _rows(self.grams[n - 1], gram_hashes(points, n), 0.0) + _rows(self.contexts[n - 1], context_hashes(points, n), 1.0) * p
        return np.log2(p)

    def cross_entropies(self, texts: Texts, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and how many letters and blanks were scored."""
        points, bounds = code_points(texts, table)
        starts, counts = bounds[:-1] + ORDER - 1, np.diff(bounds) - (ORDER - 1)
        total = np.zeros((texts.count, len(self.languages)))
        if len(points) >= ORDER:
            windows = np.lib.stride_tricks.sliding_window_view(points, ORDER)
            # windows that reach from one text into the next end at one of its leading blanks and are not summed
            codes, kinds = pd.factorize(gram_hashes(windows, ORDER))
            example = np.empty(len(kinds), np.int64)
            example[codes[::-1]] = np.arange(len(codes))[::-1]
            table_of_kinds = self.log_probabilities(windows[example]).astype(np.float32)
            full = np.flatnonzero(counts)
            ends = np.concatenate(([0], np.cumsum(counts[full])))[:-1]
            at = np.arange(int(counts.sum())) + np.repeat(starts[full] - (ORDER - 1) - ends, counts[full])
            for lang in range(len(self.languages)):
                total[full, lang] = np.add.reduceat(table_of_kinds[codes[at], lang].astype(np.float64), ends)
        return -total / np.maximum(counts, 1)[:, None], counts


def _rows(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, default: float) -> np.ndarray:
    hashes, rows = table
    if not len(hashes):
        return np.full((len(keys), rows.shape[1]), default)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return np.where((hashes[at] == keys)[:, None], rows[at], default)


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """A model from each language's distinct n-grams of length ORDER, (.., ORDER) code points, and their counts."""
    languages = sorted(counts)
    wide = len(languages)
    alphabet = len(np.unique(np.concatenate([g[:, -1] for g, _ in counts.values()]))) + 1
    found: list[tuple[list, list]] = [([], []) for _ in range(ORDER)]
    for column, lang in enumerate(languages):
        grams, number = counts[lang]
        number = number.astype(np.float64)
        for n in range(ORDER, 0, -1):
            own, before = gram_hashes(grams, n), context_hashes(grams, n)
            contexts, which = np.unique(before, return_inverse=True)
            mass = np.bincount(which, number)
            kinds = np.bincount(which)
            once, twice = (number == 1).sum(), (number == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            found[n - 1][0].append((own, (number - np.minimum(discount, number)) / mass[which], column))
            found[n - 1][1].append((contexts, np.minimum(discount, 1.0) * kinds / mass, column))
            # how many different characters come before each shorter n-gram
            _, first, number = np.unique(gram_hashes(grams, n - 1), return_index=True, return_counts=True)
            grams, number = grams[first], number.astype(np.float64)

    def merged(parts: list, default: float) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.unique(np.concatenate([h for h, _, _ in parts]))
        rows = np.full((len(hashes), wide), default, np.float32)
        for h, values, column in parts:
            rows[np.searchsorted(hashes, h), column] = values
        return hashes, rows

    return Model(languages, alphabet, [merged(g, 0.0) for g, _ in found], [merged(c, 1.0) for _, c in found], np.full(wide, np.inf))


def _count_grams(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                langs = part.column(0).to_pylist()
                for lang in sorted(set(langs)):
                    texts = Texts(part.column(1).filter(pa.array([x == lang for x in langs])))
                    points, bounds = code_points(texts, table)
                    if len(points) < ORDER:
                        continue
                    inside = np.ones(len(points), bool)
                    for i in range(ORDER - 1):
                        inside[bounds[:-1] + i] = False
                    windows = np.lib.stride_tricks.sliding_window_view(points, ORDER)[inside[ORDER - 1:]]
                    _, first, number = np.unique(gram_hashes(windows, ORDER), return_index=True, return_counts=True)
                    grams = [row.tobytes() for row in windows[first].astype("<u4")]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.binary()),
                                                      pa.array(number)], ["lang", "gram", "n"])
    return run


def train(labelled: DataFrame, most_chars: int = MOST_CHARS, seed: int = 8) -> Model | None:
    """A model of the languages of the rows (doc_id, text, lang). None if no row has a language and a letter.

    A language whose sample is empty after hashing, because it has a few
    documents only, is trained and calibrated on all of them.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    table = letter_table()
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.char_length("text")).alias("n")).collect()}
    if not sizes:
        return None
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, most_chars / n))]), F.col("lang"))
    lot = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(lot < share)
    held = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(5)) == 0

    def counted(part: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        grams = part.select("lang", "text").mapInArrow(_count_grams(table), "lang string, gram binary, n long")
        # at most the characters of the sample
        frame = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
        return {lang: (np.frombuffer(b"".join(g["gram"]), "<u4").reshape(-1, ORDER).astype(np.uint32), g["n"].to_numpy())
                for lang, g in frame.sort_values(["lang", "gram"]).groupby("lang")}

    counts = counted(sample.filter(~held))
    lacking = sorted(set(sizes) - set(counts))
    if lacking:
        counts |= counted(rows.filter(F.col("lang").isin(lacking)))
    model = fit(counts)
    calibrate(model, _scored(sample.filter(held), model, table, ["lang"]).select("lang", "bits", "chars").toPandas())
    return model


def calibrate(model: Model, scored: pd.DataFrame) -> None:
    """Set each language's highest cross-entropy and the sharpness of scores from texts that were not trained on."""
    scored = scored[scored["chars"] > 0]
    if not len(scored):
        return
    bits = np.array(scored["bits"].tolist())
    own = np.array([model.languages.index(x) for x in scored["lang"]])
    mine = bits[np.arange(len(own)), own]
    for i in range(len(model.languages)):
        if (own == i).any():
            model.limits[i] = np.quantile(mine[own == i], 0.999) + 3 * max(mine[own == i].std(), 0.05)
    fits = {}
    for sharpness in np.geomspace(0.5, 64, 29):
        logits = -bits * sharpness
        fits[sharpness] = (logits[np.arange(len(own)), own] - np.logaddexp.reduce(logits, axis=1)).mean()
    best = max(fits.values())
    model.sharpness = min(s for s, f in fits.items() if f >= best - 1e-3)


def _scored(docs: DataFrame, model: Model, table: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with bits per character under each language, and how many characters were scored."""
    sent = docs.sparkSession.sparkContext.broadcast((vars(model), table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, letters = sent.value
        own = Model(**fields)
        for batch in batches:
            for part in blocks(batch, len(keep)):
                bits, chars = own.cross_entropies(Texts(part.column(len(keep))), letters)
                rows = pa.array(list(bits), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], rows, pa.array(chars)], [*keep, "bits", "chars"])

    chosen = docs.select(*keep, F.col("text").alias("_text"))
    schema = ", ".join([*[f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in keep], "bits array<double>, chars long"])
    return chosen.mapInArrow(run, schema)


def identify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` and ``accepted``.

    Null texts and texts without a letter are ``und`` with score 0. The score is
    the calibrated share of the chosen language; ``accepted`` is false, and the
    score halved, if the text is less like the language than its texts are.
    """
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    scored = _scored(docs, model, letter_table(), keep)
    best = F.array_min("bits")
    at = F.array_position("bits", best).cast("int")
    names = F.array(*[F.lit(x) for x in model.languages])
    limits = F.array(*[F.lit(float(x) if math.isfinite(x) else 1e9) for x in model.limits])
    weight = F.aggregate("bits", F.lit(0.0), lambda s, b: s + F.exp((best - b) * model.sharpness))
    seen = F.col("chars") > 0
    accepted = seen & (best <= F.element_at(limits, at))
    return scored.select(
        *keep, F.when(seen, F.element_at(names, at)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(~seen, 0.0).otherwise(F.when(accepted, 1.0).otherwise(0.5) / weight).alias("score"), accepted.alias("accepted"))


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = train(docs.filter(~F.col("held_out")))
    return identify(docs, model, ["doc_id", "held_out"])
