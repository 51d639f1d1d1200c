"""Toxicity of texts whose words may be disguised: what was meant is restored first, then judged.

Writing in leetspeak, with separators between letters or with letters repeated
is taken as a noisy channel. A suspicious piece of text spans a lattice: each
character may stand for itself, for letters it resembles, for nothing (a
separator) or, in a run, for one or two of it. The Viterbi path is the cheapest
one by the cost of each liberty plus the cost of the result under a character
language model, which counts runs of four characters over all texts of the
corpus in a table of fixed size. The words of the restored text are then
compared with marks of toxicity: words and beginnings of words that labelled
documents show to go with the label, far beyond chance.

Pieces that hold nothing suspicious have one path through their lattice, which
is themselves; numpy finds the others in the code points of a block of texts.
"""

from __future__ import annotations

import math
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.fingerprints import shingle_hashes
from keylane.llm.shared import documents, small_batches, text_or_empty
from keylane.llm.texts import Texts, blocks, mix
from keylane.session import stored

#: Letters that a character may stand for.
RESEMBLES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il",
             "+": "t", "€": "e", "(": "c"}
SEPARATORS = " .-_*"
#: Signs that end a piece and are no part of it.
ENDS = ".,;:?!\"'[]{}"
#: Costs of a liberty, in nats: a letter for a look-alike, a separator dropped, a run written once or twice.
SWAP, DROP, RUN = 1.0, 0.5, 0.7
#: Cost of a run of look-alikes or separators that is meant as it stands.
KEEP = 2.5

#: Characters of a run that the language model counts. A character is one of 32 classes: blank, a to z without accents, five for all others.
ORDER = 4
CLASSES = 32
#: How much each length of run says, from one.
SHARES = (0.05, 0.15, 0.3, 0.5)

#: Labelled documents that marks are learned from, about: of more, a sample by a hash of the id.
MOST_LABELLED = 20_000
#: Marks kept of each length, those that deviate most from chance.
MOST_MARKS = 100_000
#: Lengths of beginnings of words that may be marks, the longest first, and of what tells whole words apart.
BEGINNINGS, WHOLE = (6, 5, 4), 16
#: Documents by which the share of a mark is pulled towards the rate of all, as marks are chosen for being extreme.
PULL = 8
#: Score from which a document is predicted to be toxic, and share from which marks are taken together.
THRESHOLD, LIKELY = 0.7, 0.5
#: Entries of a task's memory of restored pieces.
MEMORY = 100_000
#: Words hashed at once, and marks added up at once.
_WORDS, _MARKS = 1 << 16, 1 << 20

_LETTER, _LOOK, _SEPARATOR, _BLANK, _SIGN = (np.uint8(1 << i) for i in range(5))
_SIGNED = _LETTER | _LOOK | _SIGN
_FACTORS = np.random.default_rng(11).integers(1, 2**63, WHOLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEYS = np.random.default_rng(12).integers(1, 2**63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def kinds() -> tuple[np.ndarray, np.ndarray]:
    """What each code point is, as bits, and its class for the language model; made once a task."""
    every = [chr(i) for i in range(0x110000)]
    kind = np.array([c.isalpha() for c in every], np.uint8) * _LETTER
    kind |= np.array([c.isspace() for c in every], np.uint8) * _BLANK
    kind |= np.array([c.isalnum() and not c.isalpha() for c in every], np.uint8) * _SIGN
    for bit, signs in ((_LOOK, RESEMBLES), (_SEPARATOR, SEPARATORS.strip())):
        kind[[ord(c) for c in signs]] |= bit
    group = np.where(kind & _LETTER, 27 + np.arange(0x110000) % 5, 0).astype(np.uint8)
    for i in np.flatnonzero(kind[:0x2000] & _LETTER).tolist():
        plain = unicodedata.normalize("NFKD", chr(i))[0].lower()
        if "a" <= plain <= "z":
            group[i] = ord(plain) - 96
    return kind, group


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts in lower case, a line feed before each and after the last, and where each begins."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join([*low, ""])).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate(([1], 1 + np.cumsum([len(t) + 1 for t in low], dtype=np.int64)))


# -- the language model ----------------------------------------------------


def runs(codes: np.ndarray) -> np.ndarray:
    """Number of each run of ORDER classes, where everything between words is one blank."""
    group = kinds()[1][codes]
    group = group[(group != 0) | (np.concatenate(([1], group[:-1])) != 0)].astype(np.int32)
    number = np.zeros(max(len(group) - ORDER + 1, 0), np.int32)
    for i in range(ORDER):
        number = number * CLASSES + group[i: i + len(number)]
    return number


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(CLASSES**ORDER, np.int64)
    for batch in batches:
        for part in blocks(batch, 0):
            table += np.bincount(runs(code_points(part.column(0).to_pylist())[0]), minlength=len(table))
    found = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(table[found])], ["run", "n"])


def costs(counts: np.ndarray) -> np.ndarray:
    """Nats of a run's last character after the ones before it: shares of all lengths of run, each by its counts."""
    table = counts.reshape((CLASSES,) * ORDER).astype(np.float64)
    p = np.zeros_like(table)
    for length, share in enumerate(SHARES, 1):
        held = table.sum(axis=tuple(range(ORDER - length)))
        before = held.sum(axis=-1, keepdims=True)
        if length == 1:
            p += share * (held + 1) / (before + CLASSES)
        else:
            p += share * np.divide(held, before, out=np.zeros_like(held), where=before > 0)
    return -np.log(p).reshape(-1).astype(np.float32)


def character_model(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The costs of all runs, counted over every text of the table; at most one number a run reaches the driver."""
    small_batches(docs.sparkSession)
    counted = docs.select(text_or_empty(text_column).alias("text")).mapInArrow(_counted, "run long, n long")
    sums = counted.groupBy("run").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(CLASSES**ORDER, np.int64)
    counts[sums["run"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return costs(counts)


# -- the channel -----------------------------------------------------------


def run_lengths(piece: str) -> list[int]:
    """How often each character follows from there on."""
    out = [1] * len(piece)
    for i in range(len(piece) - 2, -1, -1):
        if piece[i] == piece[i + 1]:
            out[i] += out[i + 1]
    return out


def choices(piece: str, at: int, run: int) -> list[tuple[int, str, float]]:
    """What the characters from ``at`` on, ``run`` alike, may mean: (how many, their meaning, cost). One that is no letter means itself or letters."""
    c = piece[at]
    if c.isalpha():
        found = [(1, c, 0.0)]
        if run > 1:
            found += [(run, c, RUN if run > 2 else 2 * RUN)] + [(run, c + c, RUN)] * (run > 2)
        return found
    found = [(run, c * run, 0.0 if c == " " else KEEP)]
    for letter in RESEMBLES.get(c, ""):
        found += [(1, letter, SWAP)] + [(run, letter, SWAP + RUN)] * (run > 1)
    if c in SEPARATORS and 0 < at and at + run < len(piece):
        found.append((run, "", DROP))
    return found


class Restorer:
    """Restores pieces, remembering those it has met."""

    def __init__(self, model: np.ndarray) -> None:
        self.cost = array("f", model.tobytes())
        self.memory: dict[str, str] = {}

    def continued(self, state: int, meaning: str) -> tuple[int, float]:
        """The last characters after a meaning, and its cost; what is no letter is a blank to the model, and blanks in a row are one."""
        group, total = kinds()[1], 0.0
        for c in meaning:
            g = int(group[ord(c)])
            if g or state % CLASSES:
                run = state * CLASSES + g
                total += self.cost[run]
                state = run % CLASSES ** (ORDER - 1)
        return state, total

    def restore(self, piece: str) -> str:
        """The cheapest meaning of a piece, by Viterbi's algorithm over the last ``ORDER - 1`` characters."""
        best: list[dict[int, tuple]] = [{} for _ in range(len(piece) + 1)]
        best[0][0] = (0.0, None, None, "")
        run = run_lengths(piece)
        for at in range(len(piece)):
            found = choices(piece, at, run[at]) if best[at] else []
            for state, (cost, *_) in best[at].items():
                for many, meaning, price in found:
                    then, more = self.continued(state, meaning)
                    whole, known = cost + price + more, best[at + many].get(then)
                    if known is None or whole < known[0]:
                        best[at + many][then] = (whole, at, state, meaning)
        state = min(best[-1], key=lambda s: best[-1][s][0] + self.continued(s, " ")[1])
        at, said = len(piece), []
        while at:
            _, before, previous, meaning = best[at][state]
            said.append(meaning)
            at, state = before, previous
        return "".join(reversed(said))

    def __call__(self, piece: str) -> str:
        core = piece.rstrip(ENDS).lstrip(ENDS.replace("!", ""))
        if not any(c.isalpha() for c in core):
            return piece
        known = self.memory.get(core)
        if known is None:
            known = self.restore(core)
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            if len(core) <= 64:
                self.memory[core] = known
        return known


def suspicious(kind: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin and end that may be disguised: ends are exclusive, pieces of single signs in a row are one.

    A piece lies between white space. It is suspicious with a look-alike beside a
    letter, with a letter three times in a row, with three single signs and
    separators between them, or if it is one of three pieces of one sign each with
    one blank between.
    """
    letter, look, dash = kind & _LETTER > 0, kind & _LOOK > 0, kind & _SEPARATOR > 0
    blank, sign = kind & _BLANK > 0, kind & _SIGNED > 0
    solid = ~blank
    start = np.flatnonzero(solid & np.concatenate(([True], blank[:-1])))
    end = np.flatnonzero(solid & np.concatenate((blank[1:], [True]))) + 1
    odd = np.zeros(len(codes), bool)
    odd[1:] |= (letter[:-1] & look[1:]) | (look[:-1] & letter[1:])
    same = letter[1:] & (codes[1:] == codes[:-1])
    odd[2:] |= same[1:] & same[:-1]
    odd[4:] |= sign[:-4] & dash[1:-3] & sign[2:-2] & dash[3:-1] & sign[4:]
    total = np.concatenate(([0], np.cumsum(odd)))
    chosen = total[end] > total[start]
    single = (end - start == 1) & sign[start]
    near = single[1:] & single[:-1] & (start[1:] == end[:-1] + 1) & (codes[end[:-1]] == 32)  # beside the piece before it
    joined = np.concatenate(([False], near))
    many = len(start)
    first = np.maximum.accumulate(np.where(joined, 0, np.arange(many))) if many else np.empty(0, np.int64)
    size = np.bincount(first, minlength=many)
    last = np.arange(many) + size - 1
    run = (first == np.arange(many)) & (size > 2)
    alone = chosen & (size[first] < 3)
    return start[run | alone], end[np.where(run, last, np.arange(many))[run | alone]]


def restored_text(restorer: Restorer, text: str) -> str:
    """The text in lower case, its suspicious pieces restored, everything else where it was."""
    codes, _ = code_points([text])
    low, out, done = text.lower(), [], 0
    for a, b in zip(*(x.tolist() for x in suspicious(kinds()[0][codes], codes)), strict=True):
        out += [low[done: a - 1], restorer(low[a - 1: b - 1])]
        done = b - 1
    return "".join([*out, low[done:]])


def restored(docs: DataFrame, model: np.ndarray, text_column: str = "text") -> DataFrame:
    """The documents with restored texts. Null is the empty text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            texts = pa.array([restored_text(restorer, t or "") for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


# -- the marks -------------------------------------------------------------


def _hashes(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word, the whole one first, then its beginnings, and which of them the word has."""
    out = np.zeros((len(start), 1 + len(BEGINNINGS)), np.uint64)
    sums = np.zeros(len(start), np.uint64)
    for i in range(WHOLE):
        here = codes[np.minimum(start + i, len(codes) - 1)].astype(np.uint64)
        sums += np.where(i < size, here, 0) * _FACTORS[i]
        if i + 1 in BEGINNINGS:
            out[:, 1 + BEGINNINGS.index(i + 1)] = mix(sums)
    out[:, 0] = mix(sums + np.uint64(1))
    return out, np.stack([np.full(len(start), True), *[size > n for n in BEGINNINGS]], axis=1)


def _words(codes: np.ndarray, kind: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of letters: the text of each, hashes of what may mark it and whether it has them, some words at a time."""
    letter = np.concatenate(([False], kind & _LETTER > 0, [False]))
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    start, end = edge[::2], edge[1::2]
    for low in range(0, len(start), _WORDS):
        a, b = start[low: low + _WORDS], end[low: low + _WORDS]
        yield np.searchsorted(first, a, side="right") - 1, *_hashes(codes, a, b - a)


def meant_words(restorer: Restorer, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The words of the restored texts, as from :func:`_words`."""
    codes, first = code_points(texts)
    kind = kinds()[0][codes]
    start, end = suspicious(kind, codes)
    if len(start):
        owner = np.searchsorted(first, start, side="right") - 1
        whole = codes.tobytes().decode("utf-32-le", "surrogatepass")
        said = [restorer(whole[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        cover = np.zeros(len(codes) + 1, np.int8)
        cover[start], cover[end] = 1, -1
        kind = np.where(np.cumsum(cover[:-1]) > 0, np.uint8(0), kind)
        more, at = code_points(said)
        for text, hashes, has in _words(more, kinds()[0][more], at):
            yield owner[text], hashes, has
    yield from _words(codes, kind, first)


@dataclass(frozen=True)
class ToxicityModel:
    """Costs of character runs; share of toxic documents among those with a mark (hashes, ascending), and the score without any.

    The marks are a list of decisions: a word is judged by the whole word if that
    is a mark, else by its longest beginning that is one.
    """

    costs: np.ndarray
    marks: np.ndarray
    shares: np.ndarray
    base: float


class Judge:
    """Scores texts."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model = model
        self.restorer = Restorer(model.costs)
        self.maybe = np.zeros(1 << 16, bool)  # most words end at a look into this table
        self.maybe[(model.marks >> np.uint64(48)).astype(np.int64)] = True

    def scores(self, texts: list[str]) -> np.ndarray:
        """Marks more likely toxic than not are taken together, one a word, as independent chances; without one the greatest share, or the base."""
        found = [self._marked(*w) for w in meant_words(self.restorer, texts)]
        text, word, share = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, int),) * 3
        order = np.lexsort((word, text))
        fresh = np.concatenate(([True], (np.diff(text[order]) != 0) | (np.diff(word[order]) != 0)))[: len(order)]
        text, share = text[order][fresh], share[order][fresh]
        weak, left = np.full(len(texts), self.model.base), np.ones(len(texts))
        np.maximum.at(weak, text, share)
        np.multiply.at(left, text[share >= LIKELY], 1 - share[share >= LIKELY])
        return np.where(left < 1, 1 - left, weak)

    def _marked(self, text: np.ndarray, hashes: np.ndarray, has: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, at = self.decided(hashes, has)
        return text[row], hashes[row, 0], self.model.shares[at]

    def decided(self, hashes: np.ndarray, has: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that a mark decides, and the number of the most specific one."""
        row, column = np.nonzero(has & self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])  # by word, the whole word first
        if not len(row):
            return row, row
        value = hashes[row, column]
        at = np.minimum(np.searchsorted(self.model.marks, value), len(self.model.marks) - 1)
        known = self.model.marks[at] == value
        row, at = row[known], at[known]
        first = np.unique(row, return_index=True)[1]
        return row[first], at[first]


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least hashes of each text's shingles under several permutations: texts that share a twentieth of their shingles mostly share one."""
    for batch in batches:
        for part in blocks(batch, "text"):
            hashes, first = shingle_hashes(Texts(part.column(1)), 3)
            keys = [np.minimum.reduceat(mix(hashes * a), first).view(np.int64) for a in _KEYS]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *map(pa.array, keys)],
                                             ["doc_id", "toxic", *[f"k{i}" for i in range(len(_KEYS))]])


def _candidates(shared: Broadcast, column: int) -> Callable:
    """Whole words (column 0) or beginnings of words that no mark decides yet, with numbers of documents and toxic documents that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for part in blocks(batch, "text"):
                toxic = part.column(1).to_numpy().astype(np.int64)
                found = []
                for t, hashes, has in meant_words(judge.restorer, part.column(0).to_pylist()):
                    left = has[:, column].copy()
                    left[judge.decided(hashes, has)[0]] = False
                    found.append((t[left], hashes[left, column]))
                if not found:
                    continue
                text, mark = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.lexsort((mark, text))
                text, mark = text[order], mark[order]
                fresh = np.concatenate(([True], (np.diff(text) != 0) | (mark[1:] != mark[:-1])))[: len(mark)]
                held.append(_added(mark[fresh], np.ones(fresh.sum(), np.int64), toxic[text[fresh]]))
                size += len(held[-1][0])
                if size > _MARKS:
                    held = [_added(*(np.concatenate(c) for c in zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > _MARKS:
                        yield _mark_rows(held)
                        held, size = [], 0
        if held:
            yield _mark_rows(held)
    return run


def _added(mark: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    known, at = np.unique(mark, return_inverse=True)
    return known, *(np.bincount(at, weights=c, minlength=len(known)).astype(np.int64) for c in (n, toxic))


def _mark_rows(held: list) -> pa.RecordBatch:
    mark, n, toxic = _added(*(np.concatenate(c) for c in zip(*held, strict=True)))
    return pa.RecordBatch.from_arrays([pa.array(mark.view(np.int64)), pa.array(n), pa.array(toxic)], ["mark", "n", "toxic"])


def _surprise(n: Column, toxic: Column, rate: float) -> Column:
    """Twice the log likelihood ratio of the mark's share of toxic documents against the rate of all."""
    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)
    return 2 * (part(toxic, n * rate) + part(n - toxic, n * (1 - rate)))


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, most: int = MOST_LABELLED) -> ToxicityModel:
    """Marks from the documents that ``labels`` (doc_id, toxic) labels.

    Of more than ``most`` labels a sample of about that many, by a hash of the id,
    is taken: the classifier's bound. Labels without an id or without a value are
    left out; repeated ones count once, toxic if any says so. Of labelled near copies with one label mostly one
    is counted. A word is a mark if toxic documents hold it more often than chance
    would let any of all words (twice the log likelihood ratio is above 2 ln words + 4, as
    documents that share passages are no independent draws); its weight is the share of toxic documents among those with it, pulled
    towards one half by one document. Then beginnings of the words that are no
    marks become marks alike, from the longest to the shortest. Texts without
    marks score the rate of toxic labels, half the threshold at most.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("i")).agg(
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    total = known.count()
    if total > most:
        known = known.filter(F.pmod(F.xxhash64("i"), F.lit(1_000_003)) < int(1_000_003 * most / total))
    # both joins broadcast labels whose number ``most`` bounds
    held = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("i")).select(
        "doc_id", "text", "toxic")
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys = held.mapInArrow(_copies, f"doc_id {kind}, toxic int, " + ", ".join(f"k{i} long" for i in range(len(_KEYS)))).toPandas()
    keys = keys.sort_values(list(keys.columns))
    for i in range(len(_KEYS)):
        keys = keys.drop_duplicates(["toxic", f"k{i}"])
    n, toxic = len(keys), int(keys["toxic"].sum())
    base = min((toxic + 0.5) / (n + 1), THRESHOLD / 2)
    if not 0 < toxic < n:
        return ToxicityModel(model, np.empty(0, np.uint64), np.empty(0), base)
    chosen = spark.createDataFrame(keys[["doc_id"]].drop_duplicates().rename(columns={"doc_id": "j"}), f"j {kind}")
    sample = stored(held.join(F.broadcast(chosen), F.col("doc_id") == F.col("j"), "left_semi").select("text", "toxic"), "labelled")
    learned = ToxicityModel(model, np.empty(0, np.uint64), np.empty(0), base)
    for column in range(1 + len(BEGINNINGS)):
        learned = _with_marks(learned, sample, column, toxic / n)
    return learned


def _with_marks(model: ToxicityModel, sample: DataFrame, column: int, rate: float) -> ToxicityModel:
    shared = sample.sparkSession.sparkContext.broadcast(model)
    candidates = stored(sample.mapInArrow(_candidates(shared, column), "mark long, n long, toxic long").groupBy("mark").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic")), "candidates")
    least = 2 * math.log(max(candidates.count(), 1)) + 4
    rows = candidates.filter(F.col("toxic") > F.col("n") * rate).withColumn("surprise", _surprise(F.col("n"), F.col("toxic"), rate)).filter(
        F.col("surprise") > least).orderBy(F.desc("surprise"), "mark").limit(MOST_MARKS).toPandas()
    marks = np.concatenate((model.marks, rows["mark"].to_numpy(np.int64).view(np.uint64)))
    shares = np.concatenate((model.shares, ((rows["toxic"] + PULL * rate) / (rows["n"] + PULL)).to_numpy(np.float64)))
    order = np.argsort(marks)
    return ToxicityModel(model.costs, marks[order], shares[order], model.base)


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Rows (doc_id, score, predicted), one a document, repeated ones too. A null text is empty; texts are restored and read whole."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            for part in blocks(batch, "text"):
                scores = judge.scores(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                                                 ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def fold(column: str = "doc_id") -> Column:
    """The fold of an id, 0 to 2; an id that is null is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3, F.lit(0))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; the labels of fold 1 are never read. Null and empty texts score as those without any mark."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold() != 1)
    model = train(docs, labels, character_model(docs))
    return scored(docs, model).select("doc_id", (fold() == 1).alias("held_out"), "score", "predicted")
