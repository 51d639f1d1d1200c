"""MinHash fingerprints of documents.

A text's shingles are its runs of five words (all its words when it has fewer).
Each of ``PERMUTATIONS`` universal hash functions x -> a x + b (a odd) permutes
the 64-bit shingle hashes; the smallest value under each, cut to 16 bits, is
one position of the fingerprint. Two fingerprints agree in about as many
positions as the shingle sets' Jaccard similarity says. Bands of the fingerprint
bring like texts together, and their exact similarity is then verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.components import components, spanning
from keylane.llm.shared import documents, small_batches
from keylane.llm.texts import BLOCK_BYTES, Texts, Words, blocks, mix
from keylane.session import discard, stored, stored_at

PERMUTATIONS = 256
SHINGLE = 5
_A = np.random.default_rng(2).integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.default_rng(3).integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
#: Shingles hashed at once: the block and its permuted copy stay in a core's cache.
_AT_ONCE = 1 << 14
#: Shingles of a tile pair counted at once.
_COLUMNS = 1 << 14
#: Shingles of a tile, unless one text has more.
TILE_SHINGLES = 1 << 17
#: Most slices of an order: what the driver and each task of :func:`in_slices` know of it is two numbers a slice.
MOST_SLICES = 10_000


def shingle_hashes(texts: Texts, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, text by text, and where each text's begin. A text without words has one, of nothing."""
    words = Words(texts)
    hashes = words.hashes()
    at, rolled = words.windows(n, hashes)
    owner = words.text[at]
    for length in range(1, n):  # texts of fewer words: the whole sequence
        short = np.flatnonzero(words.per_text == length)
        if len(short):
            first, whole = words.windows(length, hashes)
            chosen = np.isin(words.text[first], short)
            owner, rolled = np.concatenate((owner, words.text[first][chosen])), np.concatenate((rolled, whole[chosen]))
    none = np.flatnonzero(words.per_text == 0)
    owner, rolled = np.concatenate((owner, none)), np.concatenate((rolled, np.zeros(len(none), np.uint64)))
    order = np.argsort(owner, kind="stable")
    return rolled[order], np.searchsorted(owner[order], np.arange(texts.count))


def signatures(texts: Texts, n: int = SHINGLE) -> np.ndarray:
    """A row of PERMUTATIONS 16-bit values for each text."""
    return _least(*shingle_hashes(texts, n), PERMUTATIONS)


def _least(hashes: np.ndarray, first: np.ndarray, permutations: int) -> np.ndarray:
    out = np.full((len(first), permutations), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(hashes), _AT_ONCE):
        part = hashes[low: low + _AT_ONCE]
        begin = int(np.searchsorted(first, low, side="right")) - 1
        stop = int(np.searchsorted(first, low + len(part), side="left"))
        cuts = np.maximum(first[begin:stop] - low, 0)
        for k in range(permutations):
            least = np.minimum.reduceat(part * _A[k] + _B[k], cuts)
            np.minimum(out[begin:stop, k], least, out=out[begin:stop, k])
    return (out >> np.uint64(48)).astype(np.uint16)


def as_text(signature: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signature.astype(">u2")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of positions in which fingerprints agree."""
    return (a == b).mean(axis=1)


def edited_text(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by the start of the following text, as long at most."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Cuts:
    """Cuts of an order by (k, h): at each quantile of k, and where several fall on one k, between them at even ranges of h."""

    def __init__(self, quantiles: np.ndarray):
        values, times = np.unique(quantiles, return_counts=True)
        self.k = np.repeat(values, times)
        self.h = np.array([j * 2**64 // n - 2**63 for n in times.tolist() for j in range(n)], np.int64)
        self.crowded = values[times > 1]

    def number(self, k: np.ndarray, h: np.ndarray) -> np.ndarray:
        """How many cuts are not above each row: the number of its slice."""
        out = np.searchsorted(self.k, k, side="right")
        for value in np.intersect1d(k, self.crowded):
            first, end = np.searchsorted(self.k, value), np.searchsorted(self.k, value, side="right")
            rows = k == value
            out[rows] = first + np.searchsorted(self.h[first:end], h[rows], side="right")
        return out.astype(np.int32)


def in_slices(docs: DataFrame, rows_each: int = 4096) -> DataFrame:
    """Rows (slice, k, doc_id, h, text, borrowed): each slice holds a range of ids and, borrowed, the next slice's first row.

    ``k`` orders the rows: the id, a missing id before all others; ``h``, a hash
    of the text, orders rows of the same id, and cuts an id that many rows share,
    such as the missing one. The last slice borrows the very first row. The
    driver and each task see two numbers a slice, as in a range shuffle; beyond
    ``MOST_SLICES`` slices grow instead, since their rows only stream through a task.
    """
    held = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k"), F.col("doc_id").cast("long"),
                       F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    slices = min(max(1, held.count() // rows_each), MOST_SLICES)
    shares = [i / slices for i in range(1, slices)]
    cuts = Cuts(np.array(held.approxQuantile("k", shares, 0.2 / slices) if shares else [], np.float64).astype(np.int64))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = (batch.column(i).to_numpy() for i in (0, 1))
            number = cuts.number(k, h)
            order = np.lexsort((h, k, number))
            first = order[np.unique(number[order], return_index=True)[1]]
            yield pa.RecordBatch.from_arrays([pa.array(number[first]), pa.array(k[first]), pa.array(h[first])], ["slice", "k", "h"])

    firsts = held.select("k", "h").mapInArrow(least, "slice int, k long, h long").groupBy("slice").agg(
        F.min(F.struct("k", "h")).alias("f")).select("slice", "f.k", "f.h").toPandas().sort_values("slice")
    holder = dict(zip(zip(firsts["k"].tolist(), firsts["h"].tolist(), strict=True), np.roll(firsts["slice"], 1).tolist(), strict=True))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = (batch.column(i).to_numpy() for i in (0, 2))
            number = cuts.number(k, h)
            known = np.flatnonzero(np.isin(k, firsts_k))
            lent = [(i, holder[key]) for i in known.tolist() if (key := (int(k[i]), int(h[i]))) in holder]
            yield _with(batch, number, False)
            if lent:
                at, to = zip(*lent, strict=True)
                yield _with(batch.take(pa.array(at)), np.array(to, np.int32), True)

    firsts_k = firsts["k"].to_numpy()
    return held.mapInArrow(dealt, "slice int, k long, doc_id long, h long, text string, borrowed boolean")


def _with(batch: pa.RecordBatch, number: np.ndarray, borrowed: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(number), *batch.columns, pa.array(np.full(batch.num_rows, borrowed))],
                                      ["slice", *batch.schema.names, "borrowed"])


FINGERPRINTED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of slices in order: each own row is compared with its edited text and with the row after it."""
    held: list[tuple] = []  # (slice, doc_id, text, borrowed), the first one's signature known
    known = np.empty((0, PERMUTATIONS), np.uint16)
    size = 0

    def compared() -> pa.RecordBatch:
        nonlocal held, known, size
        own = np.concatenate((known, signatures(Texts(pa.array([r[2] for r in held[len(known):]], pa.large_string())))))
        pairs = [i for i in range(len(held) - 1) if not held[i][3] and held[i][0] == held[i + 1][0]]
        edits = [edited_text(held[i][2], held[i + 1][2]) for i in pairs]
        changed = signatures(Texts(pa.array(edits, pa.large_string())))
        at = np.array(pairs, np.int64)
        out = [pa.array([held[i][1] for i in pairs], pa.int64()), pa.array([len(held[i][2]) for i in pairs], pa.int64()),
               pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
               pa.array(as_text(own[at]), pa.string()), pa.array(as_text(changed), pa.string()),
               pa.array(likeness(own[at], changed), pa.float64()), pa.array(likeness(own[at], own[at + 1]), pa.float64())]
        held, known, size = held[-1:], own[-1:], 0
        return pa.RecordBatch.from_arrays(out, [c.split()[0] for c in FINGERPRINTED.split(", ")])

    for batch in batches:
        names = ("slice", "doc_id", "text", "borrowed")
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            held.append(row)
            size += len(row[2])
            if size >= BLOCK_BYTES:
                yield compared()
    if len(held) > 1:
        yield compared()


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how like the edited and the next text are.

    Null is the empty text. Texts are shuffled once, by ranges of ids; nothing
    else of a document leaves its task.
    """
    small_batches(docs.sparkSession)
    slices = in_slices(docs)
    return slices.repartition("slice").sortWithinPartitions("slice", "borrowed", "k", "h").mapInArrow(_compared, FINGERPRINTED)


def _banded(bands: int, rows: int):
    """Each text's number of shingles and a hash of each band of its signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                hashes, first = shingle_hashes(Texts(part.column(2)))
                cut = _least(hashes, first, bands * rows).astype(np.uint64).reshape(-1, bands, rows)
                value = np.zeros(cut.shape[:2], np.uint64)
                for r in range(rows):
                    value = mix(value * _A[0] + cut[:, :, r])
                offsets = np.arange(len(first) + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(np.append(first, len(hashes)))),
                     pa.ListArray.from_arrays(offsets, value.view(np.int64).reshape(-1))], ["k", "row", "size", "bands"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in blocks(batch, "text"):
            hashes, first = shingle_hashes(Texts(part.column(1)))
            sets = [np.unique(x).view(np.int64) for x in np.split(hashes, first[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64())), part.column(2)],
                                             ["k", "shingles", "places"])


def _verified(similarity: float):
    """Edges that connect all rows of a tile pair whose exact Jaccard similarity reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                both = [batch.column(c)[i].values for c in ("left", "right")]
                node = np.concatenate([x.field("k").to_numpy() for x in both])
                sets = [s.values.to_numpy() for x in both for s in x.field("shingles")]
                sizes = np.array([len(s) for s in sets])
                known, at = np.unique(np.concatenate(sets), return_inverse=True)
                row = np.repeat(np.arange(len(sets)), sizes)
                common = np.zeros((len(both[0]), len(both[1])), np.float32)
                for low in range(0, len(known), _COLUMNS):  # counts stay far below 2**24, so they are exact
                    inside = (at >= low) & (at < low + _COLUMNS)
                    held = np.zeros((len(sets), min(_COLUMNS, len(known) - low)), np.float32)
                    held[row[inside], at[inside] - low] = 1
                    common += held[: len(both[0])] @ held[len(both[0]):].T
                together = sizes[: len(both[0]), None] + sizes[None, len(both[0]):] - common
                u, v = np.nonzero(common >= similarity * together)
                edges = spanning(len(sets), u, v + len(both[0]))
                a, b = node[edges[0]], node[edges[1]]
                yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])
    return run


PLACES = "array<struct<group:long,parts:int,part:int>>"


def alike(texts: DataFrame, similarity: float = 0.8, bands: int = 32, rows: int = 4, tile: int = 256,
          shingles: int = TILE_SHINGLES, groups: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) that connect the names of all texts (k, row, text) alike by ``similarity`` or more.

    Equal texts have one name; ``row`` tells the rows of a name apart. Signature
    bands of ``rows`` positions are joined on names alone: texts that share one
    meet in a bucket, which two texts alike by 0.8 miss with a probability below
    10^-7. Texts that buckets connect are a cluster. All texts of a cluster are
    compared by the exact Jaccard similarity of their shingles, in tiles of at
    most about ``tile`` texts and ``shingles`` shingles, or one longer text, so
    that a text's shingles are sent once for each tile of its cluster, and not for each
    bucket. Where a cluster is so large that its buckets need fewer shingles
    sent, its buckets are compared in its place, those with the same members
    once; no pair of a bucket is left out either way. A pair of tiles returns
    the edges that connect its rows, not all pairs. The names (k, group) that
    another search put in one of its ``groups`` are a bucket like those of the bands.
    """
    spark = texts.sparkSession
    small_batches(spark)
    texts = texts.select("k", "row", "text")
    banded, f1 = stored_at(texts.mapInArrow(_banded(bands, rows), "k long, row long, size long, bands array<long>").groupBy("k").agg(
        F.min("row").alias("row"), F.first("size").alias("size"), F.first("bands").alias("bands")), "bands")
    held = banded.select("k", "size", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "k", "size")
    if groups is not None:
        held = held.unionByName(banded.join(groups, "k").select(F.xxhash64(F.lit("group"), "group").alias("bucket"), "k", "size"))

    def cut(n: str, size: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / tile), F.ceil(F.col(size) / shingles)).cast("int")

    buckets, f2 = stored_at(held.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"), F.bit_xor(F.xxhash64("k")).alias("members"),
        F.min("k").alias("leader")).filter("n > 1"), "buckets")
    met, f3 = stored_at(held.join(buckets.select("bucket", "leader"), "bucket"), "met")
    roots, f4 = stored_at(components(met.filter("k <> leader").select(F.col("k").alias("a"), F.col("leader").alias("b"))).select(
        F.col("node").alias("k"), "root"), "roots")
    clusters = roots.join(banded.select("k", "size"), "k").groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("size")).select(
        "root", cut("n", "size").alias("parts"), (F.col("size") * cut("n", "size")).alias("sent"))
    chosen = buckets.groupBy("n", "size", "members").agg(F.min("bucket").alias("bucket"), F.min("leader").alias("k")).join(roots, "k").select(
        "bucket", "root", cut("n", "size").alias("parts"), (F.col("size") * cut("n", "size")).alias("sent"))
    ways, f5 = stored_at(clusters.join(chosen.groupBy("root").agg(F.sum("sent").alias("by_bucket")), "root").select(
        "root", "parts", (F.col("sent") <= F.col("by_bucket")).alias("whole")), "ways")
    whole = roots.join(ways.filter("whole"), "root").select("k", F.xxhash64(F.lit("cluster"), "root").alias("group"), "parts")
    split = chosen.join(ways.filter("not whole").select("root"), "root", "left_semi").select("bucket", "parts")
    apart = met.join(split, "bucket").select("k", F.col("bucket").alias("group"), "parts")
    placed, f6 = stored_at(whole.unionByName(apart).withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int")).groupBy("k").agg(
        F.collect_list(F.struct("group", "parts", "part")).alias("places")).join(banded.select("k", "row"), "k"), "places")
    # one row of each name, found by its key with the name, so that the copies of a text are not gathered
    sets = texts.join(placed, ["k", "row"]).dropDuplicates(["k", "row"]).select("k", "text", "places").mapInArrow(
        _sets, f"k long, shingles array<long>, places {PLACES}")
    tiles, f7 = stored_at(sets.select(F.explode("places").alias("p"), F.struct("k", "shingles").alias("one")).groupBy(
        "p.group", "p.parts", "p.part").agg(F.collect_list("one").alias("texts")), "tiles")

    alone = tiles.filter("parts = 1").select(F.col("texts").alias("left"), F.col("texts").alias("right"))
    many = tiles.filter("parts > 1")
    left = many.select("group", "parts", F.col("texts").alias("left"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("part"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    meet = left.join(many.select("group", "parts", "part", F.col("texts").alias("right")), ["group", "parts", "part"]).select(
        "left", "right").repartition(tasks)
    links = stored(alone.unionByName(meet).mapInArrow(_verified(similarity), "a long, b long").distinct(), "links")
    discard(spark, f1, f2, f3, f4, f5, f6, f7)
    return links


def named(texts: DataFrame) -> DataFrame:
    """The rows with a name ``k`` for each distinct ``text``: 64 bits of hash, and others where a second hash tells two texts of one name apart."""
    both = texts.withColumn("k", F.xxhash64("text")).withColumn("second", F.xxhash64(F.lit("text"), "text"))
    # of n texts some n^2 / 2^65 share a name: ten of 2 x 10^10
    shared = both.groupBy("k").agg(F.min("second").alias("least"), F.max("second").alias("most")).filter("least <> most").select("k", F.lit(True).alias("shared"))
    return both.join(F.broadcast(shared), "k", "left").withColumn(
        "k", F.when(F.col("shared"), F.xxhash64("second", F.lit("apart"))).otherwise(F.col("k"))).drop("second", "shared")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, bands: int = 32, rows: int = 4, tile: int = 256) -> DataFrame:
    """Rows (doc_id, class_id): the least doc_id of all documents reachable over pairs :func:`alike` by ``similarity`` or more.

    Null is the empty text; a class without any id has a null id.
    """
    texts = named(docs.select("doc_id", F.xxhash64("doc_id").alias("row"), F.coalesce("text", F.lit("")).alias("text")))
    edges = alike(texts.select("k", "row", "text"), similarity, bands, rows, tile)
    least = texts.groupBy("k").agg(F.min("doc_id").alias("least"))
    rooted = least.join(components(edges).select(F.col("node").alias("k"), "root"), "k", "left").select(
        "k", "least", F.coalesce("root", "k").alias("root"))
    classes = rooted.select("k", "root").join(rooted.groupBy("root").agg(F.min("least").alias("class_id")), "root").select("k", "class_id")
    return texts.select("doc_id", "k").join(classes, "k").select("doc_id", "class_id")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
