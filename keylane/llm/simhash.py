"""SimHash near-duplicates by exact, tiled comparison.

Documents are reduced to distinct fingerprints. Fingerprints are dealt to
tiles by the population counts of their two halves; a pair of tiles whose
counts differ by more than the radius holds no link and is never compared, all
other pairs are compared completely, with exclusive-or and bit counts. A tile
pair returns a spanning forest of its links, not the links, so a thousand near
copies give a thousand edges. Components of the forest are found by joins.

A fingerprint has one 64-bit word or several. One word and three bits is the
strict rule of :func:`op5_simhash_near_dedup`. No number of bits decides whether
texts are alike by 0.8 in their shingles of five words: of the 256 bits of
:data:`ALIKE` such texts differ in 39 on average, but some in more than 50, and
texts alike by 0.6 in 59. :func:`one_of_each` therefore takes the components of
the strict rule as candidates, adds those of MinHash bands, which find the
alike texts whose bits are further apart, and verifies all by exact Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.components import components, merge
from keylane.llm.fingerprints import alike, named
from keylane.llm.shared import aside, documents, row_key, small_batches
from keylane.llm.texts import Texts, Words, blocks, mix
from keylane.session import stored



@dataclass(frozen=True)
class Rule:
    """Words of a shingle, 64-bit words of a fingerprint, most bits in which linked ones differ."""

    shingle: int = 3
    words: int = 1
    radius: int = 3

    @property
    def first(self) -> int:
        """Most bits in which linked ones differ in the first word: it may hold all of them."""
        return self.radius


STRICT = Rule()
ALIKE = Rule(shingle=5, words=4, radius=50)
#: Fingerprints of a tile.
TILE = 4_096
#: Rows of a tile compared with the whole other tile at once.
_STRIP = 16
_UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
_UPPER_TO_LOWER[65:91] += 32
_NEXT = 0x9E3779B97F4A7C15
#: Bit i of a byte in byte lane i.
_LANES = np.array([sum((byte >> i & 1) << 8 * i for i in range(8)) for byte in range(256)], np.uint64)


def _squeezed(texts: Texts) -> tuple[bytes, Words, np.ndarray, np.ndarray]:
    """All words, A-Z lowered, each followed by one blank, and where each starts and ends."""
    words = Words(texts)
    keep = words.solid.copy()
    sizes = words.end - words.start
    start = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1].astype(np.int64)
    out = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    at = np.flatnonzero(keep)
    out[np.arange(len(at)) + np.repeat(np.arange(len(sizes)), sizes)] = _UPPER_TO_LOWER[texts.data[at]]
    return out.tobytes(), words, start, start + sizes


def fingerprints_of(texts: Texts, rule: Rule = STRICT) -> np.ndarray:
    """A row of 64-bit words a text: a bit is 1 if more than half of the shingles' hashes have it.

    The first word is of XXH64 with seed 42, the others of that hash mixed with
    their number. A text without words has all bits 0.
    """
    line, words, start, end = _squeezed(texts)
    first, counts = words.bounds[:-1], words.per_text
    shingles = np.where(counts == 0, 0, np.maximum(counts - rule.shingle + 1, 1))
    total = int(shingles.sum())
    out = np.zeros((texts.count, rule.words), np.uint64)
    if not total:
        return out
    owner = np.repeat(np.arange(texts.count), shingles)
    edge = np.concatenate(([0], np.cumsum(shingles)))
    word = first[owner] + np.arange(total) - edge[owner]
    last = np.minimum(word + rule.shingle - 1, first[owner] + counts[owner] - 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[s:e], 42) for s, e in zip(start[word].tolist(), end[last].tolist(), strict=True)),
                         np.uint64, total)
    full = np.flatnonzero(shingles)
    for w in range(rule.words):
        value = mix(hashes + np.uint64(w * _NEXT % 2**64)) if w else hashes
        ones = _bit_counts(value, edge[:-1][full], shingles[full])
        chosen = (2 * ones > shingles[full][:, None]).astype(np.uint8)
        out[full, w] = np.packbits(chosen, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def _bit_counts(values: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in each run of values.

    Each byte of a value is spread to eight byte lanes of one word, so that one
    sum counts eight bits; runs are cut to 255 values, which no lane overflows.
    """
    parts = -(-sizes // 255)
    first = np.concatenate(([0], np.cumsum(parts)))[:-1]
    part_start = np.repeat(start, parts) + 255 * (np.arange(int(parts.sum())) - np.repeat(first, parts))
    by_byte = values.view(np.uint8).reshape(-1, 8)
    out = np.empty((len(sizes), 64), np.int64)
    for j in range(8):
        lanes = np.add.reduceat(_LANES[by_byte[:, j]], part_start).view(np.uint8).reshape(-1, 8)
        out[:, 8 * j: 8 * j + 8] = np.add.reduceat(lanes, first, axis=0, dtype=np.int64)
    return out


def fingerprinted(docs: DataFrame, rule: Rule = STRICT) -> DataFrame:
    """Rows (doc_id, text_key, node, fp): each document's fingerprint as signed longs, and one long that names it.

    Null is the empty text. The name of a one-word fingerprint is that word, of
    a longer one a hash of its words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                fps = fingerprints_of(Texts(part.column("text")), rule).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(fps), pa.list_(pa.int64()))],
                                                 ["doc_id", "text_key", "fp"])

    small_batches(docs.sparkSession)
    chosen = docs.select(*row_key(), "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    name = F.col("fp")[0] if rule.words == 1 else F.xxhash64("fp")
    return chosen.mapInArrow(run, f"doc_id {kind}, text_key long, fp array<long>").withColumn("node", name)


def _forest(a: np.ndarray, b: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Edges (i, root) over the rows of a followed by those of b that connect all rows that links connect.

    Every pair is compared word by word; one within the radius has a word with
    no more than its share of the radius, so all words are counted together
    where some word is as near as that.
    """
    label = np.arange(len(a) + len(b))
    words = a.shape[1]
    one, two = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    # a strip and its copies stay in a core's cache
    bits, ones, close, also = (np.empty((_STRIP, len(b)), kind) for kind in (np.uint64, np.uint8, bool, bool))
    for low in range(0, len(a), _STRIP):
        rows = min(_STRIP, len(a) - low)
        for w in range(words):
            np.bitwise_xor(one[w, low: low + rows, None], two[w, None, :], out=bits[:rows])
            np.bitwise_count(bits[:rows], out=ones[:rows])
            np.less_equal(ones[:rows], rule.radius // words, out=(also if w else close)[:rows])
            if w:
                np.logical_or(close[:rows], also[:rows], out=close[:rows])
        u, v = np.divmod(np.flatnonzero(close[:rows]), len(b))
        u, v = u + low, v + len(a)
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
        if words > 1:
            far = sum(np.bitwise_count(a[u, w] ^ b[v - len(a), w]).astype(np.int64) for w in range(words)) > rule.radius
            u, v = u[~far], v[~far]
        label = merge(label, u, v)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return moved, label[moved]


def _compare(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                nodes, fps = [], []
                for c in (0, 1):
                    rows = batch.column(c)[i].values
                    nodes.append(rows.field("node").to_numpy())
                    fps.append(rows.field("fp").flatten().to_numpy().view(np.uint64).reshape(len(rows), -1))
                node = np.concatenate(nodes)
                moved, root = _forest(*fps, rule)
                apart = node[moved] != node[root]
                yield pa.RecordBatch.from_arrays([pa.array(node[moved][apart]), pa.array(node[root][apart])], ["a", "b"])
    return run


def links(fps: DataFrame, rule: Rule = STRICT, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between the names of distinct fingerprints (node, fp) that connect all that are within the radius.

    A class is a pair of population counts, of the upper and the lower half of
    the bits, in steps of ``grain``. There are at most 33 x 33 classes for each
    word squared, so the table of class sizes is bounded and may be broadcast.
    Each tile is sent to the tiles of the classes that may hold a link and come
    after its own.
    """
    small_batches(fps.sparkSession)
    grain = max(1, (rule.radius + 1) // 4)
    ranked = fps.select("node", "fp", *_halves(rule.words, grain))
    sizes = stored(ranked.groupBy("hi", "lo").count().select(
        "hi", "lo", F.ceil(F.col("count") / tile).cast("int").alias("parts")), "classes")
    tiles = stored(ranked.join(F.broadcast(sizes), ["hi", "lo"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).groupBy("hi", "lo", "part").agg(
        F.collect_list(F.struct("node", "fp")).alias("fps")), "tiles")
    far = rule.radius // grain + 1
    steps = [(h, w) for h in range(far + 1) for w in range(-far, far + 1)
             if _least(h, grain) + _least(w, grain) <= rule.radius and (h, w) >= (0, 0)]
    step = F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(w).alias("w")) for h, w in steps]))
    near = tiles.select("hi", "lo", "part", step.alias("s")).select(
        F.struct("hi", "lo", "part").alias("one"), (F.col("hi") + F.col("s.h")).alias("hi"), (F.col("lo") + F.col("s.w")).alias("lo"))
    pairs = near.join(F.broadcast(sizes), ["hi", "lo"]).select(
        "one", "hi", "lo", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(
        "one", F.struct("hi", "lo", "part").alias("two")).filter("one <= two")
    left = tiles.select(F.struct("hi", "lo", "part").alias("one"), F.col("fps").alias("left"))
    right = tiles.select(F.struct("hi", "lo", "part").alias("two"), F.col("fps").alias("right"))
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    meet = pairs.join(left, "one").join(right, "two").select("left", "right").repartition(tasks)
    return meet.mapInArrow(_compare(rule), "a long, b long")


def _halves(words: int, grain: int) -> list[Column]:
    def ones(values: list[Column]) -> Column:
        return (reduce(lambda x, y: x + y, [F.bit_count(v) for v in values]) / grain).cast("int")

    each = [F.col("fp")[w] for w in range(words)]
    if words == 1:
        upper, lower = [F.shiftrightunsigned(each[0], 32)], [each[0].bitwiseAND(F.lit(0xFFFFFFFF))]
    else:
        upper, lower = each[: words // 2], each[words // 2:]
    return [ones(upper).alias("hi"), ones(lower).alias("lo")]


def _least(step: int, grain: int) -> int:
    """The least difference of counts whose classes are so many steps apart."""
    return max(0, (abs(step) - 1) * grain + 1)


def near_duplicates(prints: DataFrame, rule: Rule = STRICT) -> DataFrame:
    """Rows of ``prints`` with ``first``, the least (doc_id, text_key) of the component, and ``component_id``.

    ``component_id`` is the smallest doc_id reachable over links. Repeated rows
    stay repeated. A missing doc_id counts in no minimum; a component without
    any id has a null component_id.
    """
    row = F.struct("doc_id", "text_key")
    distinct = stored(prints.groupBy("node").agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), row)).alias("least"),
                                                 F.first("fp").alias("fp")), "fingerprints")
    rooted, first = _firsts(distinct, links(distinct, rule))
    named = rooted.select("node", "root").join(first, "root").select("node", "first")
    return prints.join(named, "node").withColumn("component_id", F.col("first.doc_id"))


def _firsts(distinct: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (node, least) with the root of their component, and the least (doc_id, text_key) of each root's component."""
    roots = components(edges).select("node", "root")
    rooted = distinct.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    return rooted, rooted.groupBy("root").agg(F.min_by("least", F.struct(F.col("least.doc_id").isNull(), "least")).alias("first"))


def grouped(texts: DataFrame, rule: Rule = STRICT) -> DataFrame:
    """Rows (k, group) for the names of texts (k, text): names of one group have fingerprints that links connect."""
    prints = stored(fingerprinted(texts.select(F.col("k").alias("doc_id"), "text")).groupBy(F.col("doc_id").alias("k")).agg(
        F.first("node").alias("node"), F.first("fp").alias("fp")), "simhash")
    fps = stored(prints.groupBy("node").agg(F.first("fp").alias("fp")), "fingerprints")
    roots = components(links(fps, rule)).select("node", "root")
    return prints.select("k", "node").join(roots, "node", "left").select("k", F.coalesce("root", "node").alias("group"))


def one_of_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The documents without near copies: of each component the row with the least id, once if rows repeat.

    Candidates are the components of the fingerprints, as in :func:`near_duplicates`, and
    the buckets of MinHash bands. Links are pairs whose sets of five-word shingles, A-Z lowered, have a Jaccard
    similarity of ``similarity`` or more, verified exactly. Texts without words
    are alike to each other only.
    """
    lowered = F.translate(F.coalesce("text", F.lit("")), ascii_uppercase, ascii_lowercase)
    texts = named(docs.select(*row_key(), lowered.alias("text")))
    row = F.struct("doc_id", "text_key")
    distinct = stored(texts.groupBy(F.col("k").alias("node")).agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), row)).alias("least")), "texts")
    edges = alike(texts.select("k", F.xxhash64("doc_id").alias("row"), "text"), similarity, groups=grouped(texts))
    _, first = _firsts(distinct, edges)
    kept = first.select(F.col("first.doc_id").alias("id"), F.col("first.text_key").alias("key"))
    held, names = aside(docs)
    rows = held.withColumn("text_key", F.xxhash64(names["text"]))
    joined = rows.join(kept, F.col(names["doc_id"]).eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")))
    return joined.dropDuplicates(["id", "key"]).select(*held.columns).toDF(*docs.columns)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(fingerprinted(documents(spark, sf_dir)), "simhash")
    return near_duplicates(prints).select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id")
