"""Connected components of a graph given as a table of edges, as rounds of joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keylane.session import discard, stored_at


def merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels of rows after rows u and v, pair by pair, are connected: each row's least connected row."""
    while len(u):
        left, right = label[u], label[v]
        apart = left != right
        u, v, left, right = u[apart], v[apart], left[apart], right[apart]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(label, shorter := label[label]):
            label = shorter
    return label


def spanning(rows: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge for each row that is not the least of those it is connected with."""
    label = merge(np.arange(rows), u, v)
    moved = np.flatnonzero(label != np.arange(rows))
    return moved, label[moved]


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b): the least node of its component.

    Alternating large-star and small-star rounds: each node's larger, then each
    node's smaller neighbours are hooked to its least neighbour, until nothing
    changes. A node's neighbours are never gathered: the least one is a map-side
    minimum, and edges meet it in a join. Each round is a written table.
    """
    now, folder = stored_at(_ordered(edges), "edges")
    mark = _mark(now)
    while True:
        before = folder
        now, folder = stored_at(_small_star(_large_star(now)), "edges")
        discard(edges.sparkSession, before)
        then, mark = mark, _mark(now)
        if mark == then:
            break
    # edges are now (node, root) stars
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    larger = both.filter("b > a")
    return _ordered(larger.join(least, larger["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.join(least, edges["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
