"""What each filter of a chain removes, in every order the filters could have.

A document is reduced to its mask of failed filters, and a part of the table to
how many documents each of the 32 masks has. Which step of an order removes a
mask is a product of two small matrices in the min-plus sense: the mask's row is
0 at the filters it fails and infinite elsewhere, the order's column has each
filter's position (the inverse of the permutation), and the least sum is the
step of the first filter that the mask fails. Those steps say where each mask's
weights are added.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.shared import documents, row_keys, text_or_empty, word_count
from keylane.session import stored

FILTERS = "ABCDE"
#: All orders of the filters, by name.
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MASKS = 1 << len(FILTERS)
#: A step that never comes: the mask fails no filter.
NEVER = np.iinfo(np.int32).max // 2

#: FAILS[mask, filter]: whether the mask fails the filter.
FAILS = (np.arange(MASKS)[:, None] >> np.arange(len(FILTERS)) & 1).astype(bool)
#: POSITION[order, filter]: the step at which the order applies the filter, from 1.
POSITION = np.array([[order.index(f) + 1 for f in FILTERS] for order in ORDERS], np.int32)
#: APPLIED[order, step - 1]: the filter that the order applies at the step.
APPLIED = np.argsort(POSITION, axis=1)


def removal_steps(fails: np.ndarray = FAILS, position: np.ndarray = POSITION) -> np.ndarray:
    """REMOVED[mask, order]: the step that removes the mask, NEVER if none does, as a min-plus product."""
    barred = np.where(fails, 0, NEVER)[:, None, :] + position[None, :, :]
    return np.minimum(barred.min(axis=2), NEVER)


STEP = removal_steps()


def masks(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          part_column: str = "source") -> DataFrame:
    """Rows (part, mask, good, toxic), one a document: its failed filters as bits, A lowest, and its labels.

    Filters: A under 200 words; B distinct words under half of the words; C over
    2 % of the code points in ``A-Z``; D any of ``#$%&*|``; E a text that a
    smaller id has too. A null text is empty, a null part the empty string. A
    row without an id has no smaller one and counts for none; rows that repeat
    an id do not fail E for each other. A document is good or toxic if any of
    its labels says so; a row of labels without an id labels nothing.

    Texts are named by 128 bits of hash. The least id of a text is found by a
    map-side minimum and meets its row by id and text together, so the copies
    of one text are never gathered.
    """
    text = text_or_empty(text_column)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    narrow = stored(docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"), text.alias("text"),
    ).withColumn("words", word_count()).select(
        "id", "part", *row_keys("text"),
        (_bit(F.col("words") < 200, "A")
         + _bit(100 * F.size(F.array_distinct(words.alias("w"))).cast("long") < 50 * F.col("words"), "B")
         + _bit(100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 2 * F.length("text").cast("long"), "C")
         + _bit(F.col("text").rlike(r"[#$%&*|]"), "D")).alias("mask"),
    ), "masks")
    first = narrow.groupBy("k1", "k2").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return narrow.join(first, ["id", "k1", "k2"], "left").join(known, "id", "left").select(
        "part", (F.col("mask") + _bit(F.col("id").isNotNull() & F.col("first").isNull(), "E")).cast("int").alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def _bit(condition, name: str):
    return F.when(condition, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0))


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
         "toxic_lost long, shapley long")


def audit_of(weights: np.ndarray) -> list[np.ndarray]:
    """Counts of each part, order and step from ``weights[part, kind, mask]``, the documents, good and toxic ones of a mask.

    Returns kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley, each ``[part, order, step - 1]``.
    """
    parts, steps = len(weights), len(FILTERS)
    # every mask's weight is added to the step that removes it; those never removed to a step of their own
    lost = np.zeros((3, len(ORDERS), steps + 1, parts), np.int64)
    at = np.where(STEP == NEVER, steps, STEP - 1)
    for kind in range(3):
        np.add.at(lost[kind], (np.arange(len(ORDERS))[None, :], at), weights[:, kind].T[:, None, :])
    removed, good, toxic = lost[:, :, :steps].transpose(0, 3, 1, 2)
    kept = weights[:, 0].sum(axis=1)[:, None, None] - np.cumsum(removed, axis=2)
    count = weights[:, 0]
    fails_at = FAILS[:, APPLIED]  # mask, order, step: the step's filter fails the mask
    late = fails_at & (STEP[:, :, None] < np.arange(1, steps + 1))
    redundant = np.tensordot(count, late.astype(np.int64), 1)
    alone = FAILS & (FAILS.sum(axis=1) == 1)[:, None]
    unique = (count @ alone.astype(np.int64))[:, APPLIED]
    total = np.zeros((len(FILTERS), parts), np.int64)
    np.add.at(total, APPLIED, removed.transpose(1, 2, 0))
    return [kept, removed, redundant, unique, good, toxic, total.T[:, APPLIED]]


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            counts = part.column(1)
            held = counts.flatten()
            row = np.repeat(np.arange(part.num_rows), counts.value_lengths().to_numpy())
            weights = np.zeros((part.num_rows, 3, MASKS), np.int64)
            for kind, name in enumerate(("n", "good", "toxic")):
                weights[row, kind, held.field("mask").to_numpy()] = held.field(name).to_numpy()
            rows = len(ORDERS) * len(FILTERS)
            names = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), rows)))
            orders = pa.array(np.tile(np.repeat(np.arange(len(ORDERS)), len(FILTERS)), part.num_rows))
            steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), part.num_rows * len(ORDERS))
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(ORDERS).take(orders), pa.array(steps), *[pa.array(x.reshape(-1)) for x in audit_of(weights)]],
                [c.split()[0] for c in AUDIT.split(", ")])


def audit(masked: DataFrame) -> DataFrame:
    """One row per part, order and step from the rows of :func:`masks`, zeros included; no rows without documents.

    kept: documents left after the step; removed: by the step; redundant: failing
    the step's filter but removed before; unique_fails: failing that filter and no
    other; good_lost, toxic_lost: removed by the step with that label; shapley: what
    the filter removes, summed over all orders. A part is one row of at most 32
    counts before numpy sees it, whatever its size.
    """
    counts = masked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return parts.mapInArrow(_audited, AUDIT)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of five filters over all documents, per source; null and empty cases as in :func:`masks`."""
    return audit(masks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


#: The five conditions of the audit, in DuckDB SQL.
SQL = """
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
failing AS (SELECT doc_id, part, len(words) < 200 AS fa,
    100 * len(list_distinct(words)) < 50 * len(words) AS fb,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS fc,
    regexp_matches(text, '[#$%&*|]') AS fd,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS fe FROM texts),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
docs AS (SELECT f.*, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic FROM failing f LEFT JOIN known k ON k.doc_id = f.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step FROM orders),
masks AS (SELECT part, fa, fb, fc, fd, fe, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY ALL),
each AS (SELECT m.part, s.filter_order, s.step, m.n, m.good, m.toxic, substr(s.filter_order, s.step, 1) AS f,
    (CASE WHEN fa THEN 'A' ELSE '' END || CASE WHEN fb THEN 'B' ELSE '' END || CASE WHEN fc THEN 'C' ELSE '' END
      || CASE WHEN fd THEN 'D' ELSE '' END || CASE WHEN fe THEN 'E' ELSE '' END) AS failed FROM masks m, steps s),
placed AS (SELECT *, contains(failed, f) AS fails,
    len(list_filter(string_split(failed, ''), lambda x: x <> '' AND instr(filter_order, x) < step)) > 0 AS gone FROM each),
summed AS (SELECT part, filter_order, step, f,
    CAST(sum(CASE WHEN gone OR fails THEN 0 ELSE n END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN failed = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM placed GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM summed"""
