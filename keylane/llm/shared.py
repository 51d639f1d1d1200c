"""What the operators of this package share: the table, the hashes of a text, running numbers over slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one slice where an order over all rows is cut into slices.
SLICE_ROWS = 5_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns named by their place, and those names, so that none meets a name of an operator."""
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of a few megabytes, for this session: texts may be long, and workers share an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def row_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """Two columns that tell rows apart: the id and a hash of the text. Rows equal in both are repeats."""
    return [F.col(id_column), F.xxhash64(F.col(text_column)).alias("text_key")]


def row_keys(*columns: str) -> list[Column]:
    """``k1`` and ``k2``: 128 bits that tell rows apart by the columns, null or not, and join without null checks."""
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit("row"), *reversed(columns)).alias("k2")]


def slices_for(rows: int) -> int:
    return max(1, -(-rows // SLICE_ROWS))


def running_totals(df: DataFrame, group: Sequence[str], spread: Column, order: Sequence[Column], values: dict[str, str],
                   slices: int) -> DataFrame:
    """Add, per group, the total of each value over all rows that come before the row.

    The order is that of ``spread``, a hash that deals rows evenly, and of
    ``order`` among equal hashes. ``values`` maps new columns to summed ones.
    Rows are cut by ranges of the hash into ``slices``, so no task holds a whole
    group however large it is; the totals of earlier slices are summed over
    ``slices`` rows a group and joined back. Groups may be null.
    """
    keys = list(group)
    cut = df.withColumn("_at", spread).withColumn("_slice", _slice_of(F.col("_at"), slices))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_at", *order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{k}") for k, v in values.items()])
    totals = cut.groupBy(*keys, "_slice").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in values.items()])
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"),
                           *[F.coalesce(F.sum(f"_sum_{k}").over(earlier), F.lit(0)).alias(f"_before_{k}") for k in values])
    on = F.col("_slice") == F.col("_s")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    kept = [c for c in df.columns if c not in values]
    return local.join(before, on).select(*kept, *[(F.col(f"_in_{k}") + F.col(f"_before_{k}")).alias(k) for k in values])


def _slice_of(spread: Column, slices: int) -> Column:
    """Number of the equal range of signed 64-bit hashes that holds the hash."""
    top = F.shiftright(spread, 32) + F.lit(2**31)
    return F.shiftright(top * F.lit(slices), 32).cast("int")
