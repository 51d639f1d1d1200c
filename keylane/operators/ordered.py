"""Ordered windows that survive hot groups.

``Window.partitionBy(key)`` sends all rows of a key to one task, which fails
when one key holds a third of the table. Every running aggregate here is
computed in two levels instead:

1. the order is cut into slices, and the window runs inside
   ``(group, slice)``, so a hot group spreads over many tasks;
2. one total per ``(group, slice)`` (a plain aggregation with map-side
   partials) is carried forward over the slices and joined back.

The join needs no further shuffle of the rows: the window already left them
hashed and sorted by ``(group, slice)``. The group is held as one struct, which
is never null itself and equals another with the same nulls, so that rows with
a null key are one group in any number of slices.

Slices are bounded whatever the skew. Over a unique number (an offset) they
have a fixed width, so at most that many rows. Over a time they are cut at
quantiles of the rows, so that a burst gets many narrow slices. An instant that
many rows share is a slice of its own, cut further along the number that breaks
ties; where all rows of an instant get one value (peers), instants are reduced
to a row each before the window. A table with more rows than the first cuts can
bound is cut a second time inside each of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
GROUP = "_group"
SLICE_ROWS = 1 << 20
# quantiles are planned on the driver, so their number is bounded
MAX_SLICES = 10_000


class Running(NamedTuple):
    """One running aggregate: ``kind`` is sum, min, max or last."""

    kind: str
    column: Column


class Slices(NamedTuple):
    """Inner bounds between slices of an order; none means a single slice.

    ``hot`` are instants that are a slice each. ``fine`` are bounds inside a
    slice, of the tie-breaking number in a hot one and of the order elsewhere.
    """

    bounds: tuple[float, ...]
    hot: tuple[float, ...] = ()
    fine: dict[int, list[float]] | None = None

    def add(self, df: DataFrame, column: str, tie: str | None = None) -> DataFrame:
        if not self.bounds:
            return df.withColumn(SLICE, F.lit(0))
        splits = [-float("inf"), *self.bounds, float("inf")]
        cut = Bucketizer(splits=splits, inputCol=column, outputCol="_cut", handleInvalid="keep").transform(df)
        cut = cut.withColumn(SLICE, F.col("_cut").cast("int")).drop("_cut")
        if not self.fine:
            return cut
        # at most a bound for each slice of rows that the table has
        rows = [(at, at in self.hot_slices(), bounds) for at, bounds in self.fine.items()]
        inside = df.sparkSession.createDataFrame(rows, f"{SLICE} int, _hot boolean, _bounds array<double>")
        value = F.col(column).cast("double")
        if tie is not None:
            value = F.when(F.col("_hot"), F.col(tie).cast("double")).otherwise(value)
        passed = F.coalesce(F.size(F.filter("_bounds", lambda b: b <= F.col("_value"))), F.lit(0))
        most = 1 + max(len(b) for b in self.fine.values())
        return cut.join(F.broadcast(inside), SLICE, "left").withColumn("_value", value).withColumn(
            SLICE, F.col(SLICE).cast("bigint") * most + F.when(F.col("_value").isNull(), 0).otherwise(F.greatest(passed, F.lit(0)))
        ).select(*df.columns, SLICE)

    def hot_slices(self) -> set[int]:
        """Numbers of the slices of hot instants."""
        return {i + 1 for i, b in enumerate(self.bounds) if b in set(self.hot)}


def even_slices(df: DataFrame, column: str, rows: int | None = None, tie: str | None = None) -> Slices:
    """Slices of about ``rows`` rows each, over all groups together.

    Counts first; a table that fits one slice needs no quantiles. At most
    ``MAX_SLICES`` bounds are planned at once; a slice that holds more than twice
    the rows after that, as an instant with many rows does, is cut inside,
    for which an instant needs the number ``tie``.
    """
    rows = rows or SLICE_ROWS
    values = df.select(F.col(column).cast("double").alias("v"), F.lit(None).cast("double").alias("t") if tie is None else F.col(tie).cast("double").alias("t"))
    total = values.count()
    count = min(-(-total // rows), MAX_SLICES)
    if count <= 1:
        return Slices(())
    shares = [i / count for i in range(1, count)]
    found = sorted(values.approxQuantile("v", shares, 0.25 / count))
    hot = tuple(sorted({a for a, b in zip(found, found[1:]) if a == b}))
    slices = Slices(tuple(sorted({*found, *(math.nextafter(v, math.inf) for v in hot)})), hot)
    if total <= count * rows and (tie is None or not hot):
        return slices
    placed = slices.add(values, "v").withColumn("t", F.when(F.col(SLICE).isin(*slices.hot_slices()), F.col("t")).otherwise(F.col("v")))
    sizes = {r[SLICE]: r["n"] for r in placed.groupBy(SLICE).agg(F.count("t").alias("n")).filter(F.col("n") > 2 * rows).collect()}
    if not sizes:
        return slices
    parts = min(-(-max(sizes.values()) // rows), MAX_SLICES)
    bounds = F.percentile_approx("t", [i / parts for i in range(1, parts)], max(10_000, 4 * parts))
    fine = placed.filter(F.col(SLICE).isin(*sizes)).groupBy(SLICE).agg(bounds.alias("bounds")).collect()
    return slices._replace(fine={r[SLICE]: sorted(set(r["bounds"])) for r in fine if r["bounds"]})


def by_number(column: str, rows: int | None = None) -> Column:
    """Slices over a unique number such as an offset: at most ``rows`` rows each."""
    return F.floor(F.col(column) / F.lit(rows or SLICE_ROWS)).cast("bigint")


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    slice_by: Column | Slices | None,
    aggregates: dict[str, Running],
    *,
    inclusive: bool = False,
    reverse: bool = False,
    peers: bool = False,
) -> DataFrame:
    """Add running aggregates per group, before (or through) each row.

    ``slice_by`` must not decrease along the first column of ``order``; without
    it that column is cut evenly. ``reverse`` runs from the end, giving
    aggregates over the following rows. ``peers`` includes all rows with an
    equal (single) order value.
    """
    by = list(by)
    sort = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    tie = order[1] if len(order) > 1 and isinstance(df.schema[order[1]].dataType, T.NumericType) else None
    if slice_by is None:
        slice_by = even_slices(df, order[0], tie=tie)
    if peers and isinstance(slice_by, Slices) and (slice_by.hot or slice_by.fine):
        return _by_instant(df, by, order, slice_by, aggregates, reverse)
    sliced = slice_by.add(df, order[0], tie) if isinstance(slice_by, Slices) else df.withColumn(SLICE, slice_by)

    if by:
        sliced = sliced.withColumn(GROUP, F.struct(*by))
    group = [GROUP] if by else []

    local = Window.partitionBy(*group, SLICE).orderBy(*sort)
    if peers:
        local = local.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        local = local.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    rows = sliced.select("*", *[_over(a, local).alias(f"_in_{n}") for n, a in aggregates.items()])

    if isinstance(slice_by, Slices) and not slice_by.bounds:
        return rows.select(
            *[F.col(c) for c in df.columns],
            *[_merge(a.kind, F.lit(None), F.col(f"_in_{n}")).alias(n) for n, a in aggregates.items()],
        )

    place = F.struct(*[F.col(c) for c in order])
    totals = sliced.groupBy(*group, SLICE).agg(
        *[_total(a, place, reverse).alias(f"_total_{n}") for n, a in aggregates.items()]
    )
    slices = F.col(SLICE).desc() if reverse else F.col(SLICE).asc()
    earlier = Window.partitionBy(*group).orderBy(slices).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *group,
        SLICE,
        *[
            _over(Running(a.kind, F.col(f"_total_{n}")), earlier).alias(f"_carry_{n}")
            for n, a in aggregates.items()
        ],
    )
    joined = rows.join(carried, [*group, SLICE], "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[_merge(a.kind, F.col(f"_carry_{n}"), F.col(f"_in_{n}")).alias(n) for n, a in aggregates.items()],
    )


def _by_instant(df: DataFrame, by: list[str], order: Sequence[str], slices: Slices, aggregates: dict[str, Running],
                reverse: bool) -> DataFrame:
    """Running aggregates that give all rows of an instant one value: over a row an instant, joined back to the rows."""
    if any(a.kind == "last" for a in aggregates.values()):
        raise ValueError("rows of one instant have no last one")
    (at,) = order
    parts = df.groupBy(*by, at).agg(*[_total(a, F.struct(at), reverse).alias(f"_part_{n}") for n, a in aggregates.items()])
    whole = running(parts, by, order, slices, {n: Running(a.kind, F.col(f"_part_{n}")) for n, a in aggregates.items()},
                    inclusive=True, reverse=reverse)
    # structs equal each other with the same nulls; one row an instant on this side, so a hot instant's rows may be split
    place = F.struct(*by, at)
    held = whole.select(place.alias("_place"), *aggregates)
    return df.withColumn("_here", place).join(held, F.col("_here") == F.col("_place"), "left").select(*df.columns, *aggregates)


def row_position(
    df: DataFrame, by: Sequence[str], order: Sequence[str], slice_by: Column | Slices | None, name: str
) -> DataFrame:
    """Position of the row in its group, from 1."""
    return running(df, by, order, slice_by, {name: Running("sum", F.lit(1))}, inclusive=True)


def previous(
    df: DataFrame, by: Sequence[str], order: Sequence[str], slice_by: Column | Slices | None, names: dict[str, str]
) -> DataFrame:
    """Add the previous row's value of columns, as ``{new name: column}``."""
    return _neighbour(df, by, order, slice_by, names, reverse=False)


def following(
    df: DataFrame, by: Sequence[str], order: Sequence[str], slice_by: Column | Slices | None, names: dict[str, str]
) -> DataFrame:
    """Add the next row's value of columns, as ``{new name: column}``."""
    return _neighbour(df, by, order, slice_by, names, reverse=True)


def _neighbour(df, by, order, slice_by, names, reverse):
    # a struct is never null, so a neighbour whose value is null is still found
    packed = F.struct(*[F.col(c).alias(n) for n, c in names.items()])
    found = running(df, by, order, slice_by, {"_near": Running("last", packed)}, reverse=reverse)
    return found.select(*df.columns, *[F.col(f"_near.{n}").alias(n) for n in names])


def sliding_sum(
    df: DataFrame,
    by: Sequence[str],
    at: str,
    width_us: int,
    sums: dict[str, Column],
    slices: Slices | None = None,
) -> DataFrame:
    """Add sums over the rows of the group with time in ``[t - width, t]``.

    Spark evaluates a sliding ``rangeBetween`` frame again for every row. Here
    each row enters the sum at its time and leaves it after ``width``, so one
    running sum over twice the rows gives the same value. ``slices`` cut the
    doubled time ``2 t``.
    """
    enter = df.select("*", (F.col(at) * 2).alias("_step"), *[c.alias(n) for n, c in sums.items()])
    leave = enter.select(
        *by,
        (F.col("_step") + 2 * width_us + 1).alias("_step"),
        *[(-F.col(n)).alias(n) for n in sums],
    )
    steps = enter.withColumn("_row", F.lit(True)).unionByName(
        leave.withColumn("_row", F.lit(False)), allowMissingColumns=True
    )
    swept = running(
        steps,
        by,
        ["_step"],
        slices,
        {f"_sum_{n}": Running("sum", F.col(n)) for n in sums},
        peers=True,
    )
    return swept.filter("_row").select(*df.columns, *[F.col(f"_sum_{n}").alias(n) for n in sums])


def _over(aggregate: Running, window) -> Column:
    c = aggregate.column
    if aggregate.kind == "sum":
        return F.sum(c).over(window)
    if aggregate.kind == "min":
        return F.min(c).over(window)
    if aggregate.kind == "max":
        return F.max(c).over(window)
    return F.last(c, ignorenulls=True).over(window)


def _total(aggregate: Running, place: Column, reverse: bool) -> Column:
    c = aggregate.column
    if aggregate.kind == "sum":
        return F.sum(c)
    if aggregate.kind == "min":
        return F.min(c)
    if aggregate.kind == "max":
        return F.max(c)
    present = F.when(c.isNotNull(), place)
    return F.min_by(c, present) if reverse else F.max_by(c, present)


def _merge(kind: str, carried: Column, inside: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(inside, F.lit(0))
    if kind == "min":
        return F.least(carried, inside)
    if kind == "max":
        return F.greatest(carried, inside)
    return F.coalesce(inside, carried)
