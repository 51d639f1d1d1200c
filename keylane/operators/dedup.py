"""Deduplication and idempotence over keyed messages.

Copies of one message may make up a third of a table. So the first copy is
found by an aggregation, whose map side already reduces a hot group to one row
per task, and never by ranking the group in one window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keylane.operators.filters import unexpired
from keylane.operators.ordered import Running, by_number, previous, running
from keylane.operators.skew import bounded
from keylane.session import stored

KEYS = ("topic", "key", "id")
WEEK_S = 604_800.0
# a group of at most so many rows is walked in one task
FOLD_ROWS = 1_000_000
# more hot groups than these are not broadcast
MOST_HOT = 100_000


def dedup(
    df: DataFrame,
    ttl_s: float | None = None,
    *,
    by: Sequence[str] = KEYS,
    order: Sequence[str] = ("part", "off"),
    at: str = "ts_us",
    cache_size: int = 8192,
) -> DataFrame:
    """Keep the first message per topic, key and payload id.

    Without ``ttl_s`` the memory never ends. With it, a message counts as a
    duplicate only up to ``ttl_s`` after the last one kept; duplicates do not
    extend that. Messages without an id are always kept; ``cache_size=0``
    switches deduplication off.
    """
    if cache_size == 0:
        return df
    without_id = df.filter(F.col(by[-1]).isNull())
    with_id = df.filter(F.col(by[-1]).isNotNull())
    if ttl_s is None:
        return _firsts(with_id, by, order).unionByName(without_id)
    return _dedup_ttl(with_id, round(ttl_s * 1_000_000), by, order, at).unionByName(without_id)


def _firsts(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in by]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*by).agg(first).select(*[F.col(c) if c in by else F.col(f"_first.{c}") for c in df.columns])


def _dedup_ttl(df: DataFrame, ttl_us: int, by, order, at) -> DataFrame:
    """One count per group says which need more than their first row, and which of those are too large for one task."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"), (F.max(at) - F.min(at)).alias("_span"))
    hot = stored(sizes.filter((F.col("_span") > ttl_us) & (F.col("_n") > FOLD_ROWS)).select(*by), "hot")
    if hot.isEmpty():
        return _greedy_fold(df, ttl_us, by, order, at)
    side = bounded(hot.select(*[F.col(c).alias(f"_hot_{c}") for c in by]), MOST_HOT)
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in by])
    rest = df.join(side, same, "left_anti")
    copies = df.join(side, same, "left_semi")
    return _greedy_fold(rest, ttl_us, by, order, at).unionByName(_greedy_jumps(copies, ttl_us, by, order, at))


def _greedy_fold(df: DataFrame, ttl_us: int, by, order, at) -> DataFrame:
    """Walk each group in time order. No group is hot, and rows stream through."""
    ordered = df.repartition(*by).sortWithinPartitions(*by, at, *order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, recorded = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = [batch[c] for c in by]
            changes = np.zeros(batch.num_rows, dtype=bool)
            for key in keys:
                # a null key is a key like any other
                apart = pc.or_kleene(pc.not_equal(key[1:], key[:-1]), pc.xor(pc.is_null(key[1:]), pc.is_null(key[:-1])))
                changes[1:] |= pc.fill_null(apart, False).to_numpy(zero_copy_only=False)
            changes[0] = group != tuple(key[0].as_py() for key in keys)
            group = tuple(key[-1].as_py() for key in keys)
            keep, recorded = _kept(batch[at].to_numpy(), changes, recorded, ttl_us)
            yield batch.filter(pa.array(keep))

    return ordered.mapInArrow(walk, df.schema)


def _kept(times: np.ndarray, new: np.ndarray, recorded: int, ttl_us: int) -> tuple[np.ndarray, int]:
    """Which rows of sorted groups stay, and the time of the last that does; ``new`` begins a group.

    A row further than the ttl from the one before it stays whatever came before;
    a stretch between such rows that is no longer than the ttl has no other. Only in longer ones, and in the
    stretch that the batch before began, a search finds each next row that stays.
    """
    apart = np.flatnonzero(new | np.concatenate(([False], np.diff(times) > ttl_us)))
    keep = np.zeros(len(times), bool)
    keep[apart] = True
    ends = np.append(apart[1:], len(times))
    stretches = [(a, b, times[a]) for a, b in zip(apart.tolist(), ends.tolist()) if times[b - 1] - times[a] > ttl_us]
    if not len(apart) or apart[0]:
        stretches.append((0, int(apart[0]) if len(apart) else len(times), recorded))
    for low, high, last in stretches:
        while (low := low + int(np.searchsorted(times[low:high], last + ttl_us, side="right"))) < high:
            keep[low], last = True, times[low]
    held = np.flatnonzero(keep)
    return keep, int(times[held[-1]]) if len(held) else recorded


def _greedy_jumps(df: DataFrame, ttl_us: int, by, order, at) -> DataFrame:
    """The hot groups, whose rows no task holds together.

    After a kept row the next kept one is the first row more than ``ttl`` later.
    So every row points to that row, found by a running value over slices, and
    the kept rows are those reached from the first row of each group. A round
    doubles how far the pointers reach and how many rows are reached: log2 of
    the kept rows of a group, whatever the ttl. Pointers join by row number,
    which no row shares.
    """
    rest = [c for c in order if c != at]
    places = stored(df.select(*by, at, *rest).withColumn("_row", F.monotonically_increasing_id()), "places")
    rows = places.select("*", (F.col(at) * 2).alias("_step"), F.lit(False).alias("_probe"))
    probes = rows.select(*by, *rest, "_row", (F.col("_step") + 2 * ttl_us + 1).alias("_step"), F.lit(True).alias("_probe"))
    found = running(rows.unionByName(probes, allowMissingColumns=True), by, ["_step", *rest], None,
                    {"_next": Running("last", F.when(~F.col("_probe"), F.col("_row")))}, reverse=True)
    jumps = stored(found.filter(F.col("_probe") & F.col("_next").isNotNull()).select("_row", "_next"), "jumps")
    first = places.groupBy(*by).agg(F.min_by("_row", F.struct(at, *rest)).alias("_row"))
    kept = stored(first.select("_row"), "kept")
    while True:
        reached = stored(kept.join(jumps, "_row").select(F.col("_next").alias("_row")), "kept")
        if reached.isEmpty():
            break
        kept = kept.unionByName(reached)
        over = jumps.select(F.col("_row").alias("_next"), F.col("_next").alias("_over"))
        jumps = stored(jumps.join(over, "_next").select("_row", F.col("_over").alias("_next")), "jumps")
    chosen = places.join(kept, "_row", "left_semi").select(*[F.col(c).alias(f"_kept_{c}") for c in (*by, at, *rest)])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_kept_{c}")) for c in (*by, at, *rest)])
    return df.join(chosen, same, "left_semi")


def dedup_consecutive(df: DataFrame, by: Sequence[str] = ("topic", "key", "part"), order: str = "off",
                      slice_by: Column | None = None) -> DataFrame:
    """Drop a message whose id equals the one just before it under its key."""
    near = previous(df, by, [order], by_number(order) if slice_by is None else slice_by, {"_before": "id"})
    same = F.coalesce(F.col("id") == F.col("_before"), F.lit(False))
    return near.filter(~same).drop("_before")


def distinct_ids(df: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Best-effort dedup: one message per id, no matter which, with its copy count."""
    return df.filter(F.col(by[-1]).isNotNull()).groupBy(*by).agg(F.count("*").alias("copies"))


def dedup_ledger(df: DataFrame, version: str = "1", by: Sequence[str] = KEYS, at: str = "ts_us") -> DataFrame:
    """The record of seen ids that outlives a restart: one row per id, when first seen."""
    seen = df.filter(F.col(by[-1]).isNotNull())
    return seen.groupBy(*by).agg(F.min(at).alias("recorded_us")).withColumn("version", F.lit(version))


def ledger_filter(
    df: DataFrame,
    ledger: DataFrame,
    now_us: int,
    ttl_s: float = WEEK_S,
    version: str = "1",
    by: Sequence[str] = KEYS,
) -> DataFrame:
    """Drop messages an unexpired ledger entry of this version already names.

    The ledger is pruned first and holds one row per id. Messages without an id
    cannot match, so they skip the join.
    """
    live = ledger.filter((F.col("version") == version) & unexpired(F.col("recorded_us"), now_us, ttl_s))
    named = live.select(*[F.col(c).alias(f"_live_{c}") for c in by])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_live_{c}")) for c in by])
    with_id = df.filter(F.col(by[-1]).isNotNull()).join(named, same, "left_anti")
    return with_id.unionByName(df.filter(F.col(by[-1]).isNull()))


def producer_dedup(df: DataFrame, by: Sequence[str] = KEYS, order: Sequence[str] = ("part", "off"),
                   cache_size: int = 8192) -> DataFrame:
    """Send an id to a key only once."""
    return dedup(df, by=by, order=order, cache_size=cache_size)


def processed_offsets(df: DataFrame) -> DataFrame:
    """Highest processed offset per partition: one row per topic partition."""
    return df.groupBy("topic", "part").agg(F.max("off").alias("processed"))


def offset_filter(df: DataFrame, processed: DataFrame, max_partitions: int = 100_000) -> DataFrame:
    """Keep messages above the last processed offset of their partition.

    A partition may hold a third of the rows, so its rows must not be shuffled
    together. ``processed`` has one row per partition; its size is checked, and
    only past ``max_partitions`` is the join left to the optimizer's skew
    handling.
    """
    side = processed.select("topic", "part", "processed")
    joined = df.join(bounded(side, max_partitions), ["topic", "part"], "left")
    return joined.filter(F.col("off") > F.coalesce(F.col("processed"), F.lit(-1))).drop("processed")


def latest_per_key(
    df: DataFrame, by: Sequence[str] = ("key",), order: Sequence[str] = ("ts_us", "part", "off")
) -> DataFrame:
    """Idempotent upsert: the last write per key wins."""
    rest = [c for c in df.columns if c not in by]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*by).agg(last).select(*[F.col(c) if c in by else F.col(f"_last.{c}") for c in df.columns])
