"""Sharding as a minimax contiguous partition, with DataFrame functions only.

Equal texts are one group that is never cut. Groups are ordered by a hash of
the text; a shard is a contiguous run of groups. The smallest capacity for
which a greedy fill needs no more shards than asked for is found by search, and
the cuts of that fill are the shards. A fill only asks, once a shard, how far a
capacity reaches on the line of running sizes: one aggregate over the groups,
for many capacities at once.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.shared import aside, documents, running_totals, slices_for, text_or_empty
from keylane.session import stored

SHARDS = 8
#: Capacities tried in one aggregate, and most group ends that the driver takes.
_TRIED, GATHERED = 32, 50_000


def _fills(groups: DataFrame, capacities: list[int], shards: int, total: int) -> list[list[int]]:
    """For each capacity, where a greedy fill ends each shard on the line of sizes."""
    at = [0] * len(capacities)
    ends: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        open_ = [i for i in range(len(at)) if at[i] < total]
        if not open_:
            break
        reach = [at[i] + capacities[i] for i in open_]
        near = groups.filter(F.col("end").between(min(at[i] for i in open_), max(reach)))
        found = near.agg(*[F.max(F.when(F.col("end") <= to, F.col("end"))).alias(f"c{n}") for n, to in enumerate(reach)]).first()
        for n, i in enumerate(open_):
            at[i] = max(at[i], found[n] or 0)
        for i in open_:
            ends[i].append(at[i])
    return ends


def smallest_capacity(groups: DataFrame, shards: int, total: int, largest: int, gathered: int = GATHERED) -> list[int]:
    """Where the greedy fill with the least capacity that ``shards`` contiguous runs need ends each of them.

    A larger capacity never ends a shard earlier. So between two capacities the
    ends lie between theirs; once at most ``gathered`` group ends lie there, the
    driver takes those and finishes the search alone. Until then each round tries
    many capacities in the same aggregates.
    """
    low, high = max(-(-total // shards), largest), total // shards + largest
    lowest, highest = _fills(groups, [low, high], shards, total)
    while lowest[-1] < total and high - low > 1:
        between = F.lit(False)
        for a, b in zip(lowest, [*highest, *[total] * shards], strict=False):
            between = between | F.col("end").between(a, b)
        near = groups.filter(between).select("end").limit(gathered + 1).toPandas()["end"]
        if len(near) <= gathered:
            ends = sorted(near)
            while high - low > 1:
                middle = (low + high) // 2
                fill = _fill(ends, middle, shards)
                low, high, highest = (low, middle, fill) if fill[-1] == total else (middle, high, highest)
            break
        step = max(1, (high - low) // (_TRIED + 1))
        tried = list(range(low + step, high, step))[:_TRIED + 1]
        for capacity, fill in zip(tried, _fills(groups, tried, shards, total), strict=True):
            if fill[-1] == total:
                high, highest = capacity, fill
                break
            low, lowest = capacity, fill
    return lowest if lowest[-1] == total else highest


def _fill(ends: list[int], capacity: int, shards: int) -> list[int]:
    """The greedy fill over sorted group ends that hold all it may reach."""
    at, fill = 0, []
    for _ in range(shards):
        found = bisect_right(ends, at + capacity)
        at = max(at, ends[found - 1] if found else 0)
        fill.append(at)
    return fill


def shard(docs: DataFrame, keep: list[str], shards: int = SHARDS) -> DataFrame:
    """The columns ``keep`` of the documents with ``size`` (bytes and 1), ``shard`` and ``slot``, a gapless number in the shard.

    A null text has size 1 and is a group of its own, apart from the empty text.
    An empty table gives no rows.
    """
    aside_, names = aside(docs)
    text = names["text"]
    held = aside_.select(*[names[c] for c in dict.fromkeys([*keep, "doc_id"])], F.xxhash64(text).alias("h1"),
                         F.xxhash64(F.lit("group"), text).alias("h2"),
                         (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"))
    light = stored(held.groupBy("h1", "h2").agg(F.sum("size").cast("long").alias("bytes"), F.count("*").alias("rows")), "groups")
    total, largest, count, rows = light.agg(F.sum("bytes"), F.max("bytes"), F.count("*"), F.sum("rows")).first()
    number: Column = F.lit(0)
    if count:
        line = running_totals(light.select("h1", "h2", "bytes"), [], F.col("h1"), [F.col("h2")], {"before": "bytes"}, slices_for(count))
        groups = stored(line.select("h1", "h2", (F.col("before") + F.col("bytes")).alias("end")), "line")
        ends = smallest_capacity(groups, shards, total, largest)
        cuts = groups.filter(F.col("end").isin([e for e in ends if e < total])).select("h1", "h2").collect()
        for cut in cuts:  # fewer than the number of shards
            after = (F.col("h1") > cut["h1"]) | ((F.col("h1") == cut["h1"]) & (F.col("h2") > cut["h2"]))
            number = number + after.cast("int")
    placed = held.withColumn("shard", number.cast("int")).withColumn("one", F.lit(1).cast("long"))
    numbered = running_totals(placed, ["shard"], F.xxhash64(names["doc_id"], "h1", "h2"), [F.col(names["doc_id"])], {"slot": "one"},
                              slices_for(rows or 0))
    return numbered.select(*[F.col(names[c]).alias(c) for c in keep], "size", "shard", "slot")


def op10_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.crc32(text_or_empty()).alias("text_crc32"))
    # only what the result needs goes through the numbering, not the texts
    return shard(docs, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
