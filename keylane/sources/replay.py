"""Bounded replay of a log: the few ranges of offsets that hold what is to be read again."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keylane.operators.ordered import Running, by_number, previous, running
from keylane.sources.messages import reload

PLACE = ("topic", "part")


def replay_ranges(deferred: DataFrame, gap: int = 1000) -> DataFrame:
    """Rows (topic, part, first_off, last_off, wanted): offsets of a partition at most ``gap`` apart are one range.

    An island begins where the offset before is further away; its number is a
    running count, so the offsets of a partition are never gathered. Offsets
    that are null are in no range, repeated ones count once.
    """
    offsets = deferred.select(*PLACE, "off").filter(F.col("off").isNotNull()).distinct()
    near = previous(offsets, PLACE, ["off"], by_number("off"), {"_before": "off"})
    begins = near.withColumn("_begins", (F.col("_before").isNull() | (F.col("off") - F.col("_before") > gap)).cast("int"))
    numbered = running(begins, PLACE, ["off"], by_number("off"), {"_island": Running("sum", F.col("_begins"))}, inclusive=True)
    return numbered.groupBy(*PLACE, "_island").agg(
        F.min("off").alias("first_off"), F.max("off").alias("last_off"), F.count("*").alias("wanted")).drop("_island")


def few_ranges(deferred: DataFrame, gap: int = 1000, most: int = 1000) -> list:
    """At most ``most`` ranges that hold all deferred offsets: the gap is widened until they are so few.

    Should there be more partitions than that, there is one range each, as a Kafka read has.
    """
    while True:
        ranges = replay_ranges(deferred, gap)
        found = ranges.limit(most + 1).collect()
        if len(found) <= most:
            return found
        if gap >= 2**62:
            return ranges.collect()
        gap = min(gap * 16, 2**62)


def reload_ranges(deferred: DataFrame, log: DataFrame, gap: int = 1000, most: int = 1000) -> DataFrame:
    """Stored messages of deferred offsets, like :func:`reload`, from the ranges of the log that hold them.

    The ranges are a filter on the log's columns: files and row groups of other
    offsets are not read. Gone offsets are flagged ``offset_deleted``.
    """
    ranges = few_ranges(deferred, gap, most)
    inside = [F.col("topic").eqNullSafe(r["topic"]) & F.col("part").eqNullSafe(r["part"]) & F.col("off").between(r["first_off"], r["last_off"])
              for r in ranges]
    return reload(deferred, log.filter(_any(inside)))


def _any(conditions: list):
    """One condition out of many, as a shallow tree."""
    while len(conditions) > 1:
        conditions = [reduce(lambda a, b: a | b, conditions[i: i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0] if conditions else F.lit(False)


def kafka_offsets(ranges: list) -> tuple[str, str]:
    """``starting`` and ``ending`` for :func:`read_messages`: one span a partition, which is all that one Kafka read can say."""
    first: dict[str, dict[str, int]] = {}
    last: dict[str, dict[str, int]] = {}
    for r in ranges:
        part = str(r["part"])
        low, high = first.setdefault(r["topic"], {}), last.setdefault(r["topic"], {})
        low[part] = min(low.get(part, r["first_off"]), r["first_off"])
        high[part] = max(high.get(part, 0), r["last_off"] + 1)  # the end is exclusive
    return json.dumps(first), json.dumps(last)
