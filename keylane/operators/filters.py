"""Message filters, written as expressions so that Catalyst can push them down."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _listed(values: Sequence[str] | str | None) -> list[str]:
    if values is None:
        return []
    return [values] if isinstance(values, str) else list(values)


def filter_allowed_events(df: DataFrame, prefixes: Sequence[str] | str | None, type_: str = "type") -> DataFrame:
    """Keep messages whose type starts with a prefix, or that have no type.

    Without prefixes everything is kept. Matching is exact and case-sensitive.
    """
    prefixes = _listed(prefixes)
    if not prefixes:
        return df
    kind = F.col(type_)
    return df.filter(reduce(or_, [kind.startswith(p) for p in prefixes], kind.isNull()))


def filter_own_messages(df: DataFrame, group_id: str, source_system: str = "source_system") -> DataFrame:
    """Drop messages this consumer group sent itself; untagged ones are kept."""
    return df.filter(F.coalesce(F.col(source_system) != group_id, F.lit(True)))


def filter_topics(df: DataFrame, topics: Sequence[str] | str) -> DataFrame:
    return df.filter(F.col("topic").isin(*_listed(topics)))


def expire(df: DataFrame, now_us: int, ttl_s: float, at: str = "ts_us") -> DataFrame:
    """Drop rows older than ``ttl_s``; a row exactly that old is kept."""
    return df.filter(unexpired(F.col(at), now_us, ttl_s))


def unexpired(at_us: Column, now_us: int, ttl_s: float) -> Column:
    return at_us >= now_us - round(ttl_s * 1_000_000)
