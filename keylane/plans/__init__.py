"""Named queries over the stored tables, each with the SQL that checks it."""

from keylane.plans import dedups, failing, filtering, keyed, lasting, load, streams, timing, tracing, transport  # noqa: F401
from keylane.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
