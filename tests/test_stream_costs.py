"""What streams cost: calls of Spark and accesses to its states, that must not grow with the messages of a call."""

import inspect

from keylane.streaming.cache import RecentNames
from keylane.streaming.client import run_to_table
from tests.test_keyed_state import Clock, Handle


class Bigint:
    class dataType:
        @staticmethod
        def simpleString():
            return "bigint"


def test_a_sighting_in_the_cache_touches_no_state():
    handle = Handle()
    cache = RecentNames(5, ["id"], ["n"], ["id", "n"], {"id": Bigint})
    cache.init(handle)
    costs = []
    for low in range(0, 30_000, 10_000):
        before = handle.touched
        rows = [{"id": n % 7, "n": n} for n in range(low, low + 10_000)]
        assert len(list(cache.handleInputRows(("t", 0), iter(rows), Clock(0)))) == 10_000
        costs.append(handle.touched - before)
    assert max(costs) <= 2 + 5 * 5  # read once, old ones removed and new ones written, in both directions


def test_a_bounded_stream_may_take_its_time():
    assert inspect.signature(run_to_table).parameters["timeout_s"].default is None
