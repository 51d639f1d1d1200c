import pytest
from pyspark.sql import functions as F

from keylane.operators import failures as R
from keylane.options import PipelineOptions

S = 1_000_000


def outcomes(spark, rows):
    """rows: (n, second, error class, attempt)."""
    df = spark.createDataFrame([("t", 0, n, "k", round(s * S), round(s * S) + 5, 5, e, a) for n, s, e, a in rows],
                               "topic string, part int, off bigint, key string, start_us bigint, end_us bigint, "
                               "dur_ms bigint, error_class string, attempt int")
    return R.classify(df, {"IOError": "transient", "ValueError": "permanent"})


def test_classes(spark):
    rows = [(0, 0, None, 1), (1, 1, "IOError", 1), (2, 2, "ValueError", 1), (3, 3, "Cancelled", 1), (4, 4, "New", 1)]
    got = [(r["outcome"], r["cancelled"]) for r in outcomes(spark, rows).orderBy("off").collect()]
    assert got == [("success", False), ("transient", False), ("permanent", False), ("transient", True),
                   ("transient", False)]
    assert R.classify(outcomes(spark, rows).drop("outcome", "cancelled"), {}).filter("outcome = 'permanent'").count() == 0


ROWS = [(0, 0, None, 1), (1, 1, "IOError", 3), (2, 2, "IOError", 4), (3, 3, "ValueError", 1)]


@pytest.mark.parametrize("mode, routes", [
    ("pipeline", ["done", "retry", "retry", "skip"]),
    ("LOW_LATENCY", ["done", "retry", "dead_letter", "dead_letter"]),
    ("best_effort", ["done", "skip", "skip", "skip"]),
])
def test_routes(spark, mode, routes):
    assert [r["route"] for r in R.route(outcomes(spark, ROWS), mode).orderBy("off").collect()] == routes


def test_retry_plan(spark):
    got = [(r["exhausted"], r["delay_ms"]) for r in R.retry_plan(outcomes(spark, ROWS)).orderBy("off").collect()]
    assert got == [(False, None), (False, 80), (True, None), (False, None)]


def test_defer_plan_and_backlog(spark):
    plan = R.defer_plan(outcomes(spark, ROWS), PipelineOptions(defer_max_delay=5))
    assert [(r["off"], r["delay_ms"]) for r in plan.orderBy("off").collect()] == [(1, 4000), (2, 5000)]
    backlog = R.deferred_backlog(plan).first()
    assert (backlog["messages"], backlog["keys"], backlog["next_retry_us"]) == (2, 1, S + 5 + 4 * S)


def test_failure_rate_at_the_threshold(spark):
    """Nine of ten failing is still allowed, ten of ten is not."""
    rows = [(0, 0, None, 1)] + [(i, i, "IOError", 1) for i in range(1, 11)]
    rated = R.failure_rate(outcomes(spark, rows), PipelineOptions(defer_failure_window=9))
    got = {r["off"]: (r["window_failed"], r["window_all"], r["defer_allowed"]) for r in rated.collect()}
    assert got[9] == (9, 10, True)
    assert got[10] == (10, 10, False)
    off = R.failure_rate(outcomes(spark, rows), PipelineOptions(defer_enabled=False))
    assert off.filter("defer_allowed").count() == 0


def test_timeouts(spark):
    df = outcomes(spark, ROWS).withColumn("dur_ms", F.col("off") * 24_000)
    late = R.execution_timeouts(df, PipelineOptions(stall_threshold=60)).collect()
    assert [(r["off"], r["cancelled_us"] - r["start_us"], r["timeout_outcome"]) for r in late] == [(3, 48 * S, "transient")]


def test_resolution(spark):
    rows = [(7, 0, "IOError", 1), (7, 1, None, 2), (8, 0, "ValueError", 1)]
    got = R.resolution(outcomes(spark, rows), by=("topic", "part", "off"), order=("start_us",))
    assert {r["off"]: (r["outcome"], r["attempts"]) for r in got.collect()} == {7: ("success", 2), 8: ("permanent", 1)}
