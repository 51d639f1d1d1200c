"""Plans: no nested loops, no row-at-a-time Python, pushed filters, split windows."""

import re

import pytest
from pyspark.sql import functions as F

from keylane.operators import dedup as D
from keylane.operators import fairness as L
from keylane.operators.filters import filter_allowed_events, filter_topics
from keylane.operators.keyed import sequence_per_key
from keylane.operators.ordered import even_slices
from keylane.operators.timers import surviving
from keylane.plans import QUERIES
from keylane.plans.base import events_table
from keylane.sources import views

STREAMS = [n for n in QUERIES if n.endswith("_stream")]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def details(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS)))
def test_no_nested_loops_and_no_row_udfs(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "GlobalLimit"):
        if bad == "GlobalLimit" and name in ("hot_keys", "fair_order"):
            continue
        assert bad not in text, text


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("t", "user.a", 1)], "topic string, type string, n int").write.parquet(str(tmp_path / "m"))
    df = filter_allowed_events(filter_topics(spark.read.parquet(str(tmp_path / "m")), ["t", "u"]), ["user.", "account."])
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", details(df.select("n"))).group(1)
    assert "StringStartsWith(type,user.)" in pushed and "In(topic" in pushed


def test_columns_are_pruned(spark, sf_dir):
    text = plan(views.executions(events_table(spark, sf_dir)).groupBy("key").agg(F.max("dur_ms")))
    assert "ReadSchema: struct<user_id:bigint,value:double>" in text


def windows(text):
    """Partition columns of each window in a plan."""
    return re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", text)


def test_rows_are_windowed_in_slices(spark, sf_dir):
    """Windows over rows are partitioned by slice; only slice totals by key alone."""
    rows = views.messages(events_table(spark, sf_dir), offsets=False).select("topic", "part", "key", "event_id")
    found = windows(plan(sequence_per_key(rows, order="event_id")))
    assert any("_slice" in w for w in found) and len(found) == 2


def test_timer_windows_are_sliced(spark, sf_dir):
    ops = views.timer_ops(events_table(spark, sf_dir))
    text = plan(surviving(ops, even_slices(ops, "ts_us", 100)))
    assert sum("_slice" in w for w in windows(text)) >= 2


def test_clipped_monopolization_has_no_join_of_rows(spark, sf_dir):
    execs = views.executions(events_table(spark, sf_dir)).select("event_id", "key", "start_us", "end_us")
    text = plan(L.monopolization_clipped(execs))
    assert "Join" not in text


def test_dedup_reduces_before_the_shuffle(spark, sf_dir):
    rows = views.messages(events_table(spark, sf_dir), offsets=False).select("topic", "part", "key", "id", "event_id")
    text = plan(D.dedup(rows, order=("part", "event_id")))
    assert "partial_min_by" in text and "Window" not in text and text.count("Exchange hashpartitioning") == 1
