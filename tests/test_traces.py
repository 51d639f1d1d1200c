import pytest
from pyspark.sql import functions as F

from keylane.operators import traces as X
from keylane.options import PipelineOptions

CHAIN = [("s1", "send", "producer", "t1", None), ("e1", "on_message", "message", "t1", "s1"),
         ("h1", "handler", "internal", "t1", "e1"), ("m1", "schedule", "internal", "t1", "h1"),
         ("f1", "on_timer", "timer", "t1", "m1")]


@pytest.fixture(scope="module")
def spans(spark):
    return spark.createDataFrame(CHAIN, "span_id string, name string, kind string, cause_trace_id string, cause_span_id string")


def test_default_relations(spans):
    got = {r["span_id"]: (r["trace_id"], r["parent_span_id"], r["link_span_id"]) for r in X.link_spans(spans).collect()}
    assert got["e1"] == ("t1", "s1", None)
    assert got["f1"] == ("t-f1", None, "m1")
    assert got["s1"] == ("t1", None, None)


def test_one_tree_over_parents_and_links(spans):
    for options in (PipelineOptions(), PipelineOptions(message_spans="follows_from")):
        trees = X.assemble_traces(X.link_spans(spans, options))
        if options.message_spans == "child":
            assert {(r["span_id"], r["root_span_id"], r["depth"]) for r in trees.collect()} == {
                (s[0], "s1", i) for i, s in enumerate(CHAIN)}
            assert tuple(X.trace_sizes(trees).first()) == ("t1", "s1", 5, 4)


SPAN = "span_id string, trace_id string, parent_span_id string, link_trace_id string, link_span_id string"


def test_a_deep_chain_has_one_root(spark):
    chain = [("0", "t", None, None, None)] + [
        (str(i), "t", str(i - 1), None, None) if i % 3 else (str(i), "t", None, "t", str(i - 1)) for i in range(1, 41)]
    got = {r["span_id"]: (r["root_span_id"], r["depth"]) for r in X.assemble_traces(spark.createDataFrame(chain, SPAN)).collect()}
    assert got == {str(i): ("0", i) for i in range(41)}


def test_a_cycle_is_an_error(spark):
    ring = [("a", "t", "c", None, None), ("b", "t", "a", None, None), ("c", "t", "b", None, None), ("d", "t", None, None, None)]
    with pytest.raises(ValueError, match="cycle"):
        X.assemble_traces(spark.createDataFrame(ring, SPAN))


@pytest.mark.parametrize("carrier, found", [
    ("00-4bf92f3577b34da6a3ce929d0e0e4736-00f067aa0ba902b7-01", ("4bf92f3577b34da6a3ce929d0e0e4736", "00f067aa0ba902b7", True)),
    ("00-4bf92f3577b34da6a3ce929d0e0e4736-00f067aa0ba902b7-02", ("4bf92f3577b34da6a3ce929d0e0e4736", "00f067aa0ba902b7", False)),
    ("00-00000000000000000000000000000000-00f067aa0ba902b7-01", None),
    ("00-4bf92f3577b34da6a3ce929d0e0e4736-0000000000000000-01", None),
    ("ff-4bf92f3577b34da6a3ce929d0e0e4736-00f067aa0ba902b7-01", None),
    ("00-4BF92F3577B34DA6A3CE929D0E0E4736-00f067aa0ba902b7-01", None),
    ("nonsense", None), (None, None),
])
def test_trace_context(spark, carrier, found):
    df = spark.createDataFrame([(carrier,)], "c string")
    got = df.select(X.trace_context(F.create_map(F.lit("traceparent"), F.col("c"))).alias("x")).first()["x"]
    assert (None if got is None else tuple(got)) == found


def test_status(spark):
    df = spark.createDataFrame([("success", False), ("transient", True), ("transient", False), ("permanent", False)],
                               "outcome string, cancelled boolean")
    assert [r["span_status"] for r in X.span_status(df).collect()] == ["unset", "unset", "error", "error"]
