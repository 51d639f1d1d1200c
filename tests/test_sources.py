import json

import pytest
from pyspark.sql import functions as F

from keylane.options import PipelineOptions
from keylane.sources.messages import decode, header_map, read_messages, reload, to_records, with_reserved_fields, write_messages
from keylane.sources.sinks import failure_records, telemetry
from keylane.streaming.client import EventClient, count_partitions

RECORD = ("topic string, partition int, offset bigint, timestamp timestamp, key string, value string, "
          "headers array<struct<key:string,value:binary>>")


def test_decode(spark):
    rows = [("t", 1, 5, None, "test-key", '{"content":"Hello","type":"a.b","id":"x"}',
             [("source-system", bytearray(b"first")), ("source-system", bytearray(b"last"))]),
            ("t", 1, 6, None, "k", "not json", []), ("t", 1, 7, None, "k", "[1,2]", None)]
    got = with_reserved_fields(decode(spark.createDataFrame(rows, RECORD))).withColumn("payload", F.to_json("payload"))
    found = [(r["off"], r["type"], r["id"], r["source_system"], r["payload"]) for r in got.orderBy("off").collect()]
    assert found[0][:4] == (5, "a.b", "x", "last") and json.loads(found[0][4])["content"] == "Hello"
    assert found[1:] == [(6, None, None, None, None), (7, None, None, None, "[1,2]")]


def test_typed_payload(spark):
    rows = [("t", 0, 0, None, "k", '{"n": 3}', [])]
    assert decode(spark.createDataFrame(rows, RECORD), "n int").select("payload.n").first()[0] == 3


def test_records_carry_the_origin(spark):
    df = spark.createDataFrame([("k", "v")], "key string, content string")
    record = to_records(df, "topic", "key", F.struct("content"), "test-source")
    row = record.withColumn("h", header_map(F.col("headers"))).first()
    assert (row["topic"], row["key"], row["value"], row["h"]) == ("topic", "k", '{"content":"v"}', {"source-system": "test-source"})
    untagged = to_records(df, "topic", "key", F.struct("content"), None).first()
    assert untagged["headers"] == []


def test_reload_flags_deleted_offsets(spark):
    deferred = spark.createDataFrame([("t", 0, 1), ("t", 0, 2)], "topic string, part int, off bigint")
    log = spark.createDataFrame([("t", 0, 2, "x")], "topic string, part int, off bigint, payload string")
    got = {r["off"]: (r["payload"], r["offset_deleted"]) for r in reload(deferred, log).collect()}
    assert got == {1: (None, True), 2: ("x", False)}


def test_broker_needs_servers_and_topics(spark):
    with pytest.raises(ValueError):
        read_messages(spark, "kafka", "t", PipelineOptions())
    with pytest.raises(ValueError):
        read_messages(spark, "kafka", None, PipelineOptions(bootstrap_servers="b:9092"))
    with pytest.raises(ValueError):
        write_messages(spark.range(1), PipelineOptions())


def test_topics_of_a_folder(spark, tmp_path):
    rows = [("a", 0, 0, None, "k", "1", []), ("b", 0, 0, None, "k", "2", [])]
    spark.createDataFrame(rows, RECORD).write.parquet(str(tmp_path / "log"))
    assert read_messages(spark, str(tmp_path / "log"), "b", streaming=False).count() == 1
    assert read_messages(spark, str(tmp_path / "log"), streaming=False).count() == 2


def test_client_sends(spark, tmp_path):
    client = EventClient(spark, group_id="test-group")
    assert client.source_system == "test-group"
    client.send_message("my-topic", "message-key", {"content": "Hello"}, path=str(tmp_path / "out"))
    sent = spark.read.parquet(str(tmp_path / "out")).first()
    assert (sent["topic"], sent["key"], json.loads(sent["value"])) == ("my-topic", "message-key", {"content": "Hello"})


def test_failure_records_skip_cancelled(spark):
    rows = [("t", 0, 1, "k", "transient", "IOError", False), ("t", 0, 2, "k", "transient", "Cancelled", True),
            ("t", 0, 3, "k", "success", None, False)]
    df = spark.createDataFrame(rows, "topic string, part int, off bigint, key string, outcome string, "
                                     "error_class string, cancelled boolean")
    df = df.withColumn("error_message", F.lit("m")).withColumn("error_cause", F.lit(None).cast("string"))
    got = failure_records(df).collect()
    assert len(got) == 1 and got[0]["task_id"] == "t/0:1"
    assert got[0]["context"].asDict() == {"event_type": "message", "topic": "t", "partition": "0", "key": "k", "offset": "1"}
    timer = failure_records(df.withColumn("fire_s", F.lit(60).cast("bigint")), timer=True).first()
    assert timer["task_id"] == "timer/k/1970-01-01T00:01:00Z" and timer["event_type_tag"] == "timer"


def test_telemetry_can_be_switched_off(spark):
    df = spark.createDataFrame([("t", 0, 1, "k", "success", None, 0, 1_500_000)],
                               "topic string, part int, off bigint, key string, outcome string, error_class string, "
                               "start_us bigint, end_us bigint")
    assert [r["event_time"] for r in telemetry(df).orderBy("event_time").collect()] == [
        "1970-01-01T00:00:00.000Z", "1970-01-01T00:00:01.500Z"]
    assert telemetry(df, enabled=False).count() == 0


def test_partitions_of_offsets():
    assert count_partitions('{"a":{"0":5,"1":7},"b":{"0":1}}') == 3
    assert count_partitions({"logOffset": 3}) == 0
    assert count_partitions(None) == 0


def test_client_sends_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("k1", '{"a": 1}'), ("k2", '{"a": 2}')], "key string, payload string")
    rows.write.parquet(f"{tmp_path}/rows")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/rows").withColumn("payload", F.parse_json("payload"))
    client = EventClient(spark, source_system="shop", mock=True)
    query = client.send_stream(stream, "orders", f"{tmp_path}/progress", f"{tmp_path}/sent")
    query.processAllAvailable()
    query.stop()
    sent = read_messages(spark, f"{tmp_path}/sent", "orders", streaming=False)
    assert sorted(r["key"] for r in sent.select("key").collect()) == ["k1", "k2"]
