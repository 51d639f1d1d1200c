"""Keyed message source and sink.

A *record* is what a broker stores: topic, partition, offset, timestamp, key,
value and headers. A *message* is the decoded row the operators work on, with
``part``, ``off``, ``ts``, ``ts_us`` and the payload as a variant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keylane.functions.scalars import payload_get
from keylane.options import PipelineOptions

SOURCE_SYSTEM = "source-system"

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
            ),
        ),
    ]
)


def read_messages(
    spark: SparkSession,
    source: str,
    topics: Sequence[str] | str | None = None,
    options: PipelineOptions | None = None,
    *,
    streaming: bool = True,
    starting: str | None = None,
    ending: str | None = None,
) -> DataFrame:
    """Messages of the topics, as a stream or a bounded replay.

    ``source`` is ``"kafka"`` or a folder of record files; the folder also
    stands in for a broker in tests (``mock``). ``starting`` and ``ending`` are
    offset texts of the Kafka source.
    """
    options = options or PipelineOptions()
    topics = PipelineOptions(subscribed_topics=topics).subscribed_topics or options.subscribed_topics
    reader = spark.readStream if streaming else spark.read
    if source == "kafka" and not options.mock:
        if not topics or not options.bootstrap_servers:
            raise ValueError("the kafka source needs bootstrap_servers and topics")
        settings = {
            "kafka.bootstrap.servers": ",".join(options.bootstrap_servers),
            "subscribe": ",".join(topics),
            "includeHeaders": "true",
            "startingOffsets": starting,
            "endingOffsets": None if streaming else ending,
            "maxOffsetsPerTrigger": options.max_offsets_per_trigger if streaming else None,
        }
        records = reader.format("kafka").options(**{k: v for k, v in settings.items() if v is not None}).load()
        return decode(records)
    if streaming:
        reader = reader.option("maxBytesPerTrigger", options.max_bytes_per_trigger)
    records = reader.schema(RECORD_SCHEMA).parquet(source)
    if topics:
        records = records.filter(F.col("topic").isin(*topics))
    return decode(records)


def decode(records: DataFrame, payload_schema: str | None = None) -> DataFrame:
    """Records to messages; a value that is not JSON gives a null payload.

    ``payload_schema`` (DDL) gives a typed payload instead of a variant.
    """
    text = F.col("value").cast("string")
    payload = F.from_json(text, payload_schema) if payload_schema else F.try_parse_json(text)
    return records.select(
        "topic",
        F.col("partition").alias("part"),
        F.col("offset").alias("off"),
        F.col("key").cast("string").alias("key"),
        F.col("timestamp").alias("ts"),
        F.unix_micros("timestamp").alias("ts_us"),
        payload.alias("payload"),
        header_map(F.col("headers")).alias("headers"),
    )


def header_map(headers: Column) -> Column:
    """Broker headers as a text map; the last value of a repeated header wins."""
    named = F.transform(headers, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    last = F.filter(
        named,
        lambda h, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["key"] == h["key"]),
    )
    return F.map_from_entries(last)


def with_reserved_fields(messages: DataFrame) -> DataFrame:
    """Add the reserved payload fields and the origin header as columns."""
    return messages.select(
        "*",
        payload_get(F.col("payload"), "$.type").alias("type"),
        payload_get(F.col("payload"), "$.id").alias("id"),
        F.try_element_at("headers", F.lit(SOURCE_SYSTEM)).alias("source_system"),
    )


def to_records(
    df: DataFrame,
    topic: Column | str,
    key: Column | str,
    payload: Column,
    source_system: str | None,
    headers: Column | None = None,
) -> DataFrame:
    """Outgoing records: JSON value, key, and headers with the origin tag.

    ``payload`` is a struct, map, array, variant, or a column of JSON text made
    by the caller. Other columns of ``df`` are dropped; column pruning then
    reaches the scan.
    """
    topic = F.lit(topic) if isinstance(topic, str) else topic
    key = F.col(key) if isinstance(key, str) else key
    carried = headers if headers is not None else F.array().cast(RECORD_SCHEMA["headers"].dataType)
    if source_system is not None:
        tag = F.struct(F.lit(SOURCE_SYSTEM).alias("key"), F.lit(source_system).cast("binary").alias("value"))
        carried = F.concat(carried, F.array(tag))
    return df.select(
        topic.alias("topic"),
        key.cast("string").alias("key"),
        F.to_json(payload).alias("value"),
        carried.alias("headers"),
    )


def write_messages(records: DataFrame, options: PipelineOptions, path: str | None = None) -> None:
    """Write a batch of records to the broker, or append to a folder."""
    if path is not None:
        records.write.mode("append").parquet(path)
        return
    if not options.bootstrap_servers:
        raise ValueError("writing to the broker needs bootstrap_servers")
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", ",".join(options.bootstrap_servers))
        .option("kafka.delivery.timeout.ms", str(int(options.send_timeout * 1000)))
        .option("kafka.request.timeout.ms", str(int(options.send_timeout * 1000)))
        .option("kafka.linger.ms", "0")
        .save()
    )


def write_stream(records: DataFrame, options: PipelineOptions, checkpoint: str, path: str | None = None):
    """Send a stream of records to the broker, or append it to a folder."""
    writer = records.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if path is not None:
        return writer.format("parquet").option("path", path)
    if not options.bootstrap_servers:
        raise ValueError("writing to the broker needs bootstrap_servers")
    return writer.format("kafka").option("kafka.bootstrap.servers", ",".join(options.bootstrap_servers))


def reload(deferred: DataFrame, log: DataFrame, on: Sequence[str] = ("topic", "part", "off")) -> DataFrame:
    """Stored messages of deferred offsets; gone ones are flagged ``offset_deleted``.

    An offset is unique in its partition, so the join has no hot key.
    """
    found = log.withColumn("_found", F.lit(True))
    return deferred.join(found, list(on), "left").withColumn("offset_deleted", F.col("_found").isNull()).drop("_found")
