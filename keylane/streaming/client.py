"""Start, watch and stop a keyed event consumer."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from keylane.handlers import EventHandler
from keylane.operators.filters import filter_allowed_events, filter_own_messages
from keylane.operators.health import is_stalled
from keylane.options import PipelineOptions
from keylane.sources.messages import read_messages, to_records, with_reserved_fields, write_messages, write_stream
from keylane.sources.sinks import dead_letters, failure_records, result_telemetry, telemetry_records
from keylane.streaming.gate import FailureGate
from keylane.streaming.processor import process_stream


class EventClient:
    """Consumes topics with a handler and sends messages."""

    def __init__(self, spark: SparkSession, options: PipelineOptions | None = None, **given: Any):
        self.spark = spark
        self.options = (options or PipelineOptions()).replace(**given)
        self.query: StreamingQuery | None = None

    @property
    def source_system(self) -> str | None:
        return self.options.origin

    @property
    def consumer_state(self) -> str:
        """``unconfigured``, ``configured`` or ``running``; a failed run raises its error."""
        if not (self.options.group_id and self.options.subscribed_topics):
            return "unconfigured"
        if self.query is None:
            return "configured"
        if self.query.isActive:
            return "running"
        if self.query.exception() is not None:
            raise self.query.exception()
        return "configured"

    def subscribe(
        self,
        handler: Callable[[], EventHandler],
        sink: str,
        checkpoint: str,
        source: str = "kafka",
        *,
        event_time: bool = False,
        bounded: bool = False,
    ) -> StreamingQuery:
        """Run the handler over the subscribed topics until :meth:`unsubscribe`.

        Outcomes go to tables below ``sink``; ``bounded`` stops once the source
        is drained. Progress is kept in ``checkpoint``.
        """
        if self.consumer_state == "unconfigured":
            raise ValueError("a consumer needs group_id and subscribed_topics")
        if self.consumer_state == "running":
            raise RuntimeError("already subscribed")
        incoming = with_reserved_fields(read_messages(self.spark, source, None, self.options))
        wanted = filter_own_messages(
            filter_allowed_events(incoming, self.options.allowed_events), self.options.group_id
        ).withColumn("payload", F.to_json("payload"))
        results = process_stream(wanted, handler, self.options, event_time=event_time)
        gate = None
        if self.options.mode == "pipeline" and self.options.defer_enabled:
            gate = FailureGate(f"{checkpoint}/gate", self.options)
            gate.resume(self.spark, checkpoint)
        writer = (
            results.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(route_batch(sink, self.options, gate))
        )
        if bounded:
            writer = writer.trigger(availableNow=True)
        else:
            # a micro-batch both polls the source and commits, so it comes as often as the longer of both says
            pause = max(self.options.poll_interval, self.options.commit_interval)
            writer = writer.trigger(processingTime=f"{round(pause * 1000)} milliseconds")
        self.query = writer.start()
        return self.query

    def unsubscribe(self) -> None:
        """Finish the running micro-batch within the shutdown budget, then stop."""
        if self.query is None:
            return
        end = time.monotonic() + self.options.shutdown_timeout
        while self.query.isActive and self.query.status["isTriggerActive"] and time.monotonic() < end:
            time.sleep(0.05)
        self.query.stop()
        self.query = None

    def send_message(self, topic: str, key: str, payload: Any, path: str | None = None) -> None:
        """Send one JSON value to a topic; for many, use :meth:`send`."""
        row = self.spark.createDataFrame([(key, json.dumps(payload))], "key string, payload string")
        self.send(row.withColumn("payload", F.parse_json("payload")), topic, path)

    def send(self, df: DataFrame, topic: str, path: str | None = None) -> None:
        """Send a table with ``key`` and ``payload``."""
        write_messages(to_records(df, topic, "key", F.col("payload"), self.source_system), self.options, path)

    def send_stream(self, df: DataFrame, topic: str, checkpoint: str, path: str | None = None) -> StreamingQuery:
        """Send a stream with ``key`` and ``payload``, for as long as the query runs."""
        records = to_records(df, topic, "key", F.col("payload"), self.source_system)
        return write_stream(records, self.options, checkpoint, path).start()

    @property
    def assigned_partitions(self) -> int:
        """Partitions the running query has read from; ready when there is one."""
        if self.query is None or self.query.lastProgress is None:
            return 0
        return sum(count_partitions(source["endOffset"]) for source in self.query.lastProgress["sources"])

    def is_stalled(self, progress: DataFrame, now_us: int) -> bool:
        """Whether a partition made no progress for longer than the threshold."""
        return is_stalled(progress, now_us, self.options).first()["is_stalled"]


def count_partitions(offsets: Any) -> int:
    """Partitions named in a source's offsets, ``{topic: {partition: offset}}``."""
    if isinstance(offsets, str):
        offsets = json.loads(offsets)
    if not isinstance(offsets, dict):
        return 0
    return sum(len(partitions) for partitions in offsets.values() if isinstance(partitions, dict))


def route_batch(sink: str, options: PipelineOptions, gate: FailureGate | None = None):
    """A ``foreachBatch`` function: outcomes, failure records, telemetry, dead letters, and the gate of the next batch.

    Each batch overwrites folders named by its id, so repeating it is harmless.
    """

    def emit(records: DataFrame, name: str, batch_id: int) -> None:
        if options.mock or not options.bootstrap_servers:
            records.write.mode("overwrite").parquet(f"{sink}/{name}/batch={batch_id}")
        else:
            write_messages(records, options)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{sink}/outcomes/batch={batch_id}")
            named = batch.withColumn("cancelled", F.coalesce(F.col("error_class") == "Cancelled", F.lit(False)))
            for kind in ("message", "timer"):
                failures = failure_records(named.filter(F.col("kind") == kind), timer=kind == "timer")
                failures.write.mode("overwrite").parquet(f"{sink}/failures/batch={batch_id}/kind={kind}")
            if options.telemetry_enabled:
                told = telemetry_records(result_telemetry(batch), options.telemetry_topic, options.origin)
                emit(told, "telemetry", batch_id)
            if options.failure_topic is not None:
                letters = dead_letters(
                    batch.filter(F.col("kind") == "message"), options.failure_topic, options.origin,
                    F.try_parse_json("payload"),
                )
                emit(letters, "dead_letters", batch_id)
            if gate is not None:
                gate.update(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def run_to_table(stream: DataFrame, folder: str, timeout_s: int | None = None) -> DataFrame:
    """Drain a bounded stream into a table below ``folder`` and read it back, however long it takes unless a time is given."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/table")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    ended = query.awaitTermination(timeout_s)
    query.stop()
    if ended is False:
        raise TimeoutError(f"the stream did not end within {timeout_s} s")
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")
