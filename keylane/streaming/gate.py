"""The failure-rate gate of deferral: what one micro-batch saw decides how the next one retries."""

from __future__ import annotations

import json

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.options import PipelineOptions
from keylane.session import discard, last_committed

#: The local property of the stream's thread that tells its tasks which topics fail too often. It holds subscribed topics only.
CLOSED = "keylane.closed-topics"


def closed_topics() -> frozenset[str]:
    """Topics whose deferral is off, as a task of the stream sees it."""
    context = TaskContext.get()
    told = None if context is None else context.getLocalProperty(CLOSED)
    return frozenset(json.loads(told)) if told else frozenset()


class FailureGate:
    """Share of failed messages per topic over a rolling window, kept from micro-batch to micro-batch.

    A message counts once, by its first attempt, in the second it ran. Each
    micro-batch adds its counts to those before it and writes the seconds of the
    window, ending at the topic's newest second, to a folder of its own: a ring
    of at most a row a second and topic. Repeating a batch overwrites its ring,
    and a restarted stream goes on from that of the last committed batch. A
    topic without new messages stays as it was. Deferral is off strictly above the threshold.
    """

    def __init__(self, folder: str, options: PipelineOptions | None = None):
        options = options or PipelineOptions()
        self.folder = folder
        self.threshold = options.defer_failure_threshold
        self.window_s = options.defer_failure_window

    def resume(self, spark: SparkSession, checkpoint: str) -> None:
        """Before a stream starts: take the state its last committed batch left. The stream's thread inherits it."""
        last = last_committed(spark, checkpoint)
        spark.sparkContext.setLocalProperty(CLOSED, None if last is None else self._told(self.ring(spark, last)))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """In ``foreachBatch``, with the results of :func:`process_stream`: decide for the next micro-batch."""
        spark = batch.sparkSession
        first = batch.filter((F.col("kind") == "message") & (F.col("attempt") == 1)).groupBy(
            "topic", F.floor(F.col("at_us") / 1_000_000).alias("second")
        ).agg(F.count("*").alias("n"), F.sum((F.col("outcome") != "success").cast("bigint")).alias("failed"))
        before = self.ring(spark, batch_id - 1)
        merged = (first if before is None else first.unionByName(before)).groupBy("topic", "second").agg(
            F.sum("n").alias("n"), F.sum("failed").alias("failed"))
        # a topic has at most a row for each second of the window and of the batch
        newest = merged.groupBy("topic").agg(F.max("second").alias("newest"))
        ring = merged.join(F.broadcast(newest), "topic").filter(F.col("second") > F.col("newest") - F.lit(self.window_s)).drop("newest")
        ring.coalesce(1).write.mode("overwrite").parquet(self._place(batch_id))
        discard(spark, self._place(batch_id - 2))
        spark.sparkContext.setLocalProperty(CLOSED, self._told(self.ring(spark, batch_id)))

    def ring(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Counts per topic and second after a batch, if there are any."""
        place = spark._jvm.org.apache.hadoop.fs.Path(self._place(batch_id))
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return None
        return spark.read.schema("topic string, second bigint, n bigint, failed bigint").parquet(self._place(batch_id))

    def rates(self, ring: DataFrame) -> DataFrame:
        """Failure rate per topic, and whether deferral is on."""
        rate = F.sum("failed") / F.sum("n")
        return ring.groupBy("topic").agg(F.sum("n").alias("messages"), F.sum("failed").alias("failed"), rate.alias("failure_rate"),
                                         (rate <= self.threshold).alias("defer_allowed"))

    def _told(self, ring: DataFrame | None) -> str | None:
        if ring is None:
            return None
        return json.dumps(sorted(r["topic"] for r in self.rates(ring).filter(~F.col("defer_allowed")).collect()))

    def _place(self, batch_id: int) -> str:
        return f"{self.folder}/ring={batch_id}"
