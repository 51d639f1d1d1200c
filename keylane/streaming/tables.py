"""Tables that streams keep: upserts that are compacted, and the ledger of seen ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.operators.dedup import KEYS, WEEK_S, dedup, latest_per_key
from keylane.session import discard

DAY_US = 86_400_000_000


def _files(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


class UpsertTable:
    """The last write per key, kept as folders in levels behind a manifest.

    A micro-batch writes its last writes to a folder of level 0. ``fan`` folders
    of a level are merged into one of the next, so that a row is rewritten once
    a level and the folders to read stay few, about ``fan`` a level. Which
    folders count is a manifest, a small table of its own for each change: it
    stands once its marker of success does, so a reader sees the folders before a merge or after it.
    Folders that a merge replaced stay for one more change, for readers that
    are at work. Repeating a batch after a crash writes its rows again, which the last write per key doesn't notice.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = ("key",), order: Sequence[str] = ("ts_us", "part", "off"),
                 fan: int = 4):
        self.spark, self.path, self.by, self.order, self.fan = spark, path, tuple(by), tuple(order), fan

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """A ``foreachBatch`` function."""
        name = f"level=0-{batch_id}"
        latest_per_key(batch, self.by, self.order).write.mode("overwrite").parquet(f"{self.path}/data/{name}")
        version, folders = self.manifest()
        self._switch(version, [*(f for f in folders if f != name), name])
        self.compact()

    def compact(self) -> None:
        """Merge full levels, the lowest first."""
        version, folders = self.manifest()
        level = 0
        while level <= max((_level(f) for f in folders), default=-1):
            full = [f for f in folders if _level(f) == level]
            if len(full) >= self.fan:
                merged = f"level={level + 1}-{version + 1}"
                latest_per_key(self._read(full), self.by, self.order).write.mode("overwrite").parquet(f"{self.path}/data/{merged}")
                folders = [*(f for f in folders if f not in full), merged]
                version = self._switch(version, folders, full)
            level += 1

    def read(self) -> DataFrame | None:
        """The current value per key; None before the first batch."""
        _, folders = self.manifest()
        return latest_per_key(self._read(folders), self.by, self.order) if folders else None

    def manifest(self) -> tuple[int, list[str]]:
        """Number of the newest manifest that stands, -1 if none does, and its folders."""
        files, path = _files(self.spark, f"{self.path}/manifest")
        if not files.exists(path):
            return -1, []
        jvm = self.spark._jvm.org.apache.hadoop.fs
        numbers = [int(f.getPath().getName().split("=")[1]) for f in files.listStatus(path)
                   if files.exists(jvm.Path(f.getPath(), "_SUCCESS"))]
        if not numbers:
            return -1, []
        rows = self.spark.read.schema("folder string").parquet(f"{self.path}/manifest/version={max(numbers)}").collect()
        return max(numbers), sorted(r["folder"] for r in rows)

    def _read(self, folders: list[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.path}/data/{f}") for f in folders])

    def _switch(self, version: int, folders: list[str], replaced: Sequence[str] = ()) -> int:
        now = self.spark.createDataFrame([(f,) for f in folders], "folder string").coalesce(1)
        now.write.mode("overwrite").parquet(f"{self.path}/manifest/version={version + 1}")
        # what the change before this one replaced has no readers left
        gone = self.spark.createDataFrame([(f,) for f in replaced], "folder string").coalesce(1)
        discard(self.spark, *(f"{self.path}/data/{f}" for f in self._replaced(version) if f not in folders),
                f"{self.path}/manifest/version={version - 2}", f"{self.path}/replaced/version={version}")
        gone.write.mode("overwrite").parquet(f"{self.path}/replaced/version={version + 1}")
        return version + 1

    def _replaced(self, version: int) -> list[str]:
        files, path = _files(self.spark, f"{self.path}/replaced/version={version}/_SUCCESS")
        if not files.exists(path):
            return []
        return [r["folder"] for r in self.spark.read.schema("folder string").parquet(f"{self.path}/replaced/version={version}").collect()]


def _level(folder: str) -> int:
    return int(folder.removeprefix("level=").split("-")[0])


class Ledger:
    """Ids that were kept, and when: each micro-batch adds its own, by days and by buckets of the id.

    A batch reads the days of its own time to live and the buckets that its ids
    fall into, and of no later batch, so that repeating it gives the same. The partitions
    of expired days are never read; :meth:`forget` removes old batches.
    """

    def __init__(self, spark: SparkSession, path: str, ttl_s: float = WEEK_S, version: str = "1", by: Sequence[str] = KEYS, buckets: int = 64):
        self.spark, self.path, self.version, self.by, self.buckets = spark, path, version, tuple(by), buckets
        self.ttl_us = round(ttl_s * 1_000_000)
        self.schema: str | None = None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int").alias("bucket")

    def entries(self, before: int, since_us: int, buckets: Sequence[int]) -> DataFrame | None:
        """Entries of the batches before one, recorded on the day of ``since_us`` or later, in some buckets."""
        files, path = _files(self.spark, self.path)
        if not files.exists(path) or not any(f.getPath().getName().startswith("batch=") for f in files.listStatus(path)):
            return None
        return self.spark.read.option("basePath", self.path).parquet(self.path).filter(
            (F.col("batch") < before) & (F.col("day") >= since_us // DAY_US) & F.col("bucket").isin(*buckets) & (F.col("version") == self.version))

    def admit(self, batch: DataFrame, batch_id: int, order: Sequence[str]) -> DataFrame:
        """The rows that no entry and no earlier row of the batch makes duplicates, each within the time to live; rows without id stay."""
        with_id = batch.filter(F.col(self.by[-1]).isNotNull())
        touched = [r["bucket"] for r in with_id.select(self._bucket()).distinct().collect()]
        low = with_id.agg(F.min("ts_us")).first()[0]
        known = None if low is None else self.entries(batch_id, low - self.ttl_us, touched)
        if known is not None:
            last = known.groupBy(*[F.col(c).alias(f"_known_{c}") for c in self.by]).agg(F.max("recorded_us").alias("_recorded_us"))
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in self.by])
            with_id = with_id.join(last, same, "left").filter(
                F.col("_recorded_us").isNull() | (F.col("ts_us") > F.col("_recorded_us") + self.ttl_us)).select(*batch.columns)
        kept = dedup(with_id, self.ttl_us / 1_000_000, by=self.by, order=order)
        return kept.unionByName(batch.filter(F.col(self.by[-1]).isNull()))

    def append(self, kept: DataFrame, batch_id: int) -> None:
        """Record the rows that were kept. Repeating a batch replaces its entries."""
        rows = kept.filter(F.col(self.by[-1]).isNotNull()).groupBy(*self.by).agg(F.max("ts_us").alias("recorded_us"))
        rows.select(*self.by, "recorded_us", F.lit(self.version).alias("version"), F.floor(F.col("recorded_us") / DAY_US).cast("bigint").alias("day"),
                    self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("day", "bucket").parquet(f"{self.path}/batch={batch_id}")

    def batch(self, out: str, order: Sequence[str]):
        """A ``foreachBatch`` function: kept rows go to ``out``, their ids to the ledger."""
        def write(batch: DataFrame, batch_id: int) -> None:
            place = f"{out}/batch={batch_id}"
            self.admit(batch, batch_id, order).write.mode("overwrite").parquet(place)
            self.append(self.spark.read.schema(batch.schema).parquet(place), batch_id)
        return write

    def forget(self, now_us: int) -> None:
        """Remove the days that no id of ``now_us`` or later can meet."""
        files, path = _files(self.spark, self.path)
        old = (now_us - self.ttl_us) // DAY_US
        for batch in files.listStatus(path) if files.exists(path) else ():
            for day in files.listStatus(batch.getPath()):
                name = day.getPath().getName()
                if name.startswith("day=") and int(name.removeprefix("day=")) < old:
                    files.delete(day.getPath(), True)
