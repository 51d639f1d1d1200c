"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, name: str = "keylane") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder: on a cluster executors could not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    folder = tempfile.mkdtemp(prefix="keylane-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below :func:`shared_dir` for one run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For rows that cost more to compute than to read and are read several times.
    It also cuts lineage, and outlives a lost executor.
    """
    return stored_at(df, label)[0]


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The same, with the folder, which :func:`discard` removes once nothing reads the table any more."""
    folder = run_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, *folders: str) -> None:
    """Remove folders that :func:`run_folder` named and that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """Number of the last micro-batch that a stream's checkpoint has as done."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    numbers = [int(f.getPath().getName()) for f in files.listStatus(path) if f.getPath().getName().isdigit()]
    return max(numbers, default=None)


def ensure_state_store(spark: SparkSession) -> None:
    """Stateful processors need the state store that spills to disk."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(setting, ""):
        spark.conf.set(setting, ROCKSDB)
