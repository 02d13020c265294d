"""Session settings the operators rely on, and the shared folder for pinned data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or skew handling; memory and cores are the cluster's business.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State of streams stays off the heap; timers and list or map state need this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A retried batch replaces its own partition only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that operators assume to a running session."""
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stratalake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in _SETTINGS.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would lose data together with the executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="stratalake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Paths made inside each open ``scratch`` block.
_SCOPES: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the intermediate data: what is pinned inside the block is deleted when it ends.

    Results that outlive the block have to be written to a path taken before it.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def pin(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Cuts the lineage, so partition numbers or samples taken before the write
    stay the same when a lost executor forces a recomputation after it. Parquet
    keeps column pruning and gives the optimizer true sizes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    # Small row groups: a writer holds one in memory.
    df.write.option("parquet.block.size", 16 << 20).parquet(path)
    pinned = spark.read.schema(df.schema).parquet(path)
    pinned._pinned_at = path
    return pinned


def unpin(df: DataFrame) -> None:
    """Delete what ``pin`` wrote for ``df``; nothing may read it any more."""
    path = getattr(df, "_pinned_at", None)
    if path is not None:
        remove(df.sparkSession, path)
