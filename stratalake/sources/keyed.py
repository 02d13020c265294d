"""A keyed table that is rewritten only where it changes.

Current rows lie in hash buckets of their key, rows that never change again (closed versions) in
folders that are only added. A version of the table is a list of such folders, written as a small
table of its own; a new version lists the buckets it rewrote and, for the rest, the folders of the
version before. The number of entries is bounded by the buckets and the versions.

Writing version n again reads version n - 1 again and gives the same, so a repeated micro-batch is
harmless. A version counts once its list is complete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import remove
from stratalake.sources.sinks import Snapshots

SETTLED = -1  # in place of a bucket's number


class KeyedTable:
    """``keys`` name a current row; ``keep`` older versions stay readable."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 32, keep: int = 2):
        self.spark, self.path, self.keys, self.buckets, self.keep = spark, path.rstrip("/"), list(keys), buckets, keep
        self.versions = Snapshots(spark, f"{self.path}/versions")

    def latest(self) -> int:
        """Number of the newest complete version, 0 when there is none."""
        return self.versions.latest()

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of ``rows``."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def folders(self, version: int | None = None) -> dict[str, int]:
        """Folders of a version and the bucket, or ``SETTLED``, of each."""
        number = self.latest() if version is None else version
        return {r["folder"]: r["part"] for r in self.versions.read(number).collect()} if number else {}

    def _read(self, folders: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*folders) if folders else None

    def current(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Current rows, of some buckets only if they are given; None if there are none."""
        found = self.folders(version).items()
        return self._read([f for f, part in found if part != SETTLED and (buckets is None or part in buckets)])

    def settled(self, version: int | None = None) -> DataFrame | None:
        """Rows that were closed up to a version."""
        return self._read([f for f, part in self.folders(version).items() if part == SETTLED])

    def write(self, current: DataFrame, touched: Sequence[int], closed: DataFrame | None = None, version: int | None = None) -> int:
        """The next version: ``current`` are all current rows of the ``touched`` buckets, ``closed`` is added."""
        number = version or self.latest() + 1
        before = self.folders(number - 1)
        place = f"{self.path}/rows/v={number:09d}"
        rows = current.withColumn("_bucket", self.bucket())
        rows.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(f"{place}/current")
        listed = {f: part for f, part in before.items() if part == SETTLED or part not in touched}
        listed |= {f: int(f.rsplit("=", 1)[1]) for f in self._glob(f"{place}/current/_bucket=*")}
        if closed is not None:
            closed.write.mode("overwrite").parquet(f"{place}/settled")
            if self._read([f"{place}/settled"]).isEmpty():
                remove(self.spark, f"{place}/settled")
            else:
                listed[f"{place}/settled"] = SETTLED
        entries = [(part, folder) for folder, part in sorted(listed.items())]
        self.versions.write(self.spark.createDataFrame(entries, "part int, folder string").coalesce(1), number)
        self._forget(number)
        return number

    def upsert(self, rows: DataFrame, version: int | None = None) -> int:
        """Replace the rows of the keys in ``rows``, each of which has one row, and add new keys."""
        number = version or self.latest() + 1
        touched = self.touched(rows)
        old = self.current(number - 1, touched)
        if old is not None:
            rows = rows.unionByName(old.join(rows.select(*self.keys), self.keys, "left_anti"))
        return self.write(rows, touched, version=number)

    def _glob(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(f.getPath().toString() for f in found or [])

    def _forget(self, number: int) -> None:
        """Delete versions older than the kept ones, and the buckets that only they list."""
        old = number - self.keep - 1
        if old < 1 or not self._glob(f"{self.path}/versions/v={old}"):
            return
        gone = set(self.folders(old)) - set(self.folders(old + 1))
        remove(self.spark, f"{self.path}/versions/v={old}")
        for folder in sorted(gone):
            remove(self.spark, folder)
