"""Appending, replacing, deduplicating and stamping stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def stamped(df: DataFrame, name: str = "uploaded_at", at=None) -> DataFrame:
    """Load time; a fixed ``at`` keeps reruns equal."""
    return df.withColumn(name, F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))


def write_mart(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Partitioned table. The rebalance hint lets adaptive execution join small
    partitions and split one that holds most rows into files of the advisory size."""
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def with_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("month", F.date_format(ts, "yyyy-MM"))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


class VersionedTable:
    """A stored table that is replaced as a whole.

    Data lies in folders of its own under ``<path>/_table``; which one is current is told by a log of (version, folder), to which
    one small file is added when a folder is complete. Readers resolve the newest entry, so they see the whole old table until then
    and the whole new one after; a rewrite that fails adds nothing. A table that was plain Parquet before its first rewrite is
    version 0. There is one writer at a time: a second one that began from the same version is refused or, if both add their entries
    at once, both versions are kept and the folder later in text order is current.
    """

    LOG = "version bigint, folder string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.log = f"{self.path}/_table/log"

    def _entries(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.LOG).parquet(self.log)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def current(self) -> tuple[int, str]:
        """Version and folder of the current table."""
        entries = self._entries()
        newest = entries.agg(F.max(F.struct("version", "folder")).alias("newest")).first().newest if entries is not None else None
        return (newest.version, f"{self.path}/_table/{newest.folder}") if newest else (0, self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.current()[1])

    def replace(self, df: DataFrame, expected: int | None = None) -> int:
        """Make ``df`` the current table; it may be derived from the present one. ``expected``: the version it was derived from."""
        base = self.current()[0] if expected is None else expected
        folder = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/_table/{folder}")
        if self.current()[0] != base:
            raise RuntimeError(f"{self.path} was replaced since version {base}")
        entry = self.spark.createDataFrame([(base + 1, folder)], self.LOG)
        entry.coalesce(1).write.mode("append").parquet(self.log)
        return base + 1

    def versions(self) -> list[tuple[int, str]]:
        """All versions and their folders, oldest first; one entry for each rewrite."""
        entries = self._entries()
        rows = entries.orderBy("version", "folder").collect() if entries is not None else []
        return [(row.version, f"{self.path}/_table/{row.folder}") for row in rows]


def rewrite_distinct(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> VersionedTable:
    """Deduplicate a stored table in place: readers that resolve the table see the old rows, then the new ones."""
    table = VersionedTable(spark, path)
    version, folder = table.current()
    table.replace(distinct_rows(spark.read.parquet(folder), columns), expected=version)
    return table
