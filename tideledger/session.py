"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# keys of a stream stay on disk, and a trigger writes what it changed
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# shuffle files of a query are deleted when it ends
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **STATE_ON_DISK,
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tideledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, in a session with other settings, too. A stream copies the settings when it starts."""
    before = {key: spark.conf.get(key, None) for key in STATE_ON_DISK}
    for key, value in STATE_ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session in one process, as in tests, gets a temporary one where none is named.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tideledger-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder: one job, read back by column. Its shuffle files go at the end, for nothing reads them again."""
    spark = df.sparkSession
    path = new_path(spark, "cut")
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is not in use."""
    return f"{_FOLDER.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[str]:
    """Tables that are written inside go to one sub-folder of the shared folder, which is deleted at the end.

    Results that read them have to be written or counted inside.
    """
    folder = new_path(spark, "tables")
    before = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(before)
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
