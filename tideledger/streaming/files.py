"""New-file pick-up and append-without-duplicates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import state_on_disk


def watch_files(spark: SparkSession, path: str, schema, fmt: str = "json", max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """Files that appear in a folder; the checkpoint remembers the loaded ones."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def load_new_files(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is new, then stop. State is kept in RocksDB, whatever the session's settings."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    with state_on_disk(stream.sparkSession):
        return writer.outputMode("append").trigger(availableNow=True).start()


def _first_of_batch(keys: Sequence[str]):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.drop_duplicates(list(keys))

    return run


def append_once(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], base: DataFrame | None = None) -> StreamingQuery:
    """Append the first row of every key (null is a value) that neither earlier triggers nor ``base`` hold.

    The keys seen are the query's state, so a trigger looks up its own keys and reads nothing that earlier ones wrote; the state
    is in RocksDB, and only what a trigger touches is loaded. Rows of one key are cut down inside each Arrow
    batch first, so that a key with most rows does not meet in one task. ``base`` is a stored table whose keys count as appended; it is
    read in every trigger.
    """
    if base is not None:
        stream = stream.join(base.select(*keys).distinct(), list(keys), "left_anti")
    fewer = stream.mapInPandas(_first_of_batch(keys), stream.schema)
    return load_new_files(fewer.dropDuplicates(list(keys)), target, checkpoint)


def deduplicated(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key among rows that arrive within ``delay``; the state is bounded by it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
