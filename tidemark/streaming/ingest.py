"""Incremental event ingest: each run takes the files that arrived since the last one, then stops."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.sinks import EVENT_KEY, append_new


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    keys: Sequence[str] = EVENT_KEY,
    ts: str = "played_at",
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> None:
    """Append the unseen events of all new files under ``source`` to ``target``.

    The checkpoint remembers which files were taken. A batch that is replayed after a failure finds its
    rows already stored and appends nothing, so every event is stored once.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def store(batch: DataFrame, _: int) -> None:
        append_new(transform(batch), target, keys, ts)

    writer = reader.load(source).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
