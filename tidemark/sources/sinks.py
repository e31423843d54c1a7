"""Writers. One writer per table at a time is assumed; there is no transaction log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import merge_latest, new_rows, one_per_key
from ..session import scratch_path
from .tables import read_optional, read_table

EVENT_KEY = ("track_id", "played_at")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    whole: bool = False,
) -> str:
    """Write parquet. Partitioned output is rebalanced first: small partitions get few files, large ones many.

    An overwrite of a partitioned table replaces only the partitions present in ``df``, or the ``whole``
    table: a full rebuild must not leave partitions that no longer have rows.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static" if whole else "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return path


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` dealt into ``buckets`` by hash of ``keys`` and sorted by them, as the session's external table ``name``.

    Joins and aggregates on the keys then need no shuffle of it; two tables with the same buckets join in place. Choose
    ``buckets`` so that one of them fits in a task's memory at full size. A bucket is one file: each task writes its own.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_catalog(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> str:
    """Replace a catalog table and its schema. File size, not a fixed file count, bounds each file."""
    return write_table(df, path, max_records_per_file=max_records_per_file)


def write_gold(df: DataFrame, gold_root: str, family: str, name: str) -> str:
    return write_table(df, f"{gold_root.rstrip('/')}/{family}/{name}")


def append_new(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = EVENT_KEY,
    ts: str = "played_at",
    partition: str = "date",
) -> str:
    """Append the rows whose key is not stored yet, partitioned by date. Running it again adds nothing.

    Copies inside the batch are reduced to one first, before their shuffle. Where rows are stored already, the reduced
    batch is staged, so its source is read and parsed once; the stage tells which stored dates have to be read.
    """
    spark = df.sparkSession
    batch = one_per_key(df.withColumn(partition, F.to_date(ts)), keys)
    existing = read_optional(spark, path)
    if existing is not None:
        staged = scratch_path(spark, "batch")
        batch.write.parquet(staged)
        batch = spark.read.schema(batch.schema).parquet(staged)
        span = batch.agg(F.min(partition).alias("first"), F.max(partition).alias("last")).first()
        in_span = F.col(partition).between(span["first"], span["last"]) | F.col(partition).isNull()
        batch = new_rows(batch, existing.where(in_span), keys, null_safe=True)
    return write_table(batch, path, mode="append", partition_by=[partition])


def upsert_table(
    df: DataFrame,
    current: str | None,
    target: str,
    keys: Sequence[str] = ("track_id",),
    latest_by: Sequence[str] = (),
) -> str:
    """Write ``current`` with ``df`` merged in to the fresh path ``target``; ``current`` stays readable."""
    if current == target:
        raise ValueError("the target must not be the table being read")
    existing = read_optional(df.sparkSession, current)
    merged = one_per_key(df, keys, latest_by) if existing is None else merge_latest(existing, df, keys, latest_by)
    return write_table(merged, target)


def append_generated(df: DataFrame, path: str, key: str = "track_id") -> str:
    """Append generated attributes of keys that have none yet."""
    existing = read_optional(df.sparkSession, path)
    fresh = df if existing is None else new_rows(df, existing, [key])
    return write_table(fresh, path, mode="append")


SINGLE_FILE_ROWS = 1_000_000


def export_csv(df: DataFrame, path: str, single_file: bool = False, most: int = SINGLE_FILE_ROWS) -> str:
    """CSV with a header. ``single_file`` writes with one task; a table of more than ``most`` rows is refused."""
    if single_file and df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows are not exported as one file")
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def jdbc_options(url: str, table: str, batch_rows: int = 10_000, connections: int = 16, **more: str) -> dict[str, str]:
    """Options of a JDBC write: rows per insert batch and a cap on parallel connections."""
    base = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(connections)}
    return {**base, "truncate": "true", **more}


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table; ``numPartitions`` bounds the connections however wide the frame is."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("overwrite").save()


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame | str | None]) -> DataFrame:
    """Make tables addressable by name in SQL; returns which ones exist. No rows are read."""
    rows = []
    for name, table in tables.items():
        frame = read_optional(spark, table) if isinstance(table, str) else table
        if frame is not None:
            frame.createOrReplaceTempView(name)
        rows.append((name, frame is not None, len(frame.columns) if frame is not None else 0))
    return spark.createDataFrame(rows, "table_name string, registered boolean, column_count int")


def create_tables(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Catalog entries over existing parquet folders, for sessions that share a catalog."""
    for name, path in paths.items():
        read_table(spark, path)
        spark.catalog.createTable(name, path=path, source="parquet")
