"""Columnar table scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_optional(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None if nothing exists at ``path``. Any other failure is raised."""
    if not path:
        return None
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def optional_or_empty(df: DataFrame | None, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An absent source behaves like a table without rows, so later steps need no special case."""
    return empty(spark, schema) if df is None else df


def distinct_keys(df: DataFrame, *keys: str, limit: int | None = None) -> DataFrame:
    """Distinct keys; ``limit`` takes the smallest ones, so that it is repeatable."""
    found = df.select(*keys).distinct()
    return found if limit is None else found.orderBy(*keys).limit(limit)
