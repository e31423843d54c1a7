"""CSV scans with an explicit schema: no second pass over the files to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Drop malformed rows: a wrong number of fields, or a field that is no value of its type.

    The reader converts only the columns a query uses, so left to itself it would find a bad row in one
    query and miss it in another. Here fields are read as text, without column pruning, and cast afterwards.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.read.schema(text).option("header", header).option("mode", "DROPMALFORMED")
    raw = reader.option("columnPruning", False).csv(path)
    casts = {f.name: f"try_cast(`{f.name}` AS {f.dataType.simpleString()})" for f in schema.fields}
    readable = " AND ".join(f"(`{n}` IS NULL OR {cast} IS NOT NULL)" for n, cast in casts.items())
    return raw.where(readable).selectExpr(*[f"{cast} AS `{n}`" for n, cast in casts.items()])


def read_csv_permissive(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Keep every row: bad fields are NULL and the raw text of a bad row is in ``_corrupt_record``.

    The reader looks for bad fields only in the columns a query uses; use all of them where it matters,
    as ``load_counts`` does.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("header", header).option("mode", "PERMISSIVE")
    return reader.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def load_counts(df: DataFrame) -> DataFrame:
    """Rows read, malformed rows, and NULLs of each column, in one pass over a permissive read."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns if c != CORRUPT]
    return df.agg(F.count("*").alias("row_count"), F.count(CORRUPT).alias("corrupt_count"), *nulls)


def without_corrupt_column(df: DataFrame) -> DataFrame:
    return df.drop(CORRUPT)
