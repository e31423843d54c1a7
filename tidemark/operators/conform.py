"""Bring loosely typed input to a fixed schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import surrogate_key

# Accepted spellings of catalog columns (compared without case and outer blanks).
CATALOG_ALIASES = {
    "artist": "artists",
    "artist_name": "artists",
    "name": "track_name",
    "song_name": "track_name",
    "album": "album_name",
    "duration": "duration_ms",
    "duration_in_ms": "duration_ms",
    "genre": "track_genre",
    "genres": "track_genre",
}
CATALOG_KEY_PARTS = ("track_name", "artists", "album_name")


def normalize_columns(df: DataFrame, targets: Sequence[str], aliases: Mapping[str, str]) -> DataFrame:
    """Rename known spellings to their target; other columns keep their name. Two inputs for one target raise."""
    known = {**aliases, **{t: t for t in targets}}
    names = [known.get(c.lower().strip(), c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"several input columns map to {clashes}: {df.columns}")
    return df.toDF(*names)


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast the listed columns; text that is no value of the type becomes NULL."""

    def cast(name: str) -> str:
        return f"try_cast(`{name}` AS {types[name].simpleString()}) AS `{name}`" if name in types else f"`{name}`"

    return df.selectExpr(*[cast(c) for c in df.columns])


def conform(df: DataFrame, target: T.StructType, skip: Sequence[str] = ()) -> DataFrame:
    """Exactly the target's columns, in order and typed; a column the input lacks is NULL of its type."""
    have = set(df.columns)

    def column(field: T.StructField) -> str:
        source = f"`{field.name}`" if field.name in have else "NULL"
        return f"try_cast({source} AS {field.dataType.simpleString()}) AS `{field.name}`"

    return df.selectExpr(*[column(f) for f in target.fields if f.name not in skip])


def with_surrogate_key(df: DataFrame, key: str, parts: Sequence[str]) -> DataFrame:
    """Fill a missing or NULL key with the digest of its identifying columns."""
    made = surrogate_key([f"`{p}`" for p in parts])
    if key not in df.columns:
        return df.selectExpr(f"{made} AS `{key}`", "*")
    return df.withColumn(key, F.expr(f"coalesce(`{key}`, {made})"))


def stamp(df: DataFrame, column: str = "_ingested_at") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def conform_catalog(df: DataFrame, target: T.StructType) -> DataFrame:
    """Whole catalog step: names, key, types, column set, ingestion time."""
    names = [f.name for f in target.fields if not f.name.startswith("_")]
    named = normalize_columns(df, names, CATALOG_ALIASES)
    absent = [p for p in CATALOG_KEY_PARTS if p not in named.columns]
    padded = named.selectExpr("*", *[f"CAST(NULL AS STRING) AS `{p}`" for p in absent])
    keyed = with_surrogate_key(padded, "track_id", CATALOG_KEY_PARTS)
    return stamp(conform(keyed, target, skip=("_ingested_at",)))
