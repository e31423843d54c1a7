"""Fixed table schemas, looked up by name."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def struct(spec: str) -> T.StructType:
    """Build a schema from ``"name type, name type!"``; ``!`` marks a column that is never NULL."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# Column names, order, types and nullability of the stored tables.
SCHEMAS = {
    "listening_history_bronze": struct(
        "track_id string!, played_at timestamp!, track_name string, artist_name string, "
        "album_name string, duration_ms long, _ingested_at timestamp!"
    ),
    "my_tracks_features_bronze": struct(
        "track_id string!, track_name string, artist_name string, album_name string, popularity int, "
        "duration_ms long, explicit boolean, danceability float, energy float, acousticness float, "
        "instrumentalness float, valence float, tempo float, time_signature int, _ingested_at timestamp!"
    ),
    "kaggle_tracks_bronze": struct(
        "track_id string!, artists string, album_name string, track_name string, popularity int, "
        "duration_ms long, explicit boolean, danceability float, energy float, valence float, "
        "acousticness float, instrumentalness float, tempo float, track_genre string, _ingested_at timestamp!"
    ),
    "my_tracks_features_bronze_synthetic": struct(
        "track_id string!, danceability float!, energy float!, valence float!, acousticness float!, "
        "instrumentalness float!, speechiness float!, liveness float!, loudness float!, tempo float!, "
        "time_signature int!, key int!, mode int!, source string!, _generated_at timestamp!"
    ),
    "check_results": struct(
        "layer string!, table string!, check string!, column string, observed double, threshold double, "
        "passed boolean!"
    ),
    "model_metrics": struct("model_name string!, model_type string!, metric string!, value double"),
}

# The twelve attributes a silver row may carry, in output order.
ATTRIBUTES = (
    "danceability", "energy", "valence", "acousticness", "instrumentalness", "speechiness",
    "liveness", "loudness", "tempo", "time_signature", "key", "mode",
)
ATTRIBUTE_TYPES = {name: "int" if name in ("time_signature", "key", "mode") else "float" for name in ATTRIBUTES}


def schema(name: str) -> T.StructType:
    try:
        return SCHEMAS[name]
    except KeyError:
        raise ValueError(f"unknown schema {name!r}; known: {sorted(SCHEMAS)}") from None
