"""Nested JSON payloads to flat rows, parsed in the JVM with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import one_per_key
from .counting import StepCounts

# Field names and types of the payloads.
TRACK_TYPE = (
    "struct<id:string,name:string,duration_ms:bigint,popularity:int,explicit:boolean,"
    "artists:array<struct<id:string,name:string>>,album:struct<id:string,name:string,release_date:string>>"
)
EVENT_TYPE = f"struct<played_at:string,track:{TRACK_TYPE}>"
# One of the two shapes is filled: {"track": {...}} or the bare track.
ANY_TRACK_TYPE = TRACK_TYPE.replace("struct<", f"struct<track:{TRACK_TYPE},", 1)
FEATURE_TYPE = (
    "struct<id:string,danceability:float,energy:float,acousticness:float,instrumentalness:float,"
    "valence:float,tempo:float,time_signature:int>"
)
FEATURES = ("danceability", "energy", "acousticness", "instrumentalness", "valence", "tempo", "time_signature")


def _present(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def _first_artist(track: Column) -> Column:
    return F.try_element_at(track["artists"], F.lit(1))["name"]


def parse_events(df: DataFrame, payload: str = "payload", counts: StepCounts | None = None) -> DataFrame:
    """Play events. A payload that cannot be parsed, or lacks the track id or a readable time, is dropped; ``counts``
    tells how many."""
    parsed = df.select(F.from_json(payload, EVENT_TYPE).alias("p"))
    track = F.col("p.track")
    rows = parsed.select(
        track["id"].alias("track_id"),
        F.try_to_timestamp(F.col("p.played_at")).alias("played_at"),
        track["name"].alias("track_name"),
        _first_artist(track).alias("artist_name"),
        track["album"]["name"].alias("album_name"),
        track["duration_ms"].alias("duration_ms"),
    )
    usable = "track_id <> '' AND played_at IS NOT NULL"
    return rows.where(usable) if counts is None else counts.filtered(rows, "parse_events", f"coalesce({usable}, false)")


def parse_entities(
    tracks: DataFrame,
    features: DataFrame,
    payload: str = "payload",
    feature_order: str | None = None,
) -> DataFrame:
    """Track rows with their features looked up by id.

    Of several feature payloads for one id the last by ``feature_order`` counts; a track without
    features keeps NULLs; a track without an id is dropped.
    """
    track = F.from_json(payload, TRACK_TYPE).alias("t")
    described = tracks.select(track).select(
        F.col("t.id").alias("track_id"),
        F.col("t.name").alias("track_name"),
        _first_artist(F.col("t")).alias("artist_name"),
        F.col("t.album.name").alias("album_name"),
        F.col("t.popularity").alias("popularity"),
        F.col("t.duration_ms").alias("duration_ms"),
        F.col("t.explicit").alias("explicit"),
    )
    order = [feature_order] if feature_order else []
    parsed = features.select(F.from_json(payload, FEATURE_TYPE).alias("f"), *order)
    flat = parsed.select(F.col("f.id").alias("track_id"), *[F.col(f"f.{n}") for n in FEATURES], *order)
    usable = flat.where(F.col("track_id").isNotNull())
    looked_up = one_per_key(usable, ["track_id"], order).drop(*order)
    return described.where(_present(F.col("track_id"))).join(looked_up, "track_id", "left")


def flatten_tracks(df: DataFrame, payload: str = "payload", played_at: str | None = None) -> DataFrame:
    """Flat track rows with artist names and ids as arrays; accepts a wrapped or a bare track."""
    keep = [F.col(played_at).alias("played_at")] if played_at else []
    parsed = df.select(F.from_json(payload, ANY_TRACK_TYPE).alias("p"), *keep)
    wrapped = F.col("p.track").isNotNull()

    def pick(path: str) -> Column:
        return F.when(wrapped, F.col(f"p.track.{path}")).otherwise(F.col(f"p.{path}"))

    artists = F.coalesce(pick("artists"), F.from_json(F.lit("[]"), "array<struct<id:string,name:string>>"))
    return parsed.select(
        pick("id").alias("track_id"),
        pick("name").alias("track_name"),
        pick("duration_ms").alias("duration_ms"),
        F.coalesce(pick("explicit"), F.lit(False)).alias("explicit"),
        pick("popularity").alias("popularity"),
        F.transform(artists, lambda a: a["name"]).alias("artists"),
        F.transform(artists, lambda a: a["id"]).alias("artist_ids"),
        pick("album.name").alias("album_name"),
        pick("album.id").alias("album_id"),
        pick("album.release_date").alias("release_date"),
        *[F.col("played_at") for _ in keep],
    )
