"""How the test tables play the parts of events, catalog and attribute sources (see FIXTURES.md)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.timeparts import time_dimensions
from ..operators.enrich import any_present, attach_attributes, generate_attributes, merge_sources, missing_keys
from ..schemas import ATTRIBUTE_TYPES
from ..session import scratch_path
from ..sources import sinks
from ..sources.tables import read_table

PROVIDED = "c_mktsegment IN ('BUILDING', 'MACHINERY')"
SMALL_PART = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def hundredths(value: str, modulus: int = 100) -> str:
    return f"(({value}) % {modulus}) / 100D"


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as play history: the user stands for the track."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS track_id",
        "ts AS played_at",
        "concat('Track ', user_id) AS track_name",
        "concat('Artist ', user_id % 40) AS artist_name",
        "concat('Album ', user_id % 90) AS album_name",
        "event_id * 10 AS duration_ms",
        "event_id",
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with measures of their own and time columns."""
    measured = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "CAST(user_id AS STRING) AS track_id",
        "ts AS played_at",
        "concat('Track ', user_id) AS track_name",
        "concat('Artist ', user_id % 40) AS artist_name",
        "event_type AS label",
        "CAST(get_json_object(props, '$.k') AS INT) / 100D AS valence",
        "least(value, 100D) / 100D AS energy",
        "value / 100D AS raw_energy",
        f"{hundredths('event_id')} AS danceability",
        f"{hundredths('event_id * 7')} AS acousticness",
        f"{hundredths('event_id * 13')} AS instrumentalness",
        f"{hundredths('event_id * 31', 50)} AS speechiness",
        "CAST(-((event_id * 17) % 60) AS DOUBLE) AS loudness",
        "60D + least(value, 120D) AS tempo",
    )
    return time_dimensions(measured)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the training catalog; valence depends on other measures."""
    dance, energy = "l_discount * 10D", "l_quantity / 50D"
    key = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyyMMdd'))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{key} AS track_id",
        f"{dance} AS danceability",
        f"{energy} AS energy",
        f"({dance}) * 0.4D + ({energy}) * 0.4D + ({hundredths('l_suppkey')}) * 0.2D AS valence",
        "l_tax * 12.5D AS acousticness",
        f"{hundredths('l_partkey')} AS instrumentalness",
        "l_extendedprice / 300D AS tempo",
    )


def provided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-choice attributes: all customers, of which those of two segments have values."""
    values = {
        "danceability": f"CAST({hundredths('c_custkey * 37')} AS FLOAT)",
        "energy": f"CAST({hundredths('c_custkey * 53')} AS FLOAT)",
        "valence": f"CAST({hundredths('c_custkey * 71')} AS FLOAT)",
        "tempo": "CAST(60D + c_nationkey * 4 AS FLOAT)",
        "time_signature": "4",
    }
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS track_id", *[f"CASE WHEN {PROVIDED} THEN {v} END AS {n}" for n, v in values.items()]
    )


def with_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that have any of the attributes."""
    return any_present(provided(spark, sf_dir), ["danceability", "energy", "valence"])


def catalog_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last-choice attributes: parts."""
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS track_id",
        f"CAST({hundredths('p_partkey * 3')} AS FLOAT) AS danceability",
        "CAST(p_size / 64D AS FLOAT) AS acousticness",
        f"CAST({hundredths('p_partkey * 19')} AS FLOAT) AS instrumentalness",
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table: every event with merged attributes, provenance and time columns."""
    events = history(spark, sf_dir)
    real = with_values(spark, sf_dir)
    made = generate_attributes(missing_keys(events, "track_id", [real]))
    sources = {"real": real, "synthetic": made, "kaggle": catalog_attributes(spark, sf_dir)}
    return time_dimensions(attach_attributes(events, sources))


def stored_in_buckets(spark: SparkSession, sf_dir: str, buckets: int = 8) -> tuple[DataFrame, DataFrame]:
    """Play history and its merged attributes as two tables bucketed by track."""
    events, real = history(spark, sf_dir), with_values(spark, sf_dir)
    made = generate_attributes(missing_keys(events, "track_id", [real]))
    sources = {"real": real, "synthetic": made, "kaggle": catalog_attributes(spark, sf_dir)}
    merged = merge_sources(sources, "track_id", ATTRIBUTE_TYPES, "danceability")
    path = scratch_path(spark, "buckets")
    name = f"bucketed_{uuid.uuid4().hex}"
    return tuple(
        sinks.write_bucketed(frame, f"{name}_{part}", f"{path}/{part}", ["track_id"], buckets)
        for part, frame in (("events", events), ("attributes", merged))
    )


def order_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three sources of one attribute for the customers in ``orders``, each covering some of the keys."""
    return {
        "customer": table(spark, sf_dir, "customer")
        .selectExpr("c_custkey AS o_custkey", f"CASE WHEN {PROVIDED} THEN c_acctbal END AS score"),
        "supplier": table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS o_custkey", "s_acctbal AS score"),
        "part": table(spark, sf_dir, "part")
        .selectExpr("p_partkey AS o_custkey", f"CASE WHEN p_size <= {SMALL_PART} THEN p_retailprice END AS score"),
    }
