"""Payload and CSV sources, and sinks checked by reading back what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions import vocabulary as words
from ...functions.buckets import quadrant
from ...operators.enrich import CLEAN_RANGES, in_ranges
from ...operators.profiles import hourly_profile, patterns_by_time
from ...session import scratch_path
from ...sources import csvfiles, payloads, sinks
from ...sources.counting import StepCounts
from ...sources.tables import read_table
from ...streaming.ingest import ingest_new_files
from .. import pipeline
from ..bindings import catalog, enriched, history, plays, provided, table
from .registry import CATALOG, HISTORY, PLAYS, over_plays, quad, query, rnd

# --- payloads ------------------------------------------------------------------------------------

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _event_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested JSON: errors have no track id, signups a bad time, large values are cut off."""
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    artist = F.struct(
        F.concat(F.lit("a"), F.col("user_id") % 40).alias("id"),
        F.concat(F.lit("Artist "), F.col("user_id") % 40).alias("name"),
    )
    no_artists = F.array().cast("array<struct<id:string,name:string>>")
    track = F.struct(
        F.when(kind != "error", user).alias("id"),
        F.concat(F.lit("Track "), user).alias("name"),
        (F.col("event_id") * 10).alias("duration_ms"),
        F.when(kind == "view", no_artists).otherwise(F.array(artist)).alias("artists"),
        F.struct(
            F.concat(F.lit("b"), F.col("user_id") % 90).alias("id"),
            F.concat(F.lit("Album "), F.col("user_id") % 90).alias("name"),
            F.date_format("ts", "yyyy-MM-dd").alias("release_date"),
        ).alias("album"),
        F.when(kind == "click", F.lit(True)).alias("explicit"),
    )
    time = F.when(kind == "signup", F.lit("yesterday")).otherwise(F.date_format("ts", _ISO))
    whole = F.to_json(F.struct(time.alias("played_at"), track.alias("track")))
    cut = F.expr("substring(whole, 1, length(whole) - 5)")
    rows = table(spark, sf, "events").select("event_id", "value", "event_type", whole.alias("whole"))
    payload = F.when(F.col("value") > 200, cut).otherwise(F.col("whole"))
    return rows.select("event_id", "event_type", payload.alias("payload"))


_GOOD_EVENT = "event_type NOT IN ('error', 'signup') AND value <= 200"


@query(
    "json_events",
    f"""SELECT CAST(user_id AS VARCHAR) AS track_id, ts AS played_at, 'Track ' || user_id AS track_name,
        CASE WHEN event_type <> 'view' THEN 'Artist ' || (user_id % 40) END AS artist_name,
        'Album ' || (user_id % 90) AS album_name, event_id * 10 AS duration_ms FROM events WHERE {_GOOD_EVENT}""",
)
def json_events(spark, sf):
    parsed = payloads.parse_events(_event_payloads(spark, sf))
    # The source columns have no time zone; show the instants as UTC wall time whatever the session's zone.
    utc = F.convert_timezone(None, F.lit("UTC"), F.col("played_at").cast("timestamp_ntz"))
    return parsed.withColumn("played_at", utc)


@query(
    "json_entity_features",
    """WITH f AS (SELECT c_custkey, arg_max(c_acctbal, c_custkey) AS b FROM customer
                  WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1)
       SELECT CAST(c.c_custkey AS VARCHAR) AS track_id, c_name AS track_name, 'Artist ' || c_nationkey AS artist_name,
         c_mktsegment AS album_name, c_nationkey AS popularity, c.c_custkey * 100 AS duration_ms,
         c_acctbal < 0 AS explicit, CAST(b / 1e4 AS FLOAT) AS danceability, CAST(NULL AS FLOAT) AS energy,
         CAST(NULL AS FLOAT) AS acousticness, CAST(NULL AS FLOAT) AS instrumentalness, CAST(NULL AS FLOAT) AS valence,
         CASE WHEN b IS NOT NULL THEN CAST(c_nationkey + 100 AS FLOAT) END AS tempo,
         CASE WHEN b IS NOT NULL THEN 4 END AS time_signature
       FROM customer c LEFT JOIN f USING (c_custkey) WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
def json_entity_features(spark, sf):
    customer = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    named = F.col("c_mktsegment") != "HOUSEHOLD"
    track = F.struct(
        F.when(named, key).alias("id"),
        F.col("c_name").alias("name"),
        F.array(F.struct(F.concat(F.lit("Artist "), F.col("c_nationkey")).alias("name"))).alias("artists"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("album"),
        F.col("c_nationkey").alias("popularity"),
        (F.col("c_custkey") * 100).alias("duration_ms"),
        (F.col("c_acctbal") < 0).alias("explicit"),
    )

    def features(load: int, shift: float) -> DataFrame:
        body = F.struct(
            key.alias("id"),
            (F.col("c_acctbal") / 1e4 + shift).alias("danceability"),
            (F.col("c_nationkey") + 100).alias("tempo"),
            F.lit(4).alias("time_signature"),
        )
        known = customer.where(F.col("c_mktsegment") != "FURNITURE")
        return known.select(F.to_json(body).alias("payload"), F.lit(load).alias("load"))

    tracks = customer.select(F.to_json(track).alias("payload"))
    # Two loads of features: the later one counts.
    both = features(1, 0.5).unionByName(features(2, 0.0))
    return payloads.parse_entities(tracks, both, feature_order="load")


@query(
    "json_flatten_arrays",
    """SELECT CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS track_id,
       'Track ' || user_id AS track_name, event_id * 10 AS duration_ms, event_type = 'click' AS explicit,
       CAST(NULL AS INT) AS popularity,
       CASE WHEN event_type = 'view' THEN '' ELSE 'Artist ' || (user_id % 40) END AS artists,
       CASE WHEN event_type = 'view' THEN '' ELSE 'a' || (user_id % 40) END AS artist_ids,
       'Album ' || (user_id % 90) AS album_name, 'b' || (user_id % 90) AS album_id,
       strftime(ts, '%Y-%m-%d') AS release_date FROM events WHERE value <= 200
       UNION ALL SELECT NULL, NULL, NULL, false, NULL, '', '', NULL, NULL, NULL FROM events WHERE value > 200""",
)
def json_flatten_arrays(spark, sf):
    # A payload that is cut off gives a row without values.
    wrapped = _event_payloads(spark, sf)
    # Half of the payloads lose their wrapper: both shapes must give the same columns.
    bare = F.get_json_object("payload", "$.track")
    mixed = wrapped.select(F.when(F.col("event_type").isin("click", "view"), bare).otherwise(F.col("payload")).alias("payload"))
    flat = payloads.flatten_tracks(mixed)
    return flat.select(
        *[F.array_join(c, ",").alias(c) if c in ("artists", "artist_ids") else F.col(c) for c in flat.columns]
    )


# --- CSV -----------------------------------------------------------------------------------------

_PART_CSV = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


def _part_csv(spark: SparkSession, sf: str) -> str:
    """Parts as CSV text in which every size above 45 is unreadable."""
    size = F.when(F.col("p_size") > 45, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    lines = table(spark, sf, "part").select("p_partkey", "p_name", size.alias("p_size"), "p_retailprice")
    return sinks.export_csv(lines, scratch_path(spark, "part-csv"))


@query("csv_dropmalformed", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_size <= 45")
def csv_dropmalformed(spark, sf):
    return csvfiles.read_csv_strict(spark, _part_csv(spark, sf), _PART_CSV)


@query(
    "csv_permissive",
    "SELECT p_partkey, p_name, CASE WHEN p_size <= 45 THEN p_size END AS p_size, p_retailprice FROM part",
)
def csv_permissive(spark, sf):
    return csvfiles.without_corrupt_column(csvfiles.read_csv_permissive(spark, _part_csv(spark, sf), _PART_CSV))


@query(
    "csv_load_counts",
    """SELECT count(*) AS row_count, count(*) FILTER (WHERE p_size > 45) AS corrupt_count, 0 AS null_p_partkey,
       0 AS null_p_name, count(*) FILTER (WHERE p_size > 45) AS null_p_size, 0 AS null_p_retailprice FROM part""",
)
def csv_load_counts(spark, sf):
    return csvfiles.load_counts(csvfiles.read_csv_permissive(spark, _part_csv(spark, sf), _PART_CSV))


# --- sinks ---------------------------------------------------------------------------------------

_EVENT_ROWS = f"""WITH {HISTORY} SELECT track_id, played_at, track_name, artist_name, album_name, duration_ms,
    event_id, CAST(played_at AS DATE) AS date FROM history"""


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """History up to the 20th and from the 10th on: ten days arrive twice."""
    events = history(spark, sf)
    return (
        events.where("played_at < timestamp_ntz'2024-01-20 00:00:00'"),
        events.where("played_at >= timestamp_ntz'2024-01-10 00:00:00'"),
    )


@query("idempotent_append", _EVENT_ROWS)
def idempotent_append(spark, sf):
    target = scratch_path(spark, "history")
    first, second = _halves(spark, sf)
    for batch in (first, second, second):
        sinks.append_new(batch, target)
    return read_table(spark, target)


@query("incremental_ingest", _EVENT_ROWS)
def incremental_ingest(spark, sf):
    source, target = scratch_path(spark, "arrivals"), scratch_path(spark, "ingested")
    checkpoint = scratch_path(spark, "ingest-state")
    for batch in _halves(spark, sf):
        sinks.write_table(batch, source, mode="append")
        schema = read_table(spark, source).schema
        ingest_new_files(spark, source, schema, target, checkpoint)
    return read_table(spark, target)


@query(
    "upsert",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_acctbal + 100
       ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
)
def upsert(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    moved = customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    new = customer.where(~F.col("c_mktsegment").isin("HOUSEHOLD"))
    base = sinks.upsert_table(new, None, scratch_path(spark, "customer"), ["c_custkey"])
    updates = moved.withColumn("c_acctbal", F.col("c_acctbal") + 100).unionByName(
        customer.where(F.col("c_mktsegment") == "HOUSEHOLD")
    )
    return read_table(spark, sinks.upsert_table(updates, base, scratch_path(spark, "customer"), ["c_custkey"]))


@query("overwrite_table", "SELECT p_partkey, p_name, p_retailprice FROM part")
def overwrite_table(spark, sf):
    path = scratch_path(spark, "catalog")
    part = table(spark, sf, "part")
    sinks.write_catalog(part.select("p_partkey", "p_name", "p_brand"), path)
    # A second write replaces rows and schema.
    sinks.write_catalog(part.select("p_partkey", "p_name", "p_retailprice"), path, max_records_per_file=1000)
    return read_table(spark, path)


@query(
    "partitioned_write",
    f"""WITH h AS ({_EVENT_ROWS}) SELECT track_id, event_id, date,
        date >= DATE '2024-01-20' AS rebuilt FROM h""",
)
def partitioned_write(spark, sf):
    path = scratch_path(spark, "silver")
    dated = history(spark, sf).select("track_id", "event_id", F.to_date("played_at").alias("date"))
    sinks.write_table(dated.withColumn("rebuilt", F.lit(False)), path, partition_by=["date"])
    late = dated.where("date >= date'2024-01-20'").withColumn("rebuilt", F.lit(True))
    # Only the partitions present in the second frame are replaced.
    sinks.write_table(late, path, partition_by=["date"])
    return read_table(spark, path)


_HOURLY = f"""SELECT hour_of_day, {', '.join(f"{rnd(f'avg({m})')} AS avg_{m}"
    for m in ('valence', 'energy', 'danceability', 'acousticness'))}, count(*) AS sample_size,
    {rnd('stddev_samp(valence)')} AS valence_stddev, {rnd('stddev_samp(energy)')} AS energy_stddev
    FROM plays GROUP BY 1"""


@query("csv_export", over_plays(_HOURLY))
def csv_export(spark, sf):
    hourly = hourly_profile(plays(spark, sf))
    # At most 24 rows, so one file is safe.
    path = sinks.export_csv(hourly, scratch_path(spark, "hourly-csv"), single_file=True)
    return csvfiles.read_csv_strict(spark, path, hourly.schema)


@query(
    "csv_export_many_files",
    over_plays(f"SELECT event_id, {quad('valence', 'energy', words.MOOD)} AS mood FROM plays"),
)
def csv_export_many_files(spark, sf):
    rows = plays(spark, sf).selectExpr("event_id", f"{quadrant('valence', 'energy', words.MOOD)} AS mood")
    path = sinks.export_csv(rows, scratch_path(spark, "moods-csv"))
    return csvfiles.read_csv_strict(spark, path, rows.schema)


@query(
    "catalog_register",
    f"""WITH {HISTORY}, {PLAYS}, real_keys AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS track_id FROM customer)
        SELECT 'listening_history_bronze' AS table_name, count(*) AS n, count(DISTINCT track_id) AS tracks,
               count(*) FILTER (WHERE played_at >= TIMESTAMP '2024-01-25') AS late FROM history
        UNION ALL SELECT 'my_tracks_features_bronze', count(*), count(DISTINCT track_id), 0 FROM real_keys
        UNION ALL SELECT 'listening_with_features', count(*), count(DISTINCT track_id),
               count(*) FILTER (WHERE played_at >= TIMESTAMP '2024-01-25') FROM history
        UNION ALL SELECT 'mood_time_correlations', count(DISTINCT hour_of_day), CAST(count(*) AS BIGINT), 0 FROM plays""",
)
def catalog_register(spark, sf):
    """Rows of bronze, silver and gold tables, read by their names after registration."""
    lake = pipeline.Lake(scratch_path(spark, "lake"))
    sinks.append_new(history(spark, sf), lake.bronze(pipeline.HISTORY))
    tracks = sinks.upsert_table(provided(spark, sf), None, f"{lake.bronze(pipeline.TRACKS)}/v1")
    sinks.write_table(enriched(spark, sf).withColumn("date", F.to_date("played_at")), lake.silver, partition_by=["date"])
    sinks.write_gold(hourly_profile(plays(spark, sf)), lake.gold, "diagnostic", "mood_time_correlations")
    shown = pipeline.register(spark, lake, tracks).where("registered").select("table_name")
    assert {r.table_name for r in shown.collect()} == {
        pipeline.HISTORY, pipeline.TRACKS, pipeline.SILVER_NAME, "mood_time_correlations"
    }
    counts = "count(*) AS n, count(DISTINCT track_id) AS tracks, count_if(date >= DATE'2024-01-25') AS late"
    return spark.sql(
        f"""SELECT 'listening_history_bronze' AS table_name, {counts} FROM listening_history_bronze
            UNION ALL SELECT 'my_tracks_features_bronze', count(*), count(DISTINCT track_id), 0L FROM my_tracks_features_bronze
            UNION ALL SELECT 'listening_with_features', {counts} FROM listening_with_features
            UNION ALL SELECT 'mood_time_correlations', count(*), sum(sample_size), 0L FROM mood_time_correlations"""
    )


@query(
    "step_counts",
    f"""WITH {CATALOG}, counts AS (
          SELECT 'parse_events' AS step, count(*) AS read, count(*) FILTER (WHERE {_GOOD_EVENT}) AS kept FROM events
          UNION ALL SELECT 'read_csv', count(*), count(*) FILTER (WHERE p_size <= 45) FROM part
          UNION ALL SELECT 'range_clean', count(*), count(*) FILTER (WHERE valence BETWEEN 0 AND 1 AND energy BETWEEN 0 AND 1
            AND danceability BETWEEN 0 AND 1 AND acousticness BETWEEN 0 AND 1 AND instrumentalness BETWEEN 0 AND 1
            AND tempo BETWEEN 40 AND 250) FROM catalog_rows)
        SELECT step, 'read' AS metric, read AS value FROM counts UNION ALL SELECT step, 'kept', kept FROM counts
        UNION ALL SELECT step, 'rejected', read - kept FROM counts""",
)
def step_counts(spark, sf):
    """What three steps read, kept and rejected, counted while their results are written."""
    counts = StepCounts()
    lake = pipeline.Lake(scratch_path(spark, "lake"))
    pipeline.ingest_events(lake, _event_payloads(spark, sf), counts)
    rows = csvfiles.read_csv_permissive(spark, _part_csv(spark, sf), _PART_CSV)
    parts = counts.filtered(rows, "read_csv", f"{csvfiles.CORRUPT} IS NULL").drop(csvfiles.CORRUPT)
    sinks.write_table(parts, scratch_path(spark, "parts"))
    cleaned = counts.filtered(catalog(spark, sf), "range_clean", in_ranges(CLEAN_RANGES))
    sinks.write_table(cleaned, scratch_path(spark, "cleaned"))
    return counts.table(spark)


@query(
    "gold_write",
    over_plays(
        f"""SELECT hour_of_day, day_of_week, day_name, part_of_day, is_weekend, count(*) AS play_count,
            {', '.join(f"{rnd(f'avg({m})', 1 if m == 'tempo' else 3)} AS avg_{m}"
              for m in ('valence', 'energy', 'danceability', 'acousticness', 'tempo'))}
            FROM plays GROUP BY 1, 2, 3, 4, 5"""
    ),
)
def gold_write(spark, sf):
    gold = scratch_path(spark, "gold")
    path = sinks.write_gold(patterns_by_time(plays(spark, sf)), gold, "descriptive", "listening_patterns_by_time")
    return read_table(spark, path)
