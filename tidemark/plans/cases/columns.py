"""Scans, expressions, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions import vocabulary as words
from ...functions.buckets import band, ladder, lookup, quadrant
from ...functions.hashing import ATTRIBUTE_CHOICES, ATTRIBUTE_RANGES
from ...functions.numeric import min_max_scale, stable_round
from ...functions.timeparts import DAY_PARTS, OTHER_PART, time_dimensions
from ...operators import anomaly, conform, enrich, learn
from ...schemas import SCHEMAS
from ...session import materialize, scratch_path
from ...sources import sinks
from ...sources.tables import distinct_keys as distinct_keys_of
from ...sources.tables import optional_or_empty, read_optional, read_table
from ..bindings import SMALL_PART, catalog, enriched, history, order_sources, plays, stored_in_buckets, table, with_values
from .registry import (
    GENERATED,
    HISTORY,
    MISSING,
    ORACLES,
    REAL,
    digest,
    hex_block,
    mapped,
    over_catalog,
    over_enriched,
    over_plays,
    pct,
    quad,
    query,
    rnd,
    steps,
    time_columns,
)

# --- scans ---------------------------------------------------------------------------------------


@query("scan_events", "SELECT * FROM events")
def scan_events(spark, sf):
    return table(spark, sf, "events")


@query(
    "optional_source",
    """SELECT o_orderkey, o_custkey, c_acctbal AS score, CAST(NULL AS DOUBLE) AS bonus,
       CASE WHEN c_custkey IS NOT NULL THEN 'customer' ELSE 'unknown' END AS origin
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def optional_source(spark, sf):
    absent = read_optional(spark, f"{sf}/no_such_table.parquet")
    customer = read_optional(spark, f"{sf}/customer.parquet")
    padded = optional_or_empty(absent, spark, T.StructType([T.StructField("bonus", T.DoubleType())]))
    assert padded.columns == ["bonus"]
    sources = {
        "absent": absent,
        "customer": customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("score")),
    }
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return enrich.attach_attributes(
        orders, sources, "o_custkey", {"score": "double", "bonus": "double"}, probe="score", label="origin"
    )


@query("distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_keys(spark, sf):
    return distinct_keys_of(table(spark, sf, "events"), "user_id", "event_type")


@query("distinct_keys_limited", "SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey LIMIT 50")
def distinct_keys_limited(spark, sf):
    return distinct_keys_of(table(spark, sf, "orders"), "o_custkey", limit=50)


# --- conforming ----------------------------------------------------------------------------------


@query(
    "normalize_columns",
    """SELECT p_partkey AS track_id, p_name AS track_name, p_brand AS artists, p_type AS album_name,
       p_size AS duration_ms, p_retailprice AS "Extra" FROM part""",
)
def normalize_columns(spark, sf):
    raw = table(spark, sf, "part").toDF("Track_ID", " Song_Name ", "ARTIST", "Album", "Duration_In_MS", "Extra")
    return conform.normalize_columns(raw, SCHEMAS["kaggle_tracks_bronze"].names, conform.CATALOG_ALIASES)


@query(
    "cast_columns",
    """SELECT p_partkey, TRY_CAST(CASE WHEN p_size > 40 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS INT) AS size,
       CAST(p_retailprice AS FLOAT) AS price FROM part""",
)
def cast_columns(spark, sf):
    mixed = F.when(F.col("p_size") > 40, F.col("p_brand")).otherwise(F.col("p_size").cast("string"))
    raw = table(spark, sf, "part").select(
        "p_partkey", mixed.alias("size"), F.col("p_retailprice").cast("string").alias("price")
    )
    return conform.cast_columns(raw, {"size": T.IntegerType(), "price": T.FloatType()})


@query(
    "surrogate_key",
    """SELECT coalesce(CASE WHEN p_size > 25 THEN CAST(p_partkey AS VARCHAR) END,
              md5(p_name || '|' || coalesce(CASE WHEN p_size > 5 THEN p_brand END, '') || '|' || p_type)) AS track_id,
       p_name, p_partkey FROM part""",
)
def surrogate_key(spark, sf):
    rows = table(spark, sf, "part").select(
        F.when(F.col("p_size") > 25, F.col("p_partkey").cast("string")).alias("track_id"),
        "p_name",
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("brand"),
        "p_type",
        "p_partkey",
    )
    keyed = conform.with_surrogate_key(rows, "track_id", ["p_name", "brand", "p_type"])
    return keyed.select("track_id", "p_name", "p_partkey")


@query(
    "conform_schema",
    """SELECT md5(p_name || '|' || p_brand || '|') AS track_id, p_brand AS artists, CAST(NULL AS VARCHAR) AS album_name,
       p_name AS track_name, p_size AS popularity, CAST(NULL AS BIGINT) AS duration_ms,
       CAST(NULL AS BOOLEAN) AS explicit, CAST(NULL AS FLOAT) AS danceability,
       CAST(p_retailprice / 1e4 AS FLOAT) AS energy, CAST(NULL AS FLOAT) AS valence,
       CAST(NULL AS FLOAT) AS acousticness, CAST(NULL AS FLOAT) AS instrumentalness, CAST(NULL AS FLOAT) AS tempo,
       p_type AS track_genre FROM part""",
)
def conform_schema(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("ARTIST"),
        F.col("p_type").alias("Genre"),
        F.col("p_size").cast("string").alias("popularity"),
        (F.col("p_retailprice") / 1e4).alias("Energy"),
        F.lit("ignored").alias("unrelated"),
    )
    return conform.conform_catalog(raw, SCHEMAS["kaggle_tracks_bronze"]).drop("_ingested_at")


# --- expressions ---------------------------------------------------------------------------------


@query("time_dimensions", f"SELECT event_id, {time_columns('ts')} FROM events")
def time_dims(spark, sf):
    return time_dimensions(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@query(
    "quadrant_bucket",
    over_plays(
        f"""SELECT event_id, {quad('valence', 'energy', words.MOOD)} AS mood,
            {quad('valence', 'energy', words.MOOD_CODE)} AS mood_label FROM plays"""
    ),
)
def quadrant_bucket(spark, sf):
    return plays(spark, sf).selectExpr(
        "event_id",
        f"{quadrant('valence', 'energy', words.MOOD)} AS mood",
        f"{quadrant('valence', 'energy', words.MOOD_CODE)} AS mood_label",
    )


@query(
    "threshold_ladder",
    over_plays(
        f"""SELECT event_id, {steps('valence', [(0.3, 'High Priority'), (0.4, 'Medium Priority')], 'Low Priority')}
              AS priority,
            {steps('raw_energy', [(3.0, 'High'), (2.5, 'Medium')], 'Low', '>')} AS severity,
            CASE WHEN hour_of_day BETWEEN 6 AND 11 THEN 'morning' WHEN hour_of_day BETWEEN 12 AND 17 THEN 'afternoon'
                 WHEN hour_of_day BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END AS part FROM plays"""
    ),
)
def threshold_ladder(spark, sf):
    priority = ladder("valence", [(0.3, "High Priority"), (0.4, "Medium Priority")], "Low Priority")
    severity = ladder("raw_energy", [(3.0, "High"), (2.5, "Medium")], "Low", op=">")
    part = band("hour_of_day", DAY_PARTS, OTHER_PART)
    return plays(spark, sf).selectExpr(
        "event_id", f"{priority} AS priority", f"{severity} AS severity", f"{part} AS part"
    )


@query(
    "label_lookup",
    over_plays(
        f"""SELECT event_id, {mapped('state', words.STATE_ACTIVITY, words.STATE_ACTIVITY_DEFAULT)} AS activity
            FROM (SELECT *, {quad('valence', 'energy', words.MOOD_STATE)} AS state FROM plays)"""
    ),
)
def label_lookup(spark, sf):
    state = plays(spark, sf).selectExpr("event_id", f"{quadrant('valence', 'energy', words.MOOD_STATE)} AS state")
    text = lookup("state", words.STATE_ACTIVITY, words.STATE_ACTIVITY_DEFAULT)
    return state.selectExpr("event_id", f"{text} AS activity")


@query(
    "minmax_scale",
    over_plays(
        f"""SELECT event_id, {rnd('(tempo - 60) / 12e1', 6)} AS tempo_normalized,
            {rnd('(loudness + 60) / 6e1', 6)} AS loudness_normalized FROM plays"""
    ),
)
def minmax_scale(spark, sf):
    bounds = {"tempo": (60.0, 180.0), "loudness": (-60.0, 0.0)}
    scaled = [f"{stable_round(min_max_scale(m, lo, hi), 6)} AS {m}_normalized" for m, (lo, hi) in bounds.items()]
    return plays(spark, sf).selectExpr("event_id", *scaled)


_ATTRIBUTES = [*ATTRIBUTE_RANGES, *ATTRIBUTE_CHOICES]


@query(
    "deterministic_features",
    f"WITH {HISTORY}, {REAL}, {MISSING}, {GENERATED} SELECT track_id, "
    + ", ".join(f'"{a}"' for a in _ATTRIBUTES)
    + ", 'synthetic' AS source FROM made_rows",
)
def deterministic_features(spark, sf):
    events = history(spark, sf)
    return enrich.generate_attributes(enrich.missing_keys(events, "track_id", [with_values(spark, sf)]))


@query("append_generated", ORACLES["deterministic_features"])
def append_generated(spark, sf):
    """Attributes of half the missing keys, then of all of them: each key is stored once."""
    path = scratch_path(spark, "generated")
    missing = enrich.missing_keys(history(spark, sf), "track_id", [with_values(spark, sf)])
    for keys in (missing.where("CAST(track_id AS BIGINT) % 2 = 0"), missing, missing):
        sinks.append_generated(enrich.generate_attributes(keys), path)
    return read_table(spark, path)


def _drawn(n: int, index: int) -> str:
    return f"CAST({hex_block(digest('track_id', 'time'), index)} % {n} AS INT)"


TIMED = f"""SELECT *, {_drawn(24, 0)} AS hour_of_day, {_drawn(7, 1)} + 1 AS day_of_week,
    CAST({_drawn(7, 1)} + 1 IN (1, 7) AS INT) AS is_weekend FROM catalog_rows"""


@query(
    "deterministic_time",
    over_catalog(f"SELECT track_id, hour_of_day, day_of_week, is_weekend FROM ({TIMED})"),
)
def deterministic_time(spark, sf):
    timed = enrich.deterministic_time(catalog(spark, sf), "track_id")
    return timed.select("track_id", "hour_of_day", "day_of_week", "is_weekend")


# --- filters -------------------------------------------------------------------------------------

CLEAN = " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in enrich.CLEAN_RANGES.items())


@query(
    "range_clean",
    over_catalog(
        f"""SELECT count(*) AS rows_before, count(*) FILTER (WHERE {CLEAN}) AS rows_after,
            count(*) - count(*) FILTER (WHERE {CLEAN}) AS rows_removed FROM catalog_rows"""
    ),
)
def range_clean(spark, sf):
    return enrich.range_clean_counts(catalog(spark, sf))


@query(
    "training_scan",
    over_catalog(
        f"""SELECT track_id, {rnd('valence', 6)} AS valence, {rnd('tempo', 6)} AS tempo, hour_of_day, day_of_week,
            is_weekend FROM ({TIMED}) WHERE {CLEAN}"""
    ),
)
def training_scan(spark, sf):
    rows = enrich.training_rows(catalog(spark, sf), "track_id")
    rounded = [f"{stable_round(c, 6)} AS {c}" for c in ("valence", "tempo")]
    return rows.selectExpr("track_id", *rounded, "hour_of_day", "day_of_week", "is_weekend")


@query(
    "any_present",
    over_enriched(
        "SELECT event_id FROM enriched WHERE coalesce(acousticness, speechiness, liveness, loudness) IS NOT NULL"
    ),
)
def any_present(spark, sf):
    columns = ["acousticness", "speechiness", "liveness", "loudness"]
    return enrich.any_present(enriched(spark, sf), columns).select("event_id")


@query(
    "all_present",
    over_enriched("SELECT event_id FROM enriched WHERE valence IS NOT NULL AND loudness IS NOT NULL AND tempo IS NOT NULL"),
)
def all_present(spark, sf):
    return enrich.all_present(enriched(spark, sf), ["valence", "loudness", "tempo"]).select("event_id")


# --- joins ---------------------------------------------------------------------------------------

_ORDER_JOIN = f"""SELECT o_orderkey, o_custkey, coalesce(c_acctbal, s_acctbal, p_retailprice) AS score,
    CASE WHEN c_acctbal IS NOT NULL THEN 'customer' WHEN s_acctbal IS NOT NULL THEN 'supplier'
         WHEN p_retailprice IS NOT NULL THEN 'part' ELSE 'unknown' END AS origin
    FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) ON c_custkey = o_custkey
    LEFT JOIN supplier ON s_suppkey = o_custkey
    LEFT JOIN (SELECT * FROM part WHERE p_size <= {SMALL_PART}) ON p_partkey = o_custkey"""


def _orders_with_score(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return enrich.attach_attributes(
        orders, order_sources(spark, sf), "o_custkey", {"score": "double"}, probe="score", label="origin"
    )


@query("multi_source_join", _ORDER_JOIN)
def multi_source_join(spark, sf):
    return _orders_with_score(spark, sf)


@query(
    "source_preference",
    over_enriched(
        """SELECT event_id, danceability, acousticness, tempo, time_signature, feature_source FROM enriched"""
    ),
)
def source_preference(spark, sf):
    return enriched(spark, sf).select(
        "event_id", "danceability", "acousticness", "tempo", "time_signature", "feature_source"
    )


@query(
    "colocated_join",
    over_enriched(
        """SELECT event_id, danceability, acousticness, tempo, time_signature, feature_source FROM enriched"""
    ),
)
def colocated_join(spark, sf):
    """Events and merged attributes stored in the same buckets, joined where they lie."""
    joined = enrich.attach_stored(*stored_in_buckets(spark, sf))
    return joined.select("event_id", "danceability", "acousticness", "tempo", "time_signature", "feature_source")


@query(
    "silver_anomalies",
    over_enriched(
        f""", hourly AS (
          SELECT hour_of_day, avg(CAST(valence AS DOUBLE)) AS tv, stddev_samp(CAST(valence AS DOUBLE)) AS sv,
                 avg(CAST(energy AS DOUBLE)) AS te, stddev_samp(CAST(energy AS DOUBLE)) AS se FROM enriched GROUP BY 1),
        scored AS (SELECT hour_of_day, abs(valence - tv) / nullif(sv, 0) AS zv, abs(energy - te) / nullif(se, 0) AS ze
                   FROM enriched JOIN hourly USING (hour_of_day)),
        found AS (SELECT hour_of_day, count(*) AS anomaly_count, avg(zv) AS v, avg(ze) AS e FROM scored
                  WHERE zv > 1.5e0 OR ze > 1.5e0 GROUP BY 1)
        SELECT hour_of_day, anomaly_count, {rnd('v')} AS avg_valence_deviation, {rnd('e')} AS avg_energy_deviation,
          anomaly_severity, {mapped('anomaly_severity', words.SEVERITY_TEXT, words.SEVERITY_TEXT_DEFAULT)} AS interpretation
        FROM (SELECT *, CASE WHEN v > 3 OR e > 3 THEN 'High' WHEN v > 2.5e0 OR e > 2.5e0 THEN 'Medium' ELSE 'Low' END
              AS anomaly_severity FROM found)"""
    ),
)
def silver_anomalies(spark, sf):
    # The baseline and the join back both read silver: it is stored once, narrowed to what they need.
    silver = materialize(enriched(spark, sf).select("hour_of_day", "valence", "energy"))
    # Generated attributes are spread evenly, so few rows lie beyond two deviations; the limit is set lower.
    return anomaly.anomaly_summary(silver, limit=1.5)


@query(
    "anti_join_new_rows",
    """SELECT event_id, user_id, ts FROM events b WHERE ts >= TIMESTAMP '2024-01-10' AND NOT EXISTS (
         SELECT 1 FROM events e WHERE e.ts < TIMESTAMP '2024-01-20' AND e.user_id = b.user_id AND e.ts = b.ts)""",
)
def anti_join_new_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    stored = events.where("ts < timestamp_ntz'2024-01-20 00:00:00'")
    arrived = events.where("ts >= timestamp_ntz'2024-01-10 00:00:00'")
    return enrich.new_rows(arrived, stored, ["user_id", "ts"])


@query("missing_keys", f"WITH {HISTORY}, {REAL}, {MISSING} SELECT track_id FROM missing_rows")
def missing_keys(spark, sf):
    return enrich.missing_keys(history(spark, sf), "track_id", [with_values(spark, sf)])


@query(
    "key_coverage",
    f"""WITH {HISTORY}, {REAL}, wanted AS (SELECT DISTINCT track_id FROM history),
        hit AS (SELECT track_id FROM wanted WHERE track_id IN (SELECT track_id FROM real_rows))
        SELECT w AS total_keys, h AS covered_keys, w - h AS missing_keys, {pct('h', 'w')} AS coverage_pct
        FROM (SELECT (SELECT count(*) FROM wanted) AS w, (SELECT count(*) FROM hit) AS h)""",
)
def key_coverage(spark, sf):
    return enrich.key_coverage(history(spark, sf), "track_id", [with_values(spark, sf)])


@query(
    "coverage_stats",
    f"""WITH joined AS ({_ORDER_JOIN}), total AS (SELECT count(*) AS n FROM joined)
        SELECT origin, count(*) AS record_count, {pct('count(*)', 'any_value(n)')} AS percentage,
               count(score) AS target_count, {pct('count(score)', 'any_value(n)')} AS target_percentage
        FROM joined, total GROUP BY origin""",
)
def coverage_stats(spark, sf):
    return enrich.coverage_stats(_orders_with_score(spark, sf), source="origin", target="score")


@query(
    "one_per_key",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def one_per_key(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    return enrich.one_per_key(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# --- frames without rows, stamped rows, test rows --------------------------------------------------


@query("empty_source", "SELECT CAST(user_id AS VARCHAR) AS track_id, ts AS played_at, 'Track ' || user_id AS track_name FROM events")
def empty_source(spark, sf):
    """An absent source behaves like a table of its schema without rows."""
    events = history(spark, sf).select("track_id", "played_at", "track_name")
    absent = optional_or_empty(read_optional(spark, scratch_path(spark, "nothing")), spark, events.schema)
    return events.unionByName(absent)


@query("stamped_rows", over_plays("SELECT event_id, true AS recent FROM plays"))
def stamped_rows(spark, sf):
    """Every row carries the time at which it was taken in."""
    stamped = conform.stamp(plays(spark, sf).select("event_id"))
    return stamped.selectExpr("event_id", "timestampdiff(SECOND, _ingested_at, current_timestamp()) BETWEEN 0 AND 3600 AS recent")


@query(
    "model_test_scan",
    over_plays(
        f"""SELECT hour_of_day, day_of_week, {rnd('energy', 6)} AS energy, {rnd('tempo', 6)} AS tempo,
            {rnd('danceability', 6)} AS danceability, CAST(is_weekend AS INT) AS is_weekend_int, {rnd('valence', 6)} AS valence FROM plays"""
    ),
)
def model_test_scan(spark, sf):
    """Complete rows for scoring, with the weekend flag as a number."""
    rows = learn.model_frame(plays(spark, sf), learn.VALENCE_FOREST)
    measures = ("energy", "tempo", "danceability", "valence")
    rounded = [f"{stable_round(c, 6)} AS {c}" for c in measures]
    return rows.selectExpr("hour_of_day", "day_of_week", *rounded, "is_weekend_int")
