"""The registry and the SQL fragments the oracles share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ...functions.buckets import Quadrants
from ...functions.hashing import ATTRIBUTE_CHOICES, ATTRIBUTE_RANGES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


# --- SQL fragments -------------------------------------------------------------------------------


def rnd(expression: str, digits: int = 3) -> str:
    """Half-up rounding with the same nudge as ``stable_round``; ``+ 0`` turns -0.0 into 0.0."""
    return f"(round(({expression}) + sign({expression}) * 1e-9, {digits}) + 0e0)"


def pct(part: str, whole: str) -> str:
    ratio = f"({part}) * 100e0 / nullif({whole}, 0)"
    return f"coalesce({rnd(ratio, 2)}, 0e0)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def quad(x: str, y: str, labels: Quadrants) -> str:
    literal = [text(v) if isinstance(v, str) else str(v) for v in labels]
    return (
        f"CASE WHEN {x} >= 0.6e0 AND {y} >= 0.6e0 THEN {literal[0]} WHEN {x} >= 0.6e0 AND {y} < 0.4e0 THEN {literal[1]} "
        f"WHEN {x} < 0.4e0 AND {y} >= 0.6e0 THEN {literal[2]} WHEN {x} < 0.4e0 AND {y} < 0.4e0 THEN {literal[3]} "
        f"ELSE {literal[4]} END"
    )


def steps(value: str, cuts: Sequence[tuple[float, str]], default: str, op: str = "<") -> str:
    whens = " ".join(f"WHEN {value} {op} {cut}e0 THEN {text(label)}" for cut, label in cuts)
    return f"CASE {whens} ELSE {text(default)} END"


def mapped(value: str, texts: Mapping[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {value} = {text(k)} THEN {text(v)}" for k, v in texts.items())
    return f"CASE {whens} ELSE {text(default)} END"


def time_columns(ts: str) -> str:
    return (
        f"CAST(hour({ts}) AS INT) AS hour_of_day, CAST(dayofweek({ts}) + 1 AS INT) AS day_of_week, "
        f"dayname({ts}) AS day_name, dayofweek({ts}) IN (0, 6) AS is_weekend, "
        f"CASE WHEN hour({ts}) BETWEEN 6 AND 11 THEN 'morning' WHEN hour({ts}) BETWEEN 12 AND 17 THEN 'afternoon' "
        f"WHEN hour({ts}) BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END AS part_of_day"
    )


def _frac(value: str, modulus: int = 100) -> str:
    return f"(({value}) % {modulus}) / 1e2"


PLAYS = f"""plays AS (
  SELECT event_id, user_id, CAST(user_id AS VARCHAR) AS track_id, ts AS played_at,
         'Track ' || user_id AS track_name, 'Artist ' || (user_id % 40) AS artist_name, event_type AS label,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) / 1e2 AS valence,
         least(value, 1e2) / 1e2 AS energy, value / 1e2 AS raw_energy,
         {_frac('event_id')} AS danceability, {_frac('event_id * 7')} AS acousticness,
         {_frac('event_id * 13')} AS instrumentalness, {_frac('event_id * 31', 50)} AS speechiness,
         CAST(-((event_id * 17) % 60) AS DOUBLE) AS loudness, 6e1 + least(value, 12e1) AS tempo,
         {time_columns('ts')}
  FROM events)"""

CATALOG = f"""catalog_rows AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
           || strftime(l_shipdate, '%Y%m%d') AS track_id,
         l_discount * 1e1 AS danceability, l_quantity / 5e1 AS energy,
         (l_discount * 1e1) * 0.4e0 + (l_quantity / 5e1) * 0.4e0 + ({_frac('l_suppkey')}) * 0.2e0 AS valence,
         l_tax * 12.5e0 AS acousticness, {_frac('l_partkey')} AS instrumentalness, l_extendedprice / 3e2 AS tempo
  FROM lineitem)"""

HISTORY = """history AS (
  SELECT CAST(user_id AS VARCHAR) AS track_id, ts AS played_at, 'Track ' || user_id AS track_name,
         'Artist ' || (user_id % 40) AS artist_name, 'Album ' || (user_id % 90) AS album_name,
         event_id * 10 AS duration_ms, event_id
  FROM events)"""


def hex_block(digest: str, index: int = 0) -> str:
    return f"CAST('0x' || substr({digest}, {1 + 13 * index}, 13) AS BIGINT)"


def digest(key: str, salt: str) -> str:
    return f"sha256({key} || '|{salt}')"


def uniform(digest_hex: str, index: int = 0) -> str:
    return f"CAST({hex_block(digest_hex, index)} AS DOUBLE) / 4503599627370496e0"


def _generated(source: str, key: str) -> str:
    names = [*ATTRIBUTE_RANGES, *ATTRIBUTE_CHOICES]
    hashes = ", ".join(f"{digest(key, n)} AS h_{n}" for n in names)
    blocks = ", ".join(f"{uniform(f'h_{n}', i)} AS u_{n}_{i}" for n in ATTRIBUTE_RANGES for i in range(3))
    measures = []
    for n, (low, high) in ATTRIBUTE_RANGES.items():
        a, b, c = (f"u_{n}_{i}" for i in range(3))
        median = f"greatest(least({a}, {b}), least(greatest({a}, {b}), {c}))"
        width = repr(high - low)
        measures.append(f"CAST(round({low}e0 + {median} * {width}e0, 4) AS FLOAT) AS {n}")
    picks = [
        f"CAST(list_extract([{', '.join(map(str, options))}], CAST({hex_block(f'h_{n}')} % {len(options)} AS INT) + 1) "
        f"AS INT) AS \"{n}\""
        for n, options in ATTRIBUTE_CHOICES.items()
    ]
    return f"""SELECT {key}, {', '.join(measures)}, {', '.join(picks)}
      FROM (SELECT *, {blocks} FROM (SELECT {key}, {hashes} FROM {source}))"""


REAL = f"""real_rows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS track_id, CAST({_frac('c_custkey * 37')} AS FLOAT) AS danceability,
         CAST({_frac('c_custkey * 53')} AS FLOAT) AS energy, CAST({_frac('c_custkey * 71')} AS FLOAT) AS valence,
         CAST(6e1 + c_nationkey * 4 AS FLOAT) AS tempo
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"""

MISSING = """missing_rows AS (
  SELECT DISTINCT track_id FROM history WHERE track_id NOT IN (SELECT track_id FROM real_rows))"""

GENERATED = f"made_rows AS ({_generated('missing_rows', 'track_id')})"

ENRICHED = f"""{HISTORY}, {REAL}, {MISSING}, {GENERATED}, part_rows AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_id, CAST({_frac('p_partkey * 3')} AS FLOAT) AS danceability,
         CAST(p_size / 64e0 AS FLOAT) AS acousticness, CAST({_frac('p_partkey * 19')} AS FLOAT) AS instrumentalness
  FROM part),
enriched AS (
  SELECT h.*, coalesce(r.danceability, m.danceability, p.danceability) AS danceability,
         coalesce(r.energy, m.energy) AS energy, coalesce(r.valence, m.valence) AS valence,
         coalesce(m.acousticness, p.acousticness) AS acousticness,
         coalesce(m.instrumentalness, p.instrumentalness) AS instrumentalness,
         m.speechiness, m.liveness, m.loudness, coalesce(r.tempo, m.tempo) AS tempo,
         coalesce(CASE WHEN r.track_id IS NOT NULL THEN 4 END, m.time_signature) AS time_signature,
         m."key", m.mode,
         CASE WHEN r.danceability IS NOT NULL THEN 'real' WHEN m.danceability IS NOT NULL THEN 'synthetic'
              WHEN p.danceability IS NOT NULL THEN 'kaggle' ELSE 'unknown' END AS feature_source,
         {time_columns('h.played_at')}
  FROM history h LEFT JOIN real_rows r USING (track_id) LEFT JOIN made_rows m USING (track_id)
       LEFT JOIN part_rows p USING (track_id))"""


def over_plays(body: str) -> str:
    return f"WITH {PLAYS} {body}"


def over_enriched(body: str) -> str:
    return f"WITH {ENRICHED} {body}"


def over_catalog(body: str) -> str:
    return f"WITH {CATALOG} {body}"
