"""Data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ...functions.numeric import round_columns
from ...operators import quality
from ...operators.quality import (
    has_columns,
    mean_near,
    nulls_at_most,
    rows_at_least,
    run_checks,
    unique,
    within,
)
from ...operators.profiles import daily_trends, hourly_profile, patterns_by_time
from ...schemas import SCHEMAS
from ...operators.conform import conform
from ...session import scratch_path
from ...sources import sinks
from ...sources.tables import read_table
from ..bindings import catalog, enriched, history, plays, table
from .registry import CATALOG, ENRICHED, PLAYS, over_enriched, over_plays, query, rnd


def _row(table_name: str, check: str, column: str | None, observed: str, threshold: float, passed: str, source: str, layer: str = "table") -> str:
    shown = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT '{layer}' AS layer, '{table_name}' AS \"table\", '{check}' AS \"check\", {shown} AS \"column\", o AS observed, "
        f"{threshold}e0 AS threshold, {passed} AS passed FROM (SELECT CAST({observed} AS DOUBLE) AS o {source})"
    )


def _exact(df: DataFrame) -> DataFrame:
    return round_columns(df, {"observed": 6})


def _nulls(column: str, isnan: bool = False) -> str:
    test = f'"{column}" IS NULL' + (f' OR isnan("{column}")' if isnan else "")
    return rnd(f"count(*) FILTER (WHERE {test}) * 1e2 / count(*)", 4)


@query(
    "dq_nulls",
    over_enriched(
        _row("silver", "nulls", "loudness", _nulls("loudness"), 5.0, "o <= 5", "FROM enriched")
        + " UNION ALL "
        + _row("silver", "nulls", "played_at", _nulls("played_at"), 0.0, "o <= 0", "FROM enriched")
    ),
)
def dq_nulls(spark, sf):
    return run_checks(enriched(spark, sf), [nulls_at_most("loudness", 5.0), nulls_at_most("played_at", 0.0)], "silver")


def _outside(column: str, low: float, high: float) -> str:
    return f"count(*) FILTER (WHERE {column} < {low} OR {column} > {high})"


@query(
    "dq_range",
    over_plays(
        _row("plays", "range", "valence", _outside("valence", 0, 1), 0.0, "o <= 0", "FROM plays")
        + " UNION ALL "
        + _row("plays", "range", "raw_energy", _outside("raw_energy", 0, 1), 0.0, "o <= 0", "FROM plays")
    ),
)
def dq_range(spark, sf):
    return run_checks(plays(spark, sf), [within("valence", 0, 1), within("raw_energy", 0, 1)], "plays")


@query("dq_rowcount", _row("orders", "row_count", None, "count(*)", 100000.0, "o >= 100000", "FROM orders"))
def dq_rowcount(spark, sf):
    return run_checks(table(spark, sf, "orders"), [rows_at_least(100_000)], "orders")


@query(
    "dq_duplicates",
    _row(
        "lineitem", "duplicates", "l_orderkey,l_linenumber",
        "(SELECT count(*) FROM lineitem) - count(*)", 0.0, "o <= 0",
        "FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
    )
    + " UNION ALL "
    + _row(
        "lineitem", "duplicates", "l_orderkey", "(SELECT count(*) FROM lineitem) - count(*)", 0.0, "o <= 0",
        "FROM (SELECT DISTINCT l_orderkey FROM lineitem)",
    ),
)
def dq_duplicates(spark, sf):
    return run_checks(
        table(spark, sf, "lineitem"), [unique("l_orderkey", "l_linenumber"), unique("l_orderkey")], "lineitem"
    )


@query(
    "dq_schema",
    _row("part", "schema", None, "1", 0.0, "o <= 0", "FROM (SELECT count(*) FROM part)")
    + " UNION ALL "
    + _row("part", "schema", None, "0", 0.0, "o <= 0", "FROM (SELECT count(*) FROM part)"),
)
def dq_schema(spark, sf):
    checks = [has_columns("p_partkey", "valence"), has_columns("p_partkey", "p_name")]
    return run_checks(table(spark, sf, "part"), checks, "part")


@query(
    "dq_distribution",
    over_plays(
        _row("plays", "distribution", "valence", rnd("avg(valence)", 6), 0.25, "abs(o - 0.5e0) <= 0.25e0", "FROM plays")
        + " UNION ALL "
        + _row("plays", "distribution", "tempo", rnd("avg(tempo)", 6), 5.0, "abs(o - 60) <= 5", "FROM plays")
    ),
)
def dq_distribution(spark, sf):
    return _exact(run_checks(plays(spark, sf), [mean_near("valence", 0.5, 0.25), mean_near("tempo", 60.0, 5.0)], "plays"))


# --- suites --------------------------------------------------------------------------------------

CATALOG_NAME, HISTORY_NAME, SILVER_NAME = "kaggle_tracks_bronze", "listening_history_bronze", "listening_with_features"


def _suite(spark: SparkSession, sf: str) -> DataFrame:
    """All layers. The catalog is made of line items; one gold table has not been written."""
    # stored once, as the pipeline does: the checks then read columns, not the joins
    silver = read_table(spark, sinks.write_table(enriched(spark, sf), scratch_path(spark, "silver")))
    # The catalog's names are not part of the test data: conforming fills the columns with NULL.
    bronze = {
        CATALOG_NAME: (
            conform(catalog(spark, sf), SCHEMAS[CATALOG_NAME], skip=("_ingested_at",)),
            quality.BRONZE_CHECKS[CATALOG_NAME],
        ),
        HISTORY_NAME: (history(spark, sf), quality.BRONZE_CHECKS[HISTORY_NAME]),
    }
    measured = plays(spark, sf)
    gold_tables = {
        "listening_patterns_by_time": patterns_by_time(measured),
        "temporal_trends": daily_trends(measured),
        "mood_time_correlations": hourly_profile(measured),
        "mood_state_clusters": None,
    }
    gold = {name: (frame, quality.GOLD_CHECKS[name]) for name, frame in gold_tables.items()}
    return (
        quality.run_suite(spark, bronze, "bronze")
        .unionByName(quality.run_suite(spark, {SILVER_NAME: (silver, quality.SILVER_CHECKS[SILVER_NAME])}, "silver"))
        .unionByName(quality.run_suite(spark, gold, "gold"))
    )


def _suite_sql() -> str:
    rows = []

    def add(layer, name, check, column, observed, threshold, passed, source):
        rows.append(_row(name, check, column, observed, threshold, passed, source, layer))

    def ranges(layer, name, source, bounds):
        for column, (low, high) in bounds.items():
            as_float = f"CAST({column} AS FLOAT)" if name == CATALOG_NAME else column
            add(layer, name, "range", column, _outside(as_float, low, high), 0.0, "o <= 0", f"FROM {source}")

    add("bronze", CATALOG_NAME, "row_count", None, "count(*)", 100000.0, "o >= 100000", "FROM catalog_rows")
    add("bronze", CATALOG_NAME, "schema", None, "0", 0.0, "o <= 0", "FROM (SELECT count(*) FROM catalog_rows)")
    ranges("bronze", CATALOG_NAME, "catalog_rows", {"valence": (0, 1), "energy": (0, 1), "danceability": (0, 1), "tempo": (40, 250)})
    add("bronze", CATALOG_NAME, "nulls", "track_id", _nulls("track_id"), 0.0, "o <= 0", "FROM catalog_rows")

    add("bronze", HISTORY_NAME, "row_count", None, "count(*)", 100.0, "o >= 100", "FROM history")
    add("bronze", HISTORY_NAME, "schema", None, "0", 0.0, "o <= 0", "FROM (SELECT count(*) FROM history)")
    add("bronze", HISTORY_NAME, "nulls", "played_at", _nulls("played_at"), 0.0, "o <= 0", "FROM history")
    add(
        "bronze", HISTORY_NAME, "duplicates", "played_at,track_id", "(SELECT count(*) FROM history) - count(*)", 0.0,
        "o <= 0", "FROM (SELECT DISTINCT played_at, track_id FROM history)",
    )

    add("silver", SILVER_NAME, "row_count", None, "count(*)", 100.0, "o >= 100", "FROM enriched")
    add("silver", SILVER_NAME, "schema", None, "0", 0.0, "o <= 0", "FROM (SELECT count(*) FROM enriched)")
    ranges("silver", SILVER_NAME, "enriched", {"valence": (0, 1), "energy": (0, 1), "hour_of_day": (0, 23), "day_of_week": (1, 7)})
    add("silver", SILVER_NAME, "nulls", "valence", _nulls("valence"), 1.0, "o <= 1", "FROM enriched")
    for column, mean in (("valence", 0.5), ("energy", 0.525)):
        observed = rnd(f"avg(CAST({column} AS DOUBLE))", 6)
        add("silver", SILVER_NAME, "distribution", column, observed, 0.25, f"abs(o - {mean}e0) <= 0.25e0", "FROM enriched")

    sizes = {
        "listening_patterns_by_time": "(SELECT DISTINCT hour_of_day, day_of_week FROM plays)",
        "temporal_trends": "(SELECT DISTINCT CAST(played_at AS DATE) FROM plays)",
        "mood_time_correlations": "(SELECT DISTINCT hour_of_day FROM plays)",
    }
    for name, source in sizes.items():
        add("gold", name, "row_count", None, "count(*)", 1.0, "o >= 1", f"FROM {source}")
        add("gold", name, "schema", None, "0", 0.0, "o <= 0", f"FROM (SELECT count(*) FROM {source})")
    add("gold", "mood_state_clusters", "exists", None, "0", 1.0, "false", "")
    return " UNION ALL ".join(rows)


_LAYERS = f"WITH {PLAYS}, {CATALOG}, {ENRICHED}"


@query("dq_suite", f"{_LAYERS} {_suite_sql()}")
def dq_suite(spark, sf):
    return _exact(_suite(spark, sf))


@query(
    "dq_report",
    f"""{_LAYERS}, results AS ({_suite_sql()}), both_levels AS (
          SELECT layer, passed FROM results UNION ALL SELECT 'all', passed FROM results)
        SELECT layer, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
          count(*) FILTER (WHERE NOT passed) AS failed_checks,
          {rnd('count(*) FILTER (WHERE passed) * 1e2 / count(*)', 2)} AS pass_rate FROM both_levels GROUP BY 1""",
)
def dq_report(spark, sf):
    return quality.report(_suite(spark, sf))
