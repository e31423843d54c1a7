"""Cleaning filters, key sets, and the multi-source attribute join that makes the silver table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import ATTRIBUTE_CHOICES, ATTRIBUTE_RANGES, beta22, digest, pick, scale, unit
from ..functions.numeric import literal, percent
from ..functions.timeparts import is_weekend
from ..schemas import ATTRIBUTE_TYPES

# Plausible range of each training attribute.
CLEAN_RANGES = {
    "valence": (0, 1),
    "energy": (0, 1),
    "danceability": (0, 1),
    "acousticness": (0, 1),
    "instrumentalness": (0, 1),
    "tempo": (40, 250),
}


# --- filters -------------------------------------------------------------------------------------


def in_ranges(ranges: Mapping[str, tuple[float, float]]) -> str:
    return " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in ranges.items())


def range_clean(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = CLEAN_RANGES) -> DataFrame:
    """Rows with every listed column inside its range; a NULL fails."""
    return df.where(in_ranges(ranges))


def range_clean_counts(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = CLEAN_RANGES) -> DataFrame:
    """Rows before, after and removed, in one pass."""
    kept = f"count_if({in_ranges(ranges)})"
    return df.agg(
        F.expr("count(*) AS rows_before"), F.expr(f"{kept} AS rows_after"), F.expr(f"count(*) - {kept} AS rows_removed")
    )


def any_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(f"coalesce({', '.join(columns)}) IS NOT NULL")


def all_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(" AND ".join(f"{c} IS NOT NULL" for c in columns))


# --- keys ----------------------------------------------------------------------------------------


def one_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, then by the other columns, so the choice is repeatable.

    An aggregate, not a window: copies of a hot key are merged before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = [*latest_by, *[c for c in rest if c not in latest_by]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_row"))
    return best.select(*[c if c in keys else f"_row.{c}" for c in df.columns])


def new_rows(batch: DataFrame, existing: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``. A NULL key is always new, or with ``null_safe`` equals a NULL."""
    if null_safe:
        stored = existing.select(*[F.col(k).alias(f"_stored_{k}") for k in keys])
        return batch.join(stored, [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in keys], "left_anti")
    return batch.join(existing.select(*keys), list(keys), "left_anti")


def merge_latest(target: DataFrame, source: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """Upsert: source rows replace target rows with the same key, the others stay."""
    updates = one_per_key(source, keys, latest_by)
    return new_rows(target, updates, keys).unionByName(updates)


def _stacked_keys(frames: Sequence[DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.unionAll, [f.select(key) for f in frames])


def missing_keys(history: DataFrame, key: str, covered: Sequence[DataFrame]) -> DataFrame:
    """Distinct keys of ``history`` found in none of the covered frames."""
    wanted = history.select(key).where(f"{key} IS NOT NULL").distinct()
    return new_rows(wanted, _stacked_keys(covered, key), [key]) if covered else wanted


def key_coverage(history: DataFrame, key: str, covered: Sequence[DataFrame]) -> DataFrame:
    """How many of the history's keys are covered, as one row."""
    seen = history.selectExpr(key, "true AS wanted").unionAll(
        _stacked_keys(covered, key).selectExpr(key, "false AS wanted")
    )
    per_key = seen.where(f"{key} IS NOT NULL").groupBy(key).agg(
        F.expr("bool_or(wanted) AS wanted"), F.expr("bool_or(NOT wanted) AS covered")
    )
    total, hit = "count_if(wanted)", "count_if(wanted AND covered)"
    return per_key.agg(
        F.expr(f"{total} AS total_keys"),
        F.expr(f"{hit} AS covered_keys"),
        F.expr(f"{total} - {hit} AS missing_keys"),
        F.expr(f"{percent(hit, total)} AS coverage_pct"),
    )


# --- generated attributes ------------------------------------------------------------------------


def generate_attributes(keys: DataFrame, key: str = "track_id", source: str = "synthetic") -> DataFrame:
    """Repeatable attributes for each key, computed from the key alone."""
    hashed = keys.selectExpr(
        key, *[f"{digest(key, n)} AS _h_{n}" for n in [*ATTRIBUTE_RANGES, *ATTRIBUTE_CHOICES]]
    )
    drawn = hashed.selectExpr(
        key,
        *[f"{unit(f'_h_{n}', i)} AS _u{i}_{n}" for n in ATTRIBUTE_RANGES for i in range(3)],
        *[f"{pick(f'_h_{n}', options)} AS `{n}`" for n, options in ATTRIBUTE_CHOICES.items()],
    )
    measures = {n: scale(beta22(*[f"_u{i}_{n}" for i in range(3)]), *limits) for n, limits in ATTRIBUTE_RANGES.items()}
    return drawn.selectExpr(
        key,
        *[f"CAST({value} AS FLOAT) AS {n}" for n, value in measures.items()],
        *[f"`{n}`" for n in ATTRIBUTE_CHOICES],
        f"{literal(source)} AS source",
    )


def deterministic_time(df: DataFrame, key: str) -> DataFrame:
    """Hour, day of week and weekend flag drawn from the key's digest, for rows that have no time of their own."""
    hashed = df.selectExpr("*", f"{digest(key, 'time')} AS _h")
    timed = hashed.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"{pick('_h', range(24), 0)} AS hour_of_day",
        f"{pick('_h', range(1, 8), 1)} AS day_of_week",
    )
    return timed.withColumn("is_weekend", F.expr(f"CAST({is_weekend('day_of_week')} AS INT)"))


def training_rows(catalog: DataFrame, key: str) -> DataFrame:
    """Catalog rows fit for training: cleaned and with time columns."""
    return deterministic_time(range_clean(catalog), key)


# --- multi-source join ---------------------------------------------------------------------------


def merge_sources(
    sources: Mapping[str, DataFrame],
    key: str,
    attributes: Mapping[str, str],
    probe: str,
    latest_by: str | None = None,
    label: str = "feature_source",
    unknown: str = "unknown",
) -> DataFrame:
    """One row per key with each attribute from the first source, in mapping order, that has it.

    ``label`` names the first source whose ``probe`` attribute is present. All sources are stacked and
    folded in one aggregate: one shuffle whatever their number, and never more than one row per key, so
    the join to the events cannot multiply rows. Of several rows of one source for a key the greatest
    by ``latest_by`` (then by the attributes) is taken whole.
    """
    stacked = []
    ordered = latest_by is not None and any(latest_by in f.columns for f in sources.values())
    for rank, frame in enumerate(sources.values()):
        have = set(frame.columns)
        values = [f"CAST({f'`{a}`' if a in have else 'NULL'} AS {kind}) AS `{a}`" for a, kind in attributes.items()]
        order = [f"{latest_by if latest_by in have else 'NULL'} AS _order"] if ordered else []
        stacked.append(frame.selectExpr(key, f"{rank} AS _rank", *order, *values))
    rows = reduce(DataFrame.unionByName, stacked).where(f"{key} IS NOT NULL")

    # the order comes first, so the greatest struct is the row to take
    row = f"struct({', '.join([*(['_order'] if ordered else []), *[f'`{a}`' for a in attributes]])})"
    places = range(len(sources))
    best = [F.expr(f"max({row}) FILTER (WHERE _rank = {i}) AS _s{i}") for i in places]
    # Grouping by struct(key) hides the partitioning from the planner on purpose: the join to the events
    # then shuffles this side itself, and only a join of two plain shuffles can have a hot key split by AQE.
    folded = rows.groupBy(F.expr(f"struct({key}) AS _key")).agg(*best)

    merged = [f"coalesce({', '.join(f'_s{i}.`{a}`' for i in places)}) AS `{a}`" for a in attributes]
    origin = " ".join(f"WHEN _s{i}.`{probe}` IS NOT NULL THEN {literal(n)}" for i, n in enumerate(sources))
    return folded.selectExpr(f"_key.{key} AS {key}", *merged, f"CASE {origin} ELSE {literal(unknown)} END AS {label}")


def attach_attributes(
    events: DataFrame,
    sources: Mapping[str, DataFrame | None],
    key: str = "track_id",
    attributes: Mapping[str, str] = ATTRIBUTE_TYPES,
    probe: str = "danceability",
    latest_by: str | None = None,
    label: str = "feature_source",
    unknown: str = "unknown",
) -> DataFrame:
    """Every event once, with merged attributes and their provenance. Absent sources leave typed NULLs.

    An attribute that the events have themselves comes from the event first, then from the sources; ``label`` still tells
    the source of ``probe``. The result has one column of each name.
    """
    present = {name: frame for name, frame in sources.items() if frame is not None}
    if not present:
        blanks = {a: f"CAST(NULL AS {kind})" for a, kind in attributes.items()} | {label: literal(unknown)}
        return events.selectExpr("*", *[f"{v} AS `{a}`" for a, v in blanks.items() if a not in events.columns])
    merged = merge_sources(present, key, attributes, probe, latest_by, label, unknown)
    own = [c for c in [*attributes, label] if c in events.columns]
    joined = events.join(merged.withColumnsRenamed({c: f"_merged_{c}" for c in own}), key, "left")
    for c in own:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.col(f"_merged_{c}"))).drop(f"_merged_{c}")
    return joined.withColumn(label, F.expr(f"coalesce({label}, {literal(unknown)})"))


def attach_stored(
    events: DataFrame, merged: DataFrame, key: str = "track_id", label: str = "feature_source", unknown: str = "unknown"
) -> DataFrame:
    """Every event once, with attributes that ``merge_sources`` made earlier and that are stored, one row per key.

    The join names the plain key, so tables that are bucketed by it (``sinks.write_bucketed``) join without a shuffle.
    A hot key stays in its bucket then: where one holds a large part of the events, use ``attach_attributes``.
    """
    clash = sorted({c for c in merged.columns if c != key} & set(events.columns))
    if clash:
        raise ValueError(f"events already have {clash}")
    joined = events.join(merged, key, "left")
    return joined.withColumn(label, F.expr(f"coalesce({label}, {literal(unknown)})"))


def coverage_stats(df: DataFrame, source: str = "feature_source", target: str = "valence") -> DataFrame:
    """Per source: rows, share of all rows, rows with the target present and their share of all rows.

    The total is a scalar subquery over the per-source counts, which reuses their shuffle.
    """
    per_source = df.groupBy(source).agg(
        F.count("*").alias("record_count"), F.count(target).alias("target_count")
    )
    total = per_source.agg(F.sum("record_count")).scalar()
    return per_source.withColumn("_total", total).selectExpr(
        source,
        "record_count",
        f"{percent('record_count', '_total')} AS percentage",
        "target_count",
        f"{percent('target_count', '_total')} AS target_percentage",
    )
