"""Behaviour segments: one profile for everyone, or one per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.buckets import Quadrants, first_match, lookup, quadrant
from ..functions.numeric import double, stable_round


def behavior_segment(
    df: DataFrame,
    by: Sequence[str] = (),
    labels: Quadrants = words.ARCHETYPE,
    variable_above: float = 0.3,
    low_below: float = 0.4,
) -> DataFrame:
    """Overall means and variability, the archetype they place the listener in, and advice."""
    means = ("valence", "energy", "danceability", "acousticness")
    spreads = {"valence": "mood_variability", "energy": "energy_variability"}
    statistics = [f"avg({double(m)}) AS overall_{m}" for m in means]
    statistics += [f"stddev_samp({double(m)}) AS {name}" for m, name in spreads.items()]
    profile = df.groupBy(*by).agg(*[F.expr(s) for s in [*statistics, "count(*) AS total_listens"]])
    advice = first_match(
        [
            (f"mood_variability > {variable_above}", words.WELLBEING_VARIABLE),
            (f"overall_valence < {low_below}", words.WELLBEING_LOW),
        ],
        words.WELLBEING_DEFAULT,
    )
    archetype = quadrant("overall_valence", "overall_energy", labels)
    rounded = [f"overall_{m}" for m in means] + list(spreads.values())
    description = lookup("listening_archetype", words.ARCHETYPE_TEXT, words.ARCHETYPE_TEXT_DEFAULT)
    return profile.selectExpr("*", f"{archetype} AS listening_archetype").selectExpr(
        *by,
        *[f"{stable_round(c, 3)} AS {c}" for c in rounded],
        "total_listens",
        "listening_archetype",
        f"{description} AS archetype_description",
        f"{advice} AS wellbeing_recommendation",
    )
