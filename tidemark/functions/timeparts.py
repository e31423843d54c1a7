"""Calendar expressions. Days of the week run from 1 (Sunday) to 7 (Saturday) everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .buckets import band

# Hour ranges (both ends included) of the named parts of the day.
DAY_PARTS = ((6, 11, "morning"), (12, 17, "afternoon"), (18, 22, "evening"))
OTHER_PART = "night"
WEEKEND = (1, 7)

TIME_KEYS = ("hour_of_day", "day_of_week", "day_name", "part_of_day", "is_weekend")
# Largest number of distinct values (NULL included) each derived column can take.
TIME_DOMAINS = {"hour_of_day": 25, "day_of_week": 8, "day_name": 8, "part_of_day": 4, "is_weekend": 2}


def part_of_day(hour: str) -> str:
    return band(hour, DAY_PARTS, OTHER_PART)


def is_weekend(day_of_week: str) -> str:
    return f"coalesce({day_of_week} IN {WEEKEND}, false)"


def time_dimensions(df: DataFrame, ts: str = "played_at") -> DataFrame:
    """Append hour, day of week, day name, weekend flag and part of day of ``ts``."""
    hour, day = f"hour({ts})", f"dayofweek({ts})"
    return df.selectExpr(
        "*",
        f"{hour} AS hour_of_day",
        f"{day} AS day_of_week",
        f"date_format({ts}, 'EEEE') AS day_name",
        f"{is_weekend(day)} AS is_weekend",
        f"{part_of_day(hour)} AS part_of_day",
    )
