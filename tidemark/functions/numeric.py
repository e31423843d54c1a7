"""Literals, rounding, scaling and deviation."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

# A mean of doubles depends in its last bits on the order in which partitions are merged. Without the
# nudge a value that is exactly half-way (0.4525 at 3 digits) would round up on one run and down on
# the next; the nudge is far above that noise and far below any digit that is kept.
NUDGE = "1E-9D"


def literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def stable_round(value: str, digits: int) -> str:
    """Half-up rounding whose result does not depend on summation order."""
    return f"round({value} + signum({value}) * {NUDGE}, {digits})"


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.selectExpr(
        *[f"{stable_round(f'`{c}`', digits[c])} AS `{c}`" if c in digits else f"`{c}`" for c in df.columns]
    )


def ratio(part: str, whole: str) -> str:
    """Quotient as a double; 0 where the denominator is 0 or unknown."""
    return f"coalesce(try_divide({double(part)}, {double(whole)}), 0D)"


def percent(part: str, whole: str, digits: int = 2) -> str:
    """Share in percent; 0 when there is nothing to share."""
    return stable_round(ratio(f"(({part}) * 100D)", whole), digits)


def min_max_scale(value: str, low: float, high: float) -> str:
    return f"(({value} - {float(low)}D) / {float(high - low)}D)"


def abs_zscore(value: str, mean: str, spread: str) -> str:
    """Distance from the mean in standard deviations; NULL where the spread is 0 or unknown."""
    return f"try_divide(abs({value} - {mean}), {spread})"
