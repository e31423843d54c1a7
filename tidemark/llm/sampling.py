"""Bounded samples for fitting: the rows with the smallest hashes, whatever the number of tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def below(share: float) -> int:
    """A signed 64-bit hash is at most this number in about ``share`` of all cases."""
    return min(int(share * (1 << 64)), (1 << 64) - 1) - (1 << 63)


def least_hashes(df: DataFrame, hash_of: Column, limit: int, rows: int, usable: Column | None = None) -> DataFrame:
    """Of the rows whose hash lies in the lowest ``limit / rows`` of its range, the usable ones with different hashes.

    ``rows`` is how many rows ``df`` has, so there are about ``limit`` at most. The bound is applied where rows are read and
    copies (equal hashes) are merged before the shuffle: what tasks send is bounded in sum, however many
    there are. ``usable`` is only looked at for rows below the bound. The result has the column ``h`` besides.
    """
    drawn = df.withColumn("h", hash_of).where(F.col("h") <= below(limit / max(rows, 1)))
    if usable is not None:
        drawn = drawn.where(usable)
    others = [c for c in df.columns if c != "h"]
    return drawn.groupBy("h").agg(*[F.first(c).alias(c) for c in others])
