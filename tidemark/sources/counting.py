"""Counts of what each step reads and keeps, taken while the rows pass: no second scan."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StepCounts:
    """Observed metrics of several steps.

    ``watch`` and ``filtered`` only mark a frame; the counts are those of the first action that reads it to the
    end. Call ``table`` after those actions: it waits for a frame that nothing has read yet.
    """

    def __init__(self):
        self._watched: list[tuple[str, tuple[str, ...], Observation]] = []

    def watch(self, df: DataFrame, step: str, **counts: str) -> DataFrame:
        """``df``, with a count under each name; ``counts`` are aggregate expressions."""
        seen = Observation(f"{step}-{uuid.uuid4().hex}")
        self._watched.append((step, tuple(counts), seen))
        return df.observe(seen, *[F.expr(text).cast("bigint").alias(name) for name, text in counts.items()])

    def filtered(self, df: DataFrame, step: str, condition: str) -> DataFrame:
        """The rows for which ``condition`` is true; a step that reads, keeps and rejects rows."""
        kept = f"count_if({condition})"
        return self.watch(df, step, read="count(*)", kept=kept, rejected=f"count(*) - {kept}").where(condition)

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, metric, value) of every step."""
        rows = [(step, name, seen.get[name]) for step, names, seen in self._watched for name in names]
        return spark.createDataFrame(rows, "step string, metric string, value bigint")
