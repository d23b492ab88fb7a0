"""Choosing one reported row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class SnapshotPolicy:
    """Preference among several snapshots of the same entity and period.

    Earlier entries win; values that are not listed come last. Remaining ties go
    to the smallest snapshot id. Without a policy every row counts.
    """

    bases: Sequence[str] = ()
    sources: Sequence[str] = ()

    def choose(self, df: DataFrame, entity: str, row_id: str) -> DataFrame:
        ranked = Window.partitionBy(entity, "period_end_date").orderBy(
            preference("reporting_basis", self.bases),
            preference("snapshot_source", self.sources), F.col(row_id))
        return (df.withColumn("_choice", F.row_number().over(ranked))
                .where("_choice = 1").drop("_choice"))


def preference(column: str, order: Sequence[str]) -> Column:
    choice = F.lit(len(order))
    for position, value in reversed(list(enumerate(order))):
        choice = F.when(F.col(column) == value, F.lit(position)).otherwise(choice)
    return choice


def recency(day: str, row_id: str) -> Column:
    """Sort key of the latest row: a missing day ranks highest, ties go to the largest id."""
    return F.struct(F.col(day).isNull().alias("open"), F.col(day).alias("day"),
                    F.col(row_id).alias("id"))
