"""Values as of a date, without pairing every date with every earlier event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_IS_MARKER = "_is_marker"


def totals_to_date(events: DataFrame, markers: DataFrame, key: str, day: str,
                   measures: Sequence[str], within: dict[str, Column] | None = None) -> DataFrame:
    """Sum of each measure over all events dated up to and including each marker.

    ``events`` must already be reduced to one row per (key, day), which bounds
    a key's timeline by the calendar, however many facts it owns. ``markers``
    has one row per (key, day) plus any columns to carry along. A marker
    without a date sees no events. A sum is null until the first non-null value.

    ``within`` names further totals, each limited to the marker's own value of
    a calendar expression: ``{measure: expression of day}``.
    """
    timeline = (
        events.where(F.col(day).isNotNull()).withColumn(_IS_MARKER, F.lit(0))
        .unionByName(markers.withColumn(_IS_MARKER, F.lit(1)), allowMissingColumns=True)
    )
    past = (Window.partitionBy(key)
            .orderBy(F.col(day).asc_nulls_first(), F.col(_IS_MARKER))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = {m: F.sum(m).over(past) for m in measures}
    for measure, bucket in (within or {}).items():
        totals[measure] = F.sum(measure).over(Window.partitionBy(F.col(key), bucket))
    carried = [c for c in markers.columns if c not in (key, day)]
    return (
        timeline.select(key, day, _IS_MARKER, *carried, *[t.alias(m) for m, t in totals.items()])
        .where(F.col(_IS_MARKER) == 1).drop(_IS_MARKER)
    )


def presence_changes(intervals: DataFrame, group: str, member: str, start: str, end: str,
                     day: str, change: str) -> DataFrame:
    """Daily change in the number of distinct members present in each group.

    ``intervals`` are half-open ``[start, end)``; a null end never closes, and an
    interval without a start never opens. Overlapping intervals of a member are
    merged first, so summing the changes up to a date counts each member once.
    """
    forever = F.lit("9999-12-31").cast("date")
    spans = (
        intervals
        .where(F.col(member).isNotNull() & F.col(start).isNotNull()
               & (F.col(end).isNull() | (F.col(end) > F.col(start))))
        # One row per start date: a member's history is bounded by the calendar.
        .groupBy(group, member, start)
        .agg(F.max(F.coalesce(F.col(end), forever)).alias("_end"))
    )
    history = Window.partitionBy(group, member).orderBy(start)
    reach = F.max("_end").over(history.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.max("_end").over(history.rowsBetween(Window.unboundedPreceding, -1))
    following = F.lead(start).over(history)
    opens = before.isNull() | (F.col(start) > before)
    closes = (reach < forever) & (following.isNull() | (following > reach))
    marked = spans.select(
        group, start, opens.alias("_opens"), reach.alias("_reach"), closes.alias("_closes"))
    steps = F.array(
        F.when(F.col("_opens"), F.struct(F.col(start).alias(day), F.lit(1).alias(change))),
        F.when(F.col("_closes"), F.struct(F.col("_reach").alias(day), F.lit(-1).alias(change))),
    )
    return (
        marked.select(group, F.explode(F.array_compact(steps)).alias("_step"))
        .groupBy(F.col(group), F.col(f"_step.{day}").alias(day))
        .agg(F.sum(f"_step.{change}").alias(change))
    )
