"""Points in intervals by equality joins.

The integers are cut into blocks of 1, 8, 64, ... numbers. An interval is a disjoint
union of few such blocks, at most fourteen of each size, and a point lies in exactly one
block of each size. A point is therefore in an interval just when they share a block,
and each such pair shares exactly one. What used to be a range join, each point of a key
against all its intervals, becomes an equality join on (key, size, block): its work is
linear in points plus intervals, and a key with very many of either is spread over
its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_BITS = 3
#: Block sizes needed for all days of the years 1 to 9999, and for 32-bit integers.
DAY_SIZES, INT_SIZES = 8, 11
_FIRST_DAY, _LAST_DAY = -(1 << 20), 1 << 22
_BLOCK = "array<struct<size:int,block:bigint>>"


def _block(size: int, number: Column) -> Column:
    return F.struct(F.lit(size).alias("size"), number.cast("long").alias("block"))


def _range(size: int, first: Column, end: Column) -> Column:
    """Blocks first to end - 1 of one size; none if there are none."""
    numbers = F.when(first < end, F.sequence(first, end - 1))
    blocks = F.transform(numbers, lambda n: _block(size, n))
    return F.coalesce(blocks, F.array().cast(_BLOCK))


def blocks_of_point(point: Column, sizes: int) -> Column:
    """The block of each size that a point lies in."""
    point = point.cast("long")
    return F.array(*[_block(i, F.shiftright(point, _BITS * i)) for i in range(sizes)])


def blocks_of_interval(first: Column, last: Column, sizes: int) -> Column:
    """Disjoint blocks that make up the integers from ``first`` to ``last``; none if empty."""
    first, end = first.cast("long"), last.cast("long") + 1
    parts = []
    for i in range(sizes):
        here = (-F.shiftright(-first, _BITS * i), F.shiftright(end, _BITS * i))
        if i == sizes - 1:
            parts.append(_range(i, *here))
            continue
        over = (-F.shiftright(-first, _BITS * (i + 1)), F.shiftright(end, _BITS * (i + 1)))
        whole = over[0] < over[1]       # the next size takes the middle
        left = F.when(whole, over[0] * (1 << _BITS)).otherwise(here[1])
        right = F.when(whole, over[1] * (1 << _BITS)).otherwise(here[1])
        parts += [_range(i, here[0], left), _range(i, right, here[1])]
    return F.concat(*parts)


def smallest_in_force(points: DataFrame, intervals: DataFrame, keys: Sequence[str], day: str,
                      value: str, valid_from: str = "valid_from",
                      valid_to: str = "valid_to") -> DataFrame:
    """Per key and day of ``points``, the smallest value whose interval holds the day.

    Both ends are inclusive, an open one does not restrict. A point without a day, or
    without an interval in force, has no row. Intervals are reduced to the smallest value
    of each block before they meet the points, so a key's hot interval costs few rows.
    """
    def number(date: str, unbounded: int) -> Column:
        return F.coalesce(F.unix_date(date), F.lit(unbounded))

    held = blocks_of_interval(number(valid_from, _FIRST_DAY), number(valid_to, _LAST_DAY),
                              DAY_SIZES)
    least = (intervals.select(*keys, F.col(value), F.inline(held))
             .groupBy(*keys, "size", "block").agg(F.min(value).alias(value)))
    asked = points.where(F.col(day).isNotNull()).select(
        *keys, day, F.inline(blocks_of_point(F.unix_date(day), DAY_SIZES)))
    return (asked.join(least, [*keys, "size", "block"]).groupBy(*keys, day)
            .agg(F.min(value).alias(value)))
