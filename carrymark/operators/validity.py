"""Predicates on validity intervals, both ends inclusive."""

from __future__ import annotations

from pyspark.sql import Column


def valid_at(day: Column, valid_from: Column, valid_to: Column) -> Column:
    """An open bound does not restrict; a missing day matches only open bounds."""
    return ((valid_from.isNull() | (day >= valid_from))
            & (valid_to.isNull() | (day <= valid_to)))
