"""Points in intervals by shared blocks, against comparing every pair."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carrymark.operators.intervals import (
    INT_SIZES, blocks_of_interval, blocks_of_point, smallest_in_force)
from conftest import day

NUMBERS = st.one_of(st.integers(-(1 << 31), (1 << 31) - 1), st.integers(-70, 70))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(NUMBERS, NUMBERS, NUMBERS), min_size=200, max_size=300))
def test_a_point_shares_one_block_with_intervals_that_hold_it(spark, triples):
    rows = spark.createDataFrame(triples, "first long, last long, point long").select(
        "*", blocks_of_interval(F.col("first"), F.col("last"), INT_SIZES).alias("held"),
        blocks_of_point(F.col("point"), INT_SIZES).alias("mine")).collect()
    for r in rows:
        assert len(set(r.held)) == len(r.held) <= 14 * INT_SIZES
        assert len(set(r.held) & set(r.mine)) == (r.first <= r.point <= r.last)
        covered = sum(8 ** b.size for b in r.held)
        assert covered == max(0, r.last - r.first + 1)


def in_force(points, intervals):
    out = {}
    for key, at in points:
        names = [name for k, name, a, b in intervals
                 if k == key and (a is None or a <= at) and (b is None or b >= at)] if at else []
        if names:
            out[key, at] = min(names)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_smallest_name_in_force_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    days = [None, dt.date(1, 1, 1), dt.date(9999, 12, 31),
            *(dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(400)) for _ in range(40))]
    intervals = [(f"C{rng.randrange(4)}", rng.choice("ABCDEFG"), rng.choice(days),
                  rng.choice(days)) for _ in range(120)]
    points = [(f"C{rng.randrange(5)}", rng.choice(days)) for _ in range(150)] * 2
    found = smallest_in_force(
        spark.createDataFrame(points, "key string, at date"),
        spark.createDataFrame(intervals, "key string, name string, valid_from date, valid_to date"),
        ["key"], "at", "name").collect()
    assert len(found) == len({(r.key, r["at"]) for r in found})
    assert {(r.key, r["at"]): r.name for r in found} == in_force(points, intervals)


def test_no_pairing_of_periods_with_intervals(spark):
    """One key with 3,000 intervals and 3,000 days joins a few rows for each, not 9,000,000."""
    first = day("2000-01-01")
    spans = spark.range(3000).select(
        F.lit("hot").alias("key"), F.concat(F.lit("n"), "id").alias("name"),
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"))
    points = spark.range(3000).select(
        F.lit("hot").alias("key"), F.date_add(F.lit(first), F.col("id").cast("int")).alias("at"))
    found = smallest_in_force(points, spans, ["key"], "at", "name")
    assert found.count() == 3000
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("size" in j and "block" in j for j in joins)
