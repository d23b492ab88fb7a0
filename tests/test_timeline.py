"""The timeline operators against brute force on random data."""

import datetime as dt
import random

from pyspark.sql import functions as F

from carrymark.operators.timeline import presence_changes, totals_to_date

START = dt.date(2020, 1, 1)


def _day(n):
    return None if n is None else START + dt.timedelta(days=n)


def test_totals_to_date_equals_brute_force(spark):
    rng = random.Random(7)
    # Key "a" owns most of the events.
    keys = ["a"] * 8 + ["b", "c"]
    events = {(rng.choice(keys), rng.randrange(60)): rng.choice([None, 1, 2, -3]) for _ in range(200)}
    markers = {(rng.choice("abcd"), rng.choice([None, *range(0, 70, 3)])) for _ in range(60)}
    got = totals_to_date(
        spark.createDataFrame([(k, _day(d), v) for (k, d), v in events.items()],
                              "k string, day date, v long"),
        spark.createDataFrame([(k, _day(d), f"{k}{d}") for k, d in markers],
                              "k string, day date, tag string"),
        "k", "day", ["v"])
    assert set(got.columns) == {"k", "day", "tag", "v"}
    for row in got.collect():
        seen = [v for (k, d), v in events.items()
                if k == row.k and row.day is not None and _day(d) <= row.day and v is not None]
        assert row.v == (sum(seen) if seen else None)
    assert got.count() == len(markers)


def test_presence_changes_equal_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(300):
        start = rng.choice([None, *range(50)])
        end = rng.choice([None, None, *range(60)])
        rows.append((rng.choice("gggh"), rng.choice([None, *"uvwxyz"]), start, end))
    df = spark.createDataFrame(
        [(g, m, _day(s), _day(e)) for g, m, s, e in rows],
        "g string, m string, since date, until date")
    changes = presence_changes(df, "g", "m", "since", "until", "day", "n").collect()
    for group in "gh":
        for n in range(70):
            present = {m for g, m, s, e in rows
                       if g == group and m is not None and s is not None and s <= n
                       and (e is None or e > n)}
            running = sum(c.n for c in changes if c.g == group and c.day <= _day(n))
            assert running == len(present), (group, n)


def test_presence_has_one_row_per_group_and_day(spark):
    df = spark.range(1000).select(
        F.lit("g").alias("g"), (F.col("id") % 7).cast("string").alias("m"),
        F.date_add(F.lit(START), (F.col("id") % 5).cast("int")).alias("since"),
        F.lit(None).cast("date").alias("until"))
    changes = presence_changes(df, "g", "m", "since", "until", "day", "n")
    assert changes.count() == changes.select("g", "day").distinct().count()
    assert changes.agg(F.sum("n")).first()[0] == 7
