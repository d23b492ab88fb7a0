"""Running data contracts as Spark jobs.

All row predicates of a table share one scan, and all its key and reference checks
another: their values are reduced to one row for each check and value before anything
is compared, so a value that fills a third of a table costs one row.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window, functions as F

from carrymark.functions.dates import clock
from carrymark.operators.validity import valid_at
from carrymark.quality.rules import (
    OverlapRule, ReferenceRule, RowCountRule, RowRule, Rule, SinglePrimaryRule, UniqueRule,
    rules_for)

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

_COUNT = "failures"


def _label(rule: Rule) -> list[Column]:
    return [F.lit(rule.table).alias("table_name"), F.lit(rule.check).alias("check_name"),
            F.lit(rule.column).alias("column_name"), F.lit(rule.severity).alias("severity")]


def _known(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _row_checks(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.expr(r.failing)).alias(f"_{i}") for i, r in enumerate(rules)])
    results = F.array(*[
        F.struct(*_label(r), F.col(f"_{i}").alias(_COUNT)) for i, r in enumerate(rules)])
    return counts.select(F.inline(results))


def _duplicates(df: DataFrame, rule: UniqueRule) -> DataFrame:
    return df.where(_known(rule.keys)).groupBy(*rule.keys).count().where("count > 1")


def _orphans(catalog: Catalog, df: DataFrame, rule: ReferenceRule) -> DataFrame:
    """Missing parent values with the number of rows that use them."""
    parents = catalog.table(rule.parent).select(F.col(rule.parent_column).alias("_value"))
    used = (df.where(F.col(rule.column).isNotNull())
            .groupBy(F.col(rule.column).alias("_value")).count())
    return used.join(parents, "_value", "left_anti")


def _key_checks(catalog: Catalog, df: DataFrame,
                rules: list[UniqueRule | ReferenceRule]) -> DataFrame:
    """Repeated keys and missing parents, counted in one pass over the table.

    A key is its two 64-bit hashes under different seeds, so what is shuffled and compared is
    three numbers whatever the columns are. Two keys of a rule are taken for one
    only if both hashes agree, by chance once in some 10^14 tables of a trillion keys.
    Parents are rows of the same aggregation, used by no row, instead of a join.
    """
    def keyed(rows: DataFrame, keys: list[tuple[int, tuple[str, ...]]], used: int) -> DataFrame:
        values = F.array(*[F.when(_known(columns), F.struct(
            F.lit(i).alias("_rule"), *[F.xxhash64(F.lit(seed), *[
                F.col(c).cast("string") for c in columns]).alias(f"_hash{seed}")
                for seed in (1, 2)])) for i, columns in keys])
        return rows.select(F.inline(F.array_compact(values))).withColumn("_used", F.lit(used))

    def columns(rule: UniqueRule | ReferenceRule) -> tuple[str, ...]:
        return rule.keys if isinstance(rule, UniqueRule) else (rule.column,)

    parts = [keyed(df, [(i, columns(r)) for i, r in enumerate(rules)], 1)]
    parts += [keyed(catalog.table(r.parent), [(i, (r.parent_column,))], 0)
              for i, r in enumerate(rules) if isinstance(r, ReferenceRule)]
    used = reduce(DataFrame.unionByName, parts).groupBy("_rule", "_hash1", "_hash2").agg(
        F.sum("_used").alias("_rows"), F.min("_used").alias("_orphan"))
    counts = []
    for i, rule in enumerate(rules):
        mine = F.col("_rule") == i
        total = (F.count_if(mine & (F.col("_rows") > 1)) if isinstance(rule, UniqueRule)
                 else F.sum(F.when(mine & (F.col("_orphan") == 1), F.col("_rows"))))
        counts.append(F.coalesce(total, F.lit(0)).cast("long").alias(f"_{i}"))
    results = F.array(*[F.struct(*_label(r), F.col(f"_{i}").alias(_COUNT))
                        for i, r in enumerate(rules)])
    return used.agg(*counts).select(F.inline(results))


def _overlaps(df: DataFrame, rule: OverlapRule) -> DataFrame:
    """Start dates per key with the number of intervals that begin inside another.

    A missing start reaches back without limit, a missing end forward.
    """
    day = "date"
    start = F.coalesce("valid_from", F.lit("0001-01-01").cast(day)).alias("valid_from")
    reach = F.max(F.coalesce("valid_to", F.lit("9999-12-31").cast(day))).alias("_reach")
    starts = df.groupBy(*rule.keys, start).agg(F.count(F.lit(1)).alias("_rows"), reach)
    earlier = (Window.partitionBy(*rule.keys).orderBy("valid_from")
               .rowsBetween(Window.unboundedPreceding, -1))
    covered = F.coalesce(F.max("_reach").over(earlier) >= F.col("valid_from"), F.lit(False))
    return starts.select(
        *rule.keys, "valid_from", (F.col("_rows") - 1 + covered.cast("int")).alias("count"),
    ).where("count > 0")


def _contested(catalog: Catalog, df: DataFrame, rule: SinglePrimaryRule) -> DataFrame:
    in_force = valid_at(clock(catalog.as_of), F.col("valid_from"), F.col("valid_to"))
    return (df.where(F.col("primary_flag") & in_force)
            .groupBy(rule.key).count().where("count > 1"))


def failing_rows(catalog: Catalog, rule: Rule, df: DataFrame | None = None) -> DataFrame:
    """The rows, or for key checks the keys, that break a rule."""
    df = catalog.table(rule.table) if df is None else df
    match rule:
        case RowRule():
            return df.where(F.expr(rule.failing))
        case UniqueRule():
            return _duplicates(df, rule)
        case ReferenceRule():
            return _orphans(catalog, df, rule)
        case OverlapRule():
            return _overlaps(df, rule)
        case SinglePrimaryRule():
            return _contested(catalog, df, rule)
    raise TypeError(f"{type(rule).__name__} has no rows of its own")


def _failure_count(catalog: Catalog, df: DataFrame, rule: Rule) -> DataFrame:
    if isinstance(rule, RowCountRule):
        expected = (catalog.table("dim_instruments")
                    .agg(F.count_if(F.expr(rule.other))).scalar())
        total = F.abs(F.count(F.lit(1)) - expected)
        return df.agg(total.alias(_COUNT)).select(*_label(rule), _COUNT)
    rows = failing_rows(catalog, rule, df)
    weighted = isinstance(rule, (ReferenceRule, OverlapRule))
    total = F.coalesce(F.sum("count"), F.lit(0)) if weighted else F.count(F.lit(1))
    return rows.agg(total.cast("long").alias(_COUNT)).select(*_label(rule), _COUNT)


def table_report(catalog: Catalog, table: str, rules: list[Rule] | None = None) -> DataFrame:
    """One row per rule of the table: (table, check, column, severity, failures)."""
    rules = rules_for(table) if rules is None else rules
    df = catalog.table(table)
    by_row = [r for r in rules if isinstance(r, RowRule)]
    by_key = [r for r in rules if isinstance(r, (UniqueRule, ReferenceRule))]
    others = [r for r in rules if not isinstance(r, (RowRule, UniqueRule, ReferenceRule))]
    parts = [_row_checks(df, by_row)] if by_row else []
    parts += [_key_checks(catalog, df, by_key)] if by_key else []
    parts += [_failure_count(catalog, df, rule) for rule in others]
    return reduce(DataFrame.unionByName, parts)


def report(catalog: Catalog, tables: Iterable[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_report(catalog, t) for t in tables])


def breaches(results: DataFrame) -> DataFrame:
    return results.where(F.col(_COUNT) > 0)
