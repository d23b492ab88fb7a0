"""Instrument snapshots: conversion, latest position, period totals.

The equity and credit subtype facts are one-to-one with the common snapshot
fact, so marts that are built straight from the inputs read the curated snapshots
once and pick the subtype columns by condition instead of joining the largest fact
to itself. This relies on unique snapshot ids, which the quality checks verify.

A catalog that was given one of the three facts, stored or replaced, joins them by
snapshot id. Stored with the same number of buckets they need no shuffle for it.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from carrymark.functions.money import fx_convert, sum_when
from carrymark.operators.reporting import recency

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

CURATED = "int_instrument_snapshots_curated"
SNAPSHOT_FACTS = FACT, CREDIT_FACT, EQUITY_FACT = (
    "fct_instrument_snapshots", "fct_instrument_snapshots_credit",
    "fct_instrument_snapshots_equity")
_COMMON = ("instrument_snapshot_id", "instrument_id", "period_end_date", "reporting_basis",
           "snapshot_source", "fx_rate", "fair_value")
_CREDIT = ("principal_outstanding", "undrawn_commitment", "accrued_interest")
_EQUITY = ("equity_stake_pct",)


def _from_facts(catalog: Catalog) -> DataFrame:
    key = "instrument_snapshot_id"
    common = catalog.table(FACT).select(*_COMMON, "fair_value_converted")
    credit = catalog.table(CREDIT_FACT).select(
        key, *_CREDIT, *[f"{m}_converted" for m in _CREDIT])
    equity = catalog.table(EQUITY_FACT).select(key, *_EQUITY)
    return common.join(credit, key, "left").join(equity, key, "left")


def reported_snapshots(catalog: Catalog) -> DataFrame:
    """The snapshots that count, with native and converted measures of either subtype."""
    if catalog.given.isdisjoint(SNAPSHOT_FACTS):
        rows = catalog.table(CURATED).select(*_COMMON, *_CREDIT, *_EQUITY, *[
            fx_convert(m).alias(f"{m}_converted") for m in ("fair_value", *_CREDIT)])
    else:
        rows = _from_facts(catalog)
    return catalog.preferred(rows, "instrument_id", "instrument_snapshot_id")


def latest_positions(catalog: Catalog) -> DataFrame:
    """One row per instrument: latest snapshot, latest credit row, latest stake.

    The latest credit row is the newest snapshot with a principal and may be
    older than the latest snapshot; likewise for the stake. One aggregation with
    map-side partials replaces three ranked scans. Where no row qualifies, the
    fields of ``credit`` are null.
    """
    newest = recency("period_end_date", "instrument_snapshot_id").alias("recency")

    def row(*columns: str) -> Column:
        return F.struct(newest, *columns)

    reports_credit = F.col("principal_outstanding").isNotNull()
    reports_stake = F.col("equity_stake_pct").isNotNull()
    valued = ("period_end_date", "fair_value", "fx_rate", "fair_value_converted")
    lent = ("period_end_date", *[f"{m}_converted" for m in _CREDIT])
    return reported_snapshots(catalog).groupBy("instrument_id").agg(
        F.max(row(*valued)).alias("_latest"),
        F.max(F.when(reports_credit, row(*lent))).alias("_credit"),
        F.max(F.when(reports_stake, row("equity_stake_pct"))).alias("_stake"),
    ).select(
        "instrument_id",
        F.struct(*[f"_latest.{c}" for c in valued]).alias("latest"),
        F.struct(*[f"_credit.{c}" for c in lent]).alias("credit"),
        F.col("_stake.equity_stake_pct").alias("stake"))


def period_positions(catalog: Catalog) -> DataFrame:
    """Totals per instrument and period, with the owning fund and type.

    Reducing before the join keeps an instrument with very many snapshot rows
    from becoming one hot join partition, and makes later distinct counts of
    instruments plain counts of rows.
    """
    value, principal = F.col("fair_value_converted"), F.col("principal_outstanding_converted")
    reported = F.col("principal_outstanding").isNotNull()
    totals = reported_snapshots(catalog).groupBy("instrument_id", "period_end_date").agg(
        F.sum(value).alias("fair_value"),
        F.max(value > 0).alias("has_value"),
        F.sum(principal).alias("principal"),
        sum_when(reported, F.col("undrawn_commitment_converted")).alias("undrawn"),
        F.max(principal > 0).alias("has_principal"),
        F.max(reported).alias("has_credit"))
    owners = catalog.table("dim_instruments").select("instrument_id", "fund_id", "instrument_type")
    return totals.join(owners, "instrument_id")
