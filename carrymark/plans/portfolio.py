"""Portfolio overview: one row per reporting period across all funds."""

from __future__ import annotations

from typing import TYPE_CHECKING, Literal

from pyspark.sql import Column, DataFrame, functions as F

from carrymark.functions.dates import clock, quarter_end, quarter_start
from carrymark.functions.money import RATIO, ratio

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

FlowBucket = Literal["start", "end"]


def quarterly_net_flows(catalog: Catalog, flow_bucket: FlowBucket = "start") -> DataFrame:
    """Outflows minus inflows per calendar quarter."""
    bucket = {"start": quarter_start, "end": quarter_end}[flow_bucket]
    return (catalog.table("metrics_returns_cashflows")
            .groupBy(bucket(F.col("cashflow_date")).alias("period_end_date"))
            .agg(F.sum(-F.col("signed_amount")).alias("net_cash_contributions_period")))


def portfolio_overview(catalog: Catalog, flow_bucket: FlowBucket = "start") -> DataFrame:
    """Totals, commitment-weighted multiples and quarterly net flows.

    ``flow_bucket="start"`` keys the flows by the first day of the quarter, which
    a quarter-end period never meets, so the column is 0 there. ``"end"`` keys
    them by the last day, as the column is described. Funds without a multiple
    stay in the weights' denominator.
    """
    weight = F.col("total_commitments")

    def weighted(multiple: str) -> Column:
        return ratio(F.sum(F.col(multiple) * weight.cast(RATIO)), F.sum(weight))

    by_period = catalog.table("metrics_fund_performance").groupBy("period_end_date").agg(
        F.sum("fund_nav").alias("total_nav"),
        F.sum(weight).alias("total_commitments"),
        F.sum("total_called_capital").alias("total_called_capital"),
        F.sum("unfunded_commitment").alias("total_unfunded_commitment"),
        F.sum("total_distributions").alias("total_distributions"),
        *[weighted(m).alias(f"{m}_portfolio") for m in ("dpi", "rvpi", "tvpi")],
        F.count_distinct("fund_id").alias("number_of_funds"),
        F.sum("number_of_portfolio_companies").alias("number_of_companies"),
        F.sum("number_of_positions").alias("number_of_positions"))
    flows = quarterly_net_flows(catalog, flow_bucket)
    return by_period.join(flows, "period_end_date", "left").withColumns({
        "net_cash_contributions_period": F.coalesce("net_cash_contributions_period", F.lit(0)),
        "as_of_date": clock(catalog.as_of),
    })
