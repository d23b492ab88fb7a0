"""Everyday questions asked of the marts, with the values to ask for as parameters."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from carrymark.functions.dates import AsOf, clock, month_start
from carrymark.functions.vocab import CREDIT, EQUITY

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

NAV_TOLERANCE = 0.02
CAPITAL_TOLERANCE = 0.001


def _latest(mart: DataFrame, key: str, *columns: str) -> DataFrame:
    """``columns`` of the newest period's rows, from one pass over the mart.

    The maximum is taken over whole rows, so that both uses read the same shuffled
    rows: the mart is planned twice but its exchange, and all below it, runs once.
    """
    rows = (mart.where(F.col("period_end_date").isNotNull())
            .select(*dict.fromkeys([key, *columns])).repartition(key))
    last = F.max(F.struct("period_end_date", *[c for c in rows.columns if c != "period_end_date"]))
    newest = rows.agg(last.alias("_last")).select("_last.period_end_date")
    return rows.join(F.broadcast(newest), "period_end_date").select(*columns)     # one row


def _current(catalog: Catalog) -> Column:
    return F.col("exposure_month") == month_start(clock(catalog.as_of))


# --- exposure ----------------------------------------------------------------

def exposure_by_region(catalog: Catalog, fund_id: str, stage_id: str) -> DataFrame:
    return (catalog.table("metrics_exposure_timeseries")
            .where((F.col("fund_id") == fund_id) & (F.col("stage_id") == stage_id))
            .groupBy("exposure_month", "region")
            .agg(F.sum("total_exposure_usd").alias("total_exposure"))
            .orderBy("exposure_month"))


def exposure_by_industry(catalog: Catalog) -> DataFrame:
    return (catalog.table("metrics_exposure_timeseries")
            .where((F.col("period_type") == "Current") & _current(catalog))
            .groupBy("industry_name").agg(F.sum("deployed_capital_usd").alias("deployed_capital"))
            .orderBy(F.desc("deployed_capital")))


def exposure_drill_down(catalog: Catalog, fund_id: str) -> DataFrame:
    return (catalog.table("metrics_exposure_timeseries")
            .where((F.col("fund_id") == fund_id) & _current(catalog))
            .groupBy("region", "country_name", "industry_name")
            .agg(F.sum("total_exposure_usd").alias("exposure")))


# --- summary marts -----------------------------------------------------------

def fund_scorecard(catalog: Catalog) -> DataFrame:
    return catalog.table("metrics_fund_performance_latest").select(
        "fund_name", "vintage", "total_committed_capital", "total_called_capital", "current_nav",
        "dpi", "tvpi").orderBy(F.desc_nulls_first("tvpi"))


def deal_funnel(catalog: Catalog) -> DataFrame:
    return (catalog.table("metrics_pipeline_by_stage").orderBy("fund_name", "stage_order")
            .select("fund_name", "stage_name", "deal_count", "total_amount_usd",
                    "avg_deal_size_usd", "oldest_deal_days"))


def company_trend(catalog: Catalog, company_id: str) -> DataFrame:
    return (catalog.table("metrics_company_financials_trend")
            .where(F.col("company_id") == company_id).orderBy("period_end_date")
            .select("company_name", "period_year", "period_quarter", "revenue_usd", "ebitda_usd",
                    "ebitda_margin_pct", "revenue_growth_pct"))


def fund_activity(catalog: Catalog, fund_id: str) -> DataFrame:
    return (catalog.table("metrics_investment_activity_monthly")
            .where(F.col("fund_id") == fund_id)
            .groupBy("activity_year", "activity_month", "transaction_type")
            .agg(F.sum("total_amount_usd").alias("total_amount"))
            .orderBy("activity_month"))


def loan_maturities(catalog: Catalog) -> DataFrame:
    return catalog.table("metrics_loan_portfolio_summary").select(
        "fund_name", "maturity_year", "loan_count", "total_commitment_usd",
        "total_outstanding_usd", "weighted_avg_rate_pct", "utilization_pct",
    ).orderBy("fund_name", "maturity_year")


# --- positions and cash flows ------------------------------------------------

def top_equity_positions(catalog: Catalog, n: int = 10) -> DataFrame:
    """Highest multiples; ties go to the smaller instrument id."""
    return (catalog.table("metrics_position_performance")
            .where((F.col("instrument_type") == EQUITY) & F.col("moic").isNotNull())
            .orderBy(F.desc("moic"), "instrument_id").limit(n)
            .select("instrument_id", "fund_name", "company_name", "instrument_type", "cost_basis",
                    "fair_value", "realized_proceeds", "moic", "equity_irr_approx",
                    "holding_period_years"))


def credit_by_fund(catalog: Catalog) -> DataFrame:
    return (catalog.table("metrics_position_performance")
            .where(F.col("instrument_type") == CREDIT).groupBy("fund_name").agg(
                F.count(F.lit(1)).alias("loan_count"),
                F.sum("principal_outstanding").alias("total_principal"),
                F.sum("undrawn_commitment").alias("total_undrawn"),
                F.avg("all_in_yield").alias("avg_yield"), F.avg("spread_bps").alias("avg_spread")))


def flows_by_direction(catalog: Catalog, since: AsOf) -> DataFrame:
    return (catalog.table("metrics_returns_cashflows")
            .where(F.col("cashflow_date") >= clock(since))
            .groupBy("fund_name", "direction").agg(
                F.count(F.lit(1)).alias("transaction_count"),
                F.sum("cashflow_amount").alias("total_amount"))
            .orderBy("fund_name", "direction"))


def instrument_flows(catalog: Catalog, instrument_id: str) -> DataFrame:
    """Dated signed flows of one instrument, the input of a return calculation."""
    return (catalog.table("metrics_returns_cashflows")
            .where(F.col("instrument_id") == instrument_id)
            .select("cashflow_date", "signed_amount").orderBy("cashflow_date"))


# --- funds, companies, portfolio ---------------------------------------------

def latest_fund_performance(catalog: Catalog) -> DataFrame:
    return _latest(
        catalog.table("metrics_fund_performance"), "fund_id", "fund_name", "period_end_date",
        "fund_nav", "total_commitments", "unfunded_commitment", "tvpi", "dpi", "rvpi",
        "number_of_portfolio_companies", "number_of_positions",
    ).orderBy("fund_name")


def variance_breaches(catalog: Catalog) -> DataFrame:
    nav, called, paid = "nav_variance_pct", "called_capital_variance_pct", "distributions_variance_pct"
    breach = ((F.abs(nav) > NAV_TOLERANCE) | (F.abs(called) > CAPITAL_TOLERANCE)
              | (F.abs(paid) > CAPITAL_TOLERANCE))
    return (catalog.table("metrics_fund_performance")
            .where((F.col("fund_type") == EQUITY) & breach)
            .select("fund_name", "period_end_date", nav, called, paid)
            .orderBy(F.desc("period_end_date")))


def latest_company_performance(catalog: Catalog) -> DataFrame:
    return _latest(
        catalog.table("metrics_company_performance"), "company_id", "company_name",
        "period_end_date", "revenue", "ebitda", "ebitda_margin", "enterprise_value",
        "ev_to_ebitda", "primary_country", "primary_industry",
    ).orderBy(F.desc_nulls_first("revenue"))


def company_history(catalog: Catalog, company_id: str) -> DataFrame:
    return (catalog.table("metrics_company_performance")
            .where(F.col("company_id") == company_id)
            .select("period_end_date", "company_name", "revenue", "ebitda", "ebitda_margin")
            .orderBy("period_end_date"))


def latest_portfolio(catalog: Catalog) -> DataFrame:
    return _latest(
        catalog.table("metrics_portfolio_overview"), "period_end_date", "period_end_date",
        "total_nav", "total_commitments", "total_unfunded_commitment", "tvpi_portfolio",
        "dpi_portfolio", "rvpi_portfolio", "number_of_funds", "number_of_companies",
        "number_of_positions")


def portfolio_trend(catalog: Catalog) -> DataFrame:
    return catalog.table("metrics_portfolio_overview").select(
        "period_end_date", "total_nav", "tvpi_portfolio", "dpi_portfolio",
        "net_cash_contributions_period").orderBy("period_end_date")
