"""Position performance: one row per instrument that has a snapshot."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from carrymark.functions.dates import clock, years_between
from carrymark.functions.money import ratio, sum_when
from carrymark.functions.vocab import (
    CREDIT, CREDIT_DRAWS, CREDIT_REPAYMENTS, EQUITY, EQUITY_REALISED, INTEREST)
from carrymark.operators.snapshots import latest_positions

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog


def instrument_flows(catalog: Catalog) -> DataFrame:
    """Cash-flow totals per instrument with any flow that counts, in one pass."""
    kind = F.col("instrument_cashflow_type")

    def total(types: tuple[str, ...]) -> Column:
        return F.coalesce(sum_when(kind.isin(*types), F.col("amount_converted")), F.lit(0))

    counted = kind.isin(*CREDIT_DRAWS, *CREDIT_REPAYMENTS, *INTEREST, *EQUITY_REALISED)
    return catalog.table("fct_instrument_cashflows").where(counted).groupBy("instrument_id").agg(
        (total(CREDIT_DRAWS) - total(CREDIT_REPAYMENTS)).alias("drawn_amount"),
        total(INTEREST).alias("interest_income"),
        total(EQUITY_REALISED).alias("realized_proceeds"),
        total(CREDIT_REPAYMENTS).alias("principal_repaid"))


def position_performance(catalog: Catalog) -> DataFrame:
    """Cost, proceeds, value and multiples for equity; exposure and terms for credit.

    All inputs are reduced to one row per instrument before they meet, so the
    joins share one partitioning by instrument.
    """
    equity_terms = catalog.table("dim_instruments_equity").select(
        "instrument_id", "initial_ownership_pct", "initial_cost_converted")
    credit_terms = catalog.table("dim_instruments_credit").select(
        "instrument_id", "commitment_amount_converted", "maturity_date", "interest_index",
        "spread_bps", "security_rank")
    funds = catalog.table("dim_funds").select(
        "fund_id", F.col("name").alias("fund_name"), F.col("type").alias("fund_type"))
    companies = catalog.table("dim_companies").select(
        "company_id", F.col("name").alias("company_name"))
    instruments = catalog.table("dim_instruments").select(
        "instrument_id", "fund_id", "company_id", F.col("name").alias("instrument_name"),
        "instrument_type", "inception_date", "termination_date")
    positions = (
        latest_positions(catalog)
        .where(F.col("latest.period_end_date").isNotNull())
        .join(instruments, "instrument_id")
        .join(instrument_flows(catalog), "instrument_id", "left")
        .join(equity_terms, "instrument_id", "left")
        .join(credit_terms, "instrument_id", "left")
        .join(funds, "fund_id")
        .join(companies, "company_id", "left"))

    today, zero = clock(catalog.as_of), F.lit(0)

    def equity(value: Column) -> Column:
        return F.when(F.col("instrument_type") == EQUITY, value)

    def credit(value: Column) -> Column:
        return F.when(F.col("instrument_type") == CREDIT, value)

    def flow_total(name: str) -> Column:
        return F.coalesce(F.col(name), zero)

    measured = positions.select(
        "instrument_id", "instrument_name", "instrument_type",
        F.col("latest.period_end_date").alias("period_end_date"),
        "fund_id", "fund_name", "fund_type", "company_id", "company_name",
        F.col("inception_date").alias("initial_investment_date"),
        F.col("termination_date").alias("exit_date"),
        years_between(F.col("inception_date"), F.coalesce("termination_date", today))
        .alias("holding_period_years"),
        equity(F.col("initial_cost_converted")).alias("cost_basis"),
        equity(flow_total("realized_proceeds")).alias("realized_proceeds"),
        equity(F.coalesce(F.col("latest.fair_value_converted"), zero)).alias("fair_value"),
        equity(F.col("initial_ownership_pct")).alias("ownership_pct_initial"),
        equity(F.col("stake")).alias("ownership_pct_current"),
        credit(flow_total("drawn_amount")).alias("drawn_amount"),
        credit(flow_total("interest_income")).alias("interest_income"),
        credit(flow_total("principal_repaid")).alias("principal_repaid"),
        *[credit(F.col(f"credit.{m}_converted")).alias(m)
          for m in ("principal_outstanding", "undrawn_commitment", "accrued_interest")],
        credit(F.col("commitment_amount_converted")).alias("commitment_amount"),
        *[credit(F.col(c)).alias(c)
          for c in ("spread_bps", "interest_index", "maturity_date", "security_rank")])

    cost, years = F.col("cost_basis"), F.col("holding_period_years")
    multiple = F.when(cost > 0, ratio(F.col("realized_proceeds") + F.col("fair_value"), cost))
    growth = F.pow(F.col("moic"), F.try_divide(F.lit(1.0), years)) - 1
    return measured.withColumn("moic", multiple).select(
        "instrument_id", "instrument_name", "instrument_type", "period_end_date", "fund_id",
        "fund_name", "fund_type", "company_id", "company_name", "initial_investment_date",
        "exit_date", "holding_period_years", "cost_basis", "realized_proceeds", "fair_value",
        "ownership_pct_initial", "ownership_pct_current", "moic",
        F.when((years > 0) & (F.col("moic") > 0), growth).alias("equity_irr_approx"),
        "drawn_amount", "interest_income", "principal_repaid", "principal_outstanding",
        "undrawn_commitment", "accrued_interest", "commitment_amount", "spread_bps",
        "interest_index", "maturity_date", "security_rank",
        F.when(F.col("commitment_amount") > 0,
               ratio(F.col("principal_outstanding"), F.col("commitment_amount")))
        .alias("utilization_rate"),
        F.year("maturity_date").alias("maturity_year"),
        F.datediff("maturity_date", today).alias("days_to_maturity"),
        (F.col("spread_bps") / F.lit(10000.0)).alias("all_in_yield"))
