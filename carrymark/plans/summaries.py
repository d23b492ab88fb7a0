"""Summary marts that are specified by their columns only.

Choices the column descriptions leave open are stated on each function.
Amounts "in USD" use the converted amount where the source has one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Window, functions as F

from carrymark.functions.dates import clock, month_start
from carrymark.functions.money import ratio, sum_when
from carrymark.functions.vocab import CAPITAL_CALLS, CREDIT, INVESTOR_DISTRIBUTIONS
from carrymark.operators.reporting import recency
from carrymark.operators.snapshots import latest_positions
from carrymark.plans.exposure import deployed_by_instrument, open_stages

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog


def _funds(catalog: Catalog, *columns: str) -> DataFrame:
    return catalog.table("dim_funds").select("fund_id", F.col("name").alias("fund_name"), *columns)


def fund_performance_latest(catalog: Catalog) -> DataFrame:
    """One row per fund from commitments, ledger and latest valuations.

    Committed capital sums the investors' original commitments; called and
    distributed capital sum the ledger's drawdowns and distributions; NAV sums
    the latest converted fair values. A fund without valuations is dated by the
    valuation date.
    """
    committed = catalog.table("dim_commitments").groupBy("fund_id").agg(
        F.sum("original_amount").alias("committed"))
    kind, amount = F.col("transaction_type"), F.col("amount_converted")
    ledger = catalog.table("fct_transactions").groupBy("fund_id").agg(
        sum_when(kind.isin(*CAPITAL_CALLS), amount).alias("called"),
        sum_when(kind.isin(*INVESTOR_DISTRIBUTIONS), amount).alias("distributed"))
    owners = catalog.table("dim_instruments").select("instrument_id", "fund_id")
    values = latest_positions(catalog).join(owners, "instrument_id").groupBy("fund_id").agg(
        F.sum("latest.fair_value_converted").alias("nav"),
        F.max("latest.period_end_date").alias("valued_on"))
    joined = _funds(catalog, F.col("type").alias("fund_type"), "vintage", "base_currency_code")
    for part in (committed, ledger, values):
        joined = joined.join(part, "fund_id", "left")
    zero = F.lit(0)
    totals = joined.select(
        "fund_id", "fund_name", "fund_type", "vintage", "base_currency_code",
        F.coalesce("valued_on", clock(catalog.as_of)).alias("as_of_date"),
        F.coalesce("committed", zero).alias("total_committed_capital"),
        F.coalesce("called", zero).alias("total_called_capital"),
        F.coalesce("distributed", zero).alias("total_distributed_capital"),
        F.coalesce("nav", zero).alias("current_nav"))
    called, paid, nav = (F.col(c) for c in (
        "total_called_capital", "total_distributed_capital", "current_nav"))
    return totals.select(
        "*", ratio(paid, called).alias("dpi"), ratio(nav + paid, called).alias("tvpi"),
        nav.alias("unrealized_value"), paid.alias("realized_value"),
        (F.col("total_committed_capital") - called).alias("remaining_commitment"),
        F.lit("ADMIN, PM").alias("source_systems"))


def pipeline_by_stage(catalog: Catalog) -> DataFrame:
    """Open deals per fund and current stage; closed stages are left out."""
    today = clock(catalog.as_of)
    created = F.col("created_at").cast("date")
    grouped = (catalog.table("dim_opportunities")
               .groupBy("fund_id", "stage_id").agg(
                   F.count(F.lit(1)).alias("deal_count"),
                   F.coalesce(F.sum("amount"), F.lit(0)).alias("total_amount_usd"),
                   F.count("amount").alias("_priced"),
                   F.min(created).alias("_oldest"), F.max(created).alias("_newest")))
    return (grouped.join(open_stages(catalog), "stage_id").join(_funds(catalog), "fund_id")
            .select("fund_id", "fund_name", "stage_id", "stage_name", "stage_order",
                    "deal_count", "total_amount_usd",
                    ratio(F.col("total_amount_usd"), F.col("_priced")).alias("avg_deal_size_usd"),
                    F.datediff(today, "_oldest").alias("oldest_deal_days"),
                    F.datediff(today, "_newest").alias("newest_deal_days"),
                    F.lit("CRM").alias("source_system"), today.alias("as_of_date")))


def company_financials_trend(catalog: Catalog) -> DataFrame:
    """Financials per company and period with growth over the period before.

    Where several rows report a period, the smallest id counts. Financials carry
    no exchange rate, so amounts stay in the reporting currency. The primary fund
    is the one with the highest current exposure, then the smallest id.
    """
    measures = ("revenue", "ebitda", "net_income")
    # One row per period bounds a company's window by the calendar.
    periods = catalog.table("fct_company_financials").groupBy("company_id", "period_end_date").agg(
        F.min_by(F.struct(*measures), "company_performance_snapshot_id").alias("_row"))
    history = Window.partitionBy("company_id").orderBy("period_end_date")

    def growth(measure: str):
        now, before = F.col(f"_row.{measure}"), F.lag(F.col(f"_row.{measure}")).over(history)
        return ratio(now - before, before) * 100

    trend = periods.select(
        "company_id", "period_end_date",
        F.year("period_end_date").alias("period_year"),
        F.quarter("period_end_date").alias("period_quarter"),
        *[F.col(f"_row.{m}").alias(f"{m}_usd") for m in measures],
        (ratio(F.col("_row.ebitda"), F.col("_row.revenue")) * 100).alias("ebitda_margin_pct"),
        growth("revenue").alias("revenue_growth_pct"),
        growth("ebitda").alias("ebitda_growth_pct"))

    primary = (deployed_by_instrument(catalog).groupBy("company_id", "fund_id")
               .agg(F.sum("exposure_usd").alias("exposure"))
               .groupBy("company_id")
               .agg(F.min(F.struct((-F.col("exposure")).alias("e"), "fund_id")).alias("_first"))
               .select("company_id", F.col("_first.fund_id").alias("fund_id"))
               .join(_funds(catalog), "fund_id", "left"))
    valuation = (catalog.table("fct_company_valuations")
                 .where(F.col("valuation_type") == "ACTUAL").groupBy("company_id")
                 .agg(F.max_by("amount", recency("period_end_date", "company_valuation_id"))
                      .alias("current_valuation_usd")))
    companies = (catalog.table("dim_companies")
                 .select("company_id", F.col("name").alias("company_name"))
                 .join(primary, "company_id", "left").join(valuation, "company_id", "left"))
    return trend.join(companies, "company_id").select(
        "company_id", "company_name", "fund_id", "fund_name", "period_end_date", "period_year",
        "period_quarter", *[f"{m}_usd" for m in measures], "ebitda_margin_pct",
        "revenue_growth_pct", "ebitda_growth_pct", "current_valuation_usd",
        F.lit("PM").alias("source_system"))


def investment_activity_monthly(catalog: Catalog,
                                types: Sequence[str] | None = None) -> DataFrame:
    """Ledger activity per fund, month and type, with the systems it came from.

    All transaction types count, unless ``types`` names some; the accepted-values
    check of the mart reports those beyond the documented five.
    """
    ledger = catalog.table("fct_transactions")
    activity = ((ledger if types is None else ledger.where(
                    F.col("transaction_type").isin(*types)))
                .groupBy("fund_id", month_start(F.col("date")).alias("activity_month"),
                         "transaction_type")
                .agg(F.count(F.lit(1)).alias("transaction_count"),
                     F.coalesce(F.sum("amount_converted"), F.lit(0)).alias("total_amount_usd"),
                     F.array_join(F.array_sort(F.collect_set("source")), ", ")
                     .alias("source_systems")))
    return activity.join(_funds(catalog), "fund_id").select(
        "fund_id", "fund_name", "activity_month",
        F.year("activity_month").alias("activity_year"),
        F.quarter("activity_month").alias("activity_quarter"),
        "transaction_type", "transaction_count", "total_amount_usd", "source_systems")


def loan_portfolio_summary(catalog: Catalog) -> DataFrame:
    """Loans per fund and maturity year.

    A loan's rate is its fixed rate, else its spread, since there is no base-rate
    table. Averages weigh by outstanding principal; loans without a principal or
    without the averaged value do not count.
    """
    loans = catalog.table("dim_instruments_credit").where("maturity_date is not null").select(
        "instrument_id", F.year("maturity_date").alias("maturity_year"),
        "commitment_amount_converted", "fixed_rate_pct", "spread_bps")
    owners = (catalog.table("dim_instruments").where(F.col("instrument_type") == CREDIT)
              .select("instrument_id", "fund_id"))
    latest = latest_positions(catalog).select(
        "instrument_id", F.col("credit.principal_outstanding_converted").alias("outstanding"),
        F.col("credit.period_end_date").alias("valued_on"))
    rate = F.coalesce(F.col("fixed_rate_pct").cast("double"), F.col("spread_bps") / F.lit(100.0))
    out = F.col("outstanding").cast("double")

    def weighted(value):
        return ratio(F.sum(value * out), F.sum(F.when(value.isNotNull(), out)))

    zero = F.lit(0)
    grouped = (loans.join(owners, "instrument_id").join(latest, "instrument_id", "left")
               .groupBy("fund_id", "maturity_year").agg(
                   F.count(F.lit(1)).alias("loan_count"),
                   F.coalesce(F.sum("commitment_amount_converted"), zero)
                   .alias("total_commitment_usd"),
                   F.coalesce(F.sum("outstanding"), zero).alias("total_outstanding_usd"),
                   weighted(rate).alias("weighted_avg_rate_pct"),
                   weighted(F.col("spread_bps")).alias("weighted_avg_spread_bps"),
                   F.coalesce(F.max("valued_on"), clock(catalog.as_of)).alias("as_of_date")))
    return grouped.join(_funds(catalog), "fund_id").select(
        "fund_id", "fund_name", "maturity_year", "loan_count", "total_commitment_usd",
        "total_outstanding_usd", "weighted_avg_rate_pct", "weighted_avg_spread_bps",
        (ratio(F.col("total_outstanding_usd"), F.col("total_commitment_usd")) * 100)
        .alias("utilization_pct"),
        F.lit("PM").alias("source_system"), "as_of_date")
