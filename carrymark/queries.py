"""Named queries: every model, mart, building block, question and check.

Each takes a catalog and returns a DataFrame over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType, DoubleType

from carrymark.functions.dates import date_shift
from carrymark.operators.snapshots import SNAPSHOT_FACTS, latest_positions
from carrymark.plans import company, consumer, core, exposure, fund, portfolio
from carrymark.plans.registry import TABLES
from carrymark.quality import checks, rules
from carrymark.sources.catalog import Catalog
from carrymark.sources.staging import SourceSpec, stage

Query = Callable[[Catalog], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Amounts as doubles of six decimals, ratios of nine; the rest unchanged."""
    digits = {DecimalType: 6, DoubleType: 9}
    return df.select(*[
        F.round(F.col(f"`{f.name}`").cast("double"), digits[type(f.dataType)]).alias(f.name)
        if type(f.dataType) in digits else F.col(f"`{f.name}`")
        for f in df.schema.fields])


# Models whose stamps are the time of the run.
_STAMPED_NOW = ("dim_investor_types", "fct_instrument_snapshots_credit",
                "fct_instrument_snapshots_equity")


def _model(name: str, catalog: Catalog) -> DataFrame:
    df = catalog.table(name)
    return df.drop("created_at", "updated_at") if name in _STAMPED_NOW else df


def _table(name: str, catalog: Catalog) -> DataFrame:
    return catalog.table(name)


SAMPLE_SPEC = SourceSpec(
    renames={"id": "company_id", "name": "company_name"},
    transforms={"country": "upper(country)"},
    exclude=("secret",))


def raw_companies(suppliers: DataFrame) -> DataFrame:
    return suppliers.selectExpr(
        "s_suppkey as ID", "'  ' || s_name || ' ' as Name",
        "lower('n' || cast(s_nationkey as string)) as Country", "'x' as Secret",
        "s_acctbal as Bal")


def _staged_companies(catalog: Catalog) -> DataFrame:
    raw = raw_companies(catalog.file("supplier"))
    return stage(raw, SAMPLE_SPEC, "crm_vendor", "raw_companies").drop("loaded_at")


def _shifted_dates(catalog: Catalog) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return catalog.file("orders").select(
        "o_orderkey",
        *[date_shift(day, unit, n).alias(f"plus_{unit}") for unit, n in (
            ("day", 45), ("months", 3), ("year", 1), ("hour", 30), ("minutes", 90),
            ("second", 100))],
        date_shift(day, "month", -3).alias("minus_quarter"),
        date_shift(day, "fortnight", 2).alias("unknown_unit"))


def _latest(catalog: Catalog) -> DataFrame:
    latest = latest_positions(catalog)
    return latest.select(
        "instrument_id", F.col("latest.period_end_date").alias("period_end_date"),
        *[F.col(f"latest.{c}").alias(c) for c in ("fair_value", "fair_value_converted")],
        F.col("credit.period_end_date").alias("credit_period_end_date"),
        *[F.col(f"credit.{c}_converted").alias(c)
          for c in ("principal_outstanding", "undrawn_commitment")])


def _from_facts(name: str, catalog: Catalog) -> DataFrame:
    """A mart that reads the three snapshot facts instead of the curated snapshots."""
    catalog = catalog.copy()
    for fact in SNAPSHOT_FACTS:
        catalog.replace(fact, catalog.table(fact))
    return catalog.table(name)


BLOCKS: dict[str, Query] = {
    "instrument_valuations": fund.instrument_valuations,
    "portfolio_company_counts": fund.portfolio_company_counts,
    "position_counts": fund.position_counts,
    "period_net_flows": fund.period_net_flows,
    "cumulative_distributions": partial(
        fund.cumulative_flows, measure="distributions", name="total_distributions_calculated"),
    "cumulative_called_capital": partial(
        fund.cumulative_flows, measure="called", name="called_capital_calculated"),
    "cumulative_credit_interest": partial(
        fund.cumulative_flows, measure="interest", name="total_interest_income"),
    "credit_exposure": fund.credit_exposure,
    "peak_outstanding_credit": lambda c: c.table("metrics_fund_performance").select(
        "fund_id", "period_end_date", "lines_of_credit_outstanding", "peak_outstanding_credit"),
    "quarterly_net_flows": portfolio.quarterly_net_flows,
    "latest_positions": _latest,
    "deployed_by_instrument": lambda c: exposure.deployed_by_instrument(c),
    "deployed_base": exposure.deployed_base,
    "deployed_base_valid_countries": partial(exposure.deployed_base, country_validity=True),
    "open_deal_base": exposure.open_deal_base,
    "actual_valuations": company.actual_valuations,
    "expected_credit_instruments": partial(core.expected_credit_instruments, kind="CREDIT"),
    "staged_companies": _staged_companies,
    "shifted_dates": _shifted_dates,
    "nav_variance_breaches": lambda c: checks.failing_rows(c, rules.NAV_VARIANCE).select(
        "fund_id", "fund_name", "period_end_date", "fund_nav_reported", "fund_nav_calculated",
        "nav_variance", "nav_variance_pct"),
    "called_capital_variance_breaches":
        lambda c: checks.failing_rows(c, rules.CALLED_VARIANCE).select(
            "fund_id", "fund_name", "period_end_date", "called_capital_reported",
            "called_capital_calculated", "called_capital_variance", "called_capital_variance_pct"),
    "distributions_variance_breaches":
        lambda c: checks.failing_rows(c, rules.DISTRIBUTIONS_VARIANCE).select(
            "fund_id", "fund_name", "period_end_date", "total_distributions_reported",
            "total_distributions_calculated", "distributions_variance",
            "distributions_variance_pct"),
}

MARTS: dict[str, Query] = {
    "fund_performance": partial(_table, "metrics_fund_performance"),
    "fund_performance_from_facts": partial(_from_facts, "metrics_fund_performance"),
    "position_performance_from_facts": partial(_from_facts, "metrics_position_performance"),
    "portfolio_overview": partial(_table, "metrics_portfolio_overview"),
    "portfolio_overview_quarter_end": partial(portfolio.portfolio_overview, flow_bucket="end"),
    "exposure_timeseries": partial(_table, "metrics_exposure_timeseries"),
    "company_performance": partial(_table, "metrics_company_performance"),
    "company_performance_as_of": partial(company.company_performance, as_of_period=True),
    "position_performance": partial(_table, "metrics_position_performance"),
    "returns_cashflows": partial(_table, "metrics_returns_cashflows"),
    "fund_performance_latest": partial(_table, "metrics_fund_performance_latest"),
    "pipeline_by_stage": partial(_table, "metrics_pipeline_by_stage"),
    "company_financials_trend": partial(_table, "metrics_company_financials_trend"),
    "investment_activity_monthly": partial(_table, "metrics_investment_activity_monthly"),
    "loan_portfolio_summary": partial(_table, "metrics_loan_portfolio_summary"),
}

# --- fixed values: what the sample questions ask for ------------------------
FUND, STAGE, COMPANY, INSTRUMENT, SINCE = "F1", "2", "C1", "I1", "1997-01-01"

QUESTIONS: dict[str, Query] = {
    "x01_exposure_by_region": partial(
        consumer.exposure_by_region, fund_id=FUND, stage_id=STAGE),
    "x02_exposure_by_industry": consumer.exposure_by_industry,
    "x03_exposure_drill_down": partial(consumer.exposure_drill_down, fund_id=FUND),
    "x04_fund_scorecard": consumer.fund_scorecard,
    "x05_deal_funnel": consumer.deal_funnel,
    "x06_company_trend": partial(consumer.company_trend, company_id=COMPANY),
    "x07_fund_activity": partial(consumer.fund_activity, fund_id=FUND),
    "x08_loan_maturities": consumer.loan_maturities,
    "x09_top_equity_positions": consumer.top_equity_positions,
    "x10_credit_by_fund": consumer.credit_by_fund,
    "x11_flows_by_direction": partial(consumer.flows_by_direction, since=SINCE),
    "x12_instrument_flows": partial(consumer.instrument_flows, instrument_id=INSTRUMENT),
    "x13_latest_fund_performance": consumer.latest_fund_performance,
    "x14_variance_breaches": consumer.variance_breaches,
    "x15_latest_company_performance": consumer.latest_company_performance,
    "x16_company_history": partial(consumer.company_history, company_id=COMPANY),
    "x17_latest_portfolio": consumer.latest_portfolio,
    "x18_portfolio_trend": consumer.portfolio_trend,
}

_CORE = [name for name, spec in TABLES.items() if spec.role != "metrics"]


def all_queries() -> dict[str, Query]:
    return {
        **{f"core_{name}": partial(_model, name) for name in _CORE},
        **BLOCKS, **MARTS, **QUESTIONS,
        **{f"dq_{table}": partial(checks.table_report, table=table)
           for table in rules.CHECKED_TABLES},
    }

