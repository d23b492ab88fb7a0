"""The DuckDB query that each registered query must equal."""

from __future__ import annotations

import re

from carrymark.plans.core import PROJECTIONS, Projection
from carrymark.queries import COMPANY, FUND, INSTRUMENT, SINCE, STAGE
from carrymark.quality.rules import (
    CHECKED_TABLES, OverlapRule, ReferenceRule, RowCountRule, RowRule, Rule, SinglePrimaryRule,
    UniqueRule, rules_for)
from carrymark.sources.schemas import INPUTS as INPUT_SCHEMAS, SEEDS
from verification.marts import BLOCKS, FIRST, TODAY
from verification.relations import INPUTS, MODELS, complete

RELATIONS = {**INPUTS, **MODELS, **BLOCKS}


_RATIO = re.compile(r"pct|dpi|rvpi|tvpi|moic|irr|_rate$|^avg_|^ev_|margin|years|yield|^weighted")


def shown(query: str, numbers: str = "") -> str:
    """The query with amounts as doubles of six decimals and ratios of nine."""
    if numbers:
        casts = ", ".join(
            f"round(cast({c} as double), 9) as {c}" if _RATIO.search(c)
            else f"cast(cast({c} as decimal(30, 6)) as double) as {c}"
            for c in numbers.split())
        query = f"select * replace ({casts}) from ({query})"
    return complete(query, RELATIONS)


def rows_of(relation: str, numbers: str = "", columns: str = "*") -> str:
    return shown(f"select {columns} from {relation}", numbers)


# --- models ------------------------------------------------------------------

def _decimals(projection: Projection) -> str:
    """Declared decimal columns under their output names; needs no session."""
    names = re.findall(r"(\w+) decimal", INPUT_SCHEMAS[projection.source])
    return " ".join(projection.renames.get(n, n) for n in names if n not in projection.drops)


_SNAPSHOT_NUMBERS = {
    "fct_instrument_snapshots":
        "fx_rate fair_value fair_value_converted accrued_income accrued_income_converted",
    "fct_instrument_snapshots_credit":
        "principal_outstanding principal_outstanding_converted undrawn_commitment "
        "undrawn_commitment_converted accrued_interest accrued_interest_converted accrued_fees "
        "accrued_fees_converted amortized_cost amortized_cost_converted expected_loss",
    "fct_instrument_snapshots_equity": "equity_stake_pct",
}


def _models() -> dict[str, str]:
    numbers = dict(_SNAPSHOT_NUMBERS)
    for name, p in PROJECTIONS.items():
        numbers[name] = _decimals(p)
    return {f"core_{name}": rows_of(name, numbers.get(name, "")) for name in (*SEEDS, *MODELS)}


# --- building blocks and marts -----------------------------------------------

_FUND_NUMBERS = (
    "fund_nav_reported fund_nav_calculated fund_nav nav_variance nav_variance_pct "
    "total_commitments called_capital_reported called_capital_calculated "
    "total_distributions_reported total_distributions_calculated total_called_capital "
    "total_distributions called_capital_variance called_capital_variance_pct "
    "distributions_variance distributions_variance_pct unfunded_commitment dpi rvpi tvpi "
    "dpi_calculated rvpi_calculated tvpi_calculated expected_coc lines_of_credit_outstanding "
    "peak_outstanding_credit total_exposure principal_outstanding undrawn_commitment "
    "interest_income period_net_flows")
_OVERVIEW_NUMBERS = (
    "total_nav total_commitments total_called_capital total_unfunded_commitment "
    "total_distributions dpi_portfolio rvpi_portfolio tvpi_portfolio "
    "net_cash_contributions_period")
_COMPANY_NUMBERS = (
    "revenue ebitda ebitda_margin cash total_assets total_liabilities equity net_debt "
    "enterprise_value ev_to_ebitda ev_to_revenue")
_POSITION_NUMBERS = (
    "holding_period_years cost_basis realized_proceeds fair_value ownership_pct_initial "
    "ownership_pct_current moic equity_irr_approx drawn_amount interest_income "
    "principal_repaid principal_outstanding undrawn_commitment accrued_interest "
    "commitment_amount utilization_rate all_in_yield")
_EXPOSURE_NUMBERS = "deployed_capital_usd closed_pipeline_usd total_exposure_usd"
_OVERVIEW_COUNTS = """* replace (cast(number_of_companies as bigint) as number_of_companies,
    cast(number_of_positions as bigint) as number_of_positions)"""

_SHIFTS = {"plus_day": "interval 45 day", "plus_months": "interval 3 month",
           "plus_year": "interval 1 year", "plus_hour": "interval 30 hour",
           "plus_minutes": "interval 90 minute", "plus_second": "interval 100 second",
           "minus_quarter": "interval (-3) month", "unknown_unit": "interval 2 day"}


def _breach(prefix: str, stem: str, tolerance: str) -> str:
    columns = f"{stem}_reported, {stem}_calculated, {prefix}_variance, {prefix}_variance_pct"
    return shown(
        f"select fund_id, fund_name, period_end_date, {columns} from metrics_fund_performance "
        f"where fund_type = 'EQUITY' and ({prefix}_variance_pct > {tolerance} "
        f"or {prefix}_variance_pct < -{tolerance})", columns.replace(",", ""))


def _blocks() -> dict[str, str]:
    deployed = "deployed_capital_usd"
    return {
        "instrument_valuations": rows_of("instrument_valuations", "total_instrument_fair_value"),
        "portfolio_company_counts": rows_of("portfolio_company_counts"),
        "position_counts": rows_of("position_counts"),
        "period_net_flows": rows_of("period_net_flows", "period_net_flows"),
        "cumulative_distributions": rows_of(
            "cumulative_distributions", "total_distributions_calculated"),
        "cumulative_called_capital": rows_of(
            "cumulative_called_capital", "called_capital_calculated"),
        "cumulative_credit_interest": rows_of(
            "cumulative_credit_interest", "total_interest_income"),
        "credit_exposure": rows_of(
            "credit_exposure", "lines_of_credit_outstanding total_principal_outstanding "
                               "total_undrawn_commitment total_credit_exposure"),
        "peak_outstanding_credit": rows_of(
            "metrics_fund_performance", "lines_of_credit_outstanding peak_outstanding_credit",
            "fund_id, period_end_date, lines_of_credit_outstanding, peak_outstanding_credit"),
        "quarterly_net_flows": shown(
            "select cast(date_trunc('quarter', cashflow_date) as date) period_end_date, "
            "sum(case direction when 'outflow' then cashflow_amount else -cashflow_amount end) "
            "net_cash_contributions_period from metrics_returns_cashflows group by all",
            "net_cash_contributions_period"),
        "latest_positions": shown(
            "select s.instrument_id, s.period_end_date, s.fair_value, s.fair_value_converted, "
            "x.period_end_date credit_period_end_date, "
            "x.principal_outstanding * x.fx_rate principal_outstanding, "
            "x.undrawn_commitment * x.fx_rate undrawn_commitment "
            "from newest_snapshots s left join (select * from int_instrument_snapshots_curated "
            "where principal_outstanding is not null qualify row_number() over ("
            "partition by instrument_id order by period_end_date desc nulls first, "
            "instrument_snapshot_id desc) = 1) x using (instrument_id)",
            "fair_value fair_value_converted principal_outstanding undrawn_commitment"),
        "deployed_by_instrument": rows_of("deployed_by_instrument", "exposure_usd"),
        "deployed_base": rows_of("deployed_base", deployed),
        "deployed_base_valid_countries": rows_of("deployed_base_valid_countries", deployed),
        "open_deal_base": rows_of("open_deal_base", "pipeline_value_usd"),
        "actual_valuations": shown(
            "select company_id, period_end_date, arg_min(amount, company_valuation_id) "
            "enterprise_value from fct_company_valuations where valuation_type = 'ACTUAL' "
            "group by all", "enterprise_value"),
        "expected_credit_instruments": shown(
            "select instrument_id from dim_instruments where instrument_type = 'CREDIT'"),
        "staged_companies": shown(
            "select s_suppkey company_id, trim('  ' || s_name || ' ') company_name, "
            "'N' || s_nationkey country, s_acctbal bal, 'CRM_VENDOR' source_system, "
            "'raw_companies' source_table from supplier", "bal"),
        "shifted_dates": shown("select o_orderkey, " + ", ".join(
            f"cast(cast(o_orderdate as date) + {i} as timestamp) as {c}"
            for c, i in _SHIFTS.items()) + " from orders"),
        "nav_variance_breaches": _breach("nav", "fund_nav", "0.02"),
        "called_capital_variance_breaches": _breach("called_capital", "called_capital", "0.001"),
        "distributions_variance_breaches": _breach(
            "distributions", "total_distributions", "0.001"),
    }


def _marts() -> dict[str, str]:
    return {
        "fund_performance": rows_of("metrics_fund_performance", _FUND_NUMBERS),
        # The text joins the three facts in either case.
        "fund_performance_from_facts": rows_of("metrics_fund_performance", _FUND_NUMBERS),
        "position_performance_from_facts": rows_of(
            "metrics_position_performance", _POSITION_NUMBERS),
        "portfolio_overview": rows_of(
            "metrics_portfolio_overview", _OVERVIEW_NUMBERS, _OVERVIEW_COUNTS),
        "portfolio_overview_quarter_end": rows_of(
            "metrics_portfolio_overview_quarter_end", _OVERVIEW_NUMBERS, _OVERVIEW_COUNTS),
        "exposure_timeseries": rows_of("metrics_exposure_timeseries", _EXPOSURE_NUMBERS),
        "company_performance": rows_of("metrics_company_performance", _COMPANY_NUMBERS),
        "company_performance_as_of": rows_of(
            "metrics_company_performance_as_of", _COMPANY_NUMBERS),
        "position_performance": rows_of("metrics_position_performance", _POSITION_NUMBERS),
        "returns_cashflows": rows_of(
            "metrics_returns_cashflows", "cashflow_amount fx_rate signed_amount"),
        "fund_performance_latest": rows_of(
            "metrics_fund_performance_latest",
            "total_committed_capital total_called_capital total_distributed_capital current_nav "
            "dpi tvpi unrealized_value realized_value remaining_commitment"),
        "pipeline_by_stage": rows_of(
            "metrics_pipeline_by_stage", "total_amount_usd avg_deal_size_usd"),
        "company_financials_trend": rows_of(
            "metrics_company_financials_trend",
            "revenue_usd ebitda_usd net_income_usd ebitda_margin_pct revenue_growth_pct "
            "ebitda_growth_pct current_valuation_usd"),
        "investment_activity_monthly": rows_of(
            "metrics_investment_activity_monthly", "total_amount_usd"),
        "loan_portfolio_summary": rows_of(
            "metrics_loan_portfolio_summary",
            "total_commitment_usd total_outstanding_usd weighted_avg_rate_pct "
            "weighted_avg_spread_bps utilization_pct"),
    }


# --- questions ---------------------------------------------------------------

def _questions() -> dict[str, str]:
    newest = "(select max(period_end_date) from {0})"
    return {
        "x01_exposure_by_region": shown(
            "select exposure_month, region, sum(total_exposure_usd) total_exposure "
            f"from metrics_exposure_timeseries where fund_id = '{FUND}' "
            f"and stage_id = '{STAGE}' group by all", "total_exposure"),
        "x02_exposure_by_industry": shown(
            "select industry_name, sum(deployed_capital_usd) deployed_capital "
            f"from metrics_exposure_timeseries where period_type = 'Current' "
            f"and exposure_month = {FIRST} group by all", "deployed_capital"),
        "x03_exposure_drill_down": shown(
            "select region, country_name, industry_name, sum(total_exposure_usd) exposure "
            f"from metrics_exposure_timeseries where fund_id = '{FUND}' "
            f"and exposure_month = {FIRST} group by all", "exposure"),
        "x04_fund_scorecard": rows_of(
            "metrics_fund_performance_latest",
            "total_committed_capital total_called_capital current_nav dpi tvpi",
            "fund_name, vintage, total_committed_capital, total_called_capital, current_nav, "
            "dpi, tvpi"),
        "x05_deal_funnel": rows_of(
            "metrics_pipeline_by_stage", "total_amount_usd avg_deal_size_usd",
            "fund_name, stage_name, deal_count, total_amount_usd, avg_deal_size_usd, "
            "oldest_deal_days"),
        "x06_company_trend": shown(
            "select company_name, period_year, period_quarter, revenue_usd, ebitda_usd, "
            "ebitda_margin_pct, revenue_growth_pct from metrics_company_financials_trend "
            f"where company_id = '{COMPANY}'",
            "revenue_usd ebitda_usd ebitda_margin_pct revenue_growth_pct"),
        "x07_fund_activity": shown(
            "select activity_year, activity_month, transaction_type, "
            "sum(total_amount_usd) total_amount from metrics_investment_activity_monthly "
            f"where fund_id = '{FUND}' group by all", "total_amount"),
        "x08_loan_maturities": rows_of(
            "metrics_loan_portfolio_summary",
            "total_commitment_usd total_outstanding_usd weighted_avg_rate_pct utilization_pct",
            "fund_name, maturity_year, loan_count, total_commitment_usd, total_outstanding_usd, "
            "weighted_avg_rate_pct, utilization_pct"),
        "x09_top_equity_positions": shown(
            "select instrument_id, fund_name, company_name, instrument_type, cost_basis, "
            "fair_value, realized_proceeds, moic, equity_irr_approx, holding_period_years "
            "from metrics_position_performance where instrument_type = 'EQUITY' "
            "and moic is not null order by moic desc, instrument_id limit 10",
            "cost_basis fair_value realized_proceeds moic equity_irr_approx holding_period_years"),
        "x10_credit_by_fund": shown(
            "select fund_name, count(*) loan_count, sum(principal_outstanding) total_principal, "
            "sum(undrawn_commitment) total_undrawn, avg(all_in_yield) avg_yield, "
            "avg(spread_bps) avg_spread from metrics_position_performance "
            "where instrument_type = 'CREDIT' group by all",
            "total_principal total_undrawn avg_yield avg_spread"),
        "x11_flows_by_direction": shown(
            "select fund_name, direction, count(*) transaction_count, "
            "sum(cashflow_amount) total_amount from metrics_returns_cashflows "
            f"where cashflow_date >= date '{SINCE}' group by all", "total_amount"),
        "x12_instrument_flows": shown(
            "select cashflow_date, signed_amount from metrics_returns_cashflows "
            f"where instrument_id = '{INSTRUMENT}'", "signed_amount"),
        "x13_latest_fund_performance": shown(
            "select fund_name, period_end_date, fund_nav, total_commitments, "
            "unfunded_commitment, tvpi, dpi, rvpi, number_of_portfolio_companies, "
            "number_of_positions from metrics_fund_performance where period_end_date = "
            + newest.format("metrics_fund_performance"),
            "fund_nav total_commitments unfunded_commitment tvpi dpi rvpi"),
        "x14_variance_breaches": shown(
            "select fund_name, period_end_date, nav_variance_pct, called_capital_variance_pct, "
            "distributions_variance_pct from metrics_fund_performance where fund_type = 'EQUITY' "
            "and greatest(abs(nav_variance_pct) / 20, abs(called_capital_variance_pct), "
            "abs(distributions_variance_pct)) > 0.001",
            "nav_variance_pct called_capital_variance_pct distributions_variance_pct"),
        "x15_latest_company_performance": shown(
            "select company_name, period_end_date, revenue, ebitda, ebitda_margin, "
            "enterprise_value, ev_to_ebitda, primary_country, primary_industry "
            "from metrics_company_performance where period_end_date = "
            + newest.format("metrics_company_performance"),
            "revenue ebitda ebitda_margin enterprise_value ev_to_ebitda"),
        "x16_company_history": shown(
            "select period_end_date, company_name, revenue, ebitda, ebitda_margin "
            f"from metrics_company_performance where company_id = '{COMPANY}'",
            "revenue ebitda ebitda_margin"),
        "x17_latest_portfolio": shown(
            "select period_end_date, total_nav, total_commitments, total_unfunded_commitment, "
            "tvpi_portfolio, dpi_portfolio, rvpi_portfolio, number_of_funds, "
            "cast(number_of_companies as bigint) number_of_companies, "
            "cast(number_of_positions as bigint) number_of_positions "
            "from metrics_portfolio_overview order by period_end_date desc limit 1",
            "total_nav total_commitments total_unfunded_commitment tvpi_portfolio "
            "dpi_portfolio rvpi_portfolio"),
        "x18_portfolio_trend": rows_of(
            "metrics_portfolio_overview",
            "total_nav tvpi_portfolio dpi_portfolio net_cash_contributions_period",
            "period_end_date, total_nav, tvpi_portfolio, dpi_portfolio, "
            "net_cash_contributions_period"),
    }


# --- checks ------------------------------------------------------------------

def _failures(rule: Rule) -> str:
    """A scalar query that counts what breaks the rule."""
    t = rule.table
    match rule:
        case RowRule():
            return f"select count(*) from {t} where {rule.failing.replace('`', chr(34))}"
        case UniqueRule():
            keys = ", ".join(rule.keys)
            known = " and ".join(f"{k} is not null" for k in rule.keys)
            return (f"select count(*) from (select {keys} from {t} where {known} "
                    f"group by {keys} having count(*) > 1)")
        case ReferenceRule():
            return (f"select count(*) from {t} c where c.{rule.column} is not null and not exists "
                    f"(select 1 from {rule.parent} p where p.{rule.parent_column} = "
                    f"c.{rule.column})")
        case RowCountRule():
            return (f"select abs((select count(*) from {t}) - (select count(*) "
                    f"from dim_instruments where {rule.other}))")
        case OverlapRule():
            same = " and ".join(f"a.{k} = b.{k}" for k in rule.keys)
            # Rows that tie are alike in all that matters here, so any order serves.
            keys = ", ".join(rule.keys)
            numbered = (f"(select {keys}, valid_from, valid_to, row_number() over (partition by "
                        f"{keys} order by valid_from nulls first, valid_to) n from {t})")
            return (f"select count(*) from {numbered} b where exists (select 1 from {numbered} a "
                    f"where {same} and a.n < b.n and (a.valid_to is null or "
                    "a.valid_to >= coalesce(b.valid_from, date '0001-01-01')))")
        case SinglePrimaryRule():
            return (f"select count(*) from (select {rule.key} from {t} where primary_flag "
                    f"and coalesce(valid_from <= {TODAY}, true) "
                    f"and coalesce(valid_to >= {TODAY}, true) "
                    f"group by {rule.key} having count(*) > 1)")
    raise TypeError(rule)


def _reports() -> dict[str, str]:
    reports = {}
    for table in CHECKED_TABLES:
        reports[f"dq_{table}"] = shown(" union all ".join(
            f"select '{r.table}' table_name, '{r.check}' check_name, '{r.column}' column_name, "
            f"'{r.severity}' severity, cast(({_failures(r)}) as bigint) failures"
            for r in rules_for(table)))
    return reports


def expected_sql() -> dict[str, str]:
    return {**_models(), **_blocks(), **_marts(), **_questions(), **_reports()}
