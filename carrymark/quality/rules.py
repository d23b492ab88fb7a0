"""Declared data contracts of every table.

``CONTRACTS`` holds the column checks; ``NOTED`` holds the rules the data model
states in prose (amount signs, interval overlap, ledger domains and the like).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from carrymark.functions import vocab

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Rule:
    table: str
    check: str
    column: str
    severity: str = ERROR


@dataclass(frozen=True)
class RowRule(Rule):
    """Fails on every row that meets ``failing``, a SQL predicate."""

    failing: str = "false"


@dataclass(frozen=True)
class UniqueRule(Rule):
    """Fails on every key that occurs more than once; keys with a null do not count."""

    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class ReferenceRule(Rule):
    """Fails on every row whose non-null value is missing in the parent."""

    parent: str = ""
    parent_column: str = ""


@dataclass(frozen=True)
class RowCountRule(Rule):
    """Fails by the difference to the number of rows of another relation."""

    other: str = ""


@dataclass(frozen=True)
class OverlapRule(Rule):
    """Fails on every validity interval that begins inside an earlier one of its key."""

    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class SinglePrimaryRule(Rule):
    """Fails on every key with several primary rows in force at the valuation date."""

    key: str = ""


def _in(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def accepted(table: str, column: str, values: Sequence[str], where: str = "true") -> RowRule:
    return RowRule(table, "accepted_values", column,
                   failing=f"({where}) and `{column}` not in ({_in(values)})")


def _contract(table: str, *, unique: Sequence[str] = (), required: Sequence[str] = (),
              refs: Mapping[str, str] | None = None,
              values: Mapping[str, Sequence[str]] | None = None,
              more: Sequence[Rule] = ()) -> list[Rule]:
    rules: list[Rule] = [UniqueRule(table, "unique", c, keys=(c,)) for c in unique]
    rules += [RowRule(table, "not_null", c, failing=f"`{c}` is null") for c in required]
    for column, target in (refs or {}).items():
        parent, parent_column = target.split(".")
        rules.append(ReferenceRule(table, "relationships", column,
                                   parent=parent, parent_column=parent_column))
    rules += [accepted(table, c, v) for c, v in (values or {}).items()]
    return [*rules, *more]


# Parents of foreign keys, by column name.
FUND, COMPANY = "dim_funds.fund_id", "dim_companies.company_id"
INSTRUMENT, CURRENCY = "dim_instruments.instrument_id", "dim_currencies.currency_code"
COUNTRY, INDUSTRY = "dim_countries.country_iso2_code", "dim_industries.industry_id"
INVESTOR, FACILITY = "dim_investors.investor_id", "dim_facilities.facility_id"
SNAPSHOT = "fct_instrument_snapshots.instrument_snapshot_id"
OPPORTUNITY, STAGE = "dim_opportunities.opportunity_id", "dim_stages.stage_id"

_PERIOD = ("period_end_date", "reporting_basis", "snapshot_source")
_SOURCES = {"snapshot_source": vocab.SNAPSHOT_SOURCES}
_KNOWN_INCOME = "income_level is not null"


def null_for_fund_type(column: str, fund_type: str) -> RowRule:
    return RowRule("metrics_fund_performance", "null_for_fund_type", column,
                   failing=f"fund_type = '{fund_type}' and `{column}` is not null")


def _variance(check: str, stem: str, tolerance: float, severity: str, prefix: str) -> RowRule:
    return RowRule(
        "metrics_fund_performance", check, f"{prefix}_variance_pct", severity,
        failing=f"abs({prefix}_variance_pct) > {tolerance} and {stem}_reported is not null "
                f"and {stem}_calculated is not null and fund_type = 'EQUITY'")


NAV_VARIANCE = _variance("nav_variance", "fund_nav", 0.02, WARN, "nav")
CALLED_VARIANCE = _variance("called_capital_variance", "called_capital", 0.001, ERROR,
                            "called_capital")
DISTRIBUTIONS_VARIANCE = _variance("distributions_variance", "total_distributions", 0.001, ERROR,
                                   "distributions")
_VARIANCES = [NAV_VARIANCE, CALLED_VARIANCE, DISTRIBUTIONS_VARIANCE]

_CONTRACT_LIST = [
    _contract("ref_currencies", unique=["currency_code"],
              required=["currency_code", "currency_name"]),
    _contract("ref_countries", unique=["iso2"], required=["iso2", "name"],
              more=[accepted("ref_countries", "income_level", vocab.INCOME_LEVELS, _KNOWN_INCOME)]),
    _contract("dim_currencies", unique=["currency_code"], required=["currency_code", "name"]),
    _contract("dim_countries", unique=["country_iso2_code"],
              required=["country_iso2_code", "name"],
              more=[accepted("dim_countries", "income_level", vocab.INCOME_LEVELS, _KNOWN_INCOME)]),
    _contract("dim_industries", unique=["industry_id", "name"], required=["industry_id", "name"]),
    _contract("dim_stages", unique=["stage_id"], required=["stage_id", "name"]),
    _contract("dim_investor_types", unique=["investor_type_id", "name"],
              required=["investor_type_id", "name"]),
    _contract("dim_investors", unique=["investor_id"], required=["investor_id", "name"],
              refs={"investor_type_id": "dim_investor_types.investor_type_id",
                    "domicile_country_code": COUNTRY}),
    _contract("dim_funds", unique=["fund_id"], required=["fund_id", "name", "type"],
              refs={"base_currency_code": CURRENCY}, values={"type": vocab.FUND_TYPES}),
    _contract("fct_fund_snapshots", unique=["fund_snapshot_id"],
              required=["fund_snapshot_id", "fund_id", *_PERIOD, "nav_amount_converted"],
              refs={"fund_id": FUND, "currency_code": CURRENCY}, values=_SOURCES),
    _contract("dim_companies", unique=["company_id"], required=["company_id", "name"],
              refs={"currency_code": CURRENCY}),
    _contract("br_company_industries", required=["company_id", "industry_id", "valid_from"],
              refs={"company_id": COMPANY, "industry_id": INDUSTRY}),
    _contract("br_company_countries", required=["company_id", "country_code", "valid_from"],
              refs={"company_id": COMPANY, "country_code": COUNTRY}),
    _contract("fct_company_valuations", unique=["company_valuation_id"],
              required=["company_valuation_id", "company_id", *_PERIOD, "valuation_type"],
              refs={"company_id": COMPANY},
              values={**_SOURCES, "valuation_type": vocab.VALUATION_TYPES}),
    _contract("fct_company_financials", unique=["company_performance_snapshot_id"],
              required=["company_performance_snapshot_id", "company_id", *_PERIOD],
              refs={"company_id": COMPANY, "currency_code": CURRENCY}, values=_SOURCES),
    _contract("dim_share_classes", unique=["share_class_id"],
              required=["share_class_id", "company_id", "name"], refs={"company_id": COMPANY}),
    _contract("dim_instruments", unique=["instrument_id"],
              required=["instrument_id", "fund_id", "company_id", "instrument_type"],
              refs={"fund_id": FUND, "company_id": COMPANY},
              values={"instrument_type": vocab.INSTRUMENT_TYPES}),
    _contract("dim_instruments_equity", unique=["instrument_id"],
              required=["instrument_id", "share_class_id"],
              refs={"instrument_id": INSTRUMENT,
                    "share_class_id": "dim_share_classes.share_class_id",
                    "currency_code": CURRENCY},
              more=[RowCountRule("dim_instruments_equity", "equal_rowcount", "*",
                                 other="instrument_type = 'EQUITY'")]),
    _contract("dim_instruments_credit", unique=["instrument_id"],
              required=["instrument_id", "facility_id", "start_date", "maturity_date",
                        "interest_index", "spread_bps", "day_count", "pay_freq_months",
                        "amortization_type"],
              refs={"instrument_id": INSTRUMENT, "facility_id": FACILITY,
                    "currency_code": CURRENCY},
              values={"instrument_credit_type": vocab.CREDIT_TYPES,
                      "interest_index": vocab.INTEREST_INDEXES, "day_count": vocab.DAY_COUNTS,
                      "amortization_type": vocab.AMORTIZATIONS,
                      "security_rank": vocab.SECURITY_RANKS},
              # The documented comparison filters on a type that cannot occur (LOAN).
              more=[RowCountRule("dim_instruments_credit", "equal_rowcount", "*",
                                 other="instrument_type = 'CREDIT'")]),
    _contract("fct_instrument_snapshots", unique=["instrument_snapshot_id"],
              required=["instrument_snapshot_id", "instrument_id", *_PERIOD, "currency_code"],
              refs={"instrument_id": INSTRUMENT, "currency_code": CURRENCY}, values=_SOURCES),
    _contract("fct_instrument_snapshots_equity", unique=["instrument_snapshot_id"],
              required=["instrument_snapshot_id"], refs={"instrument_snapshot_id": SNAPSHOT}),
    _contract("fct_instrument_snapshots_credit", unique=["instrument_snapshot_id"],
              required=["instrument_snapshot_id"], refs={"instrument_snapshot_id": SNAPSHOT}),
    _contract("fct_instrument_cashflows", unique=["instrument_cashflow_id"],
              required=["instrument_cashflow_id", "instrument_id", "instrument_cashflow_type",
                        "date", "amount", "currency_code"],
              refs={"instrument_id": INSTRUMENT, "currency_code": CURRENCY,
                    "transaction_id": "fct_transactions.transaction_id"},
              values={"instrument_cashflow_type": vocab.CASHFLOW_TYPES}),
    _contract("br_instrument_countries", required=["instrument_id", "country_code", "valid_from"],
              refs={"instrument_id": INSTRUMENT, "country_code": COUNTRY}),
    _contract("br_instrument_industries", required=["instrument_id", "industry_id", "valid_from"],
              refs={"instrument_id": INSTRUMENT, "industry_id": INDUSTRY}),
    _contract("dim_facilities", unique=["facility_id"],
              required=["facility_id", "fund_id", "borrower_company_id", "facility_type",
                        "agreement_date", "currency_code"],
              refs={"fund_id": FUND, "borrower_company_id": COMPANY, "currency_code": CURRENCY},
              values={"facility_type": vocab.FACILITY_TYPES}),
    _contract("dim_commitments", unique=["commitment_id"],
              required=["commitment_id", "fund_id", "investor_id"],
              refs={"fund_id": FUND, "investor_id": INVESTOR, "currency_code": CURRENCY}),
    _contract("fct_commitment_snapshots", unique=["commitment_snapshot_id"],
              required=["commitment_snapshot_id", "commitment_id", *_PERIOD],
              refs={"commitment_id": "dim_commitments.commitment_id", "currency_code": CURRENCY},
              values=_SOURCES),
    _contract("dim_opportunities", unique=["opportunity_id"], required=["opportunity_id", "name"],
              refs={"fund_id": FUND, "stage_id": STAGE, "company_id": COMPANY}),
    _contract("br_opportunity_countries", required=["opportunity_id", "country_code"],
              refs={"opportunity_id": OPPORTUNITY, "country_code": COUNTRY}),
    _contract("br_opportunity_industries", required=["opportunity_id", "industry_id"],
              refs={"opportunity_id": OPPORTUNITY, "industry_id": INDUSTRY}),
    _contract("fct_transactions", unique=["transaction_id", "source_reference"],
              required=["transaction_id", "transaction_type", "fund_id", "amount",
                        "currency_code", "date", "source", "source_reference"],
              refs={"fund_id": FUND, "investor_id": INVESTOR, "instrument_id": INSTRUMENT,
                    "facility_id": FACILITY, "currency_code": CURRENCY},
              values={"transaction_type": vocab.TRANSACTION_TYPES}),
    _contract("metrics_exposure_timeseries",
              required=["exposure_month", "exposure_year", "exposure_month_num", "fund_id",
                        "fund_name", "region", "country_code", "country_name", "industry_id",
                        "industry_name", "deployed_capital_usd", "closed_pipeline_usd",
                        "total_exposure_usd", "period_type"],
              values={"period_type": vocab.PERIOD_TYPES}),
    _contract("metrics_fund_performance_latest", unique=["fund_id"],
              required=["fund_id", "fund_name", "base_currency_code", "as_of_date",
                        "total_committed_capital", "total_called_capital",
                        "total_distributed_capital", "current_nav", "source_systems"],
              refs={"fund_id": FUND}),
    _contract("metrics_pipeline_by_stage",
              required=["fund_id", "fund_name", "stage_id", "stage_name", "stage_order",
                        "deal_count", "total_amount_usd", "source_system", "as_of_date"],
              refs={"fund_id": FUND, "stage_id": STAGE}, values={"source_system": ("CRM",)}),
    _contract("metrics_company_financials_trend",
              required=["company_id", "company_name", "period_end_date", "period_year",
                        "period_quarter", "source_system"],
              refs={"company_id": COMPANY, "fund_id": FUND}, values={"source_system": ("PM",)}),
    _contract("metrics_investment_activity_monthly",
              required=["fund_id", "fund_name", "activity_month", "activity_year",
                        "activity_quarter", "transaction_type", "transaction_count",
                        "total_amount_usd", "source_systems"],
              refs={"fund_id": FUND}, values={"transaction_type": vocab.ACTIVITY_TYPES}),
    _contract("metrics_loan_portfolio_summary",
              required=["fund_id", "fund_name", "maturity_year", "loan_count",
                        "total_commitment_usd", "total_outstanding_usd", "source_system",
                        "as_of_date"],
              refs={"fund_id": FUND}, values={"source_system": ("PM",)}),
    _contract("metrics_position_performance",
              required=["instrument_id", "instrument_name", "instrument_type", "period_end_date",
                        "fund_id", "fund_name", "initial_investment_date",
                        "holding_period_years"],
              refs={"instrument_id": INSTRUMENT, "fund_id": FUND, "company_id": COMPANY}),
    _contract("metrics_returns_cashflows",
              required=["fund_id", "fund_name", "instrument_id", "instrument_name",
                        "cashflow_date", "cashflow_type", "cashflow_amount", "currency_code",
                        "direction", "signed_amount"],
              refs={"fund_id": FUND, "instrument_id": INSTRUMENT, "company_id": COMPANY,
                    "currency_code": CURRENCY},
              values={"cashflow_type": vocab.CASHFLOW_TYPES, "direction": vocab.DIRECTIONS}),
    _contract("metrics_fund_performance",
              required=["fund_id", "fund_name", "period_end_date", "fund_nav",
                        "total_commitments", "total_called_capital",
                        "number_of_portfolio_companies", "number_of_positions",
                        "lines_of_credit_outstanding", "period_net_flows", "as_of_date"],
              refs={"fund_id": FUND},
              more=[*[null_for_fund_type(c, vocab.CREDIT) for c in ("dpi", "rvpi", "tvpi")],
                    *[null_for_fund_type(c, vocab.EQUITY) for c in (
                        "total_exposure", "principal_outstanding", "undrawn_commitment")],
                    *_VARIANCES]),
    _contract("metrics_company_performance",
              required=["company_id", "company_name", "period_end_date"],
              refs={"company_id": COMPANY}),
    _contract("metrics_portfolio_overview", unique=["period_end_date"],
              required=["period_end_date", "total_nav", "total_commitments",
                        "total_called_capital", "total_unfunded_commitment",
                        "total_distributions", "number_of_funds", "number_of_companies",
                        "number_of_positions", "net_cash_contributions_period", "as_of_date"]),
]

CONTRACTS: dict[str, list[Rule]] = {rules[0].table: rules for rules in _CONTRACT_LIST}


# --- rules stated in prose ---------------------------------------------------

def _key(table: str, *columns: str) -> UniqueRule:
    return UniqueRule(table, "unique_key", ", ".join(columns), keys=columns)


def _never(table: str, check: str, column: str, failing: str) -> RowRule:
    return RowRule(table, check, column, failing=failing)


def _positive_rate(table: str) -> RowRule:
    return _never(table, "fx_rate_positive", "fx_rate", "fx_rate <= 0")


def _not_negative(table: str, *columns: str) -> list[Rule]:
    return [_never(table, "not_negative", c, f"{c} < 0") for c in columns]


def _bridge(table: str, entity: str, code: str, allocated: bool = True) -> list[Rule]:
    rules: list[Rule] = [
        OverlapRule(table, "no_overlap", f"{entity}, {code}", keys=(entity, code)),
        SinglePrimaryRule(table, "single_primary", entity, key=entity),
        _key(table, entity, code, "valid_from")]
    if allocated:
        rules.append(_allocation(table))
    return rules


def _allocation(table: str) -> RowRule:
    return _never(table, "allocation_range", "allocation_pct",
                  "allocation_pct < 0 or allocation_pct > 100")


_SNAPSHOT_KEY = ("period_end_date", "reporting_basis", "snapshot_source")

_NOTED_LIST: list[Rule] = [
    _key("fct_fund_snapshots", "fund_id", *_SNAPSHOT_KEY),
    _key("fct_company_valuations", "company_id", "period_end_date", "valuation_type",
         "reporting_basis", "snapshot_source"),
    _key("fct_company_financials", "company_id", *_SNAPSHOT_KEY),
    _key("fct_instrument_snapshots", "instrument_id", *_SNAPSHOT_KEY),
    _key("fct_commitment_snapshots", "commitment_id", *_SNAPSHOT_KEY),
    _key("dim_commitments", "fund_id", "investor_id"),
    _key("dim_share_classes", "company_id", "name"),
    _key("dim_instruments_credit", "facility_id", "tranche_label"),
    _key("br_opportunity_countries", "opportunity_id", "country_code"),
    _key("br_opportunity_industries", "opportunity_id", "industry_id"),
    # Declared grains; the cash-flow mart's key does not identify its rows.
    _key("metrics_fund_performance", "fund_id", "period_end_date"),
    _key("metrics_position_performance", "instrument_id", "period_end_date"),
    _key("metrics_company_performance", "company_id", "period_end_date"),
    _key("metrics_pipeline_by_stage", "fund_id", "stage_id"),
    _key("metrics_company_financials_trend", "company_id", "period_end_date"),
    _key("metrics_investment_activity_monthly", "fund_id", "activity_month", "transaction_type"),
    _key("metrics_loan_portfolio_summary", "fund_id", "maturity_year"),
    *_bridge("br_instrument_countries", "instrument_id", "country_code"),
    *_bridge("br_instrument_industries", "instrument_id", "industry_id"),
    *_bridge("br_company_countries", "company_id", "country_code"),
    *_bridge("br_company_industries", "company_id", "industry_id", allocated=False),
    _allocation("br_opportunity_countries"),
    *[_positive_rate(t) for t in (
        "fct_instrument_snapshots", "fct_instrument_cashflows", "fct_transactions",
        "dim_instruments_equity", "dim_instruments_credit")],
    _never("fct_instrument_cashflows", "not_negative", "amount", "amount < 0 and not non_cash"),
    *_not_negative("fct_transactions", "amount"),
    *_not_negative("dim_instruments_equity", "initial_cost"),
    *_not_negative("dim_instruments_credit", "commitment_amount"),
    *_not_negative("fct_instrument_snapshots_credit", "principal_outstanding",
                   "undrawn_commitment", "accrued_interest", "accrued_fees"),
    _never("dim_instruments_equity", "ownership_range", "initial_ownership_pct",
           "initial_ownership_pct < 0 or initial_ownership_pct > 1"),
    _never("fct_transactions", "single_domain", "investor_id, facility_id, instrument_id",
           "(case when investor_id is not null then 1 else 0 end)"
           " + (case when facility_id is not null then 1 else 0 end)"
           " + (case when instrument_id is not null then 1 else 0 end) > 1"),
]

NOTED: dict[str, list[Rule]] = {}
for _rule in _NOTED_LIST:
    NOTED.setdefault(_rule.table, []).append(_rule)

CHECKED_TABLES = tuple(CONTRACTS)


def rules_for(table: str) -> list[Rule]:
    return [*CONTRACTS.get(table, []), *NOTED.get(table, [])]
