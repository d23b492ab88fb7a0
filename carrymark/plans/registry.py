"""Every table the catalog can build, in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING, Literal

from pyspark.sql import DataFrame

from carrymark.plans import core
from carrymark.plans.cashflows import returns_cashflows
from carrymark.plans.company import company_performance
from carrymark.plans.exposure import exposure_timeseries
from carrymark.plans.fund import fund_performance
from carrymark.plans.portfolio import portfolio_overview
from carrymark.plans.position import position_performance
from carrymark.plans.summaries import (
    company_financials_trend, fund_performance_latest,
    investment_activity_monthly, loan_portfolio_summary, pipeline_by_stage)

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

Builder = Callable[["Catalog"], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """``grain`` names the columns of one row; it is declared, not enforced.

    ``order`` is what readers sort by who ask for an order; nothing is stored sorted.
    """

    name: str
    role: Literal["seed", "dimension", "fact", "bridge", "metrics", "helper"]
    build: Builder
    grain: tuple[str, ...] = ()
    stored_as: Literal["table", "view", "inline"] = "table"
    order: tuple[str, ...] = ()

    @property
    def namespace(self) -> str:
        return {"seed": "reference", "metrics": "metrics"}.get(self.role, "public")


_ROLES = {"dim": "dimension", "fct": "fact", "br": "bridge"}
_VIEWS = {"fct_commitment_snapshots", "fct_company_valuations", "fct_company_financials",
          "fct_fund_snapshots", "fct_instrument_cashflows", "fct_transactions"}

_SNAPSHOT_FACTS: dict[str, Builder] = {
    "fct_instrument_snapshots": core.instrument_snapshots,
    "fct_instrument_snapshots_credit": core.instrument_snapshots_credit,
    "fct_instrument_snapshots_equity": core.instrument_snapshots_equity,
}


def _core(name: str, build: Builder) -> TableSpec:
    return TableSpec(name, _ROLES[name.split("_")[0]], build,
                     stored_as="view" if name in _VIEWS else "table")


def _metrics(name: str, build: Builder, *grain: str, order: tuple[str, ...] = ()) -> TableSpec:
    return TableSpec(f"metrics_{name}", "metrics", build, grain, order=order)


def _seed(name: str, key: str) -> TableSpec:
    return TableSpec(name, "seed", lambda catalog: catalog.input(name), (key,))


_SPECS = [
    _seed("ref_countries", "iso2"),
    _seed("ref_currencies", "currency_code"),
    *[_core(n, p) for n, p in {**core.PROJECTIONS, **_SNAPSHOT_FACTS}.items()],
    TableSpec("int_expect_instruments_equity", "helper", core.expected_equity_instruments,
              ("instrument_id",), "inline"),
    TableSpec("int_expect_instruments_credit", "helper", core.expected_credit_instruments,
              ("instrument_id",), "inline"),
    _metrics("fund_performance", fund_performance, "fund_id", "period_end_date"),
    _metrics("returns_cashflows", returns_cashflows,
             "fund_id", "instrument_id", "cashflow_date", "cashflow_type"),
    _metrics("portfolio_overview", portfolio_overview, "period_end_date"),
    _metrics("position_performance", position_performance, "instrument_id", "period_end_date"),
    _metrics("company_performance", company_performance, "company_id", "period_end_date"),
    _metrics("exposure_timeseries", exposure_timeseries, order=(
        "fund_name", "instrument_type", "region", "country_name", "industry_name",
        "maturity_year", "security_rank", "stage_name", "exposure_month")),
    _metrics("fund_performance_latest", fund_performance_latest, "fund_id"),
    _metrics("pipeline_by_stage", pipeline_by_stage, "fund_id", "stage_id"),
    _metrics("company_financials_trend", company_financials_trend, "company_id", "period_end_date"),
    _metrics("investment_activity_monthly", investment_activity_monthly,
             "fund_id", "activity_month", "transaction_type"),
    _metrics("loan_portfolio_summary", loan_portfolio_summary, "fund_id", "maturity_year"),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}
