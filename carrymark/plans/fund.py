"""Fund performance: one row per fund and reporting period."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window, functions as F

from carrymark.functions.dates import clock, quarter_end
from carrymark.functions.money import ratio, sum_when
from carrymark.functions.vocab import (
    CREDIT, CUMULATIVE_CALLED, CUMULATIVE_DISTRIBUTIONS, EQUITY, INTEREST,
    PERIOD_CONTRIBUTIONS, PERIOD_DISTRIBUTIONS)
from carrymark.operators.snapshots import period_positions
from carrymark.operators.timeline import presence_changes, totals_to_date

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

GRAIN = ["fund_id", "period_end_date"]


def _is(kind: str, column: str = "instrument_type") -> Column:
    return F.col(column) == kind


def _fund_snapshots(catalog: Catalog) -> DataFrame:
    return catalog.preferred(catalog.table("fct_fund_snapshots"), "fund_id", "fund_snapshot_id")


# --- snapshot side -----------------------------------------------------------

def instrument_valuations(catalog: Catalog) -> DataFrame:
    """Converted fair value of equity instruments."""
    return (period_positions(catalog).where(_is(EQUITY)).groupBy(*GRAIN)
            .agg(F.sum("fair_value").alias("total_instrument_fair_value")))


def _positions() -> Column:
    return F.count_if((_is(EQUITY) & F.col("has_value")) | (_is(CREDIT) & F.col("has_principal")))


def position_counts(catalog: Catalog) -> DataFrame:
    """Instruments with exposure: equity by fair value, credit by principal."""
    return (period_positions(catalog).groupBy(*GRAIN)
            .agg(_positions().alias("number_of_positions")))


def credit_exposure(catalog: Catalog) -> DataFrame:
    credit = period_positions(catalog).where(_is(CREDIT) & F.col("has_credit"))
    return credit.groupBy(*GRAIN).agg(
        F.sum("principal").alias("total_principal_outstanding"),
        F.sum("undrawn").alias("total_undrawn_commitment"),
    ).withColumns({
        "lines_of_credit_outstanding": F.col("total_principal_outstanding"),
        "total_credit_exposure":
            F.col("total_principal_outstanding") + F.col("total_undrawn_commitment"),
    })


def _snapshot_totals(catalog: Catalog) -> DataFrame:
    """The three aggregates above in one pass over the snapshots."""
    credit = _is(CREDIT)
    return period_positions(catalog).groupBy(*GRAIN).agg(
        sum_when(_is(EQUITY), F.col("fair_value")).alias("instrument_fair_value"),
        _positions().alias("positions"),
        sum_when(credit, F.col("principal")).alias("principal"),
        sum_when(credit, F.col("undrawn")).alias("undrawn"))


# --- cash-flow side ----------------------------------------------------------

def _flow_type(types: tuple[str, ...]) -> Column:
    return F.col("instrument_cashflow_type").isin(*types)


def _net_flow() -> Column:
    amount = F.col("amount_converted")
    return F.sum(F.when(_flow_type(PERIOD_CONTRIBUTIONS), amount)
                 .when(_flow_type(PERIOD_DISTRIBUTIONS), -amount)
                 .otherwise(F.lit(0)))


def _owned_flows(catalog: Catalog, *types: str) -> DataFrame:
    """Flows, of the given types if any, with their fund and instrument type.

    They are summed by instrument, type and day before they meet their instrument, so
    that an instrument with very many flows is no hot join partition.
    """
    owners = catalog.table("dim_instruments").select("instrument_id", "fund_id", "instrument_type")
    flows = catalog.table("fct_instrument_cashflows").select(
        "instrument_id", "instrument_cashflow_type", "date", "amount_converted")
    daily = (flows.where(_flow_type(types)) if types else flows).groupBy(
        "instrument_id", "instrument_cashflow_type", "date").agg(
        F.sum("amount_converted").alias("amount_converted"))
    return daily.join(owners, "instrument_id")


def period_net_flows(catalog: Catalog) -> DataFrame:
    """Contributions minus distributions per fund and calendar quarter."""
    return (_owned_flows(catalog)
            .groupBy("fund_id", quarter_end(F.col("date")).alias("period_end_date"))
            .agg(_net_flow().alias("period_net_flows")))


_TO_DATE = {
    "distributions": (EQUITY, CUMULATIVE_DISTRIBUTIONS),
    "called": (EQUITY, CUMULATIVE_CALLED),
    "interest": (CREDIT, INTEREST),
}


def _to_date_total(measure: str) -> Column:
    kind, types = _TO_DATE[measure]
    return sum_when(_is(kind) & _flow_type(types), F.col("amount_converted"))


def _markers(catalog: Catalog) -> DataFrame:
    """Reporting dates of each fund, with the number of snapshots on each."""
    return (_fund_snapshots(catalog)
            .groupBy("fund_id", F.col("period_end_date").alias("date"))
            .agg(F.count(F.lit(1)).alias("copies")))


def cumulative_flows(catalog: Catalog, measure: str, name: str) -> DataFrame:
    """Total of one cash-flow set up to each reporting date of a fund.

    Funds without an instrument of the set's type have no row. A date reported
    by several snapshots counts each flow once per snapshot.
    """
    kind, types = _TO_DATE[measure]
    daily = (_owned_flows(catalog, *types).groupBy("fund_id", "date")
             .agg(_to_date_total(measure).alias(measure)))
    holders = (catalog.table("dim_instruments").where(_is(kind))
               .select("fund_id").distinct())
    markers = _markers(catalog).join(holders, "fund_id", "left_semi")
    return totals_to_date(daily, markers, "fund_id", "date", [measure]).select(
        "fund_id", F.col("date").alias("period_end_date"),
        (F.col(measure) * F.col("copies")).alias(name))


def _company_changes(catalog: Catalog) -> DataFrame:
    return presence_changes(catalog.table("dim_instruments"), "fund_id", "company_id",
                            "inception_date", "termination_date", "date", "companies")


def portfolio_company_counts(catalog: Catalog) -> DataFrame:
    """Distinct companies with an active instrument on each reporting date."""
    counts = totals_to_date(_company_changes(catalog), _markers(catalog),
                            "fund_id", "date", ["companies"])
    return counts.select(
        "fund_id", F.col("date").alias("period_end_date"),
        F.coalesce("companies", F.lit(0)).alias("number_of_portfolio_companies"))


def _flow_totals(catalog: Catalog) -> DataFrame:
    """All date-dependent totals of a fund from one timeline.

    The cash flows are scanned once, without the types no total uses, and reduced
    to fund and day before anything is ordered, so a fund that owns most of the
    flows costs no more than its days.
    """
    used = {*PERIOD_CONTRIBUTIONS, *PERIOD_DISTRIBUTIONS,
            *(t for _, types in _TO_DATE.values() for t in types)}
    daily = _owned_flows(catalog, *sorted(used)).groupBy("fund_id", "date").agg(
        _net_flow().alias("net_flows"), *[_to_date_total(m).alias(m) for m in _TO_DATE])
    events = daily.unionByName(_company_changes(catalog), allowMissingColumns=True)
    at_dates = totals_to_date(
        events, _markers(catalog), "fund_id", "date", [*_TO_DATE, "companies"],
        within={"net_flows": quarter_end(F.col("date"))})
    return at_dates.select(
        "fund_id", F.col("date").alias("period_end_date"),
        *[(F.col(m) * F.col("copies")).alias(m) for m in _TO_DATE], "companies",
        F.when(F.col("date") == quarter_end(F.col("date")), F.col("net_flows")).alias("net_flows"))


# --- mart --------------------------------------------------------------------

def _variance(reported: str, calculated: str) -> dict[str, Column]:
    difference = F.col(reported) - F.col(calculated)
    return {"absolute": difference, "pct": ratio(difference, F.col(calculated))}


def fund_performance(catalog: Catalog) -> DataFrame:
    """NAV, capital, multiples and credit exposure, reported against calculated."""
    funds = catalog.table("dim_funds").select(
        "fund_id", F.col("name").alias("fund_name"), F.col("type").alias("fund_type"))
    reported = _fund_snapshots(catalog).select(
        "fund_id", "period_end_date", "committed_capital", "called_capital", "expected_coc",
        "cash_amount", "total_distributions", "total_interest_income", "nav_amount_converted")
    joined = (reported.join(funds, "fund_id")
              .join(_snapshot_totals(catalog), GRAIN, "left")
              .join(_flow_totals(catalog), GRAIN, "left"))

    of_credit, of_equity = _is(CREDIT, "fund_type"), _is(EQUITY, "fund_type")
    zero = F.lit(0)

    def unless_credit(value: Column) -> Column:
        return F.when(of_credit, None).otherwise(value)

    def unless_equity(value: Column) -> Column:
        return F.when(of_equity, None).otherwise(value)

    facts = joined.select(
        "fund_id", "fund_name", "fund_type", "period_end_date",
        unless_credit(F.col("nav_amount_converted")).alias("fund_nav_reported"),
        unless_credit(F.coalesce("instrument_fair_value", zero) + F.coalesce("cash_amount", zero))
        .alias("fund_nav_calculated"),
        F.col("committed_capital").alias("total_commitments"),
        F.col("called_capital").alias("called_capital_reported"),
        F.when(of_equity, F.col("called")).otherwise(F.col("called_capital"))
        .alias("called_capital_calculated"),
        F.col("total_distributions").alias("total_distributions_reported"),
        F.when(of_equity, F.col("distributions")).otherwise(F.col("total_distributions"))
        .alias("total_distributions_calculated"),
        (F.col("committed_capital") - F.col("called_capital")).alias("unfunded_commitment"),
        "expected_coc",
        F.coalesce("companies", zero).alias("number_of_portfolio_companies"),
        F.coalesce("positions", zero).alias("number_of_positions"),
        F.coalesce("principal", zero).alias("lines_of_credit_outstanding"),
        unless_equity(F.col("principal") + F.col("undrawn")).alias("total_exposure"),
        unless_equity(F.col("principal")).alias("principal_outstanding"),
        unless_equity(F.col("undrawn")).alias("undrawn_commitment"),
        F.when(of_credit, F.coalesce("interest", zero)).otherwise(F.col("total_interest_income"))
        .alias("interest_income"),
        F.coalesce("net_flows", zero).alias("period_net_flows"))

    primary = facts.withColumns({
        "fund_nav": F.coalesce("fund_nav_reported", "fund_nav_calculated"),
        "total_called_capital": F.coalesce("called_capital_reported", "called_capital_calculated"),
        "total_distributions":
            F.coalesce("total_distributions_reported", "total_distributions_calculated"),
    })
    nav = _variance("fund_nav_reported", "fund_nav_calculated")
    called = _variance("called_capital_reported", "called_capital_calculated")
    paid = _variance("total_distributions_reported", "total_distributions_calculated")
    invested = F.col("total_called_capital")
    multiples = {
        "dpi": unless_credit(ratio(F.col("total_distributions"), invested)),
        "rvpi": unless_credit(ratio(F.col("fund_nav"), invested)),
        "tvpi": unless_credit(ratio(F.col("fund_nav") + F.col("total_distributions"), invested)),
    }
    so_far = (Window.partitionBy("fund_id").orderBy(F.col("period_end_date").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return primary.select(
        "fund_id", "fund_name", "fund_type", "period_end_date",
        "fund_nav_reported", "fund_nav_calculated", "fund_nav",
        nav["absolute"].alias("nav_variance"), nav["pct"].alias("nav_variance_pct"),
        "total_commitments", "called_capital_reported", "called_capital_calculated",
        "total_distributions_reported", "total_distributions_calculated",
        "total_called_capital", "total_distributions",
        called["absolute"].alias("called_capital_variance"),
        called["pct"].alias("called_capital_variance_pct"),
        paid["absolute"].alias("distributions_variance"),
        paid["pct"].alias("distributions_variance_pct"),
        "unfunded_commitment",
        *[value.alias(f"{name}_calculated") for name, value in multiples.items()],
        *[value.alias(name) for name, value in multiples.items()],
        "expected_coc", "number_of_portfolio_companies", "number_of_positions",
        "lines_of_credit_outstanding",
        F.max("lines_of_credit_outstanding").over(so_far).alias("peak_outstanding_credit"),
        "total_exposure", "principal_outstanding", "undrawn_commitment", "interest_income",
        "period_net_flows", clock(catalog.as_of).alias("as_of_date"))
