from decimal import Decimal

import pytest

from carrymark.operators.reporting import SnapshotPolicy
from carrymark.plans import fund
from conftest import day, records

Q1, Q2, Q3 = "2020-03-31", "2020-06-30", "2020-09-30"


def instrument(i, fund_id="A", company="X", kind="EQUITY", start="2019-01-01", end=None):
    return dict(instrument_id=i, fund_id=fund_id, company_id=company, instrument_type=kind,
                name=i, inception_date=start, termination_date=end)


def flow(i, kind, date, amount):
    return dict(instrument_id=i, instrument_cashflow_type=kind, date=date, amount_converted=amount)


def fund_snapshot(period, fund_id="A", **more):
    return dict(fund_snapshot_id=f"{fund_id}{period}{more.get('reporting_basis', '')}",
                fund_id=fund_id, period_end_date=period, **more)


FUNDS = [dict(fund_id="A", name="Alpha", type="EQUITY"), dict(fund_id="C", name="Gamma", type="CREDIT")]


def test_flow_on_the_period_end_counts_and_earlier_periods_are_null(tables):
    catalog = tables(
        int_fund_snapshots_curated=[fund_snapshot(p) for p in (Q1, Q2, Q3)],
        int_instruments_unified=[instrument("i")],
        int_instrument_cashflows_curated=[
            flow("i", "DIVIDEND", Q2, 10), flow("i", "EXIT_PROCEEDS", "2020-07-01", 5),
            flow("i", "FEE", Q1, 99), flow("i", "DIVIDEND", None, 1000)])
    got = records(fund.cumulative_flows(catalog, "distributions", "paid"), "period_end_date")
    assert [got[day(p)]["paid"] for p in (Q1, Q2, Q3)] == [None, Decimal(10), Decimal(15)]


def test_repeated_period_counts_each_flow_per_snapshot(tables):
    rows = [fund_snapshot(Q1, reporting_basis=b, snapshot_source="ADMIN", committed_capital=c)
            for b, c in (("AUDITED", 7), ("MANAGEMENT", 8))]
    catalog = tables(
        int_funds_unified=FUNDS, int_fund_snapshots_curated=rows,
        int_instruments_unified=[instrument("i")],
        int_instrument_cashflows_curated=[flow("i", "INVESTMENT", "2020-01-01", 10)])
    got = records(fund.cumulative_flows(catalog, "called", "called"), "period_end_date")
    assert got[day(Q1)]["called"] == Decimal(20)
    assert [r.called_capital_calculated for r in fund.fund_performance(catalog).collect()] == [20, 20]
    catalog.policy = SnapshotPolicy(bases=("MANAGEMENT", "AUDITED"))
    preferred = fund.fund_performance(catalog).collect()
    assert [(r.total_commitments, r.called_capital_calculated) for r in preferred] == [(8, 10)]


def test_funds_without_the_instrument_type_have_no_row(tables):
    catalog = tables(
        int_fund_snapshots_curated=[fund_snapshot(Q1), fund_snapshot(Q1, "C")],
        int_instruments_unified=[instrument("i"), instrument("k", "C", kind="CREDIT")])
    assert list(records(fund.cumulative_flows(catalog, "interest", "x"), "fund_id")) == ["C"]
    assert list(records(fund.cumulative_flows(catalog, "called", "x"), "fund_id")) == ["A"]


def test_company_counts_merge_overlapping_holdings(tables):
    catalog = tables(
        int_fund_snapshots_curated=[
            fund_snapshot(p) for p in ("2018-12-31", Q1, Q2, Q3, "2020-12-31", None)],
        int_instruments_unified=[
            instrument("a", company="X", start="2019-01-01", end=Q2),      # ends on Q2: gone then
            instrument("b", company="X", start="2019-06-01", end="2020-05-01"),
            instrument("c", company="X", start=Q3, end=None),              # starts on Q3: counts
            instrument("d", company="Y", start=None),                      # never active
            instrument("e", company="Y", start="2020-01-01", end="2019-01-01"),
            instrument("f", company=None, start="2019-01-01"),
            instrument("g", company="Z", start="2020-04-01", end="2020-10-01"),
            instrument("h", company="Z", start="2020-10-01", end=None)])   # touching intervals
    got = records(fund.portfolio_company_counts(catalog), "period_end_date")
    counts = {str(k): v["number_of_portfolio_companies"] for k, v in got.items()}
    assert counts == {"2018-12-31": 0, Q1: 1, Q2: 1, Q3: 2, "2020-12-31": 2, "None": 0}


def test_credit_fund_has_no_nav_and_no_multiples(tables):
    catalog = tables(
        int_funds_unified=FUNDS,
        int_fund_snapshots_curated=[fund_snapshot(
            Q1, "C", nav_amount_converted=100, called_capital=50, total_distributions=10,
            committed_capital=80, total_interest_income=3)],
        int_instruments_unified=[instrument("k", "C", kind="CREDIT")],
        int_instrument_cashflows_curated=[flow("k", "INTEREST", "2020-02-01", 4)])
    row = fund.fund_performance(catalog).collect()[0]
    assert (row.fund_nav, row.fund_nav_reported, row.fund_nav_calculated) == (None, None, None)
    assert (row.dpi, row.rvpi, row.tvpi) == (None, None, None)
    assert row.interest_income == 4 and row.called_capital_variance == 0
    assert row.unfunded_commitment == 30


def test_multiples_variances_and_zero_denominators(tables):
    catalog = tables(
        int_funds_unified=FUNDS,
        int_fund_snapshots_curated=[
            fund_snapshot(Q1, nav_amount_converted=90, called_capital=50, total_distributions=25,
                          cash_amount=10, committed_capital=100),
            fund_snapshot(Q2, called_capital=0, committed_capital=100)],
        int_instruments_unified=[instrument("i")],
        int_instrument_snapshots_curated=[
            dict(instrument_snapshot_id="s", instrument_id="i", period_end_date=Q1,
                 fair_value=40, fx_rate=2)],
        int_instrument_cashflows_curated=[flow("i", "INVESTMENT", "2020-01-01", 40)])
    got = records(fund.fund_performance(catalog), "period_end_date")
    first, second = got[day(Q1)], got[day(Q2)]
    assert first["fund_nav_calculated"] == 90 and first["nav_variance"] == 0
    assert (first["dpi"], first["rvpi"], first["tvpi"]) == (0.5, 1.8, 2.3)
    assert first["called_capital_variance_pct"] == pytest.approx(0.25)
    assert first["number_of_positions"] == 1
    assert second["tvpi"] is None and second["fund_nav_calculated"] == 0
    assert second["total_distributions"] is None


def test_period_flows_need_a_quarter_end_period(tables):
    catalog = tables(
        int_funds_unified=FUNDS,
        int_fund_snapshots_curated=[fund_snapshot("2020-02-29"), fund_snapshot(Q1)],
        int_instruments_unified=[instrument("i", kind="CREDIT")],
        int_instrument_cashflows_curated=[
            flow("i", "DRAW", "2020-01-15", 10), flow("i", "PRINCIPAL", "2020-03-01", 4),
            flow("i", "INVESTMENT", "2020-03-01", 100)])
    got = records(fund.fund_performance(catalog), "period_end_date")
    assert got[day("2020-02-29")]["period_net_flows"] == 0
    assert got[day(Q1)]["period_net_flows"] == 6


def test_peak_credit_runs_over_periods(tables):
    catalog = tables(
        int_funds_unified=FUNDS,
        int_fund_snapshots_curated=[fund_snapshot(p, "C") for p in (Q1, Q2, Q3)],
        int_instruments_unified=[instrument("k", "C", kind="CREDIT")],
        int_instrument_snapshots_curated=[
            dict(instrument_snapshot_id=p, instrument_id="k", period_end_date=p, fx_rate=1,
                 principal_outstanding=v) for p, v in ((Q1, 5), (Q2, 9), (Q3, 7))])
    got = records(fund.fund_performance(catalog), "period_end_date")
    assert [got[day(p)]["peak_outstanding_credit"] for p in (Q1, Q2, Q3)] == [5, 9, 9]
    assert [got[day(p)]["total_exposure"] for p in (Q1, Q2, Q3)] == [None] * 3
    assert [got[day(p)]["principal_outstanding"] for p in (Q1, Q2, Q3)] == [5, 9, 7]


def test_marts_run_on_todays_date(tables):
    catalog = tables(
        as_of=None, int_funds_unified=FUNDS, int_fund_snapshots_curated=[fund_snapshot(Q1)],
        int_instruments_unified=[instrument("i")],
        int_instrument_snapshots_curated=[dict(
            instrument_snapshot_id="s", instrument_id="i", period_end_date=Q1, fair_value=1)])
    today = catalog.spark.sql("select current_date()").first()[0]
    assert fund.fund_performance(catalog).first().as_of_date == today
    for name in ("metrics_portfolio_overview", "metrics_position_performance",
                 "metrics_pipeline_by_stage", "metrics_loan_portfolio_summary"):
        catalog.table(name).collect()
    months = catalog.table("metrics_exposure_timeseries").collect()
    assert len(months) == 13 and months[0].exposure_month == today.replace(day=1)
