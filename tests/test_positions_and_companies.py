import pytest

from carrymark.operators.reporting import SnapshotPolicy
from carrymark.plans import fund
from carrymark.plans.company import company_performance
from carrymark.plans.portfolio import portfolio_overview
from carrymark.plans.position import position_performance
from carrymark.plans.summaries import company_financials_trend, loan_portfolio_summary
from conftest import day, records

FUNDS = [dict(fund_id="A", name="Alpha", type="EQUITY"), dict(fund_id="B", name="Beta", type="EQUITY")]


def instrument(i, kind="EQUITY", fund="A", **more):
    return dict(instrument_id=i, fund_id=fund, company_id="X", name=i, instrument_type=kind,
                inception_date="2018-06-15", **more)


def snapshot(i, period, n=0, **more):
    return dict(instrument_snapshot_id=f"{i}{period}{n}", instrument_id=i, period_end_date=period,
                fx_rate=1, **more)


def test_equity_position(tables):
    catalog = tables(
        as_of="2020-06-15", int_funds_unified=FUNDS,
        int_instruments_unified=[instrument("e"), instrument("z"), instrument("none"),
                                 instrument("w", fund="unknown")],
        int_instruments_equity_curated=[
            dict(instrument_id="e", initial_cost_converted=100, initial_ownership_pct=0.5),
            dict(instrument_id="z", initial_cost_converted=0)],
        int_instrument_snapshots_curated=[
            snapshot("e", "2019-12-31", fair_value=1, equity_stake_pct=0.4),
            snapshot("e", "2020-03-31", fair_value=300),
            snapshot("z", "2020-03-31", fair_value=5), snapshot("w", "2020-03-31", fair_value=5)],
        int_instrument_cashflows_curated=[
            dict(instrument_id="e", instrument_cashflow_type=t, amount_converted=a)
            for t, a in (("DIVIDEND", 60), ("EXIT_PROCEEDS", 40), ("FEE", 7), ("INVESTMENT", 100))])
    got = records(position_performance(catalog), "instrument_id")
    assert set(got) == {"e", "z"}  # no snapshot, or no known fund: no row
    e = got["e"]
    assert (e["realized_proceeds"], e["fair_value"], e["moic"]) == (100, 300, 4.0)
    assert e["period_end_date"] == day("2020-03-31") and float(e["ownership_pct_current"]) == 0.4
    assert e["holding_period_years"] == pytest.approx(731 / 365.25)
    assert e["equity_irr_approx"] == pytest.approx(4 ** (365.25 / 731) - 1)
    assert e["drawn_amount"] is None and e["all_in_yield"] is None
    assert got["z"]["moic"] is None and got["z"]["equity_irr_approx"] is None


def test_credit_position(tables):
    catalog = tables(
        as_of="2020-06-15", int_funds_unified=FUNDS, int_instruments_unified=[
            instrument("c", "CREDIT"), instrument("q", "CREDIT")],
        int_instruments_credit_curated=[dict(
            instrument_id="c", commitment_amount_converted=200, maturity_date="2020-06-25",
            spread_bps=550, interest_index="SOFR")],
        int_instrument_snapshots_curated=[
            snapshot("c", "2019-12-31", principal_outstanding=50, undrawn_commitment=9),
            snapshot("c", "2020-03-31"), snapshot("q", "2020-03-31")],
        int_instrument_cashflows_curated=[
            dict(instrument_id="c", instrument_cashflow_type=t, amount_converted=a)
            for t, a in (("DRAW", 80), ("PRINCIPAL", 20), ("PREPAYMENT", 10), ("INTEREST", 3))])
    got = records(position_performance(catalog), "instrument_id")
    c = got["c"]
    assert (c["drawn_amount"], c["principal_repaid"], c["interest_income"]) == (50, 30, 3)
    # The newest snapshot reports no principal; the credit values come from an older one.
    assert c["period_end_date"] == day("2020-03-31") and c["principal_outstanding"] == 50
    assert (c["utilization_rate"], c["days_to_maturity"], c["maturity_year"]) == (0.25, 10, 2020)
    assert c["all_in_yield"] == pytest.approx(0.055) and c["moic"] is None
    q = got["q"]
    assert q["drawn_amount"] == 0 and q["principal_outstanding"] is None
    assert q["utilization_rate"] is None


def company_rows(**more):
    base = dict(
        int_companies_unified=[dict(company_id="X", name="Xco")],
        int_company_financials_curated=[
            dict(company_performance_snapshot_id=p, company_id="X", period_end_date=p,
                 revenue=r, ebitda=e, cash=1, total_liabilities=5)
            for p, r, e in (("2020-03-31", 100, 20), ("2020-06-30", 0, 0), ("2020-09-30", 50, -5))])
    return {**base, **more}


def test_company_ratios_guard_zero(tables):
    catalog = tables(**company_rows(int_company_valuations_curated=[
        dict(company_valuation_id=i, company_id="X", period_end_date="2020-03-31", amount=a,
             valuation_type=t)
        for i, a, t in (("2", 900, "ACTUAL"), ("1", 400, "ACTUAL"), ("0", 7, "FORECAST"))]))
    got = records(company_performance(catalog), "period_end_date")
    first, zero = got[day("2020-03-31")], got[day("2020-06-30")]
    assert (first["enterprise_value"], first["ev_to_ebitda"], first["ev_to_revenue"]) == (400, 20, 4)
    assert first["ebitda_margin"] == pytest.approx(20) and first["net_debt"] == 4
    assert zero["ebitda_margin"] is None and zero["ev_to_revenue"] is None


def test_primary_country_choice_and_validity(tables):
    catalog = tables(**company_rows(
        ref_countries=[dict(iso2="DE", name="Germany"), dict(iso2="AT", name="Austria"),
                       dict(iso2="BE", name="Belgium")],
        int_company_countries_mapped=[
            dict(company_id="X", country_code="DE", primary_flag=True, valid_from="2020-05-01"),
            dict(company_id="X", country_code="AT", primary_flag=True, valid_from="2020-01-01",
                 valid_to="2020-06-30"),
            dict(company_id="X", country_code="BE", primary_flag=False, valid_from="2020-01-01")]))
    plain = records(company_performance(catalog), "period_end_date")
    assert {v["primary_country"] for v in plain.values()} == {"Austria"}
    dated = records(company_performance(catalog, as_of_period=True), "period_end_date")
    assert [dated[day(d)]["primary_country"] for d in ("2020-03-31", "2020-06-30", "2020-09-30")] == [
        "Austria", "Austria", "Germany"]


def test_trend_growth_and_primary_fund(tables):
    catalog = tables(**company_rows(
        int_funds_unified=FUNDS,
        int_instruments_unified=[instrument("a"), instrument("b", fund="B")],
        int_instrument_snapshots_curated=[
            snapshot("a", "2020-03-31", fair_value=10), snapshot("b", "2020-03-31", fair_value=10)]))
    got = records(company_financials_trend(catalog), "period_end_date")
    assert [got[day(d)]["revenue_growth_pct"] for d in ("2020-03-31", "2020-06-30", "2020-09-30")] == [
        None, -100.0, None]
    assert {v["fund_id"] for v in got.values()} == {"A"}  # tie on exposure


def test_overview_flow_bucket(tables):
    catalog = tables(
        int_funds_unified=FUNDS, int_instruments_unified=[instrument("a")],
        int_fund_snapshots_curated=[
            dict(fund_snapshot_id=p, fund_id="A", period_end_date=p, committed_capital=10)
            for p in ("2020-03-31", "2020-04-01")],
        int_instrument_cashflows_curated=[
            dict(instrument_id="a", instrument_cashflow_type=t, amount_converted=a, date=d)
            for t, a, d in (("INVESTMENT", 30, "2020-02-01"), ("FEE", 5, "2020-03-31"),
                            ("DIVIDEND", 4, "2020-05-01"))])

    def flows(bucket):
        return {str(k): v["net_cash_contributions_period"] for k, v in
                records(portfolio_overview(catalog, flow_bucket=bucket), "period_end_date").items()}

    assert flows("start") == {"2020-03-31": 0, "2020-04-01": -4}
    assert flows("end") == {"2020-03-31": 25, "2020-04-01": 0}


def test_loan_summary_weights_by_outstanding(tables):
    catalog = tables(
        int_funds_unified=FUNDS,
        int_instruments_unified=[instrument(i, "CREDIT") for i in ("a", "b", "c")],
        int_instruments_credit_curated=[
            dict(instrument_id="a", maturity_date="2025-01-01", spread_bps=100, fixed_rate_pct=6,
                 commitment_amount_converted=100),
            dict(instrument_id="b", maturity_date="2025-12-31", spread_bps=300,
                 commitment_amount_converted=100),
            dict(instrument_id="c", maturity_date="2025-12-31", spread_bps=9999)],
        int_instrument_snapshots_curated=[
            snapshot("a", "2020-03-31", principal_outstanding=30),
            snapshot("b", "2020-03-31", principal_outstanding=10)])
    row = loan_portfolio_summary(catalog).collect()[0]
    assert (row.loan_count, row.total_outstanding_usd, row.utilization_pct) == (3, 40, 20.0)
    assert row.weighted_avg_rate_pct == pytest.approx((6 * 30 + 3 * 10) / 40)
    assert row.weighted_avg_spread_bps == pytest.approx(150)


def test_policy_picks_one_of_several_snapshots(tables):
    catalog = tables(
        int_funds_unified=FUNDS, int_instruments_unified=[instrument("e")],
        int_instrument_snapshots_curated=[
            snapshot("e", "2020-03-31", n, fair_value=v, reporting_basis=b, snapshot_source=s)
            for n, (v, b, s) in enumerate([
                (1, "ESTIMATE", "ADMIN"), (2, "AUDITED", "INTERNAL"), (4, "AUDITED", "ADMIN"),
                (8, "AUDITED", "ADMIN"), (16, None, None)])])
    everything = fund.instrument_valuations(catalog).first()
    assert everything.total_instrument_fair_value == 31
    catalog.policy = SnapshotPolicy(bases=("AUDITED",), sources=("ADMIN", "INTERNAL"))
    assert fund.instrument_valuations(catalog).first().total_instrument_fair_value == 4
    assert position_performance(catalog).first().fair_value == 4
