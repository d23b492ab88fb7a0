"""Marts on random, untidy inputs against the SQL oracle.

The sample inputs are regular; these are not: missing dates, amounts and rates,
several snapshots per period, dominant keys, dangling references, repeated and
overlapping links, companies held through several instruments.
"""

import datetime as dt
import random

import duckdb
import pytest

import verification.expected as expected
from carrymark.queries import all_queries, comparable
from carrymark.sources.catalog import Catalog
from carrymark.sources.sample_columns import SAMPLE_AS_OF
from carrymark.sources.schemas import INPUTS
from conftest import frame
from verification.compare import difference
from verification.marts import BLOCKS as SQL_BLOCKS
from verification.relations import MODELS

NEEDS_FILES = {"staged_companies", "shifted_dates"}
QUARTERS = [dt.date(1997 + q // 4, 3 * (q % 4) + 3, (31, 30, 30, 31)[q % 4]) for q in range(8)]
ODD_DATES = [dt.date(1997, 2, 14), dt.date(1998, 7, 1)]


def make(seed):
    rng = random.Random(seed)
    funds, companies, instruments = 4, 6, 40

    def some(value, missing=0.15):
        return None if rng.random() < missing else value

    def hot(prefix, n):
        """The first key takes a third of the rows; a few keys point nowhere."""
        return f"{prefix}{0 if rng.random() < 1 / 3 else rng.randrange(n + 1)}"

    def day(first=dt.date(1996, 1, 1), span=1200):
        return first + dt.timedelta(days=rng.randrange(span))

    def money(top=100_000):
        return rng.randrange(-top // 10, top) / 100

    def validity(missing_start=0.0):
        start = day(span=400)
        end = start + dt.timedelta(days=rng.randrange(900))
        return dict(valid_from=some(start, missing_start), valid_to=some(end, 0.4))

    def tens():
        # Two such shares of a converted amount end within the six compared decimals.
        return 10 * rng.randrange(11)

    def rate():
        return rng.choice([None, 1, 1.1, 1.25])

    kinds = {i: rng.choice(["EQUITY", "CREDIT"]) for i in range(instruments)}
    periods = QUARTERS + ODD_DATES
    fund_periods = [(f, p) for f in range(funds) for p in periods if rng.random() < 0.8]
    fund_periods += rng.sample(fund_periods, 5)
    company_periods = [(c, p) for c in range(companies) for p in QUARTERS if rng.random() < 0.8]
    flow_types = ["INVESTMENT", "DIVIDEND", "EXIT_PROCEEDS", "RETURN_OF_CAPITAL", "FEE", "DRAW",
                  "PRINCIPAL", "INTEREST", "PREPAYMENT", "OTHER", "PURCHASE", "CONTRIBUTION"]
    rows = {
        "int_funds_unified": [
            dict(fund_id=f"F{i}", name=f"Fund {i}", type=rng.choice(["EQUITY", "CREDIT"]),
                 vintage=1990 + i, base_currency_code="USD") for i in range(funds)],
        "int_companies_unified": [
            dict(company_id=f"C{i}", name=f"Company {i}") for i in range(companies)],
        "int_instruments_unified": [
            dict(instrument_id=f"I{i}", fund_id=hot("F", funds), company_id=some(hot("C", companies)),
                 name=f"Instrument {i}", instrument_type=kinds[i], inception_date=some(day()),
                 termination_date=some(day(), 0.5)) for i in range(instruments)],
        "int_instruments_equity_curated": [
            dict(instrument_id=f"I{i}", initial_cost_converted=some(abs(money())),
                 initial_ownership_pct=0.25)
            for i in kinds if kinds[i] == "EQUITY" and rng.random() < 0.8],
        "int_instruments_credit_curated": [
            dict(instrument_id=f"I{i}", commitment_amount_converted=some(rng.choice([0, 500])),
                 maturity_date=some(day(dt.date(1999, 1, 1))), spread_bps=some(rng.randrange(900)),
                 fixed_rate_pct=some(6.5, 0.5), security_rank=rng.choice([None, "PIK", "MEZZANINE"]))
            for i in kinds if kinds[i] == "CREDIT" and rng.random() < 0.8],
        "int_fund_snapshots_curated": [
            dict(fund_snapshot_id=f"S{n}", fund_id=f"F{f}", period_end_date=p,
                 committed_capital=some(5000 + n), called_capital=some(rng.choice([0, 100 + n])),
                 total_distributions=some(50 + n), cash_amount=some(money()),
                 total_interest_income=some(7), nav_amount_converted=some(money()),
                 expected_coc=1.5)
            for n, (f, p) in enumerate(fund_periods)],
        "int_instrument_snapshots_curated": [
            dict(instrument_snapshot_id=f"N{n:04}", instrument_id=hot("I", instruments),
                 period_end_date=rng.choice(periods), fx_rate=rate(), fair_value=some(money()),
                 principal_outstanding=some(money(), 0.3), undrawn_commitment=some(money(), 0.4),
                 accrued_interest=some(money()), equity_stake_pct=some(0.5, 0.3))
            for n in range(250)],
        "int_instrument_cashflows_curated": [
            dict(instrument_cashflow_id=f"X{n}", instrument_id=hot("I", instruments),
                 instrument_cashflow_type=rng.choice(flow_types),
                 date=some(rng.choice([day(), rng.choice(periods)]), 0.05),
                 amount_converted=some(money(), 0.1), currency_code="USD", fx_rate=rate())
            for n in range(600)],
        "ref_countries": [dict(iso2=c, name=f"Land {c}", region=some("R" + c[0]))
                          for c in ("AA", "AB", "BA", "BB")],
        "stg_ref__industries": [dict(industry_id=i, canonical_name=f"Industry {i}") for i in "xyz"],
        "stg_crm__stages": [
            dict(stage_id=str(n), name=name, stage_order=order) for n, (name, order) in enumerate([
                ("Declined", 0), ("Screening", 1), ("Diligence", 20), ("Parallel", 20),
                ("Committee", 300), ("Committed", 400), ("Unordered", None)])],
    }
    rows["int_instrument_countries_mapped"] = [
        dict(instrument_id=hot("I", instruments), country_code=rng.choice(["AA", "AB", "BA", "ZZ"]),
             **validity(), allocation_pct=some(tens(), 0.4), primary_flag=rng.random() < 0.5)
        for _ in range(60)]
    rows["int_instrument_industries_mapped"] = [
        dict(instrument_id=hot("I", instruments), industry_id=rng.choice("xyzw"),
             **validity(0.3), allocation_pct=some(tens(), 0.4), primary_flag=rng.random() < 0.5)
        for _ in range(60)]
    rows["int_company_countries_mapped"] = [
        dict(company_id=hot("C", companies), country_code=rng.choice(["AA", "AB", "BA", "ZZ"]),
             **validity(), primary_flag=some(rng.random() < 0.7)) for _ in range(20)]
    rows["int_company_industries_mapped"] = [
        dict(company_id=hot("C", companies), industry_id=rng.choice("xyzw"), **validity(),
             primary_flag=some(rng.random() < 0.7)) for _ in range(20)]
    rows["int_company_financials_curated"] = [
        dict(company_performance_snapshot_id=f"R{n}", company_id=f"C{c}", period_end_date=p,
             revenue=some(rng.choice([0, money()])), ebitda=some(money()), net_income=some(money()),
             cash=some(money()), total_liabilities=some(money()), currency_code="USD")
        for n, (c, p) in enumerate(company_periods)]
    rows["int_company_valuations_curated"] = [
        dict(company_valuation_id=f"V{n}", company_id=f"C{c}", period_end_date=p, amount=money(),
             valuation_type=rng.choice(["ACTUAL", "ACTUAL", "FORECAST"]))
        for n, (c, p) in enumerate(company_periods)]
    rows["int_opportunities_curated"] = [
        dict(opportunity_id=f"O{n}", fund_id=hot("F", funds), stage_id=str(rng.randrange(8)),
             amount=some(abs(money())), close_date=some(day(dt.date(1997, 6, 1))),
             created_at=dt.datetime(1997, 1, 1) + dt.timedelta(days=rng.randrange(500)))
        for n in range(120)]
    rows["int_opportunity_countries_curated"] = [
        dict(opportunity_id=hot("O", 120), country_code=rng.choice(["AA", "AB", "ZZ"]),
             allocation_pct=some(tens(), 0.4)) for _ in range(150)]
    rows["int_opportunity_industries_curated"] = [
        dict(opportunity_id=hot("O", 120), industry_id=rng.choice("xyw"),
             primary_flag=some(rng.random() < 0.5, 0.4)) for _ in range(150)]
    rows["int_commitments_curated"] = [
        dict(commitment_id=f"K{n}", fund_id=hot("F", funds), investor_id=f"V{n}",
             original_amount=some(abs(money()))) for n in range(30)]
    rows["int_transactions_classified"] = [
        dict(transaction_id=f"T{n}", transaction_type=rng.choice(
            ["DRAWDOWN", "DISTRIBUTION", "EXPENSE", "DIVIDEND"]), fund_id=hot("F", funds),
             amount_converted=some(abs(money())), date=day(), source=rng.choice(["ADMIN", "ACC"]))
        for n in range(200)]
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def world(request, spark, tmp_path_factory):
    """The same random inputs as a Spark catalog and as DuckDB views."""
    root, rows = tmp_path_factory.mktemp(f"world{request.param}"), make(request.param)
    con = duckdb.connect()
    for name in INPUTS:
        frame(spark, name, rows.get(name, [])).write.parquet(str(root / name))
        con.execute(f"create view {name} as select * from read_parquet('{root / name}/*.parquet')")
    return Catalog.from_parquet(spark, str(root), as_of=SAMPLE_AS_OF), con


@pytest.fixture(scope="module")
def oracle():
    """Oracle text that reads the inputs as stored tables."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(expected, "RELATIONS", {**MODELS, **SQL_BLOCKS})
        return expected.expected_sql()


QUERIES = {n: q for n, q in all_queries().items() if n not in NEEDS_FILES}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle_on_untidy_inputs(world, oracle, name):
    catalog, con = world
    assert difference(con, comparable(QUERIES[name](catalog)), oracle[name]) is None
