import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carrymark.functions.money import exact
from carrymark.plans import exposure
from carrymark.queries import all_queries
from carrymark.sources.sample_inputs import sample_catalog
from conftest import SMALL, day, records

STAGES = [dict(stage_id=str(o), name=n, stage_order=o) for o, n in (
    (1, "Screening"), (2, "Diligence"), (3, "Committee"), (4, "Committed"))] + [
    dict(stage_id="0", name="Declined", stage_order=0), dict(stage_id="9", name="Odd")]
FUNDS = [dict(fund_id="A", name="Alpha", type="EQUITY")]
COUNTRIES = [dict(iso2="DE", name="Germany", region="Europe"),
             dict(iso2="US", name="United States", region="Americas")]
INDUSTRIES = [dict(industry_id="sw", canonical_name="Software")]


def deal(i, stage, close, amount=100):
    return dict(opportunity_id=i, fund_id="A", stage_id=stage, amount=amount, close_date=close)


def test_deals_count_in_every_stage_they_reached(tables):
    catalog = tables(
        int_funds_unified=FUNDS, stg_crm__stages=STAGES,
        int_opportunities_curated=[
            deal("a", "3", "2020-07-20"), deal("b", "1", "2020-07-01", 5),
            deal("c", "0", "2020-07-01"), deal("d", "4", "2020-07-01"),
            deal("e", "2", None), deal("f", "9", "2020-07-01")])
    got = records(exposure.open_deal_base(catalog), "stage_name", "close_month")
    july = day("2020-07-01")
    assert {k: v["pipeline_value_usd"] for k, v in got.items()} == {
        ("Screening", july): 105, ("Diligence", july): 100, ("Committee", july): 100}


def reached(stages, deals):
    """Value by stage: every deal of an open stage, in each open stage of no higher order."""
    order = {s["stage_id"]: s.get("stage_order") for s in stages
             if s["name"] not in ("Committed", "Declined")}
    out = {}
    for d in deals:
        own = order.get(d["stage_id"])
        for stage, o in order.items():
            if own is not None and o is not None and o <= own:
                key = stage, d["close_date"][:7]
                out[key] = out.get(key, 0) + d["amount"]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_tied_missing_and_sparse_orders_against_all_pairs(tables, seed):
    rng = random.Random(seed)
    orders = [None, 0, 1, 1, 2, 7, 7, 8, 64, 500, -3, -2147483648, 2147483647]
    stages = [dict(stage_id=f"s{i}", name=f"Stage {i}", stage_order=o)
              for i, o in enumerate(rng.sample(orders, 9))]
    stages += [dict(stage_id="x", name="Committed", stage_order=5)]
    deals = [deal(str(i), rng.choice(stages)["stage_id"], f"2020-{rng.choice((7, 8)):02d}-05", i)
             for i in range(1, 40)]
    catalog = tables(int_funds_unified=FUNDS, stg_crm__stages=stages,
                     int_opportunities_curated=deals)
    rows = exposure.open_deal_base(catalog).collect()
    assert {(r.stage_id, str(r.close_month)[:7]): r.pipeline_value_usd for r in rows} == reached(
        stages, deals)
    last = exposure.exposure_timeseries(catalog).where("exposure_month = '2021-06-01'").collect()
    total = {}
    for (stage, _), value in reached(stages, deals).items():
        total[stage] = total.get(stage, 0) + value
    assert {r.stage_id: r.closed_pipeline_usd for r in last} == total


@pytest.mark.parametrize("name", ["open_deal_base", "exposure_timeseries", "x01_exposure_by_region",
                                  "x02_exposure_by_industry", "x03_exposure_drill_down"])
def test_stages_are_not_ordered_in_one_task(spark, name):
    query = all_queries()[name](sample_catalog(spark, SMALL))
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "collect_list" not in plan


def test_early_closings_join_the_first_month_and_late_ones_never_count(tables):
    catalog = tables(
        as_of="2020-06-15", int_funds_unified=FUNDS, stg_crm__stages=STAGES[:1],
        int_opportunities_curated=[
            deal("a", "1", "2015-01-01", 1), deal("b", "1", "2020-06-30", 2),
            deal("c", "1", "2021-06-30", 4), deal("d", "1", "2021-07-01", 8)])
    got = records(exposure.exposure_timeseries(catalog), "exposure_month")
    assert len(got) == 13
    values = {str(k): v["closed_pipeline_usd"] for k, v in got.items()}
    assert values["2020-06-01"] == 3 and values["2021-05-01"] == 3 and values["2021-06-01"] == 7
    assert got[day("2020-06-01")]["period_type"] == "Current"
    assert got[day("2020-07-01")]["period_type"] == "Forecast"


def test_keys_with_only_late_closings_still_have_rows(tables):
    catalog = tables(
        int_funds_unified=FUNDS, stg_crm__stages=STAGES[:1],
        int_opportunities_curated=[deal("d", "1", "2031-07-01", 8)])
    rows = exposure.exposure_timeseries(catalog).collect()
    assert len(rows) == 13 and {r.closed_pipeline_usd for r in rows} == {Decimal(0)}


def test_deal_weights_and_primary_flags(tables):
    catalog = tables(
        int_funds_unified=FUNDS, stg_crm__stages=STAGES[:1], ref_countries=COUNTRIES,
        stg_ref__industries=INDUSTRIES,
        int_opportunities_curated=[deal("a", "1", "2020-07-01"), deal("b", "1", "2020-07-01")],
        int_opportunity_countries_curated=[
            dict(opportunity_id="a", country_code="DE", allocation_pct=25, primary_flag=True),
            dict(opportunity_id="a", country_code="US", primary_flag=False),
            dict(opportunity_id="b", country_code="XX", allocation_pct=50)],
        int_opportunity_industries_curated=[
            dict(opportunity_id="a", industry_id="sw", primary_flag=None),
            dict(opportunity_id="b", industry_id="sw", primary_flag=False)])
    got = records(exposure.open_deal_base(catalog), "country_code", "industry_id")
    assert {k: v["pipeline_value_usd"] for k, v in got.items()} == {
        ("DE", "sw"): 25, ("US", "sw"): 100, ("XX", "UNKNOWN"): 50}
    assert got[("XX", "UNKNOWN")]["region"] == "Unknown Region"
    assert got[("XX", "UNKNOWN")]["industry_name"] == "Unknown Industry"


def instrument(i, kind="EQUITY"):
    return dict(instrument_id=i, fund_id="A", company_id="X", instrument_type=kind)


def snapshot(i, period, **more):
    return dict(instrument_snapshot_id=f"{i}{period}", instrument_id=i, period_end_date=period, **more)


def test_deployed_value_rules(tables):
    catalog = tables(
        int_funds_unified=FUNDS,
        int_instruments_unified=[instrument("e1"), instrument("e2"), instrument("e3"),
                                 instrument("c1", "CREDIT"), instrument("c2", "CREDIT"),
                                 instrument("c3", "CREDIT")],
        int_instruments_credit_curated=[
            dict(instrument_id="c1", maturity_date="2025-05-05", security_rank="PIK"),
            dict(instrument_id="c2", maturity_date="2025-05-05")],
        int_instrument_snapshots_curated=[
            snapshot("e1", "2020-03-31", fair_value=10, fx_rate=2),
            snapshot("e2", "2020-03-31", fair_value=10),              # no rate: native value
            snapshot("e3", "2020-03-31", fx_rate=2),                  # no value: dropped
            snapshot("c1", "2020-03-31", principal_outstanding=7, undrawn_commitment=1, fx_rate=1),
            snapshot("c1", "2020-06-30", undrawn_commitment=50, fx_rate=1),  # not a credit row
            snapshot("c2", "2020-03-31", principal_outstanding=7),    # no rate: dropped
            snapshot("c3", "2020-03-31", principal_outstanding=7, fx_rate=1)])  # no terms: dropped
    got = records(exposure.deployed_by_instrument(catalog), "instrument_id")
    assert {k: v["exposure_usd"] for k, v in got.items()} == {"e1": 20, "e2": 10, "c1": 8}
    assert got["c1"]["maturity_year"] == 2025 and got["c1"]["period_end_date"] == day("2020-06-30")


def test_allocation_and_industry_validity(tables):
    def links(**more):
        return dict(instrument_id="e1", industry_id="sw", valid_from="2020-01-01", **more)

    def build(industries):
        return exposure.deployed_base(tables(
            int_funds_unified=FUNDS, ref_countries=COUNTRIES, stg_ref__industries=INDUSTRIES,
            int_instruments_unified=[instrument("e1")],
            int_instrument_snapshots_curated=[
                snapshot("e1", "2020-03-31", fair_value=100, fx_rate=1)],
            int_instrument_countries_mapped=[
                dict(instrument_id="e1", country_code="DE", allocation_pct=60,
                     valid_from="2010-01-01", valid_to="2011-01-01"),
                dict(instrument_id="e1", country_code="US")],
            int_instrument_industries_mapped=industries))

    def values(df):
        return {k: v["deployed_capital_usd"]
                for k, v in records(df, "country_code", "industry_id").items()}

    assert values(build([links(valid_to="2020-03-31", allocation_pct=50)])) == {
        ("DE", "sw"): 30, ("US", "sw"): 50}
    assert values(build([links(valid_to="2020-03-30", allocation_pct=50)])) == {
        ("DE", "UNKNOWN"): 60, ("US", "UNKNOWN"): 100}
    # Several links without a percentage each take the whole amount.
    assert values(build([links(), links(valid_to="2021-01-01")]))[("US", "sw")] == 200


def test_country_validity_is_optional(tables):
    catalog = tables(
        int_funds_unified=FUNDS, ref_countries=COUNTRIES,
        int_instruments_unified=[instrument("e1")],
        int_instrument_snapshots_curated=[snapshot("e1", "2020-03-31", fair_value=100, fx_rate=1)],
        int_instrument_countries_mapped=[
            dict(instrument_id="e1", country_code="DE", valid_from="2010-01-01",
                 valid_to="2011-01-01")])
    assert [r.country_code for r in exposure.deployed_base(catalog).collect()] == ["DE"]
    strict = exposure.deployed_base(catalog, country_validity=True).collect()
    assert [r.country_code for r in strict] == ["UNKNOWN"]


def test_a_rank_spelled_null_is_not_a_missing_rank(tables):
    catalog = tables(
        int_funds_unified=FUNDS,
        int_instruments_unified=[instrument("c1", "CREDIT"), instrument("c2", "CREDIT")],
        int_instruments_credit_curated=[
            dict(instrument_id="c1", maturity_date="2025-05-05", security_rank="NULL"),
            dict(instrument_id="c2", maturity_date="2025-05-05")],
        int_instrument_snapshots_curated=[
            snapshot(i, "2020-03-31", principal_outstanding=v, fx_rate=1)
            for i, v in (("c1", 1), ("c2", 2))])
    rows = catalog.table("metrics_exposure_timeseries").collect()
    assert len(rows) == 26
    assert {(r.security_rank, r.deployed_capital_usd) for r in rows} == {("NULL", 1), (None, 2)}


def test_a_snapshot_without_a_period_is_the_latest(tables):
    catalog = tables(
        int_funds_unified=FUNDS, int_instruments_unified=[instrument("e1")],
        int_instrument_snapshots_curated=[
            snapshot("e1", "2020-03-31", fair_value=1, fx_rate=1),
            snapshot("e1", None, fair_value=2, fx_rate=1)])
    row = exposure.deployed_by_instrument(catalog).first()
    assert row.exposure_usd == 2 and row.period_end_date is None
    assert catalog.table("metrics_position_performance").count() == 0


def held(tables, value):
    return tables(
        int_funds_unified=FUNDS, ref_countries=COUNTRIES,
        int_instruments_unified=[dict(instrument_id=i, fund_id="A", instrument_type="EQUITY")
                                 for i in ("big", "small")],
        int_instrument_snapshots_curated=[
            dict(instrument_snapshot_id=i, instrument_id=i, period_end_date="2020-03-31",
                 fair_value=v, fx_rate=1) for i, v in (("big", value), ("small", 5))],
        int_instrument_countries_mapped=[
            dict(instrument_id="big", country_code=c, allocation_pct=p)
            for c, p in (("DE", "33.33"), ("US", "66.67"))])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_amounts_and_fractions_of_a_percent_are_whole(spark, tables, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        big = Decimal("2000000000000000000.03")
        rows = exposure.deployed_base(held(tables, big)).collect()
        assert sum(r.deployed_capital_usd for r in rows) == big + 5
        by = {r.country_code: r.deployed_capital_usd for r in rows}
        assert by["DE"] == (big * Decimal("0.3333")).quantize(Decimal("1e-10"))
        full = Decimal("9" * 22 + ".99")
        assert exposure.deployed_by_instrument(held(tables, full)).count() == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_what_does_not_fit_stops_the_job(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.sql("select cast('12345.6' as decimal(20,2)) as x")
        with pytest.raises(Exception, match="does not fit"):
            df.select(exact(F.col("x"), "decimal(5,2)")).collect()
        assert df.select(exact(F.col("x"), "decimal(8,1)").alias("y")).first().y == Decimal("12345.6")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
