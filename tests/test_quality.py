from collections import Counter

import pytest

from carrymark.plans.core import expected_credit_instruments
from carrymark.plans.registry import TABLES
from carrymark.quality import checks, rules
from carrymark.quality.rules import (
    CONTRACTS, ERROR, NOTED, WARN, OverlapRule, ReferenceRule, RowCountRule, SinglePrimaryRule,
    UniqueRule)
from carrymark.sources.sample_inputs import sample_catalog
from conftest import SMALL


def failures(catalog, table, rule_list=None):
    rows = checks.table_report(catalog, table, rule_list).collect()
    return {(r.check_name, r.column_name): r.failures for r in rows if r.failures}


def test_contract_has_all_declared_checks():
    """Counts of the documented contract, by kind."""
    kinds = Counter(r.check for table in CONTRACTS.values() for r in table)
    assert kinds["unique"] == 31 and kinds["not_null"] == 208
    assert kinds["relationships"] == 69 and kinds["accepted_values"] == 25
    assert kinds["null_for_fund_type"] == 6 and kinds["equal_rowcount"] == 2
    assert rules.NAV_VARIANCE.severity == WARN and rules.CALLED_VARIANCE.severity == ERROR


def test_column_checks_fire(tables):
    catalog = tables(
        int_funds_unified=[dict(fund_id="A", name="a", type="EQUITY", base_currency_code="USD"),
                           dict(fund_id="A", name=None, type="OTHER", base_currency_code="XXX"),
                           dict(fund_id=None, name="n", type=None),
                           dict(fund_id=None, name="n", type="CREDIT")],
        ref_currencies=[dict(currency_code="USD", currency_name="Dollar")])
    assert failures(catalog, "dim_funds") == {
        ("unique", "fund_id"): 1, ("not_null", "fund_id"): 2, ("not_null", "name"): 1,
        ("not_null", "type"): 1, ("accepted_values", "type"): 1,
        ("relationships", "base_currency_code"): 1}


def test_reference_counts_rows_not_values(tables):
    catalog = tables(int_share_classes_curated=[
        dict(share_class_id=str(i), company_id="gone", name="n") for i in range(5)])
    assert failures(catalog, "dim_share_classes")[("relationships", "company_id")] == 5


def test_income_level_allows_null_and_empty(tables):
    catalog = tables(ref_countries=[dict(iso2=str(i), name="n", income_level=v)
                                    for i, v in enumerate((None, "", "HIC", "RICH"))])
    assert failures(catalog, "dim_countries") == {("accepted_values", "income_level"): 1}


def test_row_counts_compare_subtypes(tables):
    catalog = tables(
        int_instruments_unified=[dict(instrument_id=i, instrument_type=t) for i, t in (
            ("a", "EQUITY"), ("b", "EQUITY"), ("c", "CREDIT"))],
        int_instruments_equity_curated=[dict(instrument_id="a", share_class_id="s")])
    for table, difference in (("dim_instruments_equity", 1), ("dim_instruments_credit", 1)):
        only = [r for r in CONTRACTS[table] if isinstance(r, RowCountRule)]
        assert failures(catalog, table, only) == {("equal_rowcount", "*"): difference}
    assert catalog.table("int_expect_instruments_credit").count() == 0
    assert expected_credit_instruments(catalog, "CREDIT").count() == 1


def test_overlaps_single_primaries_and_allocation(tables):
    def link(code, start, end=None, primary=False, pct=None, company="X"):
        return dict(company_id=company, country_code=code, valid_from=start, valid_to=end,
                    primary_flag=primary, allocation_pct=pct)

    catalog = tables(as_of="2020-06-15", int_company_countries_mapped=[
        link("DE", "2019-01-01", "2019-12-31", True), link("DE", "2020-01-01", None, True),
        link("US", "2019-01-01", "2020-01-01"), link("US", "2020-01-01", "2020-02-01"),  # touches
        link("US", "2020-01-15", None, True, 101),
        link("FR", "2019-01-01", None, pct=-1), link("FR", "2019-01-01", None),
        link("DE", "2020-01-01", None, True, company="Y")])
    got = failures(catalog, "br_company_countries", NOTED["br_company_countries"])
    assert got == {
        ("no_overlap", "company_id, country_code"): 3, ("single_primary", "company_id"): 1,
        ("unique_key", "company_id, country_code, valid_from"): 1,
        ("allocation_range", "allocation_pct"): 2}


def test_ledger_and_amount_rules(tables):
    catalog = tables(
        int_transactions_classified=[
            dict(transaction_id="1", investor_id="v", facility_id="f", amount=1, fx_rate=0),
            dict(transaction_id="2", investor_id="v", amount=-1, fx_rate=1),
            dict(transaction_id="3", amount=1)],
        int_instrument_cashflows_curated=[
            dict(instrument_cashflow_id="1", amount=-1, non_cash=False),
            dict(instrument_cashflow_id="2", amount=-1, non_cash=True)],
        int_instruments_equity_curated=[
            dict(instrument_id="e", initial_ownership_pct=1.5, initial_cost=-1)],
        int_instruments_credit_curated=[
            dict(instrument_id=i, facility_id="f", tranche_label=t)
            for i, t in (("a", "T"), ("b", "T"), ("c", None), ("d", None))])
    assert failures(catalog, "fct_transactions", NOTED["fct_transactions"]) == {
        ("fx_rate_positive", "fx_rate"): 1, ("not_negative", "amount"): 1,
        ("single_domain", "investor_id, facility_id, instrument_id"): 1}
    assert failures(catalog, "fct_instrument_cashflows", NOTED["fct_instrument_cashflows"]) == {
        ("not_negative", "amount"): 1}
    assert set(failures(catalog, "dim_instruments_equity", NOTED["dim_instruments_equity"])) == {
        ("ownership_range", "initial_ownership_pct"), ("not_negative", "initial_cost")}
    assert failures(catalog, "dim_instruments_credit", NOTED["dim_instruments_credit"]) == {
        ("unique_key", "facility_id, tranche_label"): 1}


def test_fund_mart_checks_fire(spark, tables):
    catalog = tables()
    mart = catalog.table("metrics_fund_performance")
    broken = spark.createDataFrame([{
        "fund_type": "CREDIT", "dpi": 1.0, "rvpi": None, "tvpi": 2.0}, {
        "fund_type": "EQUITY", "total_exposure": 5, "nav_variance_pct": -0.03,
        "fund_nav_reported": 1, "fund_nav_calculated": 2, "called_capital_variance_pct": 0.0005,
        "called_capital_reported": 1, "called_capital_calculated": 1,
        "distributions_variance_pct": 0.5, "total_distributions_reported": 1}],
        "fund_type string, dpi double, rvpi double, tvpi double, total_exposure long, "
        "nav_variance_pct double, fund_nav_reported long, fund_nav_calculated long, "
        "called_capital_variance_pct double, called_capital_reported long, "
        "called_capital_calculated long, distributions_variance_pct double, "
        "total_distributions_reported long")
    catalog.replace("metrics_fund_performance",
                    mart.limit(0).unionByName(broken, allowMissingColumns=True))
    got = failures(catalog, "metrics_fund_performance")
    fired = {k for k in got if k[0] not in ("not_null", "relationships")}
    assert fired == {("null_for_fund_type", "dpi"), ("null_for_fund_type", "tvpi"),
                     ("null_for_fund_type", "total_exposure"),
                     ("nav_variance", "nav_variance_pct")}


def test_sample_findings_are_the_known_ones(spark):
    catalog = sample_catalog(spark, SMALL)
    report = checks.report(catalog, ["fct_instrument_cashflows", "br_instrument_countries",
                                     "fct_fund_snapshots", "metrics_portfolio_overview"])
    found = {(r.table_name, r.check_name, r.column_name)
             for r in checks.breaches(report).collect()}
    assert ("fct_instrument_cashflows", "unique", "instrument_cashflow_id") in found
    assert ("br_instrument_countries", "relationships", "country_code") in found
    assert ("fct_fund_snapshots", "not_null", "nav_amount_converted") in found


@pytest.mark.parametrize("kind, columns", [
    (UniqueRule, {"fund_id", "count"}), (ReferenceRule, {"_value", "count"})])
def test_failing_rows_name_the_culprits(tables, kind, columns):
    catalog = tables(int_funds_unified=[
        dict(fund_id="A", type="EQUITY", base_currency_code="ZZZ"), dict(fund_id="A")])
    rule = next(r for r in CONTRACTS["dim_funds"] if isinstance(r, kind))
    rows = checks.failing_rows(catalog, rule)
    assert set(rows.columns) == columns and rows.count() == 1


def test_interval_rules_have_rows(tables):
    catalog = tables(as_of="2020-06-15", int_company_industries_mapped=[
        dict(company_id="X", industry_id=i, valid_from="2020-01-01", primary_flag=True)
        for i in ("a", "a", "b")])
    for kind in (OverlapRule, SinglePrimaryRule):
        rule = next(r for r in NOTED["br_company_industries"] if isinstance(r, kind))
        assert checks.failing_rows(catalog, rule).count() == 1


def test_declared_mart_grains_are_checked():
    for name, spec in TABLES.items():
        if spec.role == "metrics" and spec.grain and name != "metrics_returns_cashflows":
            keys = {r.keys for r in rules.rules_for(name) if isinstance(r, UniqueRule)}
            assert spec.grain in keys, name


def test_a_stored_mart_is_checked_where_it_is(spark):
    catalog = sample_catalog(spark, SMALL)
    catalog.save("metrics_pipeline_by_stage")
    assert not failures(catalog, "metrics_pipeline_by_stage")


def test_keys_and_references_take_one_scan_of_a_fact(spark):
    catalog = sample_catalog(spark, SMALL)
    rules_ = [r for r in rules.rules_for("fct_transactions")
              if isinstance(r, (UniqueRule, ReferenceRule))]
    assert len(rules_) > 3
    plan = checks.table_report(catalog, "fct_transactions", rules_)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("o_totalprice") <= text.count("o_orderkey") and text.count("Expand") == 0
    scans = plan._jdf.queryExecution().executedPlan().toString().count("orders.parquet")
    assert scans == 1
