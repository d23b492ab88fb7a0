"""Column expressions that derive the canonical inputs from TPC-H-like tables.

The same expressions serve Spark and the SQL oracle, which differ only in how a
quarter end is written. Row sources live next to each engine.
"""

from __future__ import annotations

# --- fixed values: sample clock and conversion rates ------------------------
STAMP = "timestamp '1995-01-01 00:00:00'"
EPOCH = "date '1995-01-01'"
SAMPLE_AS_OF = "1998-07-15"


def text(x: str) -> str:
    return f"cast({x} as string)"


def cents(x: str) -> str:
    return f"cast({x} as decimal(18,2))"


def dec(x: str, precision: int, scale: int) -> str:
    return f"cast({x} as decimal({precision},{scale}))"


def money(x: str) -> str:
    return dec(x, 24, 2)


def fund_money(x: str) -> str:
    return dec(x, 20, 2)


def plus_days(day: str, n: str) -> str:
    return f"{day} + cast({n} as int)"


def cycle(key: str, *values: str) -> str:
    cases = " ".join(f"when {i} then {v}" for i, v in enumerate(values[:-1]))
    return f"case {key} % {len(values)} {cases} else {values[-1]} end"


def key_or_gap(prefix: str, key: str, gap: str) -> str:
    """A key, or where ``gap`` holds one that nothing else has: the row stays, unmatched."""
    return f"case when {gap} then 'GAP' else '{prefix}' end || {text(key)}"


def currency(key: str) -> str:
    return cycle(key, "'USD'", "'EUR'", "'GBP'")


def rate(key: str) -> str:
    return dec(cycle(key, "1", "1.10", "1.25"), 18, 8)


def short_rate(key: str) -> str:
    return dec(cycle(key, "1", "1.10", "1.25"), 5, 2)


def sector(key: str) -> str:
    return cycle(key, "'ECONOMY'", "'LARGE'", "'MEDIUM'", "'PROMO'", "'SMALL'", "'STANDARD'")


NO_TEXT = "cast(null as string)"
NO_DATE = "cast(null as date)"
_STAMPS = {"created_at": STAMP, "updated_at": STAMP}


def _period(source: str) -> dict[str, str]:
    return {"period_start_date": NO_DATE, "period_end_date": "qe", "frequency": "'QUARTERLY'",
            "reporting_basis": "'MANAGEMENT'", "snapshot_source": f"'{source}'"}


def _fx(key: str, as_of: str) -> dict[str, str]:
    return {"currency_code": currency(key), "fx_rate": rate(key), "fx_rate_as_of": as_of,
            "fx_rate_source": "'FIXTURE'"}


def _when_credit(x: str) -> str:
    return f"case when itype = 'CREDIT' then {money(x)} end"


# Helper relation: one row per instrument, over ``part`` with a column n_suppliers.
PARTS = {
    "pk": "p_partkey",
    "fnum": "p_partkey % 25",
    "cnum": "p_partkey % n_suppliers",
    "psize": "p_size",
    "ptype": "p_type",
    "price": cents("p_retailprice"),
    "itype": "case when (p_partkey % 25) % 3 = 2 or p_size > 45 then 'CREDIT' else 'EQUITY' end",
    "inception": plus_days(EPOCH, "p_size * 20"),
    "termination": f"case when p_size % 4 = 0 then {plus_days(EPOCH, 'p_size * 20 + 1500')} end",
}

_EQUITY_FLOWS = cycle("(l_orderkey + l_linenumber)", "'INVESTMENT'", "'DIVIDEND'",
                      "'EXIT_PROCEEDS'", "'RETURN_OF_CAPITAL'", "'FEE'")
_CREDIT_FLOWS = cycle("(l_orderkey + l_linenumber)", "'DRAW'", "'PRINCIPAL'", "'INTEREST'",
                      "'PREPAYMENT'", "'OTHER'")

COLUMNS: dict[str, dict[str, str]] = {
    "ref_countries": {
        "id": text("n_nationkey"), "iso2": f"case when n_nationkey = 24 then 'ZZ' else lpad({text('n_nationkey')}, 2, '0') end",
        "iso3": f"lpad({text('n_nationkey')}, 3, '0')", "name": "n_name",
        "phone_code": text("n_nationkey + 100"), "region": "r_name",
        "sub_region": "r_name || ' SUB'",
        "income_level": "case n_nationkey % 5 when 0 then 'HIC' when 1 then 'UMC' "
                        "when 2 then 'LMC' when 3 then 'LIC' end",
        "created_at": EPOCH, "updated_at": EPOCH,
    },
    "ref_currencies": {
        "currency_code": "code", "iso_numeric_code": NO_TEXT,
        "currency_name": "case code when 'USD' then 'US Dollar' when 'EUR' then 'Euro' "
                         "else 'British Pound' end",
        "currency_symbol": "case code when 'USD' then '$' when 'EUR' then 'E' else 'L' end",
        "created_date": EPOCH, "last_modified_date": EPOCH,
    },
    "stg_ref__industries": {
        "industry_id": "p_type", "canonical_name": "p_type || ' INDUSTRY'", **_STAMPS},
    "stg_ref__investor_types": {
        "investor_type_id": "c_mktsegment", "name": "c_mktsegment", "description": NO_TEXT,
        "kyc_category": "'STANDARD'"},
    "stg_crm__stages": {
        "stage_id": "code",
        "name": "case code when '1' then 'Screening' when '2' then 'Diligence' "
                "when '3' then 'Committee' when '4' then 'Committed' else 'Declined' end",
        "pipeline_type": "'DEAL'", "stage_order": "cast(code as int) % 5", "loaded_at": STAMP},
    "int_investors_unified": {
        "investor_id": f"'V' || {text('c_custkey')}", "name": "c_name",
        "investor_type_id": "c_mktsegment",
        "domicile_country_code": f"lpad({text('c_nationkey % 24')}, 2, '0')", **_STAMPS},
    "int_funds_unified": {
        "fund_id": f"'F' || {text('n_nationkey')}", "name": "'Fund ' || n_name",
        "type": "case when n_nationkey % 3 = 2 then 'CREDIT' else 'EQUITY' end",
        "vintage": "1990 + n_nationkey % 8", "management_fee": dec("0.02", 7, 4),
        "hurdle": dec("0.08", 7, 4), "carried_interest": dec("0.20", 7, 4),
        "target_commitment": fund_money("1000000 * (n_nationkey + 1)"),
        "incorporated_in": "n_name", "base_currency_code": "'USD'",
        "strategy": f"'STRATEGY ' || {text('n_regionkey')}",
        "final_close_date": plus_days(EPOCH, "n_nationkey * 30"), **_STAMPS},
    "int_companies_unified": {
        "company_id": f"'C' || {text('s_suppkey')}", "name": "s_name",
        "website": f"'https://example.org/' || {text('s_suppkey')}", "description": NO_TEXT,
        "currency_code": currency("s_suppkey"), **_STAMPS},
    "int_instruments_unified": {
        "instrument_id": f"'I' || {text('pk')}", "fund_id": f"'F' || {text('fnum')}",
        "company_id": f"'C' || {text('cnum')}", "name": f"'Instrument ' || {text('pk')}",
        "instrument_type": "itype", "inception_date": "inception",
        "termination_date": "termination", "description": NO_TEXT, **_STAMPS},
    "int_share_classes_curated": {
        "share_class_id": f"'SC' || {text('s_suppkey')}",
        "company_id": f"'C' || {text('s_suppkey')}", "name": "'Common'", **_STAMPS},
    "int_instruments_equity_curated": {
        "instrument_id": f"'I' || {text('pk')}", "share_class_id": f"'SC' || {text('cnum')}",
        "initial_share_count": dec("psize * 1000", 24, 6),
        "initial_ownership_pct": dec(dec("psize", 9, 6) + " / 100", 7, 6),
        "initial_cost": f"case when pk % 17 = 0 then {money('0')} else {money('price * 100')} end",
        "initial_price_per_share": dec("price", 24, 6), **_fx("pk", "inception"),
        "initial_cost_converted":
            f"case when pk % 17 = 0 then {money('0')} "
            f"else {money('price * 100 * ' + short_rate('pk'))} end",
        "description": NO_TEXT, **_STAMPS},
    "int_facilities_curated": {
        "facility_id": f"'FA' || {text('fnum')} || '-' || {text('cnum')}",
        "fund_id": f"'F' || {text('fnum')}", "borrower_company_id": f"'C' || {text('cnum')}",
        "facility_type": cycle("fnum", "'UNITRANCHE'", "'REVOLVER'", "'TERM_LOAN_B'"),
        "agreement_date": "d", "effective_date": "d", "maturity_date": plus_days("d", "2500"),
        "currency_code": "'USD'", "total_commitment": money("t * 1000"), "purpose": NO_TEXT,
        **_STAMPS},
    "int_instruments_credit_curated": {
        "instrument_id": f"'I' || {text('pk')}",
        "facility_id": f"'FA' || {text('fnum')} || '-' || {text('cnum')}",
        "instrument_credit_type": cycle("psize", "'TERM'", "'REVOLVER'", "'MEZZ'"),
        "tranche_label": f"'T' || {text('pk')}", "commitment_amount": money("price * 1000"),
        **_fx("pk", "inception"),
        "commitment_amount_converted": money("price * 1000 * " + short_rate("pk")),
        "start_date": "inception", "maturity_date": plus_days("inception", "2500"),
        "interest_index": cycle("pk", "'SOFR'", "'EURIBOR'", "'SONIA'", "'FIXED'"),
        "index_tenor_days": "90",
        "fixed_rate_pct": f"case when pk % 4 = 3 then {dec('6.5', 7, 4)} end",
        "spread_bps": "100 + psize * 10", "floor_pct": dec("1", 7, 4), "day_count": "'ACT_360'",
        "pay_freq_months": "3", "amortization_type": "'BULLET'",
        "security_rank": "case pk % 5 when 0 then 'SENIOR_SECURED' when 1 then 'MEZZANINE' "
                         "when 2 then 'PIK' when 3 then 'SECOND_LIEN' end",
        "status": "'PERFORMING'", **_STAMPS},
    "int_instrument_snapshots_curated": {
        "instrument_snapshot_id": f"'S' || {text('pk')} || '-' || {text('qe')}",
        "instrument_id": f"'I' || {text('pk')}", **_period("ADMIN"), **_fx("pk", "qe"),
        "fx_rate": f"case when pk % 7 = 0 then null else {rate('pk')} end",
        "fair_value": f"case when itype = 'EQUITY' and pk % 23 <> 0 then {money('v')} end",
        "accrued_income": money("n"), "principal_outstanding": _when_credit("n * 1000"),
        "undrawn_commitment":
            f"case when itype = 'CREDIT' and pk % 3 <> 0 then {money('n * 100')} end",
        "accrued_interest": _when_credit("n * 10"), "accrued_fees": _when_credit("n"),
        "amortized_cost": _when_credit("n * 990"), "expected_loss": _when_credit("n * 5"),
        "status": "'PERFORMING'",
        "equity_stake_pct":
            f"case when itype = 'EQUITY' and pk % 19 <> 0 then {dec('0.25', 7, 6)} end",
        "stake_basis": "'FULLY_DILUTED'", "snapshot_source_file_ref": NO_TEXT, **_STAMPS},
    "int_instrument_cashflows_curated": {
        "instrument_cashflow_id": f"'CF' || {text('l_orderkey')} || '-' || {text('l_linenumber')}",
        "instrument_id": f"'I' || {text('pk')}",
        "instrument_cashflow_type":
            f"case when itype = 'EQUITY' then {_EQUITY_FLOWS} else {_CREDIT_FLOWS} end",
        "date": "cast(l_shipdate as date)", "amount": money(cents("l_extendedprice")),
        **_fx("pk", "cast(l_shipdate as date)"),
        "amount_converted": money(f"{cents('l_extendedprice')} * {short_rate('pk')}"),
        "transaction_id": NO_TEXT, "reference": "l_returnflag || l_linestatus",
        "non_cash": "false", **_STAMPS},
    "int_instrument_countries_mapped": {
        "instrument_id": key_or_gap("I", "pk", "pk % 11 = 0"),
        "country_code": f"lpad({text('c')}, 2, '0')",
        "valid_from": EPOCH, "valid_to": NO_DATE,
        "allocation_pct": dec("a + 0.25 * (pk % 3)", 5, 2),
        "role": "'OPERATIONS'", "primary_flag": "p", **_STAMPS},
    "int_instrument_industries_mapped": {
        "instrument_id": key_or_gap("I", "pk", "pk % 13 = 0"), "industry_id": "ptype",
        "valid_from": EPOCH,
        "valid_to": "case when pk % 9 = 0 then date '1999-12-31' end",
        "allocation_pct": f"case when pk % 2 = 0 then {dec('100', 5, 2)} end",
        "primary_flag": "true", **_STAMPS},
    "int_fund_snapshots_curated": {
        "fund_snapshot_id": f"'FS' || {text('k')} || '-' || {text('qe')}",
        "fund_id": f"'F' || {text('k')}", **_period("ADMIN"), "currency_code": "'USD'",
        "committed_capital": fund_money("v * 10"),
        "called_capital": f"case when k = 1 then {fund_money('0')} when k % 5 = 3 then null "
                          f"else {fund_money('v * 4')} end",
        "dpi": dec("0.5", 18, 10), "rvpi": dec("0.75", 18, 10),
        "expected_coc": dec("1.5", 18, 10),
        "cash_amount": f"case when k % 7 = 6 then null else {fund_money('v')} end",
        "total_distributions": f"case when k % 5 = 4 then null else {fund_money('v * 2')} end",
        "total_expenses": fund_money("v"), "total_management_fees": fund_money("v"),
        "total_interest_income": fund_money("v"), "nav_amount": fund_money("v * 3"),
        "nav_amount_converted": f"case when k % 4 = 0 then null else {fund_money('v * 3')} end",
        "source": "'FIXTURE'", "source_reference": NO_TEXT, **_STAMPS},
    "int_company_countries_mapped": {
        "company_id": f"'C' || {text('k')}", "country_code": f"lpad({text('n')}, 2, '0')",
        "valid_from": EPOCH, "valid_to": NO_DATE, "allocation_pct": dec("50", 5, 2),
        "role": "'HEADQUARTERS'", "primary_flag": "p", **_STAMPS},
    "int_company_industries_mapped": {
        "company_id": f"'C' || {text('s_suppkey')}", "industry_id": sector("s_suppkey"),
        "valid_from": EPOCH, "valid_to": NO_DATE, "primary_flag": "s_suppkey % 10 <> 9",
        **_STAMPS},
    "int_company_financials_curated": {
        "company_performance_snapshot_id": f"'CS' || {text('k')} || '-' || {text('qe')}",
        "company_id": f"'C' || {text('k')}", **_period("INTERNAL"), "currency_code": currency("k"),
        "revenue": f"case when k % 8 = 7 then {money('0')} else {money('v')} end",
        "cost_of_goods_sold": money("n * 500"), "gross_profit": money("v - n * 500"),
        "operating_expenses": money("n * 100"),
        "ebitda": f"case when k % 8 = 6 then null else {money('v - n * 600')} end",
        "depreciation_amortization": money("n * 10"), "ebit": money("v - n * 610"),
        "net_income": money("v - n * 700"), "cash": money("n * 50"),
        "total_assets": money("v * 5"), "total_liabilities": money("v * 2"),
        "equity": money("v * 3"), "operating_cash_flow": money("n * 20"),
        "investing_cash_flow": money("0 - n * 5"), "financing_cash_flow": money("n"),
        "source_system": "'FIXTURE'", "source_file_ref": NO_TEXT, **_STAMPS},
    "int_company_valuations_curated": {
        "company_valuation_id": f"'CV' || {text('k')} || '-' || {text('qe')} || '-' || vt",
        "company_id": key_or_gap("C", "k", "k % 6 = 5"), **_period("INTERNAL"), "amount": fund_money("v * m"),
        "valuation_type": "vt", **_STAMPS},
    "int_commitments_curated": {
        "commitment_id": f"'K' || {text('c_custkey')}", "fund_id": f"'F' || {text('c_nationkey')}",
        "investor_id": f"'V' || {text('c_custkey')}", "currency_code": "'USD'",
        "original_amount": fund_money(cents("abs(c_acctbal)") + " * 100"),
        "agreement_date": plus_days(EPOCH, "c_custkey % 365"), **_STAMPS},
    "int_commitment_snapshots_curated": {
        "commitment_snapshot_id": f"'KS' || {text('k')} || '-' || {text('qe')}",
        "commitment_id": f"'K' || {text('k')}", **_period("ADMIN"), "currency_code": "'USD'",
        "committed_capital": fund_money("v * 10"), "called_capital": fund_money("v * 4"),
        "total_distributions": fund_money("v * 2"), "source": "'FIXTURE'",
        "source_reference": NO_TEXT, **_STAMPS},
    "int_opportunities_curated": {
        "opportunity_id": f"'O' || {text('o_orderkey')}",
        "fund_id": f"'F' || {text('c_nationkey')}", "name": f"'Deal ' || {text('o_orderkey')}",
        "stage_id": "substr(o_orderpriority, 1, 1)",
        "company_id": f"'C' || {text('o_custkey % n_suppliers')}", "responsible": NO_TEXT,
        "amount": fund_money(cents("o_totalprice")), "source": "'CRM'",
        "close_date": "case when o_orderkey % 29 = 0 then null else cast(o_orderdate as date) end",
        "created_at": f"cast({plus_days('cast(o_orderdate as date)', '-90')} as timestamp)",
        "updated_at": STAMP},
    "int_opportunity_countries_curated": {
        "opportunity_id": key_or_gap("O", "o_orderkey", "o_orderkey % 10 = 0"),
        "country_code": f"lpad({text('o_custkey % 25')}, 2, '0')", "primary_flag": "true",
        "allocation_pct": f"case when o_orderkey % 2 = 0 then {dec('50', 5, 2)} end",
        "role": "'OPERATING'", **_STAMPS},
    "int_opportunity_industries_curated": {
        "opportunity_id": key_or_gap("O", "o_orderkey", "o_orderkey % 12 = 0"),
        "industry_id": sector("o_custkey"),
        "primary_flag": "case o_orderkey % 3 when 0 then true when 1 then false end", **_STAMPS},
    "int_transactions_classified": {
        "transaction_id": f"'TX' || {text('o_orderkey')}",
        "transaction_type": "case when o_orderkey % 7 = 6 then " + cycle(
            "o_orderkey", "'DIVIDEND'", "'LOAN_RECEIVED'", "'LOAN_DRAW'",
            "'LOAN_PRINCIPAL_REPAYMENT'", "'LOAN_INTEREST_RECEIPT'", "'LOAN_FEE_RECEIPT'")
            + " else " + cycle("o_orderkey", "'DRAWDOWN'", "'DISTRIBUTION'",
                               "'INVESTMENT_TRANSACTION'", "'EXPENSE'", "'MANAGEMENT_FEE'")
            + " end",
        "fund_id": f"'F' || {text('c_nationkey')}",
        "investor_id": f"case when o_orderkey % 5 in (0, 1) then 'V' || {text('c_custkey')} end",
        "instrument_id": "case when o_orderkey % 5 = 2 "
                         f"then 'I' || {text('o_orderkey % n_parts')} end",
        "facility_id": NO_TEXT, "name": "o_orderpriority", "description": NO_TEXT,
        "amount": money(cents("o_totalprice")), "currency_code": currency("o_custkey"),
        "fx_rate": rate("o_custkey"),
        "amount_converted": money(f"{cents('o_totalprice')} * {short_rate('o_custkey')}"),
        "fx_rate_as_of": "cast(o_orderdate as date)", "fx_rate_source": "'FIXTURE'",
        "date": "cast(o_orderdate as date)",
        "source": "case when o_orderkey % 5 in (0, 1) then 'ADMIN' else 'ACC' end",
        "reference": NO_TEXT, "source_reference": f"'SRC' || {text('o_orderkey')}", **_STAMPS},
}
