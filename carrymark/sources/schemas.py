"""Declared types of every input relation.

Each entry is a Spark DDL string. ``Catalog`` selects and casts the declared
columns, so unread columns of a wider source never leave the scan.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

_STAMPS = "created_at timestamp, updated_at timestamp"
_PERIOD = ("period_start_date date, period_end_date date, frequency string, "
           "reporting_basis string, snapshot_source string")
_FX = "currency_code string, fx_rate decimal(18,8), fx_rate_as_of date, fx_rate_source string"
_VALIDITY = "valid_from date, valid_to date"

SEEDS = {
    "ref_countries":
        "id string, iso2 string, iso3 string, name string, phone_code string, region string, "
        "sub_region string, income_level string, created_at date, updated_at date",
    "ref_currencies":
        "currency_code string, iso_numeric_code string, currency_name string, "
        "currency_symbol string, created_date date, last_modified_date date",
}

UPSTREAM = {
    "stg_ref__industries": f"industry_id string, canonical_name string, {_STAMPS}",
    "stg_ref__investor_types":
        "investor_type_id string, name string, description string, kyc_category string",
    "stg_crm__stages":
        "stage_id string, name string, pipeline_type string, stage_order int, loaded_at timestamp",
    "int_investors_unified":
        f"investor_id string, name string, investor_type_id string, "
        f"domicile_country_code string, {_STAMPS}",
    "int_funds_unified":
        "fund_id string, name string, type string, vintage int, management_fee decimal(7,4), "
        "hurdle decimal(7,4), carried_interest decimal(7,4), target_commitment decimal(20,2), "
        "incorporated_in string, base_currency_code string, strategy string, "
        f"final_close_date date, {_STAMPS}",
    "int_fund_snapshots_curated":
        f"fund_snapshot_id string, fund_id string, {_PERIOD}, currency_code string, "
        "committed_capital decimal(20,2), called_capital decimal(20,2), dpi decimal(18,10), "
        "rvpi decimal(18,10), expected_coc decimal(18,10), cash_amount decimal(20,2), "
        "total_distributions decimal(20,2), total_expenses decimal(20,2), "
        "total_management_fees decimal(20,2), total_interest_income decimal(20,2), "
        "nav_amount decimal(20,2), nav_amount_converted decimal(20,2), source string, "
        f"source_reference string, {_STAMPS}",
    "int_companies_unified":
        "company_id string, name string, website string, description string, "
        f"currency_code string, {_STAMPS}",
    "int_company_countries_mapped":
        f"company_id string, country_code string, {_VALIDITY}, allocation_pct decimal(5,2), "
        f"role string, primary_flag boolean, {_STAMPS}",
    "int_company_industries_mapped":
        f"company_id string, industry_id string, {_VALIDITY}, primary_flag boolean, {_STAMPS}",
    "int_company_financials_curated":
        f"company_performance_snapshot_id string, company_id string, {_PERIOD}, "
        "currency_code string, " + ", ".join(
            f"{measure} decimal(24,2)" for measure in (
                "revenue", "cost_of_goods_sold", "gross_profit", "operating_expenses", "ebitda",
                "depreciation_amortization", "ebit", "net_income", "cash", "total_assets",
                "total_liabilities", "equity", "operating_cash_flow", "investing_cash_flow",
                "financing_cash_flow"))
        + f", source_system string, source_file_ref string, {_STAMPS}",
    "int_company_valuations_curated":
        f"company_valuation_id string, company_id string, {_PERIOD}, amount decimal(20,2), "
        f"valuation_type string, {_STAMPS}",
    "int_share_classes_curated":
        f"share_class_id string, company_id string, name string, {_STAMPS}",
    "int_instruments_unified":
        "instrument_id string, fund_id string, company_id string, name string, "
        "instrument_type string, inception_date date, termination_date date, "
        f"description string, {_STAMPS}",
    "int_instruments_equity_curated":
        "instrument_id string, share_class_id string, initial_share_count decimal(24,6), "
        "initial_ownership_pct decimal(7,6), initial_cost decimal(24,2), "
        f"initial_price_per_share decimal(24,6), {_FX}, initial_cost_converted decimal(24,2), "
        f"description string, {_STAMPS}",
    "int_instruments_credit_curated":
        "instrument_id string, facility_id string, instrument_credit_type string, "
        f"tranche_label string, commitment_amount decimal(24,2), {_FX}, "
        "commitment_amount_converted decimal(24,2), start_date date, maturity_date date, "
        "interest_index string, index_tenor_days int, fixed_rate_pct decimal(7,4), "
        "spread_bps int, floor_pct decimal(7,4), day_count string, pay_freq_months int, "
        f"amortization_type string, security_rank string, status string, {_STAMPS}",
    "int_instrument_snapshots_curated":
        f"instrument_snapshot_id string, instrument_id string, {_PERIOD}, {_FX}, "
        "fair_value decimal(24,2), accrued_income decimal(24,2), "
        "principal_outstanding decimal(24,2), undrawn_commitment decimal(24,2), "
        "accrued_interest decimal(24,2), accrued_fees decimal(24,2), "
        "amortized_cost decimal(24,2), expected_loss decimal(24,2), status string, "
        "equity_stake_pct decimal(7,6), stake_basis string, snapshot_source_file_ref string, "
        f"{_STAMPS}",
    "int_instrument_cashflows_curated":
        "instrument_cashflow_id string, instrument_id string, instrument_cashflow_type string, "
        f"date date, amount decimal(24,2), {_FX}, amount_converted decimal(24,2), "
        f"transaction_id string, reference string, non_cash boolean, {_STAMPS}",
    "int_instrument_countries_mapped":
        f"instrument_id string, country_code string, {_VALIDITY}, allocation_pct decimal(5,2), "
        f"role string, primary_flag boolean, {_STAMPS}",
    "int_instrument_industries_mapped":
        f"instrument_id string, industry_id string, {_VALIDITY}, allocation_pct decimal(5,2), "
        f"primary_flag boolean, {_STAMPS}",
    "int_facilities_curated":
        "facility_id string, fund_id string, borrower_company_id string, facility_type string, "
        "agreement_date date, effective_date date, maturity_date date, currency_code string, "
        f"total_commitment decimal(24,2), purpose string, {_STAMPS}",
    "int_commitments_curated":
        "commitment_id string, fund_id string, investor_id string, currency_code string, "
        f"original_amount decimal(20,2), agreement_date date, {_STAMPS}",
    "int_commitment_snapshots_curated":
        f"commitment_snapshot_id string, commitment_id string, {_PERIOD}, currency_code string, "
        "committed_capital decimal(20,2), called_capital decimal(20,2), "
        "total_distributions decimal(20,2), source string, source_reference string, "
        f"{_STAMPS}",
    "int_opportunities_curated":
        "opportunity_id string, fund_id string, name string, stage_id string, company_id string, "
        "responsible string, amount decimal(20,2), source string, close_date date, "
        f"{_STAMPS}",
    "int_opportunity_countries_curated":
        "opportunity_id string, country_code string, primary_flag boolean, "
        f"allocation_pct decimal(5,2), role string, {_STAMPS}",
    "int_opportunity_industries_curated":
        f"opportunity_id string, industry_id string, primary_flag boolean, {_STAMPS}",
    "int_transactions_classified":
        "transaction_id string, transaction_type string, fund_id string, investor_id string, "
        "instrument_id string, facility_id string, name string, description string, "
        "amount decimal(24,2), currency_code string, fx_rate decimal(18,8), "
        "amount_converted decimal(24,2), fx_rate_as_of date, fx_rate_source string, date date, "
        f"source string, reference string, source_reference string, {_STAMPS}",
}

INPUTS = {**SEEDS, **UPSTREAM}


@cache
def input_schema(name: str) -> StructType:
    return StructType.fromDDL(INPUTS[name])
