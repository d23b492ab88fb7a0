"""DuckDB text of the inputs and canonical models, as named common table expressions.

Written against the row sources directly and with plain joins, correlated
subqueries and ranked rows, so that it shares no plan shape with the Spark code.
Only the column expressions of the sample inputs are common to both.
"""

from __future__ import annotations

import re

from carrymark.sources.sample_columns import COLUMNS, PARTS, cents


def quarter_end(day: str) -> str:
    return f"last_day(cast(date_trunc('quarter', cast({day} as date)) + interval 2 month as date))"


def _per_quarter(table: str, key: str, day: str, totals: str) -> str:
    return f"select {key} k, {quarter_end(day)} qe, {totals} from {table} group by all"


_V = f"sum({cents('l_extendedprice')}) v"
_N = f"sum({cents('l_quantity')}) n"
_ORDERS = "orders join customer on o_custkey = c_custkey"

_SOURCES = {
    "ref_countries": "nation join region on n_regionkey = r_regionkey",
    "ref_currencies": "(select distinct case p_partkey % 3 when 0 then 'USD' when 1 then 'EUR' "
                      "else 'GBP' end code from part)",
    "stg_ref__industries": "(select distinct p_type from part)",
    "stg_ref__investor_types": "(select distinct c_mktsegment from customer)",
    "stg_crm__stages": "(select distinct o_orderpriority[1] code from orders)",
    "int_investors_unified": "customer",
    "int_funds_unified": "nation",
    "int_companies_unified": "supplier",
    "int_instruments_unified": "sample_parts",
    "int_share_classes_curated": "supplier",
    "int_instruments_equity_curated": "sample_parts where itype = 'EQUITY'",
    "int_facilities_curated":
        "(select fnum, cnum, min(inception) d, sum(price) t from sample_parts "
        "where itype = 'CREDIT' group by fnum, cnum)",
    "int_instruments_credit_curated": "sample_parts where itype = 'CREDIT'",
    "int_instrument_snapshots_curated":
        f"({_per_quarter('lineitem', 'l_partkey', 'l_shipdate', _V + ', ' + _N)}) q "
        "join sample_parts on pk = k",
    "int_instrument_cashflows_curated": "lineitem join sample_parts on pk = l_partkey",
    "int_instrument_countries_mapped":
        "(select pk, fnum c, 60 a, true p from sample_parts union all "
        "select pk, (pk + 1) % 25, 40, false from sample_parts)",
    "int_instrument_industries_mapped": "sample_parts",
    "int_fund_snapshots_curated":
        f"({_per_quarter(_ORDERS, 'c_nationkey', 'o_orderdate', 'sum(' + cents('o_totalprice') + ') v')})",
    "int_company_countries_mapped":
        "(select s_suppkey k, s_nationkey n, s_suppkey % 9 <> 8 p from supplier "
        "union all select s_suppkey, (s_nationkey + 1) % 25, false from supplier)",
    "int_company_industries_mapped": "supplier",
    "int_company_financials_curated":
        f"({_per_quarter('lineitem', 'l_suppkey', 'l_shipdate', _V + ', ' + _N)})",
    "int_company_valuations_curated":
        f"({_per_quarter('lineitem', 'l_suppkey', 'l_shipdate', _V)}) q, "
        "(values ('ACTUAL', 8), ('FORECAST', 9)) w(vt, m)",
    "int_commitments_curated": "customer",
    "int_commitment_snapshots_curated":
        f"({_per_quarter('orders', 'o_custkey', 'o_orderdate', 'sum(' + cents('o_totalprice') + ') v')})",
    "int_opportunities_curated":
        f"{_ORDERS} cross join (select count(*) n_suppliers from supplier)",
    "int_opportunity_countries_curated": "orders",
    "int_opportunity_industries_curated": "orders",
    "int_transactions_classified": f"{_ORDERS} cross join (select count(*) n_parts from part)",
}


def _select(columns: dict[str, str], rows: str) -> str:
    return "select " + ", ".join(f'{e} as "{c}"' for c, e in columns.items()) + f" from {rows}"


INPUTS = {
    "sample_parts": _select(PARTS, "part cross join (select count(*) n_suppliers from supplier)"),
    **{name: _select(COLUMNS[name], rows) for name, rows in _SOURCES.items()},
}

_SAME = {
    "dim_investors": "int_investors_unified", "dim_funds": "int_funds_unified",
    "fct_fund_snapshots": "int_fund_snapshots_curated", "dim_companies": "int_companies_unified",
    "br_company_countries": "int_company_countries_mapped",
    "br_company_industries": "int_company_industries_mapped",
    "fct_company_financials": "int_company_financials_curated",
    "fct_company_valuations": "int_company_valuations_curated",
    "dim_share_classes": "int_share_classes_curated",
    "dim_instruments": "int_instruments_unified",
    "dim_instruments_equity": "int_instruments_equity_curated",
    "dim_instruments_credit": "int_instruments_credit_curated",
    "fct_instrument_cashflows": "int_instrument_cashflows_curated",
    "br_instrument_countries": "int_instrument_countries_mapped",
    "br_instrument_industries": "int_instrument_industries_mapped",
    "dim_facilities": "int_facilities_curated", "dim_commitments": "int_commitments_curated",
    "fct_commitment_snapshots": "int_commitment_snapshots_curated",
    "dim_opportunities": "int_opportunities_curated",
    "br_opportunity_countries": "int_opportunity_countries_curated",
    "br_opportunity_industries": "int_opportunity_industries_curated",
    "fct_transactions": "int_transactions_classified",
}

_CURATED = "int_instrument_snapshots_curated"

MODELS = {
    **{name: f"select * from {source}" for name, source in _SAME.items()},
    "dim_countries": "select iso2 country_iso2_code, iso3 country_iso3_code, name, region, "
                     "sub_region subregion, income_level, created_at, updated_at from ref_countries",
    "dim_currencies": "select currency_code, currency_name as name, currency_symbol symbol, "
                      "created_date created_at, last_modified_date updated_at from ref_currencies",
    "dim_industries": "select industry_id, canonical_name as name, created_at, updated_at "
                      "from stg_ref__industries",
    "dim_investor_types": "select * from stg_ref__investor_types",
    "dim_stages": 'select stage_id, name, pipeline_type as "type", stage_order as "order", '
                  "loaded_at created_at, loaded_at updated_at from stg_crm__stages",
    "fct_instrument_snapshots":
        "select instrument_snapshot_id, instrument_id, period_start_date, period_end_date, "
        "frequency, reporting_basis, snapshot_source, currency_code, fx_rate, fx_rate_as_of, "
        "fx_rate_source, fair_value, fair_value * fx_rate fair_value_converted, accrued_income, "
        "accrued_income * fx_rate accrued_income_converted, snapshot_source_file_ref, created_at, "
        f"updated_at from {_CURATED}",
    "fct_instrument_snapshots_credit":
        "select instrument_snapshot_id, " + ", ".join(
            f"{m}, {m} * fx_rate {m}_converted" for m in (
                "principal_outstanding", "undrawn_commitment", "accrued_interest",
                "accrued_fees", "amortized_cost"))
        + f", expected_loss, status from {_CURATED} where principal_outstanding is not null and "
        "instrument_id in (select instrument_id from dim_instruments where instrument_type = 'CREDIT')",
    "fct_instrument_snapshots_equity":
        f"select instrument_snapshot_id, equity_stake_pct, stake_basis from {_CURATED} "
        "where equity_stake_pct is not null and instrument_id in "
        "(select instrument_id from dim_instruments where instrument_type = 'EQUITY')",
    "int_expect_instruments_equity":
        "select instrument_id from dim_instruments where instrument_type = 'EQUITY'",
    "int_expect_instruments_credit":
        "select instrument_id from dim_instruments where instrument_type = 'LOAN'",
}


def complete(query: str, relations: dict[str, str]) -> str:
    """The query preceded by every relation it needs, each after its own needs."""
    ordered: dict[str, str] = {}

    def visit(text: str, inside: tuple[str, ...] = ()) -> None:
        # A relation's own name inside it is one of its columns.
        for word in dict.fromkeys(re.findall(r"[a-z_][a-z0-9_]*", text)):
            if word in relations and word not in ordered and word not in inside:
                visit(relations[word], (*inside, word))
                ordered[word] = relations[word]

    visit(query)
    if not ordered:
        return query
    ctes = ",\n".join(f"{name} as ({text})" for name, text in ordered.items())
    return f"with {ctes}\n{query}"
