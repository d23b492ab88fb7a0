"""Cash flows with their owners, direction and sign: one row per flow."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from carrymark.functions.vocab import RETURNS_OUTFLOWS

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog


def fund_instruments(catalog: Catalog) -> DataFrame:
    """Instruments of known funds."""
    funds = catalog.table("dim_funds").select("fund_id", F.col("name").alias("fund_name"))
    instruments = catalog.table("dim_instruments").select(
        "instrument_id", F.col("name").alias("instrument_name"), "fund_id", "company_id")
    return instruments.join(funds, "fund_id")


def directed_flows(catalog: Catalog, owners: DataFrame) -> DataFrame:
    flows = catalog.table("fct_instrument_cashflows").select(
        "instrument_id", "instrument_cashflow_type", "date", "amount_converted",
        "currency_code", "fx_rate")
    out = F.col("instrument_cashflow_type").isin(*RETURNS_OUTFLOWS)
    amount = F.col("amount_converted")
    return flows.withColumns({
        "direction": F.when(out, F.lit("outflow")).otherwise(F.lit("inflow")),
        "signed_amount": F.when(out, -amount).otherwise(amount),
    }).join(owners, "instrument_id")


def returns_cashflows(catalog: Catalog) -> DataFrame:
    """Owners are joined to each other first, so the flows move at most once."""
    companies = catalog.table("dim_companies").select(
        "company_id", F.col("name").alias("company_name"))
    owners = fund_instruments(catalog).join(companies, "company_id", "left")
    return directed_flows(catalog, owners).select(
        "fund_id", "fund_name", "instrument_id", "instrument_name", "company_id", "company_name",
        F.col("date").alias("cashflow_date"),
        F.col("instrument_cashflow_type").alias("cashflow_type"),
        F.col("amount_converted").alias("cashflow_amount"),
        "currency_code", "fx_rate", "direction", "signed_amount")
