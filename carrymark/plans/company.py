"""Company performance: one row per company and financial period."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from carrymark.functions.money import ratio
from carrymark.operators.intervals import smallest_in_force

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

GRAIN = ["company_id", "period_end_date"]


def actual_valuations(catalog: Catalog) -> DataFrame:
    """Actual valuation per company and period; of several, the smallest id."""
    return (catalog.table("fct_company_valuations").where(F.col("valuation_type") == "ACTUAL")
            .groupBy(*GRAIN)
            .agg(F.min_by("amount", "company_valuation_id").alias("enterprise_value")))


def _primary_links(catalog: Catalog, bridge: str, code: str, dimension: str, key: str) -> DataFrame:
    names = catalog.table(dimension).select(F.col(key).alias(code), "name")
    return (catalog.table(bridge).where("primary_flag")
            .select("company_id", code, "valid_from", "valid_to").join(names, code))


def primary_name(catalog: Catalog, bridge: str, code: str, dimension: str, key: str,
                 output: str, periods: DataFrame | None = None) -> DataFrame:
    """Name of a company's primary country or industry, the first by alphabet.

    With ``periods`` (company, period) only links valid at the period count and
    the result is per period.
    """
    links = _primary_links(catalog, bridge, code, dimension, key)
    if periods is None:
        return links.groupBy("company_id").agg(F.min("name").alias(output))
    named = smallest_in_force(periods, links, ["company_id"], "period_end_date", "name")
    return named.withColumnRenamed("name", output)


def company_performance(catalog: Catalog, *, as_of_period: bool = False) -> DataFrame:
    """Financials, margins and valuation multiples.

    Primary country and industry ignore validity unless ``as_of_period`` is set.
    """
    financials = catalog.table("fct_company_financials")
    companies = catalog.table("dim_companies").select(
        "company_id", F.col("name").alias("company_name"), "website", "description")
    country = ("br_company_countries", "country_code", "dim_countries", "country_iso2_code",
               "primary_country")
    industry = ("br_company_industries", "industry_id", "dim_industries", "industry_id",
                "primary_industry")
    measured = financials.join(actual_valuations(catalog), GRAIN, "left")
    if as_of_period:
        periods = financials.select(*GRAIN).distinct()
        for link in (country, industry):
            measured = measured.join(primary_name(catalog, *link, periods=periods), GRAIN, "left")
    else:
        for link in (country, industry):
            companies = companies.join(primary_name(catalog, *link), "company_id", "left")

    revenue, ebitda, value = F.col("revenue"), F.col("ebitda"), F.col("enterprise_value")
    return measured.join(companies, "company_id").select(
        "company_id", "company_name", "primary_country", "primary_industry", "website",
        "description", "period_end_date", "revenue", "ebitda",
        (ratio(ebitda, revenue) * 100).alias("ebitda_margin"),
        "cash", "total_assets", "total_liabilities", "equity",
        (F.col("total_liabilities") - F.col("cash")).alias("net_debt"),
        "enterprise_value",
        ratio(value, ebitda).alias("ev_to_ebitda"),
        ratio(value, revenue).alias("ev_to_revenue"),
        F.col("currency_code").alias("reporting_currency"))
