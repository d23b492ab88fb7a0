"""Exposure by month: deployed capital today plus expected deal closings.

Deployed rows never carry a stage and deal rows never carry an instrument type,
so the two families cannot meet on the output grain. Each is spread over the
months on its own and the results are concatenated; no spine of all months and
dimension values is joined back.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window, functions as F

from carrymark.functions.dates import clock, month_spine, month_start
from carrymark.functions.money import allocation_share, exact, sum_when
from carrymark.functions.vocab import CLOSED_STAGES, CREDIT, EQUITY
from carrymark.operators.intervals import INT_SIZES, blocks_of_interval, blocks_of_point
from carrymark.operators.snapshots import latest_positions
from carrymark.operators.validity import valid_at

if TYPE_CHECKING:
    from carrymark.sources.catalog import Catalog

MONTHS_AHEAD = 12
PLACE = ["region", "country_code", "country_name", "industry_id", "industry_name"]
# Every amount the inputs can hold fits: 22 digits and six decimals. Allocated
# amounts keep ten decimals, the most that 38 digits leave; whole percentages need
# no more, and fractions of a percent are rounded there, allocation by allocation.
# What does not fit stops the job.
AMOUNT = "decimal(38,10)"
NATIVE = "decimal(28,6)"
SHARE = "decimal(12,4)"
COMBINED_SHARE = "decimal(13,8)"


# --- deployed capital --------------------------------------------------------

def deployed_by_instrument(catalog: Catalog) -> DataFrame:
    """Current exposure of each instrument with a reported value.

    Equity counts its converted fair value, or the native value where no rate is
    known. Credit counts principal plus undrawn commitment and needs at least
    one converted measure.
    """
    instruments = catalog.table("dim_instruments").select(
        "instrument_id", "fund_id", "company_id", "instrument_type")
    terms = catalog.table("dim_instruments_credit").select(
        "instrument_id", "maturity_date", "security_rank", F.lit(True).alias("has_terms"))
    held = (latest_positions(catalog).join(instruments, "instrument_id")
            .join(terms, "instrument_id", "left"))
    is_credit = (F.col("instrument_type") == CREDIT) & F.col("has_terms")
    principal = F.col("credit.principal_outstanding_converted")
    undrawn = F.col("credit.undrawn_commitment_converted")
    fair, zero = F.col("latest.fair_value"), F.lit(0)
    equity_value = F.coalesce(F.col("latest.fair_value_converted"), fair)
    credit_value = F.coalesce(principal, zero) + F.coalesce(undrawn, zero)
    is_equity = F.col("instrument_type") == EQUITY
    kept = ((is_equity & fair.isNotNull())
            | (is_credit & (principal.isNotNull() | undrawn.isNotNull())))
    return held.where(kept).select(
        "instrument_id", "fund_id", "company_id", "instrument_type",
        F.col("latest.period_end_date").alias("period_end_date"),
        exact(F.when(is_equity, equity_value).otherwise(credit_value), NATIVE)
        .alias("exposure_usd"),
        F.when(is_credit, F.col("maturity_date")).alias("maturity_date"),
        F.when(is_credit, F.year("maturity_date")).alias("maturity_year"),
        F.when(is_credit, F.col("security_rank")).alias("security_rank"))


def _funds(catalog: Catalog) -> DataFrame:
    return catalog.table("dim_funds").select("fund_id", F.col("name").alias("fund_name"))


def _with_place(catalog: Catalog, df: DataFrame) -> DataFrame:
    """Country and industry labels for rows that carry the two codes."""
    countries = catalog.table("dim_countries").select(
        F.col("country_iso2_code").alias("country_code"), F.col("name").alias("_country"),
        F.col("region").alias("_region"))
    industries = catalog.table("dim_industries").select(
        "industry_id", F.col("name").alias("_industry"))
    labelled = (df.join(countries, "country_code", "left").join(industries, "industry_id", "left"))
    return labelled.withColumns({
        "region": F.coalesce("_region", F.lit("Unknown Region")),
        "country_code": F.coalesce("country_code", F.lit("UNKNOWN")),
        "country_name": F.coalesce("_country", F.lit("Unknown Country")),
        "industry_id": F.coalesce("industry_id", F.lit("UNKNOWN")),
        "industry_name": F.coalesce("_industry", F.lit("Unknown Industry")),
    }).drop("_region", "_country", "_industry")


def _allocated(amount: Column, share: Column) -> Column:
    """The share of an amount, to ten decimals."""
    product = amount * share
    lost = amount.isNotNull() & share.isNotNull() & product.isNull()
    return exact(F.when(lost, F.raise_error(F.lit("an allocated amount does not fit")).cast(
        AMOUNT)).otherwise(product), AMOUNT)


def link_shares(bridge: DataFrame, entity: str, code: str, share: str, *bounds: str) -> DataFrame:
    """Total share per entity and code, and validity interval where given.

    Shares act linearly, so repeated links can be added up before the join. An
    entity then has at most one row per code and interval, however many link
    rows it owns.
    """
    return bridge.groupBy(entity, code, *bounds).agg(
        exact(F.sum(allocation_share(F.col("allocation_pct"))), SHARE).alias(share))


def deployed_base(catalog: Catalog, *, country_validity: bool = False) -> DataFrame:
    """Deployed capital by fund, type, place, industry, maturity year and rank.

    Exposure is split by the industry and country percentages; a missing
    percentage takes the whole amount. Industry links must be valid at the
    snapshot date; country links only with ``country_validity``.
    """
    held = deployed_by_instrument(catalog)

    def allocated(df: DataFrame, bridge: str, code: str, share: str, only_valid: bool) -> DataFrame:
        bounds = ["valid_from", "valid_to"] if only_valid else []
        links = link_shares(catalog.table(bridge), "instrument_id", code, share, *bounds)
        links = links.withColumnRenamed("instrument_id", "_linked")
        on = F.col("instrument_id") == F.col("_linked")
        if only_valid:
            on &= valid_at(F.col("period_end_date"), F.col("valid_from"), F.col("valid_to"))
        return df.join(links, on, "left").drop("_linked", *bounds)

    held = allocated(held, "br_instrument_countries", "country_code", "_country_share",
                     country_validity)
    held = allocated(held, "br_instrument_industries", "industry_id", "_industry_share", True)
    whole = F.lit(1).cast(SHARE)
    share = exact(F.coalesce("_industry_share", whole) * F.coalesce("_country_share", whole),
                  COMBINED_SHARE)
    # Labels come after the sums: codes determine them, and the sums are small.
    sums = held.groupBy("fund_id", "instrument_type", "country_code", "industry_id",
                        "maturity_year", "security_rank").agg(
        exact(F.sum(_allocated(F.col("exposure_usd"), share)), AMOUNT)
        .alias("deployed_capital_usd"),
        F.max("period_end_date").alias("as_of_date"))
    labelled = _with_place(catalog, sums).join(_funds(catalog), "fund_id")
    # A code missing from its link and a code spelled UNKNOWN share one label.
    return labelled.groupBy("fund_id", "fund_name", "instrument_type", *PLACE, "maturity_year",
                            "security_rank").agg(
        exact(F.sum("deployed_capital_usd"), AMOUNT).alias("deployed_capital_usd"),
        F.max("as_of_date").alias("as_of_date"))


# --- open deals --------------------------------------------------------------

def open_stages(catalog: Catalog) -> DataFrame:
    return (catalog.table("dim_stages").where(~F.col("name").isin(*CLOSED_STAGES))
            .select("stage_id", F.col("name").alias("stage_name"),
                    F.col("order").alias("stage_order")))


def _deal_values(catalog: Catalog) -> DataFrame:
    """Country-weighted value of every open deal with a close date, unlabelled.

    A deal in a stage without an order has reached no stage.
    """
    stages = (open_stages(catalog).where("stage_order is not null")
              .select("stage_id", "stage_order"))
    deals = (catalog.table("dim_opportunities").where(F.col("close_date").isNotNull())
             .select("opportunity_id", "fund_id", "stage_id", "amount", "close_date")
             .join(stages, "stage_id"))
    countries = link_shares(catalog.table("br_opportunity_countries"), "opportunity_id",
                            "country_code", "share")
    # Industry links carry no percentage: each one counts the deal in full.
    industries = (catalog.table("br_opportunity_industries")
                  .where(F.coalesce("primary_flag", F.lit(True)))
                  .groupBy("opportunity_id", "industry_id")
                  .agg(F.count(F.lit(1)).alias("links")))
    weight = exact(F.coalesce("share", F.lit(1).cast(SHARE))
                   * F.coalesce("links", F.lit(1)).cast("decimal(18,0)"), SHARE)
    return (deals.join(countries, "opportunity_id", "left")
            .join(industries, "opportunity_id", "left")
            .select("fund_id", "stage_order", "country_code",
                    "industry_id", month_start(F.col("close_date")).alias("close_month"),
                    _allocated(F.col("amount"), weight).alias("value")))


def _stages_between(catalog: Catalog, steps: DataFrame) -> DataFrame:
    """The open stages with an order in (below, stage_order], for each distinct step.

    Steps are pairs of stage orders, as few as configuration makes them.
    """
    first = F.coalesce(F.col("below").cast("long") + 1, F.lit(-(1 << 31)))
    held = steps.select("below", "stage_order", F.inline(
        blocks_of_interval(first, F.col("stage_order"), INT_SIZES)))
    stages = open_stages(catalog).where("stage_order is not null").select(
        "stage_id", "stage_name", F.inline(blocks_of_point(F.col("stage_order"), INT_SIZES)))
    return held.join(stages, ["size", "block"]).drop("size", "block")


def _reached(catalog: Catalog, by_order: DataFrame, key: list[str],
             amounts: list[str]) -> DataFrame:
    """Amounts of all deals that have reached a stage, for every stage of a key, labelled.

    ``by_order`` has one row for each key and order of its deals' stages. A deal has
    reached its own stage, those with the same order and all before, so what has reached
    a stage is a sum over the orders from it on: a running sum within the key. It holds for
    all stages down to the next order that the key has deals in.
    """
    onwards = Window.partitionBy(*key).orderBy(F.desc("stage_order"))
    summed = by_order.select(
        *key, "stage_order",
        F.lead("stage_order").over(onwards).alias("below"),
        *[exact(F.sum(a).over(onwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                AMOUNT).alias(a) for a in amounts])
    steps = _stages_between(catalog, summed.select("below", "stage_order").distinct())
    steps = steps.select(F.col("below").alias("_below"), F.col("stage_order").alias("_order"),
                         "stage_id", "stage_name")
    same = F.col("below").eqNullSafe(F.col("_below")) & (F.col("stage_order") == F.col("_order"))
    spread = summed.join(steps, same).drop("below", "_below", "stage_order", "_order")
    return _with_place(catalog, spread).join(_funds(catalog), "fund_id")


DEAL_GRAIN = ["fund_id", "fund_name", *PLACE, "stage_id", "stage_name"]


def open_deal_base(catalog: Catalog) -> DataFrame:
    """Open deal value by close month, place, industry and reached stage."""
    key = ["close_month", "fund_id", "country_code", "industry_id"]
    own = (_deal_values(catalog).groupBy(*key, "stage_order")
           .agg(exact(F.sum("value"), AMOUNT).alias("value")))
    return (_reached(catalog, own, key, ["value"]).groupBy("close_month", *DEAL_GRAIN)
            .agg(exact(F.sum("value"), AMOUNT).alias("pipeline_value_usd")))


# --- mart --------------------------------------------------------------------

def _month_labels(first: Column) -> dict[str, Column]:
    month = F.col("exposure_month")
    return {
        "exposure_year": F.year(month),
        "exposure_month_num": F.month(month),
        "period_type": F.when(month == first, F.lit("Current"))
        .when(month < first, F.lit("Historical")).otherwise(F.lit("Forecast")),
    }


def _deal_months(catalog: Catalog, first: Column) -> DataFrame:
    """Per deal key, the value closed up to each month of the spine.

    Deals are first summed per order of their stage: what has closed by each month is
    a conditional sum. Keys whose deals all close later keep their rows, with zeros.
    """
    key = ["fund_id", "country_code", "industry_id"]
    zero = F.lit(0).cast(AMOUNT)
    totals = {f"_m{i}": sum_when(F.col("close_month") <= F.add_months(first, i), F.col("value"))
              for i in range(MONTHS_AHEAD + 1)}
    own = _deal_values(catalog).groupBy(*key, "stage_order").agg(
        *[exact(F.coalesce(total, zero), AMOUNT).alias(name) for name, total in totals.items()])
    keyed = _reached(catalog, own, key, list(totals)).groupBy(*DEAL_GRAIN).agg(
        *[exact(F.sum(name), AMOUNT).alias(name) for name in totals])
    months = F.array(*[
        F.struct(F.add_months(first, i).alias("exposure_month"),
                 F.col(name).alias("closed_pipeline_usd"))
        for i, name in enumerate(totals)])
    return keyed.select(*DEAL_GRAIN, F.explode(months).alias("_month")).select(
        *DEAL_GRAIN, "_month.*", zero.alias("deployed_capital_usd"))


def exposure_timeseries(catalog: Catalog, *, country_validity: bool = False) -> DataFrame:
    """Thirteen months of exposure from the month of the valuation date, in no order."""
    today = clock(catalog.as_of)
    first = month_start(today)
    deployed = (deployed_base(catalog, country_validity=country_validity)
                .withColumn("exposure_month", F.explode(month_spine(today, MONTHS_AHEAD)))
                .withColumn("closed_pipeline_usd", F.lit(0).cast(AMOUNT)))
    rows = deployed.unionByName(_deal_months(catalog, first), allowMissingColumns=True)
    return rows.withColumns({
        **_month_labels(first),
        "total_exposure_usd": F.col("deployed_capital_usd") + F.col("closed_pipeline_usd"),
    }).select(
        "exposure_month", "exposure_year", "exposure_month_num", "fund_id", "fund_name",
        "instrument_type", *PLACE, "maturity_year", "security_rank", "stage_id", "stage_name",
        "deployed_capital_usd", "closed_pipeline_usd", "total_exposure_usd", "period_type",
        "as_of_date")
