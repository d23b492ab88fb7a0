"""Physical plans: what must not and what must be in them."""

import re

import pytest
from pyspark.sql import functions as F

from carrymark.plans import fund
from carrymark.plans.cashflows import returns_cashflows
from carrymark.plans.registry import TABLES
from carrymark.queries import BLOCKS, QUESTIONS
from carrymark.sources.catalog import Catalog
from carrymark.sources.sample_inputs import sample_catalog
from conftest import SMALL, frame

MARTS = [name for name, spec in TABLES.items() if spec.role == "metrics"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [*MARTS, *BLOCKS])
def test_no_pairing_joins_and_no_python(spark, no_broadcast, name):
    """Even when nothing fits a broadcast, every join has an equality key."""
    catalog = sample_catalog(spark, SMALL)
    plan = plan_of(BLOCKS[name](catalog) if name in BLOCKS else catalog.table(name))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


def test_fund_mart_reads_each_fact_once(spark):
    catalog = sample_catalog(spark, SMALL)
    plan = plan_of(catalog.table("metrics_fund_performance"))
    assert plan.count("lineitem.parquet") == 2  # once as cash flows, once as snapshots
    scans = [line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line]
    assert all("l_tax" not in s and "l_discount" not in s for s in scans)


def test_filters_reach_the_scan(spark, tmp_path):
    """A date filter on the cash-flow mart is pushed into the stored fact."""
    catalog = sample_catalog(spark, SMALL)
    for name in ("int_instrument_cashflows_curated", "int_instruments_unified",
                 "int_funds_unified", "int_companies_unified"):
        catalog.table(name).write.parquet(str(tmp_path / name))
    stored = Catalog.from_parquet(spark, str(tmp_path))
    flows = returns_cashflows(stored).where("cashflow_date >= '1997-01-01'").select(
        "fund_id", "cashflow_amount")
    scan = next(line for line in plan_of(flows).splitlines()
                if "FileScan" in line and "amount_converted" in line)
    assert "GreaterThanOrEqual(date,1997-01-01)" in scan
    assert "fx_rate_source" not in scan.split("ReadSchema")[1]


def test_unused_flow_types_stay_in_the_scan(spark, tmp_path):
    catalog = sample_catalog(spark, SMALL)
    for name in ("int_instrument_cashflows_curated", "int_instruments_unified"):
        catalog.table(name).write.parquet(str(tmp_path / name))
    stored = Catalog.from_parquet(spark, str(tmp_path))
    stored.replace("fct_fund_snapshots", catalog.table("fct_fund_snapshots"))
    called = fund.cumulative_flows(stored, "called", "called_capital")
    scan = next(line for line in plan_of(called).splitlines()
                if "FileScan" in line and "amount_converted" in line)
    assert "In(instrument_cashflow_type, [INVESTMENT,PURCHASE])" in scan


def test_latest_positions_shuffle_one_row_per_instrument(spark):
    """Map-side partials come before the only shuffle of the snapshots."""
    plan = plan_of(sample_catalog(spark, SMALL).table("metrics_position_performance"))
    assert "partial_max(" in plan and "row_number" not in plan


def test_a_hot_instrument_is_split_at_run_time(spark, no_broadcast):
    """One instrument owns a third of the flows and a third of the fund's rows."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 60_000
        ids = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
        flows = spark.range(0, n, 1, 8).select(
            F.concat(F.lit("I"), ids.cast("string")).alias("instrument_id"),
            F.lit("DIVIDEND").alias("instrument_cashflow_type"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("date"),
            (F.rand(3) * 1000).cast("decimal(24,2)").alias("amount_converted"))
        names = frame(spark, "int_instrument_cashflows_curated", []).columns
        padded = flows.select(*[
            c if c in flows.columns else F.lit(None).cast("string").alias(c) for c in names])
        catalog = Catalog(spark, {
            "int_instrument_cashflows_curated": padded,
            "int_instruments_unified": frame(spark, "int_instruments_unified", [
                dict(instrument_id=f"I{i}", fund_id="A", company_id="X", name=f"I{i}",
                     instrument_type="EQUITY") for i in range(500)]),
            "int_funds_unified": frame(spark, "int_funds_unified", [
                dict(fund_id="A", name="Alpha", type="EQUITY")]),
            "int_companies_unified": frame(spark, "int_companies_unified", []),
        })
        result = returns_cashflows(catalog)
        assert result.count() == n
        rows = result.collect()
        assert len(rows) == n
        assert "skew=true" in plan_of(result)
        assert sum(r.cashflow_amount for r in rows) == flows.agg(F.sum("amount_converted")).first()[0]
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize("name, mart", [
    ("x13_latest_fund_performance", "metrics_fund_performance"),
    ("x15_latest_company_performance", "metrics_company_performance"),
    ("x17_latest_portfolio", "metrics_portfolio_overview")])
def test_newest_period_scans_facts_as_often_as_the_mart(spark, name, mart):
    def scans(df):
        df.collect()
        plan = plan_of(df).split("== Initial Plan ==")[0]
        return sorted(re.findall(r"FileScan parquet.*?/(\w+)\.parquet", plan))

    assert scans(QUESTIONS[name](sample_catalog(spark, SMALL))) == scans(
        sample_catalog(spark, SMALL).table(mart).repartition(3, F.col("period_end_date")))
