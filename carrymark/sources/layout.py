"""How stored tables are laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The key each large relation is joined on. Tables bucketed alike by it join and
# aggregate on it without a shuffle.
_BUCKETED = {
    "instrument_id": (
        "int_instruments_unified", "int_instruments_equity_curated",
        "int_instruments_credit_curated", "int_instrument_snapshots_curated",
        "int_instrument_cashflows_curated", "int_instrument_countries_mapped",
        "int_instrument_industries_mapped", "dim_instruments", "dim_instruments_equity",
        "dim_instruments_credit", "br_instrument_countries", "br_instrument_industries"),
    # The three facts are joined with each other; totals per instrument come after.
    "instrument_snapshot_id": (
        "fct_instrument_snapshots", "fct_instrument_snapshots_credit",
        "fct_instrument_snapshots_equity"),
    "opportunity_id": (
        "int_opportunities_curated", "int_opportunity_countries_curated",
        "int_opportunity_industries_curated", "dim_opportunities", "br_opportunity_countries",
        "br_opportunity_industries"),
    "company_id": (
        "int_companies_unified", "int_company_financials_curated",
        "int_company_valuations_curated", "dim_companies"),
}
BUCKET_KEY = {table: key for key, tables in _BUCKETED.items() for table in tables}


def store(df: DataFrame, database: str, name: str, *, buckets: int | None = None,
          partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a parquet table and read it back.

    ``buckets`` holds for tables with a bucket key; others have none to bucket by.
    A bucket is read by one task and cannot be split later, unlike a shuffle
    partition, so a table that one key value dominates is better left unbucketed.
    """
    spark, target = df.sparkSession, f"`{database}`.`{name}`"
    spark.sql(f"create database if not exists `{database}`")
    key = BUCKET_KEY.get(name)
    bucketed = bool(buckets and key)
    # Shuffled by bucket first, each bucket becomes one file.
    rows = df.repartition(buckets, key) if bucketed else df
    writer = rows.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucketed:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(target)
    return spark.table(target)


def store_view(spark: SparkSession, query: str, database: str, name: str) -> DataFrame:
    """A permanent view in the metastore, which every later session can read."""
    target = f"`{database}`.`{name}`"
    spark.sql(f"create database if not exists `{database}`")
    spark.sql(f"create or replace view {target} as {query}")
    return spark.table(target)
