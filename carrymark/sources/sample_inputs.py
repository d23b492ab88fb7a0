"""Canonical inputs derived from the TPC-H-like tables of one directory.

Used by the registered queries, the benchmark and the tests. A real deployment
passes its own relations to ``Catalog`` instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from carrymark.functions.dates import quarter_end
from carrymark.sources.catalog import Catalog
from carrymark.sources.sample_columns import COLUMNS, PARTS, SAMPLE_AS_OF, cents, currency


class SampleInputs:
    """Builds each input lazily; calling it with an input name returns a DataFrame."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark = spark
        self._directory = directory.rstrip("/")
        self._files: dict[str, DataFrame] = {}

    def file(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self._spark.read.parquet(f"{self._directory}/{name}.parquet")
        return self._files[name]

    def __call__(self, name: str) -> DataFrame:
        rows = self._ROWS[name](self)
        return rows.selectExpr(*[f"{e} as `{c}`" for c, e in COLUMNS[name].items()])

    # -- row sources ---------------------------------------------------------
    def _size(self, name: str) -> Column:
        return self.file(name).agg(F.count(F.lit(1))).scalar()

    def _parts(self) -> DataFrame:
        parts = self.file("part").withColumn("n_suppliers", self._size("supplier"))
        return parts.selectExpr(*[f"{e} as {c}" for c, e in PARTS.items()])

    def _countries(self) -> DataFrame:
        nation, region = self.file("nation"), self.file("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey)

    def _currencies(self) -> DataFrame:
        return self.file("part").selectExpr(f"{currency('p_partkey')} as code").distinct()

    def _stages(self) -> DataFrame:
        return self.file("orders").selectExpr("substr(o_orderpriority, 1, 1) as code").distinct()

    def _typed_parts(self, kind: str) -> DataFrame:
        return self._parts().where(F.col("itype") == kind)

    def _facilities(self) -> DataFrame:
        return (self._typed_parts("CREDIT").groupBy("fnum", "cnum")
                .agg(F.min("inception").alias("d"), F.sum("price").alias("t")))

    def _by_quarter(self, table: str, key: str, day: str, **totals: str) -> DataFrame:
        return (self.file(table)
                .groupBy(F.col(key).alias("k"), quarter_end(F.col(day)).alias("qe"))
                .agg(*[F.sum(F.expr(cents(c))).alias(a) for a, c in totals.items()]))

    def _snapshots(self) -> DataFrame:
        totals = self._by_quarter("lineitem", "l_partkey", "l_shipdate",
                                  v="l_extendedprice", n="l_quantity")
        return totals.join(self._parts().select("pk", "itype"), F.col("k") == F.col("pk"))

    def _flows(self) -> DataFrame:
        parts = self._parts().select("pk", "itype")
        return self.file("lineitem").join(parts, F.col("l_partkey") == F.col("pk"))

    def _instrument_countries(self) -> DataFrame:
        pair = F.explode(F.array(
            F.struct(F.col("fnum").alias("c"), F.lit(60).alias("a"), F.lit(True).alias("p")),
            F.struct(((F.col("pk") + 1) % 25).alias("c"), F.lit(40).alias("a"),
                     F.lit(False).alias("p"))))
        return self._parts().select("pk", pair.alias("b")).select("pk", "b.*")

    def _orders_of_customers(self) -> DataFrame:
        orders, customer = self.file("orders"), self.file("customer")
        return orders.join(customer, orders.o_custkey == customer.c_custkey)

    def _fund_snapshots(self) -> DataFrame:
        return (self._orders_of_customers()
                .groupBy(F.col("c_nationkey").alias("k"),
                         quarter_end(F.col("o_orderdate")).alias("qe"))
                .agg(F.sum(F.expr(cents("o_totalprice"))).alias("v")))

    def _company_countries(self) -> DataFrame:
        supplier = self.file("supplier")
        primary = supplier.selectExpr(
            "s_suppkey as k", "s_nationkey as n", "s_suppkey % 9 <> 8 as p")
        return primary.unionByName(supplier.selectExpr(
            "s_suppkey as k", "(s_nationkey + 1) % 25 as n", "false as p"))

    def _financials(self) -> DataFrame:
        return self._by_quarter("lineitem", "l_suppkey", "l_shipdate",
                                v="l_extendedprice", n="l_quantity")

    def _valuations(self) -> DataFrame:
        totals = self._by_quarter("lineitem", "l_suppkey", "l_shipdate", v="l_extendedprice")
        kind = F.explode(F.array(
            F.struct(F.lit("ACTUAL").alias("vt"), F.lit(8).alias("m")),
            F.struct(F.lit("FORECAST").alias("vt"), F.lit(9).alias("m"))))
        return totals.select("k", "qe", "v", kind.alias("w")).select("k", "qe", "v", "w.*")

    _ROWS: dict[str, Callable[[SampleInputs], DataFrame]] = {
        "ref_countries": _countries,
        "ref_currencies": _currencies,
        "stg_ref__industries": lambda s: s.file("part").select("p_type").distinct(),
        "stg_ref__investor_types": lambda s: s.file("customer").select("c_mktsegment").distinct(),
        "stg_crm__stages": _stages,
        "int_investors_unified": lambda s: s.file("customer"),
        "int_funds_unified": lambda s: s.file("nation"),
        "int_companies_unified": lambda s: s.file("supplier"),
        "int_instruments_unified": _parts,
        "int_share_classes_curated": lambda s: s.file("supplier"),
        "int_instruments_equity_curated": lambda s: s._typed_parts("EQUITY"),
        "int_facilities_curated": _facilities,
        "int_instruments_credit_curated": lambda s: s._typed_parts("CREDIT"),
        "int_instrument_snapshots_curated": _snapshots,
        "int_instrument_cashflows_curated": _flows,
        "int_instrument_countries_mapped": _instrument_countries,
        "int_instrument_industries_mapped": _parts,
        "int_fund_snapshots_curated": _fund_snapshots,
        "int_company_countries_mapped": _company_countries,
        "int_company_industries_mapped": lambda s: s.file("supplier"),
        "int_company_financials_curated": _financials,
        "int_company_valuations_curated": _valuations,
        "int_commitments_curated": lambda s: s.file("customer"),
        "int_commitment_snapshots_curated":
            lambda s: s._by_quarter("orders", "o_custkey", "o_orderdate", v="o_totalprice"),
        "int_opportunities_curated":
            lambda s: s._orders_of_customers().withColumn("n_suppliers", s._size("supplier")),
        "int_opportunity_countries_curated": lambda s: s.file("orders"),
        "int_opportunity_industries_curated": lambda s: s.file("orders"),
        "int_transactions_classified":
            lambda s: s._orders_of_customers().withColumn("n_parts", s._size("part")),
    }


class SampleCatalog(Catalog):
    """A catalog over sample inputs that also gives access to the files behind them."""

    def __init__(self, spark: SparkSession, directory: str, as_of: str = SAMPLE_AS_OF):
        inputs = SampleInputs(spark, directory)
        super().__init__(spark, inputs, as_of=as_of)
        self.file = inputs.file


def sample_catalog(spark: SparkSession, directory: str, as_of: str = SAMPLE_AS_OF) -> SampleCatalog:
    return SampleCatalog(spark, directory, as_of)
