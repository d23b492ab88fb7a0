import pytest
from pyspark.errors import AnalysisException

from carrymark.functions.dates import date_shift, month_spine, quarter_end
from carrymark.operators.snapshots import (
    SNAPSHOT_FACTS, latest_positions, period_positions, reported_snapshots)
from carrymark.plans import fund
from carrymark.plans.registry import TABLES
from carrymark.queries import SAMPLE_SPEC
from carrymark.sources.catalog import Catalog
from carrymark.sources.layout import store
from carrymark.sources.sample_inputs import sample_catalog
from carrymark.sources.schemas import input_schema, INPUTS
from carrymark.sources.seeds import read_seed
from carrymark.sources.staging import SourceSpec, stage
from conftest import SMALL, day, records
from pyspark.sql import functions as F

COUNTRY_HEADER = "id,iso2,iso3,name,phone_code,region,sub_region,income_level,created_at,updated_at"


def test_country_seed_keeps_na_and_empty_fields(spark, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_text(f"{COUNTRY_HEADER}\n"
                    "1,NA,NAX,Inland,99,South,Far South,LMC,2023-02-03,2025-01-26\n"
                    "2,QZ,,Nowhere,1,,,,,\n", encoding="utf-8")
    rows = records(read_seed(spark, "ref_countries", str(path)), "id")
    assert rows["1"]["iso2"] == "NA" and rows["1"]["updated_at"] == day("2025-01-26")
    assert rows["2"]["iso3"] is None and rows["2"]["income_level"] is None


def test_currency_seed_reads_symbols(spark, tmp_path):
    path = tmp_path / "currencies.csv"
    path.write_text("currency_code,iso_numeric_code,currency_name,currency_symbol,created_date,"
                    "last_modified_date\nEUR,978,Euro,€,2020-01-01,2024-01-01\n", encoding="utf-8")
    catalog = Catalog(spark, {"ref_currencies": read_seed(spark, "ref_currencies", str(path))})
    assert catalog.table("dim_currencies").first().asDict() == dict(
        currency_code="EUR", name="Euro", symbol="€", created_at=day("2020-01-01"),
        updated_at=day("2024-01-01"))


def test_seed_with_another_header_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("iso2,id\nNA,1\n", encoding="utf-8")
    with pytest.raises(Exception):
        read_seed(spark, "ref_countries", str(path)).collect()
    with pytest.raises(KeyError):
        read_seed(spark, "ref_planets", str(path))


def raw(spark, **extra):
    values = {"ID": 1, "Name": "  Acme ", "Country": "n1", "Secret": "x", "Bal": 2.5, **extra}
    return spark.createDataFrame([tuple(values.values())], list(values))


def test_stage_projects_trims_and_adds_lineage(spark):
    df = stage(raw(spark), SAMPLE_SPEC, "crm_vendor", "raw_companies")
    assert df.columns == ["company_id", "company_name", "country", "bal", "source_system",
                          "source_table", "loaded_at"]
    row = df.first()
    assert (row.company_name, row.country, row.source_system) == ("Acme", "N1", "CRM_VENDOR")


@pytest.mark.parametrize("spec, columns", [
    (SourceSpec(include=("id", "bal"), add_metadata=False), ["id", "bal"]),
    (SourceSpec(include=("id", "bal"), exclude=("bal",), add_metadata=False), ["id"]),
    (SourceSpec(exclude=("id", "name", "country", "secret", "bal")),
     ["source_system", "source_table", "loaded_at"]),
])
def test_stage_column_lists(spark, spec, columns):
    assert stage(raw(spark), spec, "s", "t").columns == columns


def test_stage_keeps_the_sources_own_lineage_columns(spark):
    df = raw(spark, LOADED_AT="then", Source_System="own")
    kept = stage(df, SourceSpec(include=("id", "loaded_at")), "s", "t")
    assert kept.columns == ["id", "loaded_at", "source_table"]
    assert kept.first().loaded_at == "then"


def test_stage_transform_replaces_the_default(spark):
    spec = SourceSpec(transforms={"name": "upper(name)"}, renames={"name": "label"},
                      add_metadata=False, include=("name",))
    assert stage(raw(spark), spec, "s", "t").first().asDict() == {"label": "  ACME "}


def test_dates(spark):
    row = spark.range(1).select(
        quarter_end(F.lit("2020-02-29").cast("date")).alias("q"),
        month_spine(F.lit("2020-06-15").cast("date")).alias("m"),
        date_shift(F.lit("2020-03-31").cast("date"), "Month", -1).cast("string").alias("clamped"),
        date_shift(F.lit("2020-02-29").cast("date"), "years", 1).cast("string").alias("leap"),
        date_shift(F.lit("2020-01-01 10:00:00").cast("timestamp"), "day", 1)
        .cast("string").alias("kept_time"),
        date_shift(F.lit("2020-01-01").cast("date"), "hours", F.col("id") + 5)
        .cast("string").alias("column_amount"),
    ).first()
    assert row.q == day("2020-03-31")
    assert len(row.m) == 13 and row.m[0] == day("2020-06-01") and row.m[-1] == day("2021-06-01")
    assert row.clamped == "2020-02-29 00:00:00" and row.leap == "2021-02-28 00:00:00"
    assert row.kept_time == "2020-01-02 10:00:00" and row.column_amount == "2020-01-01 05:00:00"


def test_inputs_are_narrowed_and_cast(spark):
    wide = spark.createDataFrame(
        [("1", "Screening", "DEAL", "7", "2020-01-01 00:00:00", "noise")],
        "stage_id string, name string, pipeline_type string, stage_order string, "
        "loaded_at string, extra string")
    df = Catalog(spark, {"stg_crm__stages": wide}).table("dim_stages")
    assert df.columns == ["stage_id", "name", "type", "order", "created_at", "updated_at"]
    assert df.schema["order"].dataType.typeName() == "integer"
    with pytest.raises(AnalysisException):
        Catalog(spark, {"stg_crm__stages": wide.drop("name")}).table("dim_stages")


def test_every_input_and_table_has_rows_and_a_schema(spark):
    catalog = sample_catalog(spark, SMALL)
    assert len(INPUTS) == 28 and len(TABLES) == 45
    for name in (*INPUTS, *TABLES):
        assert catalog.table(name).columns
    with pytest.raises(KeyError):
        catalog.table("dim_planets")


def test_parquet_and_database_inputs(spark, tmp_path):
    source = sample_catalog(spark, SMALL)
    source.table("stg_crm__stages").write.parquet(str(tmp_path / "stg_crm__stages"))
    assert Catalog.from_parquet(spark, str(tmp_path)).table("dim_stages").count() == 5
    spark.sql("create database if not exists staging_area")
    source.table("stg_crm__stages").write.mode("overwrite").saveAsTable("staging_area.stg_crm__stages")
    assert Catalog.from_database(spark, "staging_area").table("dim_stages").count() == 5


def test_saved_tables_views_and_sql(spark):
    catalog = sample_catalog(spark, SMALL)
    expected = catalog.table("metrics_portfolio_overview").count()
    catalog.save_all("ref_currencies", "dim_funds", "fct_fund_snapshots", "int_expect_instruments_equity",
                     "metrics_fund_performance", "metrics_returns_cashflows",
                     "metrics_portfolio_overview")
    assert spark.table("metrics.metrics_portfolio_overview").count() == expected
    assert spark.table("public.dim_funds").count() == 25
    assert spark.table("reference.ref_currencies").count() == 3
    assert spark.sql("select * from public.fct_fund_snapshots").count() > 0
    # The overview was built from the stored fund mart.
    assert "metrics_fund_performance" in catalog.table("metrics_fund_performance").inputFiles()[0]
    catalog.save("metrics_portfolio_overview")  # a rebuild replaces the stored table
    catalog.register_views("metrics_portfolio_overview")
    latest = spark.sql("""select number_of_funds from metrics_portfolio_overview
        where period_end_date = (select max(period_end_date) from metrics_portfolio_overview)""")
    assert latest.first()[0] > 0


def test_partitioned_table_prunes_folders(spark):
    catalog = sample_catalog(spark, SMALL)
    mart = catalog.save("metrics_fund_performance", partition_by=["period_end_date"])
    plan = mart.where("period_end_date = '1998-06-30'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period_end_date" in plan


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if " Exchange " in line]


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast):
    catalog = sample_catalog(spark, SMALL)
    catalog.save_all("dim_instruments", "dim_instruments_credit", buckets=4)
    joined = catalog.table("dim_instruments").join(
        catalog.table("dim_instruments_credit"), "instrument_id")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert not _exchanges(joined)


def test_bucketed_inputs_carry_marts_without_a_fact_shuffle(spark, no_broadcast):
    """Latest positions and flow totals meet by instrument where they are stored."""
    sample_catalog(spark, SMALL).save_inputs(database="bucketed", buckets=4)
    catalog = Catalog.from_database(spark, "bucketed", as_of="1998-07-15")
    assert not _exchanges(latest_positions(catalog))
    assert not _exchanges(period_positions(catalog))
    positions = catalog.table("metrics_position_performance")
    # Only the fund and company lookups remain.
    assert not [e for e in _exchanges(positions) if "instrument_id" in e.split("hashpartitioning")[1]]
    expected = sample_catalog(spark, SMALL).table("metrics_position_performance")
    assert positions.exceptAll(expected).isEmpty() and positions.count() == expected.count()


def test_layout_is_as_asked(spark):
    rows = spark.range(100).select(F.concat(F.lit("k"), "id").alias("instrument_id"))
    for buckets in (None, 16):
        assert store(rows, "layout", "dim_instruments", buckets=buckets).count() == 100
        detail = spark.sql("describe extended layout.dim_instruments").collect()
        assert any(r.col_name == "Num Buckets" for r in detail) == bool(buckets)
    with pytest.raises(ValueError):
        sample_catalog(spark, SMALL).save("fct_transactions", buckets=4)


def test_stored_marts_are_read_by_a_later_catalog(spark):
    sample_catalog(spark, SMALL).save_all("metrics_pipeline_by_stage", "dim_funds")
    later = Catalog(spark, {}, as_of="1998-07-15").use_stored("metrics_pipeline_by_stage")
    mart = later.table("metrics_pipeline_by_stage")
    assert "metrics_pipeline_by_stage" in mart.inputFiles()[0]
    assert "Join" not in mart._jdf.queryExecution().optimizedPlan().toString()
    assert mart.exceptAll(sample_catalog(spark, SMALL).table("metrics_pipeline_by_stage")).isEmpty()
    assert "dim_funds" in Catalog(spark, {}).use_stored().stored


VIEWS = [name for name, spec in TABLES.items() if spec.stored_as == "view"]


@pytest.mark.parametrize("source", ["database", "parquet", "frames"])
def test_views_are_permanent_and_need_no_catalog(spark, tmp_path, source):
    """Saved in one session; another reads all six by their names in SQL."""
    frames = catalog = sample_catalog(spark, SMALL)
    inputs = [TABLES[name].build.source for name in VIEWS]
    if source == "database":
        frames.save_inputs(*inputs, database="views_staging")
        catalog = Catalog.from_database(spark, "views_staging")
    elif source == "parquet":
        for name in inputs:
            frames.table(name).write.parquet(str(tmp_path / name))
        catalog = Catalog.from_parquet(spark, str(tmp_path))
    catalog.save_all(*VIEWS)
    later = spark.newSession()
    assert len(VIEWS) == 6
    for name in VIEWS:
        rows = later.sql(f"select * from public.{name}")
        wanted = sample_catalog(spark, SMALL).table(name)
        assert rows.columns == wanted.columns and rows.count() == wanted.count() > 0
        assert [t.tableType for t in later.catalog.listTables("public") if t.name == name] == ["VIEW"]
    flows = later.sql("select instrument_id, sum(amount) as total from "
                      "public.fct_instrument_cashflows group by instrument_id")
    assert flows.count() > 0
    opened = Catalog(later, {}).use_stored(*VIEWS)
    assert opened.stored == set(VIEWS)
    assert opened.table("fct_transactions").count() == frames.table("fct_transactions").count()


def test_a_view_follows_its_input_and_casts_it(spark):
    names = [f"`{f.name}` {'string' if f.dataType.typeName() == 'date' else f.dataType.simpleString()}"
             for f in input_schema("int_transactions_classified").fields]
    empty = spark.createDataFrame([], ", ".join(names))
    spark.sql("create database if not exists views_text")
    empty.write.mode("overwrite").saveAsTable("views_text.int_transactions_classified")
    catalog = Catalog.from_database(spark, "views_text")
    catalog.save("fct_transactions")
    view = spark.table("public.fct_transactions")
    assert view.count() == 0
    assert [f.dataType for f in view.schema.fields] == [
        f.dataType for f in input_schema("int_transactions_classified").fields]
    one = spark.createDataFrame([tuple(None for _ in names)], ", ".join(names))
    one.write.mode("append").saveAsTable("views_text.int_transactions_classified")
    assert spark.newSession().table("public.fct_transactions").count() == 1


def _snapshot_facts(spark, buckets=None):
    catalog = sample_catalog(spark, SMALL)
    catalog.save_all("dim_instruments", *SNAPSHOT_FACTS, buckets=buckets)
    return catalog


def test_marts_read_the_stored_snapshot_facts(spark, no_broadcast):
    catalog = _snapshot_facts(spark, buckets=4)
    rows = reported_snapshots(catalog)
    assert not _exchanges(rows)
    assert rows._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 2
    for mart in ("metrics_fund_performance", "metrics_position_performance"):
        expected = sample_catalog(spark, SMALL).table(mart)
        assert catalog.table(mart).exceptAll(expected).isEmpty()
        assert catalog.table(mart).count() == expected.count()


def test_a_changed_snapshot_fact_changes_the_marts(spark):
    catalog = _snapshot_facts(spark)
    held = lambda: records(fund.instrument_valuations(catalog), "fund_id", "period_end_date")
    nav = lambda: {(r.fund_id, r.period_end_date): r.fund_nav_calculated for r in catalog.table(
        "metrics_fund_performance").collect()}
    before, nav_before = held(), nav()
    fact = catalog.table("fct_instrument_snapshots")
    doubled = (F.col("fair_value_converted") * 2).cast(fact.schema["fair_value_converted"].dataType)
    catalog.replace("fct_instrument_snapshots", fact.withColumn("fair_value_converted", doubled))
    value = "total_instrument_fair_value"
    assert before and {k: v[value] for k, v in held().items()} == {
        k: v[value] and 2 * v[value] for k, v in before.items()}
    assert nav().keys() == nav_before.keys() and nav() != nav_before
    none = catalog.table("fct_instrument_snapshots_credit").where("false")
    catalog.replace("fct_instrument_snapshots_credit", none)
    mart = catalog.table("metrics_fund_performance")
    assert mart.where("principal_outstanding > 0").isEmpty()


def test_declared_order(spark):
    catalog = sample_catalog(spark, SMALL)
    keys = ["fund_name", "instrument_type", "region", "country_name", "industry_name",
            "maturity_year", "security_rank", "stage_name", "exposure_month"]
    rows = [tuple(r) for r in catalog.table(
        "metrics_exposure_timeseries", ordered=True).select(*keys).collect()]
    assert rows == sorted(rows, key=lambda r: [(v is None, v if v is not None else 0) for v in r])
    assert any(v is None for r in rows for v in r) and len(rows) > 1000
    with pytest.raises(ValueError, match="no order"):
        catalog.table("dim_funds", ordered=True)


def test_seeds_come_from_a_folder_of_csv_files(spark, tmp_path):
    fields = [f.name for f in input_schema("ref_countries").fields]
    row = {f: "" for f in fields} | {"iso2": "QQ", "iso3": "QQQ", "name": "Quill", "id": "1"}
    (tmp_path / "ref_countries.csv").write_text(
        ",".join(fields) + "\n" + ",".join(row[f] for f in fields) + "\n")
    catalog = Catalog.from_parquet(spark, str(tmp_path), seeds=str(tmp_path))
    assert [r.country_iso2_code for r in catalog.table("dim_countries").collect()] == ["QQ"]
