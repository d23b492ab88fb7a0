import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from carrymark.session import local_session  # noqa: E402
from carrymark.sources.catalog import Catalog  # noqa: E402
from carrymark.sources.schemas import input_schema  # noqa: E402
from pyspark.sql.types import DecimalType  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", 8, shuffle_partitions=4, memory="6g",
        **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


def frame(spark, name, rows):
    """Rows of an input relation; columns that are not given are null."""
    schema = input_schema(name)

    def cell(field, value):
        if isinstance(field.dataType, DecimalType) and value is not None:
            return Decimal(str(value))
        if field.dataType.typeName() == "date" and isinstance(value, str):
            return day(value)
        return value

    return spark.createDataFrame(
        [tuple(cell(f, row.get(f.name)) for f in schema.fields) for row in rows], schema)


@pytest.fixture
def tables(spark):
    """Build a catalog from rows per input; other inputs are empty."""

    def build(as_of="2020-06-15", **rows):
        return Catalog(spark, lambda name: frame(spark, name, rows.get(name, [])), as_of=as_of)

    return build


def records(df, *keys):
    """Rows as dictionaries by the given key columns."""
    out = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        assert key not in out, f"duplicate key {key}"
        out[key[0] if len(key) == 1 else key] = row.asDict()
    return out
