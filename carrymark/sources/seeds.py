"""CSV seed scans with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carrymark.sources.schemas import SEEDS, input_schema


def read_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read ``ref_countries`` or ``ref_currencies`` from a CSV with a header.

    Only the empty field is null: the country code ``NA`` is a value. The header
    is checked against the declared columns, so a reordered file fails loudly.
    """
    if name not in SEEDS:
        raise KeyError(f"unknown seed {name!r}; known: {sorted(SEEDS)}")
    return (
        spark.read.schema(input_schema(name))
        .option("header", True).option("enforceSchema", False)
        .option("mode", "FAILFAST").option("encoding", "UTF-8")
        .csv(path)
    )
