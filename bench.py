"""Times the marts on stored canonical inputs.

The inputs are first derived from the source files and written to a scratch
folder (``stage_inputs``), as a warehouse would hold them; each mart, question
and check then reads them, runs to its last row, and is timed on its own. Prints
one JSON line whose value is the total of the marts.

Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_MEMORY.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from pyspark.sql import DataFrame

from carrymark.queries import MARTS, QUESTIONS, all_queries
from carrymark.session import local_session
from carrymark.sources.catalog import Catalog
from carrymark.sources.sample_columns import SAMPLE_AS_OF
from carrymark.sources.sample_inputs import sample_catalog
from carrymark.sources.schemas import INPUTS

FACTS = ("int_instrument_cashflows_curated", "int_instrument_snapshots_curated")
CHECKS = ("dq_fct_instrument_snapshots", "dq_fct_instrument_cashflows", "dq_fct_transactions")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    width = int(cpus) if cpus.isdigit() else 8
    spark = local_session("bench", cpus, shuffle_partitions=width,
                          memory=os.environ.get("BENCH_MEMORY", "8g"))
    seconds = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    with tempfile.TemporaryDirectory(prefix="carrymark-bench-") as scratch:
        def stage_inputs() -> None:
            source = sample_catalog(spark, directory)
            for name in INPUTS:
                df = source.input(name)
                # Enough files for every core to scan the facts.
                df = df.repartition(width) if name in FACTS else df
                df.write.parquet(f"{scratch}/{name}")

        timed("stage_inputs", stage_inputs)
        registered = all_queries()
        for name in (*MARTS, *QUESTIONS, *CHECKS):
            catalog = Catalog.from_parquet(spark, scratch, as_of=SAMPLE_AS_OF)
            timed(name, lambda: run(registered[name](catalog)))
        spark.stop()

    scale = re.search(r"sf([0-9.]+)", directory)
    print(json.dumps({
        "metric": "marts_total", "value": round(sum(seconds[m] for m in MARTS), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
