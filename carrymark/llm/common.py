"""Shared pieces: stored tables, joins with hot keys, batches of text."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_SHARE = 1000
_HELD: dict[str, dict] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without the setting, as in tests, gets one of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="carrymark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: what follows survives the loss of any executor without
    computing ``df`` again, and sees the same rows however often it reads them.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, row: str = "row_") -> DataFrame:
    """Stored rows with a number of their own, so that repeated rows can be told apart."""
    return stored(df.withColumn(row, F.monotonically_increasing_id()), name)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per ``key`` in ``groups``, hot keys apart.

    ``size`` is the number of ``rows`` of each group and ``total`` their sum, so at
    most HOT_SHARE groups can hold more than ``total / HOT_SHARE`` rows: those few
    are broadcast and their rows are not moved. All other groups are small, and
    meet their rows in a shuffled join.
    """
    hot = F.col(size) * HOT_SHARE > F.lit(total)
    few = F.broadcast(groups.filter(hot))
    rest = rows.join(few.select(key), key, "left_anti")
    return rows.join(few, key).unionByName(rest.join(groups.filter(~hot), key))


def bounded_sample(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """About ``most`` of the ``rows``, all of them if there are no more, by a hash of keys.

    ``rows`` is read twice and has one row for each value of the keys, so that no
    value can fill the sample. No row is sorted or gathered for it.
    """
    parts, total = 1 << 24, rows.count()
    if total <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64(*keys), F.lit(parts)) < most * parts // total)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held(kind: str, key: str, make: Callable, most: int = 1):
    """What a Python worker keeps for its later tasks, at most ``most`` things of one kind.

    Those of another kind are dropped first, so that the tables of several operators
    in one session never add up in a worker.
    """
    if kind not in _HELD:
        _HELD.clear()
        _HELD[kind] = {}
    mine = _HELD[kind]
    if key not in mine:
        if len(mine) >= most:
            mine.clear()
        mine[key] = make()
    return mine[key]


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column one by one; null is empty."""
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type)
                         else pa.binary())
    for value in column:
        yield value.as_py() or b""


def texts(column: pa.Array) -> Iterator[str | None]:
    """The strings of a column one by one, so that only one is a Python object at a time."""
    for value in column:
        yield value.as_py()
