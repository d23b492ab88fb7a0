"""Operator 11: line deduplication over levelled sorted runs of line digests.

The index of lines is a set of runs, each a table of distinct line digests that is
bucketed and sorted by digest. A digest lies in one run only. A batch of documents
is reduced to one entry for each digest and merge-joined with all runs, which are
neither shuffled nor sorted again. What no run knows becomes the batch's own run at
level 0. Entries that some run knows already are written beside it as recurrences,
which are few, because most lines are never repeated. ``fanout`` runs of one level are
compacted into one of the next, so the number of runs a batch meets grows with the
logarithm of the number of batches.

Runs and recurrences together give each line's number of documents and the last
document that holds it; documents then lose the lines that too many share.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrymark.llm.common import join_groups, new_path, stored, utf8

BLANKS = b" \t\n\v\f\r"
ENTRY = "line binary, docs bigint, lines bigint, last bigint"
STATE = "version int, kind string, name string, level int, batch string, buckets int"


class Part(NamedTuple):
    """What the index consists of: batches with their recurrences (level -1), and runs."""

    kind: str
    name: str
    level: int
    batch: str


def _run(name: str) -> str:
    """Where a batch's new lines lie; what was known before lies beside them."""
    return f"{name}/known=false"


class LineRuns:
    """Digests of all lines seen so far with their documents, in levelled runs.

    ``path`` is where the index lives; a later session opens the same path and goes
    on. The number of buckets is fixed when the index is made, by default the session's
    shuffle partitions, and another number is refused later. Each change writes a new
    version of the list of parts, last of all: files of a change that was interrupted
    are not listed, so they do not count.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None,
                 fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.path = path or new_path(spark, "line-runs")
        self.tables: dict[str, str] = {}
        self.version, self.parts = 0, []
        if path is None:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            self._list([])
            return
        states = spark.read.schema(STATE).parquet(f"{path}/state")
        self.version = states.agg(F.max("version")).first()[0]
        rows = states.filter(F.col("version") == self.version).collect()
        self.buckets = rows[0].buckets
        if buckets not in (None, self.buckets):
            raise ValueError(f"this index has {self.buckets} buckets, not {buckets}")
        self.parts = [Part(r.kind, r.name, r.level, r.batch) for r in rows if r.name]

    def _list(self, parts: list[Part]) -> None:
        rows = [(self.version + 1, *part, self.buckets) for part in parts]
        rows = rows or [(self.version + 1, "", "", 0, "", self.buckets)]
        (self.spark.createDataFrame(rows, STATE).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/state"))
        self.version, self.parts = self.version + 1, parts

    def _write(self, rows: DataFrame, name: str, *folders: str) -> None:
        """Files bucketed and sorted by digest, one for each bucket and folder."""
        table = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").option("path", f"{self.path}/{name}")
        if folders:
            writer = writer.partitionBy(*folders)
        writer.bucketBy(self.buckets, "line").sortBy("line").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")     # the files stay

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, "line")

    def _read(self, name: str) -> DataFrame:
        if name not in self.tables:
            table = self.tables[name] = f"line_run_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {table} ({ENTRY}) USING parquet CLUSTERED BY (line) "
                           f"SORTED BY (line) INTO {self.buckets} BUCKETS "
                           f"LOCATION '{self.path}/{name}'")
        return self.spark.table(self.tables[name])

    def _met(self, entries: DataFrame) -> DataFrame:
        """Entries with ``known``: whether some run has their line."""
        marks, met = [], self._dealt(entries)
        for i, run in enumerate(self.runs()):
            marks.append(F.col(f"run{i}").isNotNull())
            line = self._read(run).select("line", F.lit(True).alias(f"run{i}"))
            met = met.join(line.hint("merge"), "line", "left")
        known = reduce(lambda a, b: a | b, marks, F.lit(False))
        return met.select(*entries.columns, known.alias("known"))

    def runs(self, level: int | None = None) -> list[str]:
        return [p.name for p in self.parts
                if p.kind == "run" and (level is None or p.level == level)]

    def add(self, entries: DataFrame, batch: str) -> None:
        """Add a batch's entries, one row of ENTRY for each digest.

        ``batch`` names the batch: one that the index holds already is not added
        again, so a job that was interrupted can simply be repeated.
        """
        if any(p.batch == batch for p in self.parts):
            return
        name = f"batch-{uuid.uuid4().hex}"
        self._write(self._met(entries), name, "known")
        self._list([*self.parts, Part("batch", name, -1, batch), Part("run", _run(name), 0, "")])
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(names := self.runs(level)) >= self.fanout:
            merged = f"run-{uuid.uuid4().hex}"
            self._write(self._dealt(reduce(DataFrame.unionByName, map(self._read, names))), merged)
            kept = [p for p in self.parts if p.kind == "batch" or p.name not in names]
            self._list([*kept, Part("run", merged, level + 1, "")])
            level += 1

    def totals(self, least: int = 1) -> DataFrame:
        """ENTRY of each line in at least ``least`` documents of all batches, stored."""
        empty = self.spark.createDataFrame([], ENTRY)
        again = [self.spark.read.schema(f"{ENTRY}, known boolean")
                 .parquet(f"{self.path}/{p.name}").filter("known").drop("known")
                 for p in self.parts if p.kind == "batch"]
        more = stored(summed(reduce(DataFrame.unionByName, again, empty)).select(
            "line", *(F.col(c).alias(f"{c}_") for c in ("docs", "lines", "last"))), "again")
        found = [self._read(run).join(more.hint("merge"), "line", "left").select(
            "line", *((F.col(c) + F.coalesce(f"{c}_", F.lit(0))).alias(c)
                      for c in ("docs", "lines")), F.greatest("last", "last_").alias("last"))
            .filter(F.col("docs") >= least) for run in self.runs()]
        return stored(reduce(DataFrame.unionByName, found, empty), "lines-of-many")

    def close(self) -> None:
        """Drop this session's tables; the files of the index stay."""
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()


def summed(entries: DataFrame) -> DataFrame:
    return entries.groupBy("line").agg(F.sum("docs").alias("docs"), F.sum("lines").alias("lines"),
                                       F.max("last").alias("last"))


def line_key(line: bytes) -> bytes:
    """What lines are compared by: no ASCII blanks at the ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def _long(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id and text with a digest of the text; rows equal in both have equal results."""
    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select("doc_id", text, F.unhex(F.md5(text.cast("binary"))).alias("row"))


def keyed_lines(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """One row for each document and digest of a line: doc_id, row, line and its places.

    Lines with a key of fewer than ``min_chars`` code points are left out. Stored by
    batch, to which documents are dealt by a hash; text stays behind.
    """
    names = ["doc_id", "row", "line", "places"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()))
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
            for c in columns:
                c.clear()
            return out

        columns: tuple[list, ...] = ([], [], [], [])
        for batch in rows:
            for doc_id, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row"),
                                         utf8(batch.column("text")), strict=True):
                places: dict[bytes, list[int]] = {}
                for place, line in enumerate(text.split(b"\n")):
                    if _long(key := line_key(line), min_chars):
                        places.setdefault(hashlib.md5(key).digest(), []).append(place)
                columns[0].extend(repeat(doc_id, len(places)))
                columns[1].extend(repeat(row.as_py(), len(places)))
                columns[2].extend(places)
                columns[3].extend(places.values())
                if len(columns[0]) > 50_000:
                    yield made()
        yield made()

    lines = _identified(docs).mapInArrow(
        run, "doc_id bigint, row binary, line binary, places array<int>").withColumn(
        "batch", F.pmod(F.xxhash64("doc_id", "row"), F.lit(batches)))
    path = new_path(docs.sparkSession, "lines")
    lines.write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema(lines.schema).parquet(path)


def _entries(lines: DataFrame) -> DataFrame:
    """One row for each digest; each row of ``lines`` is another document."""
    return lines.groupBy("line").agg(
        F.count("*").alias("docs"), F.sum(F.size("places").cast("long")).alias("lines"),
        F.max("doc_id").alias("last"))


def _without(lines: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in lines:
        texts, numbers, dropped = [], [], []
        for text, places in zip(batch.column("text"), batch.column("places"), strict=True):
            whole, gone = text.as_py().split("\n"), set(places.as_py() or ())
            texts.append("\n".join([x for i, x in enumerate(whole) if i not in gone])
                         if gone else text.as_py())
            numbers.append(len(whole))
            dropped.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(numbers, pa.int64()),
             pa.array(dropped, pa.int64())], names=["doc_id", "text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                index: LineRuns | None = None, name: str = "documents") -> DataFrame:
    """doc_id, text without the lines that many documents share, n_lines, n_dropped.

    A line whose key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents stays in the documents with the largest doc_id that holds it
    (null is smallest), and there as often as it is found; all other lines stay.

    Every row is a document: repeated rows count each, also those of one doc_id. A null
    text is empty, and an empty text is one empty line. Other columns of ``docs`` are
    not used or returned, whatever their names. An empty table gives no rows.

    Documents are added to ``index`` in ``batches`` named after ``name``; documents
    that it holds from earlier calls count too. Without one, a new index is made.
    """
    spark = docs.sparkSession
    runs = index or LineRuns(spark)
    lines = keyed_lines(docs, min_chars, batches)
    for k in range(batches):
        runs.add(_entries(lines.filter(F.col("batch") == k)), f"{name}-{k}")
    many = runs.totals(min_docs)
    if index is None:
        runs.close()
    total = max(lines.count(), many.agg(F.sum("docs")).first()[0] or 0)
    gone = (join_groups(lines, many, "line", "docs", total)
            .filter(~F.col("doc_id").eqNullSafe(F.col("last")))
            .groupBy("doc_id", "row").agg(F.flatten(F.collect_set("places")).alias("places")))
    rows, gone = _identified(docs).alias("d"), stored(gone, "lost-lines").alias("g")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.row") == F.col("g.row"))
    return rows.join(gone, same, "left").select("d.doc_id", "text", "places").mapInArrow(
        _without, "doc_id bigint, text string, n_lines bigint, n_dropped bigint")


def op11_line_dedup(docs: DataFrame) -> DataFrame:
    """One row for each document: its lines, how many it lost, and the rest's digest."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                    F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
