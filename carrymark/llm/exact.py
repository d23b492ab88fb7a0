"""Operator 8: exact deduplication against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by its
digest. A batch of documents is reduced to one row per digest, anti-joined with
the index by sort-merge (the index side is neither shuffled nor sorted again),
and what is new is appended. Everything is DataFrame code.
"""

from __future__ import annotations

import hashlib
import string
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carrymark.llm.common import join_groups, new_path, stored

COLUMNS = "digest binary, keep_id bigint, batch string"
DEFAULT_BUCKETS = 64


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; null is empty."""
    text = F.coalesce(text, F.lit(""))
    # Of pure ASCII text lower() changes A-Z only, and is much faster.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256))


class DigestIndex:
    """Digests of all texts seen so far, one row each with the batch that brought it.

    ``path`` is where the table lives; a later session opens the same path and goes
    on. The number of buckets is fixed when the index is created and kept beside it:
    opening takes it from there, and asking for another number is an error, since rows
    would be looked for in the wrong bucket. One batch is added at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, (path or new_path(spark, "digest-index")).rstrip("/")
        self.table = f"digest_index_{hashlib.sha256(self.path.encode()).hexdigest()[:32]}"
        self.buckets = self._layout(buckets)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({COLUMNS}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}'")
        spark.catalog.refreshTable(self.table)

    def _layout(self, asked: int | None) -> int:
        """The number of buckets that the index has, or is given now if it is new."""
        beside = f"{self.path}-layout"
        try:
            known = self.spark.read.schema("buckets int").parquet(beside).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            known = None
        if known is None:
            buckets = asked or DEFAULT_BUCKETS
            self.spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode(
                "overwrite").parquet(beside)
            return buckets
        if asked not in (None, known.buckets):
            raise ValueError(f"the index at {self.path} has {known.buckets} buckets, not {asked}")
        return known.buckets

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Add rows whose digests are not in the index, one file for each bucket."""
        (groups.select("digest", "keep_id", "batch")
         .repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def forget(self) -> None:
        """Drop the table's name; the files stay, and the path opens them again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def deduplicate(rows: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Deduplicate a batch against the index, and add its new texts to the index.

    ``rows``: doc_id, digest and row_, a number that tells rows apart, from a
    table that reads the same each time. Returns each of them with keep_id,
    group_size (rows of this batch with that text) and kept.

    ``batch`` names the batch. Rows of the index with that name count as its own, so
    a batch that was lost before its output was written, even in the middle of the
    append, is given again under the same name with the same result. Without a name
    it is a batch of its own.

    Of equal texts in a batch the largest doc_id stays (null is smallest; of
    several rows with that id, the one with the largest row number, so exactly one
    row stays). A text that an earlier batch brought is not kept again; keep_id
    then names the earlier document. An empty batch gives no rows.
    """
    batch = batch or uuid.uuid4().hex
    groups = (rows.groupBy("digest")
              .agg(F.max(F.struct("doc_id", "row_")).alias("last"),
                   F.count("*").alias("group_size"))
              .select("digest", "group_size", F.col("last.doc_id").alias("keep_id"),
                      F.col("last.row_").alias("keep_row"), F.lit(batch).alias("batch")))
    groups = stored(groups, "batch-digests")
    index.append(groups.hint("merge").join(index.read().select("digest"), "digest", "left_anti"))
    own = groups.select("digest", "group_size", "keep_row").hint("merge")
    known = stored(own.join(index.read(), "digest"), "known-digests")
    return join_groups(rows, known, "digest", "group_size", rows.count()).select(
        "doc_id", "row_", "digest", "keep_id", "group_size",
        ((F.col("batch") == batch) & (F.col("keep_row") == F.col("row_"))).alias("kept"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest and a row number for every document, stored."""
    return stored(docs.select("doc_id", text_digest(F.col("text")).alias("digest"),
                              F.monotonically_increasing_id().alias("row_")), "digests")


def op8_exact_dedup(docs: DataFrame, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """All documents as one batch against a new index: one row for each document."""
    index = DigestIndex(docs.sparkSession, buckets=buckets)
    found = deduplicate(digests(docs), index)
    index.forget()
    return found.select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))
