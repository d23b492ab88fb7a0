"""Documents from raw to packed sequences: five stages, each one of the llm operators.

Every stage is a function of (spark, docs, sf_dir). What it returns is written as
Parquet and read again as the next one's documents. All stages but the last return
the columns that they were given; documents' other columns, whatever their names,
pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrymark.llm import exact, packing, personal, simhash, toxicity
from carrymark.llm.common import documents, numbered, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rows(docs: DataFrame, name: str) -> DataFrame:
    """Numbered documents: doc_id, text and, in ``rest``, their other columns."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    return numbered(docs.select("text", rest), name).withColumn("doc_id", F.col("rest.doc_id"))


def _those(docs: DataFrame, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose number is among the ``kept`` ones, with the columns of ``docs``."""
    return rows.join(kept.select("row_"), "row_", "left_semi").select(
        *[F.col("text" if c == "text" else f"rest.`{c}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; a null text is scored as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    rows = docs.select("text", F.struct(*docs.columns).alias("doc"))
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    return toxicity.score(rows, model).filter("score < 0.5").select("doc.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased, null as empty) the one with the largest doc_id.

    Of repeated rows one stays; a null doc_id is the smallest.
    """
    rows = _rows(docs, "exact-rows")
    marked = stored(rows.select("row_", "doc_id", exact.text_digest(F.col("text"))
                                .alias("digest")), "digests")
    index = exact.DigestIndex(spark)
    found = exact.deduplicate(marked, index)
    index.forget()
    return _those(docs, rows, found.filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id.

    Texts without a word, null ones among them, are one group; of repeated rows one
    stays, and a document without an id only where its group has no other.
    """
    rows = _rows(docs, "near-rows")
    found = simhash.near_duplicates(rows.select("row_", "doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_"))
    return _those(docs, rows, found.groupBy("root").agg(first.alias("first")).select("first.row_"))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by its kind; n_chars follows the text."""
    clean = personal.redact(docs, personal.learn(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(
            docs.schema["n_chars"].dataType))
    return clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its sequence and its place in it.

    A null or empty text is its end id alone; repeated rows have pieces each.
    """
    return packing.op5_best_fit_packing(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_neardup", drop_near_copies),
    ("personal_data", redact_personal),
    ("best_fit_packing", pack),
]

#: Learned models and a tokenizer decide here, which SQL cannot express; tests/llm
#: holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
