"""Operator 3: toxicity by gradient-boosted trees over dense features.

The lexicon is learned: words and word beginnings that toxic training texts hold several
times as often as clean ones. Texts become a dozen densities and rates; boosted trees are
fitted on them and calibrated by isotonic regression. The lexicon, the trees and
the calibration each learn from texts of their own, so all of them see features of one
definition, that of a text which the lexicon was not learned from. Training uses a bounded
sample of labelled rows in which near copies count once; scoring is row by row.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from carrymark.llm.common import (
    bounded_sample, crc32_of_id, documents, held, stored, texts)

#: Second-person pronouns of the languages served.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes "
    "vous votre vos ti tus usted ustedes vosotros tuyo".split())
#: Signs that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!", "oieastasi")
WORD = re.compile(r"[^\W\d_]+")
#: A sign within a word; the word around it is only looked for where there is one.
SIGN = re.compile(r"(?<=[^\W\d_])[013457@$!*]+(?=[^\W\d_])")
DISGUISED = re.compile(r"[^\W\d_]+(?:[013457@$!*]+[^\W\d_]+)+")
SHOUTS = re.compile(r"[!?]{2,}")
NEAR = 5
#: Beginnings of longer words of these lengths are lexicon entries too.
STEMS = (4, 5, 7)
FEATURES = 13


@dataclass(frozen=True)
class Training:
    """An entry's effect is the log of its share of toxic over its share of clean texts, less
    ``doubt`` standard errors. Limits are on the effect, so they do not depend on the number
    of texts, and every entry that reaches them is used."""

    max_rows: int = 10_000      # labelled texts of each label that are used
    strong: float = 2.0         # effect, for words that are at least 7 times as frequent
    weak: float = 0.9
    doubt: float = 2.0
    min_toxic: int = 4          # toxic texts that an entry must be in,
    min_share: float = 0.002    # and share of them
    trees: int = 20
    depth: int = 3
    step: float = 0.3


#: Of 20 parts of the training texts: those of the lexicon, the trees, the calibration.
PARTS, LEXICON_PARTS, TREE_PARTS = 20, 12, 17


@dataclass(frozen=True)
class Lexicon:
    strong: frozenset
    weak: frozenset


def entries(word: str) -> list[str]:
    """What a word is looked up as: itself, and its beginnings with a dash."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


STRONG, WEAK, YOU = 1, 2, 4
REMEMBERED = 200_000


class WordKinds(dict):
    """What each word is, worked out once: STRONG, WEAK and YOU added up."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        known = entries(word)
        kind = YOU * (word in SECOND_PERSON)
        if not self.lexicon.strong.isdisjoint(known):
            kind += STRONG
        elif not self.lexicon.weak.isdisjoint(known):
            kind += WEAK
        self[word] = kind
        return kind


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def capitals(text: str) -> int:
    """Latin capitals that stand next to another."""
    codes = _codes(text)
    upper = ((codes >= 65) & (codes <= 90)) | ((codes >= 192) & (codes <= 222) & (codes != 215))
    return int((upper[1:] & upper[:-1]).sum())


def stretched(text: str) -> int:
    """Places where a letter stands three times."""
    codes = _codes(text)
    same = codes[1:] == codes[:-1]
    return sum(chr(c).isalpha() for c in codes[2:][same[1:] & same[:-1]].tolist())


def features(text: str, kinds: WordKinds) -> list[float]:
    """Densities and rates of a whole text; all 0 for a text without characters."""
    if not text:
        return [0.0] * FEATURES
    lower = text.lower()
    words = WORD.findall(lower)
    n, chars = max(len(words), 1), len(text)
    marked = [(i, k) for i, k in enumerate([kinds[w] for w in words]) if k]
    strong = [i for i, k in marked if k & STRONG]
    weak = sum(k & WEAK > 0 for _, k in marked)
    you = [i for i, k in marked if k & YOU]
    beside = 0
    if strong and you:
        places = np.array(you)
        at = np.searchsorted(places, strong)
        left = np.abs(places[np.maximum(at - 1, 0)] - strong)
        right = np.abs(places[np.minimum(at, len(places) - 1)] - strong)
        beside = int((np.minimum(left, right) <= NEAR).sum())
    disguised = DISGUISED.findall(lower) if SIGN.search(lower) else []
    hidden = sum(kinds[w.translate(DISGUISE).replace("*", "")] & STRONG for w in disguised)
    shouts = len(SHOUTS.findall(text)) if "!" in text or "?" in text else 0
    return [
        100 * len(strong) / n, float(len(strong)), float(len({words[i] for i in strong})),
        100 * weak / n, float(weak), float(beside), 100 * len(you) / n,
        100 * capitals(text) / chars, 100 * shouts / n,
        100 * (text.count("!") + text.count("?")) / chars,
        100 * len(disguised) / n, float(hidden), 100 * stretched(lower) / n]


def _column(lexicon: Lexicon, spark):
    """A function of a text column that gives the features."""
    known, key = spark.sparkContext.broadcast(lexicon), uuid.uuid4().hex

    @arrow_udf("array<double>")
    def run(column: pa.Array) -> pa.Array:
        kinds = held("word kinds", key, lambda: WordKinds(known.value), most=2)
        return pa.array([features(t or "", kinds) for t in texts(column)],
                        pa.list_(pa.float64()))

    return run


def sketch(text: str) -> int:
    """The same for near copies mostly: the two smallest hashes of the text's 5-word shingles."""
    words = text.lower().split()
    shingles = {" ".join(words[i:i + 5]) for i in range(max(len(words) - 4, 1))}
    least = heapq.nsmallest(2, map(xxhash.xxh64_intdigest, shingles))
    return xxhash.xxh64_intdigest(repr(least)) >> 1


def sample(docs: DataFrame, labels: DataFrame, training: Training) -> DataFrame:
    """Training texts (text, toxic, weight, part): about ``max_rows`` of each label at most, by
    a hash of doc_id; near copies with one label once.

    The sampled ids are few, so that they are broadcast and no text is moved. Labels
    that are null are left out; a doc_id that is labelled twice is toxic if once. A row's
    weight is the number of labelled texts that it stands for. Near copies share a part,
    so none is on both sides of what is learned and what it is tried on.
    """
    ids = stored(labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id")
                 .agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    parts = []
    for toxic in (0, 1):
        mine = ids.filter(F.col("toxic") == toxic)
        some = stored(bounded_sample(mine, training.max_rows, "doc_id"), "sampled")
        share = mine.count() / max(some.count(), 1)
        parts.append(some.withColumn("weight", F.lit(float(share))))
    sketches = arrow_udf(lambda column: pa.array(map(sketch, texts(column)), pa.int64()), "bigint")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
    rows = stored(rows.select("text", "toxic", "weight", sketches("text").alias("key")), "drawn")
    rows = rows.groupBy("key", "toxic").agg(F.min("text").alias("text"),
                                            F.first("weight").alias("weight"))
    return stored(rows.select("text", "toxic", "weight", F.pmod(
        F.xxhash64("key"), F.lit(PARTS)).cast("int").alias("part")), "labelled")


def lexicon_of(rows: DataFrame, training: Training) -> Lexicon:
    """The entries whose share of toxic texts is well above that of clean ones."""
    def distinct_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(texts(batch.column("text")),
                                   batch.column("toxic").to_pylist(), strict=True):
                words = list({e for w in set(WORD.findall((text or "").lower()))
                              for e in entries(w)})
                for a in range(0, len(words), 10_000):
                    some = words[a:a + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.string()), pa.array([toxic] * len(some), pa.int32())],
                        names=["word", "toxic"])

    sums = [F.sum(F.when(F.col("toxic") == t, 1).otherwise(0)).alias(f"n{t}") for t in (0, 1)]
    total = rows.agg(*sums).first()
    counts = rows.mapInArrow(distinct_entries, "word string, toxic int").groupBy("word").agg(*sums)
    toxic, clean = F.col("n1") + 0.5, F.col("n0") + 0.5
    effect = (F.log(toxic / ((total.n1 or 0) + 1)) - F.log(clean / ((total.n0 or 0) + 1))
              - training.doubt * F.sqrt(1 / toxic + 1 / clean))
    least = max(training.min_toxic, training.min_share * (total.n1 or 0))
    found = counts.select("word", effect.alias("effect"), "n1").filter(
        (F.col("n1") >= least) & (F.col("effect") >= training.weak)).collect()
    return Lexicon(frozenset(r.word for r in found if r.effect >= training.strong),
                   frozenset(r.word for r in found if r.effect < training.strong))


@dataclass(frozen=True)
class Model:
    """``trees`` and ``calibration`` are None where only one class was seen: then every
    text has the score ``constant``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float = 0.0


def learn(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """Fit on ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text)."""
    rows = sample(docs, labels, training)
    seen = {r.toxic for r in rows.select("toxic").distinct().collect()}
    if len(seen) < 2:
        nothing = Lexicon(frozenset(), frozenset())
        return Model(nothing, None, None, float(max(seen, default=0)))
    part = F.col("part")
    lexicon = lexicon_of(rows.filter(part < LEXICON_PARTS), training)
    rows = stored(rows.filter(part >= LEXICON_PARTS).select(
        "toxic", "weight", "part", _column(lexicon, docs.sparkSession)("text").alias("values")),
        "features").withColumn("features", array_to_vector("values"))
    fitted = rows.filter(part < TREE_PARTS)
    if fitted.select("toxic").distinct().count() < 2:
        fitted = rows        # too few texts to leave some out
    if rows.select("toxic").distinct().count() < 2:
        return Model(lexicon, None, None, float(seen == {1}))
    trees = GBTClassifier(
        labelCol="toxic", weightCol="weight", maxIter=training.trees, maxDepth=training.depth,
        stepSize=training.step, minInstancesPerNode=5, seed=1).fit(
        fitted.select("toxic", "weight", "features"))
    raw = trees.transform(rows.filter(part >= TREE_PARTS)).select(
        F.col("toxic").cast("double").alias("label"), "weight",
        vector_to_array("probability")[1].alias("features"))
    if raw.isEmpty():
        return Model(lexicon, trees, None)
    return Model(lexicon, trees, IsotonicRegression(weightCol="weight").fit(raw))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the calibrated probability that each text is toxic.

    Needs text; all other columns stay. Null is scored as an empty text. An empty
    table gives no rows.
    """
    if model.trees is None:
        return docs.withColumn(column, F.lit(model.constant))
    names = [c for c in docs.columns if c != column]
    values = _column(model.lexicon, docs.sparkSession)("text")
    # The models' own columns are set apart from those of the documents.
    rows = docs.select(F.struct(*names).alias("row_"),
                       array_to_vector(values).alias("features"))
    rows = model.trees.transform(rows).select(
        "row_", vector_to_array("probability")[1].alias("features"))
    if model.calibration is None:
        rows = rows.withColumnRenamed("features", "prediction")
    else:
        rows = model.calibration.transform(rows)
    return rows.select("row_.*", F.least(F.greatest(
        F.col("prediction"), F.lit(0.0)), F.lit(1.0)).alias(column))


def held_out():
    return F.coalesce(crc32_of_id() % 5 == 0, F.lit(False))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
