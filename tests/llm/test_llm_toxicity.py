import math
import zlib

import pytest
from carrymark.llm import toxicity
from carrymark.llm.common import documents
from messy import ROWS, empty, messy
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def learned(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = documents(spark, SMALL).select("doc_id", "text")
    return toxicity.learn(docs, labels.filter(~toxicity.held_out())), labels


def test_held_out_quality(spark, learned):
    model, labels = learned
    docs = documents(spark, SMALL).select("doc_id", "text").join(
        labels.filter(toxicity.held_out()), "doc_id")
    rows = toxicity.score(docs, model).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    taken = [r for r in rows if r.score >= 0.5]
    right = sum(r.toxic for r in taken)
    assert right / len(taken) > 0.9
    assert right / sum(r.toxic for r in rows) > 0.8
    assert all(0 <= r.score <= 1 for r in rows)


def test_documents_of_every_kind(spark, learned):
    rows = toxicity.score(messy(spark), learned[0], "toxicity").collect()
    assert len(rows) == len(ROWS) and all(r.score == "own score" for r in rows)
    assert all(0 <= r.toxicity <= 1 for r in rows)
    assert toxicity.score(empty(spark), learned[0]).count() == 0


def test_features_by_hand():
    lexicon = toxicity.Lexicon(frozenset({"idiot", "grump-"}), frozenset({"bad"}))
    kinds = toxicity.WordKinds(lexicon)
    f = toxicity.features("You IDIOT!! A grumpling, bad id1ot sooo", kinds)
    assert f[1] == 2 and f[2] == 2           # idiot, and grumpling by its beginning
    assert f[4] == 1 and f[5] == 2           # weak words; entries beside "you"
    assert f[8] > 0 and f[10] > 0 and f[11] == 1 and f[12] > 0
    assert toxicity.features("", kinds) == [0.0] * toxicity.FEATURES
    assert len(f) == toxicity.FEATURES


@pytest.mark.parametrize("toxic", [[], [0, 0, 0], [1, 1]])
def test_labels_of_one_class_or_none(spark, toxic):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert {r.score for r in toxicity.score(docs, model).collect()} == {float(any(toxic))}


def test_sample_is_bounded_and_takes_equal_texts_once(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(50)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 7 == 1)) for i in range(50)] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, toxicity.Training(max_rows=20)).collect()
    assert 0 < len({r.text for r in rows}) == len(rows) <= 7
    assert all(r.toxic == (r.text == "text 1") for r in rows)
    assert {r.weight for r in rows if r.toxic} == {1.0}
    assert len({r.weight for r in rows if not r.toxic}) == 1
    assert all(0 <= r.part < toxicity.PARTS for r in rows)


def test_near_copies_have_one_sketch():
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join([*words, f"last{i}"]) for i in range(50)]
    assert len({toxicity.sketch(t) for t in texts}) <= 3
    assert len({toxicity.sketch(f"{i} {t}") for i, t in enumerate(words)}) == 400
    assert toxicity.sketch("") == toxicity.sketch(" ") != toxicity.sketch("a")


def test_lexicon_by_plain_counts(spark):
    """Effects of all entries, counted text by text."""
    rows = [(("slur " if i % 3 else "") + f"common name{i % 5} slurry", 1) for i in range(30)]
    rows += [(f"common name{i % 5} {'rare' if i % 40 == 0 else ''} {'slur' * (i == 7)}", 0)
             for i in range(200)]
    training = toxicity.Training()
    found = toxicity.lexicon_of(spark.createDataFrame(rows, "text string, toxic int"), training)
    counts = {}
    for text, toxic in rows:
        for e in {e for w in text.split() for e in toxicity.entries(w)}:
            counts.setdefault(e, [0, 0])[toxic] += 1
    effects = {e: math.log((b + .5) / 31) - math.log((a + .5) / 201)
               - 2 * math.sqrt(1 / (b + .5) + 1 / (a + .5)) for e, (a, b) in counts.items() if b >= 4}
    assert found.strong == {e for e, x in effects.items() if x >= training.strong}
    assert found.weak == {e for e, x in effects.items() if training.weak <= x < training.strong}
    assert {"slurry", "slur-"} <= found.strong and "slur" in found.strong | found.weak
    assert not {"common", "rare", "name-"} & (found.strong | found.weak)


def quality(times, docs, labels):
    """Precision and recall on documents none of whose copies was learned from."""
    kept = F.floor(F.col("doc_id") / times) % 5 == 0
    model = toxicity.learn(docs, labels.filter(~kept))
    tried = toxicity.score(docs.join(labels.filter(kept), "doc_id"), model)
    n = {(r.toxic, r.called): r["count"] for r in tried.groupBy(
        "toxic", (F.col("score") >= 0.5).alias("called")).count().collect()}
    right = n.get((1, True), 0)
    return right / (right + n.get((0, True), 0)), right / (right + n.get((1, False), 0))


def copied(spark, folder, times, text):
    """Documents and labels ``times`` over, the i-th copy with its own ids and text."""
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    ids = F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("copy")
    docs = docs.select("doc_id", "text", ids).select(
        (F.col("doc_id") * times + F.col("copy")).alias("doc_id"), text.alias("text"))
    labels = labels.select("doc_id", "toxic", ids).select(
        (F.col("doc_id") * times + F.col("copy")).alias("doc_id"), "toxic")
    return docs, labels


def test_near_copies_do_not_crowd_out_the_lexicon(spark):
    """Seven copies of each document that differ in their last word."""
    ending = F.concat("text", F.lit(" end"), F.col("copy").cast("string"))
    precision, recall = quality(7, *copied(spark, SMALL, 7, ending))
    assert precision > 0.8 and recall > 0.8


def test_many_alphabets(spark):
    """25 languages with words of their own: a vocabulary that no cap may cut."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = F.lit(None).cast("string")
    for i in range(25):
        text = F.when(F.col("copy") == i, F.translate(
            F.lower("text"), letters, letters[i:] + letters[:i])).otherwise(text)
    precision, recall = quality(25, *copied(spark, SMALL, 25, text))
    assert precision > 0.8 and recall > 0.8
