import zlib

import numpy as np
import pytest
from carrymark.llm import language
from carrymark.llm.common import documents
from carrymark.llm.mphash import mix
from messy import ROWS, empty, messy
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.01"


def vector(codepoint):
    words = language.DIMENSIONS // 64
    at = np.arange(words, dtype=np.uint64) + np.uint64(codepoint * words)
    bits = np.unpackbits(mix(at, language.SEED).view(np.uint8))
    return 2 * bits.astype(np.int64) - 1


def plain_bundle(text):
    codes = [0] + [ord(c) if c.isalpha() else 0 for c in text.lower()] + [0]
    total = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        if b:
            total += np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
    return total


@pytest.mark.parametrize("segment", [1 << 19, 5])
def test_bundles_of_whole_texts(monkeypatch, segment):
    monkeypatch.setattr(language, "SEGMENT", segment)
    texts = ["Hello wörld", "", "123", "日本語 テキスト", "a", "ñandú\x00x " * 20]
    total, grams = language.profile([t.lower() for t in texts])
    for text, sums, n in zip(texts, total, grams, strict=True):
        assert n == sum(c.isalpha() for c in text)
        assert np.array_equal(sums, plain_bundle(text))


def test_many_letters_use_sorted_grams(monkeypatch):
    monkeypatch.setattr(language, "CELLS", 2000)
    total, _ = language.profile(["the quick brown fox", "jumps över"])
    assert np.array_equal(total[0], plain_bundle("the quick brown fox"))


def test_held_out_accuracy(spark):
    docs = documents(spark, SMALL).cache()
    rows = language.op1_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in out} == {
        r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_documents_are_not_used(spark):
    docs = documents(spark, SMALL).filter("doc_id < 200")
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast(
        "binary")) % 3 == 1, "zz").otherwise(F.col("lang")))
    assert language.op1_language_id(docs).exceptAll(language.op1_language_id(changed)).isEmpty()


def test_documents_of_every_kind(spark):
    rows = language.op1_language_id(messy(spark)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.doc_id in (3, 4, 5, 9):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    kept = language.identify(messy(spark), language.learn(messy(spark)))
    assert kept.filter("kept = 'own kept'").count() == len(ROWS)


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language.op1_language_id(docs).first().lang_pred == "und"
    assert language.op1_language_id(empty(spark)).count() == 0
