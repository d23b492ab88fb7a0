import math
import re
from collections import Counter

from carrymark.llm import quality
from carrymark.llm.common import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import ROWS, empty, messy
from pyspark.sql import functions as F


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def counts(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)


TEXTS = st.lists(st.sampled_from(["a", "b", "A", "é", "#$", " ", "  ", "\n", "\t", "\x0b", "\x85",
                                  "a b c d e ", "x y z w v u "]), max_size=40).map("".join)


@given(st.lists(TEXTS, min_size=30, max_size=60))
@settings(max_examples=4, deadline=None)
def test_counts_against_plain_python(spark, texts):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string")
    for r in quality.op4_quality_rules(docs).collect():
        n = plain(texts[r.doc_id])
        assert counts(r) == n, texts[r.doc_id]
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)


def test_distance(spark):
    def js(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
        def kl(a):
            return sum(x * math.log2(x / y) for x, y in zip(a, m, strict=True) if x)
        return math.sqrt((kl(p) + kl(q)) / 2)

    for p, q in (([0.5, 0.5, 0.0], [0.1, 0.2, 0.7]), ([1.0, 0.0], [0.0, 1.0]), ([1.0], [1.0])):
        a, b = (F.array(*map(F.lit, x)) for x in (p, q))
        got = spark.range(1).select(quality.distance(a, b).alias("d")).first().d
        assert abs(got - js(p, q)) < 1e-9


def test_common_counts(spark):
    tokens = F.split(F.lit("b a c a d b a zz"), " ")
    common = F.array(*map(F.lit, ["a", "b", "q", "zz"]))
    got = spark.range(1).select(quality.common_counts(tokens, common).alias("n")).first().n
    assert got == [3, 2, 0, 1]


def test_clean_documents_stay_and_junk_goes(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.op4_quality_rules(documents(spark, "/root/testdata/sf0.01")).join(
        labels, "doc_id").filter("not base_failed and n_words >= 30").collect()
    good = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(junk) / len(junk) < 0.1


def test_only_built_in_functions_run(spark):
    plan = quality.op4_quality_rules(documents(spark, "/root/testdata/sf0.001"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


def test_documents_of_every_kind(spark):
    rows = quality.op4_quality_rules(messy(spark)).collect()
    assert sorted(counts(r) for r in rows) == sorted(plain(r[1]) for r in ROWS)
    whole = quality.quality(messy(spark))
    assert "kept" in whole.columns and whole.filter("common = 'own common'").count() == len(ROWS)
    assert whole.schema["kept"].dataType.simpleString() == "boolean"
    assert quality.op4_quality_rules(empty(spark)).count() == 0
