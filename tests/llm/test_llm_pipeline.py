from collections import Counter

import corpus_pipeline
import numpy as np
from carrymark.llm import personal, toxicity
from carrymark.llm.common import documents, stored
from carrymark.llm.tokens import BYTE_BPE
from messy import SCHEMA, empty, messy
from pyspark.sql import functions as F
from test_llm_packing import check_packed
from test_llm_simhash import plain_fingerprint, roots
from tokenizers import Tokenizer

SMALL = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_neardup", "personal_data", "best_fit_packing"]


def test_pipeline_against_brute_force(spark):
    rows = documents(spark, SMALL).collect()
    docs = documents(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter(~toxicity.held_out())
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    score = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rows = [r for r in rows if score[r.doc_id] < 0.5]

    last = {}
    for r in rows:
        last[lowered(r.text)] = max(last.get(lowered(r.text), -1), r.doc_id)
    rows = [r for r in rows if last[lowered(r.text)] == r.doc_id]

    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    root = roots(set(prints.values()))
    first = {}
    for i, p in prints.items():
        first[root[p]] = min(first.get(root[p], i), i)
    rows = [r for r in rows if first[root[prints[r.doc_id]]] == r.doc_id]

    known = personal.learn(spark.createDataFrame([(r.text,) for r in rows], "text string"))
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for r in rows:
        n = len(tokenizer.encode(personal.redacted(r.text or "", known),
                                 add_special_tokens=False).ids) + 1
        for k, start in enumerate([0, *range(n % 1024 or 1024, n, 1024)]):
            want[r.doc_id, k, start] += 1
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start) for r in out) == want
    check_packed(out, 1024)


def test_documents_of_every_kind(spark, tmp_path):
    spark.createDataFrame([(1, 0), (2, 1), (None, 1), (7, None)], "doc_id long, toxic int"
                          ).write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (messy(spark), empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), name)
            if name != "best_fit_packing":
                assert docs.columns == columns
                if "fp" in columns:
                    assert docs.filter("fp <> 'own fp'").isEmpty()
        check_packed(docs.collect(), 1024)


def test_one_of_each_exact_and_near_copy_stays(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(500)]
    base = " ".join(rng.choice(words, 400))
    texts = [base, base.upper(), base + " end", " ".join(rng.choice(words, 400)), None, "", ""]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    kept = stored(corpus_pipeline.drop_exact_copies(spark, docs, ""), "kept")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6]
    near = corpus_pipeline.drop_near_copies(spark, kept, "").collect()
    far = (plain_fingerprint(texts[1]) ^ plain_fingerprint(texts[2])).bit_count() > 3
    assert sorted(r.doc_id for r in near) == ([1, 2, 3, 6] if far else [1, 3, 6])


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(7, "same"), (7, "same"), (None, "x"), (None, "x")],
                                 "doc_id long, text string").withColumn("row_", F.lit(0))
    kept = corpus_pipeline.drop_exact_copies(spark, docs, "")
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["7", "None"]
