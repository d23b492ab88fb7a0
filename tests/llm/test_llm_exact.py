import hashlib
from collections import Counter

import pytest
from carrymark.llm.exact import DigestIndex, deduplicate, digests, op8_exact_dedup
from messy import ROWS, empty, messy


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_every_row_and_one_of_each_text_stays(spark):
    rows = op8_exact_dedup(messy(spark), buckets=4).collect()
    size = Counter(lowered(r[1]) for r in ROWS)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in size}
    assert len(rows) == len(ROWS)
    assert Counter(sha[r.text_sha256] for r in rows) == size
    assert all(r.group_size == size[sha[r.text_sha256]] for r in rows)
    assert Counter(sha[r.text_sha256] for r in rows if r.kept) == Counter(dict.fromkeys(size, 1))
    for text in size:
        ids = [r[0] for r in ROWS if lowered(r[1]) == text and r[0] is not None]
        got = {r.keep_id for r in rows if sha[r.text_sha256] == text}
        assert got == {max(ids, default=None)}
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_later_batches_meet_the_index_of_earlier_sessions(spark):
    schema = "doc_id long, text string"
    first = spark.createDataFrame([(5, "a"), (3, "A"), (4, "b")], schema)
    index = DigestIndex(spark, buckets=3)
    assert {r.doc_id for r in deduplicate(digests(first), index).collect() if r.kept} == {4, 5}
    again = DigestIndex(spark, path=index.path, buckets=3)
    second = spark.createDataFrame([(9, "a"), (8, "c"), (7, "C"), (6, "B")], schema)
    rows = deduplicate(digests(second), again).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows} == {
        (9, 5, 1, False), (8, 8, 2, True), (7, 8, 2, False), (6, 4, 1, False)}
    assert again.read().count() == 3


def test_another_number_of_buckets_is_refused(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "cast(id as string) as text")
    index = DigestIndex(spark, buckets=16)
    deduplicate(digests(docs), index)
    with pytest.raises(ValueError, match="16 buckets"):
        DigestIndex(spark, path=index.path, buckets=4)
    again = DigestIndex(spark, path=index.path)
    assert again.buckets == 16
    assert deduplicate(digests(docs), again).filter("kept").count() == 0
    assert again.read().count() == 400


def test_a_batch_can_be_given_again(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "cast(id % 300 as string) as text")
    index = DigestIndex(spark, buckets=4)

    def kept(name):
        found = deduplicate(digests(docs.repartition(3)), index, name).filter("kept")
        return sorted(r.doc_id for r in found.collect())

    first = kept("monday")
    assert len(first) == 300 and kept("monday") == first
    assert kept("tuesday") == [] and kept("monday") == first
    assert index.read().count() == 300


def test_an_append_that_broke_off_is_completed(spark):
    docs = spark.range(100).selectExpr("id as doc_id", "cast(id as string) as text")
    index, rows = DigestIndex(spark, buckets=4), digests(docs)
    index.append(rows.filter("doc_id < 40").selectExpr("digest", "doc_id as keep_id",
                                                       "'monday' as batch"))
    assert deduplicate(rows, index, "monday").filter("kept").count() == 100
    assert index.read().count() == 100


def test_table_names_do_not_pile_up(spark):
    before = len(spark.catalog.listTables())
    index = DigestIndex(spark, buckets=2)
    DigestIndex(spark, path=index.path)
    assert len(spark.catalog.listTables()) == before + 1
    index.forget()
    op8_exact_dedup(messy(spark), buckets=2).count()
    assert len(spark.catalog.listTables()) == before


def test_index_side_is_not_shuffled(spark):
    index = DigestIndex(spark, buckets=4)
    groups = spark.range(10).selectExpr("unhex(sha2(cast(id as string), 256)) as digest")
    plan = groups.hint("merge").join(index.read().select("digest"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange") == 1


def test_empty_table(spark):
    assert op8_exact_dedup(empty(spark), buckets=2).count() == 0
