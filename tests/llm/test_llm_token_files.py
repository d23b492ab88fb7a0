import zlib

import numpy as np
import pytest
from carrymark.llm.mphash import PerfectHash, fingerprint
from carrymark.llm.token_files import (
    TokenFiles, lookup, op2_token_files, open_files, read, write)
from carrymark.llm.tokens import WORD_BPE
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import ROWS, empty, messy
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TOKENIZER = Tokenizer.from_file(WORD_BPE)
TOKENIZER.encode_special_tokens = True


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


@given(st.sets(st.integers(-2**63, 2**63 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_perfect_hash_is_minimal_and_tells_foreign_keys(keys):
    values = np.array(sorted(keys), np.int64).view(np.uint64)
    perfect = PerfectHash.build(values)
    again = PerfectHash(perfect.sizes, perfect.bits)
    assert sorted(again.slots(values).tolist()) == list(range(len(keys)))
    assert len(np.unique(fingerprint(values))) == len(keys)


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([4, 4], np.uint64))


def test_files_hold_all_documents_in_order(spark):
    files = write(messy(spark), shard_ids=5)
    assert len(files.shards()) > 5
    keys = messy(spark).select("doc_id").distinct()
    rows = read(files, keys.union(spark.createDataFrame([(77,), (-5,)], "doc_id long"))).collect()
    assert len(rows) == len(ROWS)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (r[0] or 0, len(ids(r[1])), zlib.crc32(np.array(ids(r[1]), "<u4").tobytes()))
        for r in ROWS)


def test_keyed_access_by_a_later_session(spark, tmp_path):
    write(messy(spark), shard_ids=50).manifest.write.parquet(str(tmp_path / "manifest"))
    files = open_files(spark, str(tmp_path / "manifest"))
    assert isinstance(files, TokenFiles)
    assert [x.tolist() for x in lookup(files, 1)] == [ids(ROWS[0][1])]
    assert sorted(x.tolist() for x in lookup(files, 7)) == sorted(
        ids(r[1]) for r in ROWS if r[0] == 7)
    assert lookup(files, 12345) == []


def test_hot_id_is_dealt_to_several_shards(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.concat(F.lit("text "), F.col("id")).alias("text")).repartition(8)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # as if the partitions were large
    files = write(docs)
    spark.conf.unset(setting)
    holding = [s for s in files.shards() if s.first_id is not None and s.first_id <= 5 <= s.last_id]
    assert len(holding) > 1
    assert read(files, docs.select("doc_id").distinct()).count() == 3000


def test_empty_table(spark):
    assert op2_token_files(empty(spark)).count() == 0
