import random

import numpy as np
import pytest
import xxhash
from carrymark.llm import simhash
from carrymark.llm.bktree import links
from carrymark.llm.common import join_groups, stored
from carrymark.llm.components import components
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import ROWS, empty, messy
from pyspark.sql import functions as F


def plain_fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i:i + words]), 42)
              for i in range(max(1, len(tokens) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius=3):
    values = sorted(values)
    array, root = np.array(values, np.uint64), list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {v: values[find(i)] for i, v in enumerate(values)}


def closure(values, pairs):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


@given(st.binary(max_size=400))
@settings(max_examples=50, deadline=None)
def test_fingerprint_of_whole_text_in_segments(data):
    text = data.decode("latin-1").replace("\x85", " ").replace("\xa0", " ")
    old, simhash.SEGMENT = simhash.SEGMENT, 7
    try:
        parts = list(simhash.segments(text.encode(), 7))
        assert b"".join(parts) == text.encode()
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    finally:
        simhash.SEGMENT = old


@given(st.lists(st.integers(0, 2**64 - 1), max_size=30), st.lists(
    st.tuples(st.integers(0, 29), st.integers(0, 63)), max_size=60))
@settings(max_examples=60, deadline=None)
def test_tree_links_connect_what_is_near(values, flips):
    for at, bit in flips:
        if values:
            values.append(values[at % len(values)] ^ (1 << bit))
    values = sorted(set(values))
    assert closure(values, links(values, 3)) == roots(values)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("blocks", [None, 5])
def test_large_shards_are_dealt_again_without_losing_links(spark, blocks):
    rng = random.Random(5)
    # 5,000 fingerprints that agree in 40 bits, so that shards must be dealt again
    values = {0xABCDEF0123 << 24 | rng.getrandbits(24) for _ in range(5000)}
    values |= {v ^ (1 << rng.randrange(64)) for v in list(values)[:500]}
    rows = stored(spark.createDataFrame([(signed(v),) for v in values], "fp long"), "fps")
    found = simhash.link(rows, blocks=blocks).collect()
    pairs = [(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in found]
    assert all((a ^ b).bit_count() >= 1 for a, b in pairs)
    assert closure(values, pairs) == roots(values)


def test_blocks_grow_with_the_number_of_fingerprints():
    sizes = [simhash.blocks_for(n, 3) for n in (10, 10**7, 10**9, 10**11)]
    assert sizes[0] == 4 and sizes == sorted(sizes) and sizes[-1] > 4


def test_components_against_search(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 6000 + i) for i in range(300)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len(rows) == len(nodes)
    assert {r.node: r.root for r in rows} == closure(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_hub_is_not_gathered_in_one_task(spark):
    edges = stored(spark.range(0, 40_000, 1, 8).selectExpr("id + 1 as u", "0L as v"), "star")
    rows = components(edges)
    assert rows.count() == 40_001 and rows.filter("root <> 0").isEmpty()
    # Each end of an edge meets what is known of the hub where it lies.
    ends = edges.selectExpr("v as hub", "u as node")
    hubs = ends.groupBy("hub").agg(F.min("node").alias("least"), F.count("*").alias("size"))
    old = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        joined = join_groups(ends, hubs, "hub", "size", 40_000).select(
            F.spark_partition_id().alias("task"))
        tasks = sorted(r["count"] for r in joined.groupBy("task").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", old)
    assert sum(tasks) == 40_000 and tasks[-1] <= 3 * tasks[len(tasks) // 2]


def test_documents_of_every_kind(spark):
    rows = simhash.near_duplicates(messy(spark)).collect()
    assert sorted((r.doc_id or 0, r.fp & (1 << 64) - 1) for r in rows) == sorted(
        (r[0] or 0, plain_fingerprint(r[1])) for r in ROWS)
    by = roots({plain_fingerprint(r[1]) for r in ROWS})
    least = {}
    for r in ROWS:
        root = by[plain_fingerprint(r[1])]
        ids = [i for i in (least.get(root), r[0]) if i is not None]
        least[root] = min(ids, default=None)
    assert all(r.component_id == least[by[r.fp & (1 << 64) - 1]] for r in rows)
    assert all(r.row_ == "own row_" for r in rows)


def test_query_columns_and_empty_table(spark):
    out = simhash.op10_simhash_neardup(messy(spark))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert {len(r.fingerprint) for r in out.collect()} == {16}
    assert simhash.op10_simhash_neardup(empty(spark)).count() == 0
