import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from carrymark.llm import prefix_trie
from carrymark.llm.prefix_trie import op12_prefix_trie
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Nodes of the trie by dictionaries of prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = f"{len(role.encode())}:{role}{text}"
            own[conv].append((turn is not None, turn or 0, role,
                              hashlib.md5(name.encode()).hexdigest(), text))
    turns = {c: [(x[2], x[4]) for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        t = turns.get(c - int(abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + t[h:]
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
        ends[tuple(t)].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        cost = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += cost
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p],
         saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items())


def found(spark, rows, limit, **extra):
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns(
        {c: F.lit(c) for c in ("ids", "sizes", "container", "depth", "n", "ends", "base")})
    return Counter(tuple(r) for r in op12_prefix_trie(turns, limit).collect())


def threads(conversations, seed):
    """Conversations over few turns, so that prefixes are shared at every depth."""
    rng, rows = random.Random(seed), []
    for c in range(conversations):
        for k in range(rng.choice((1, 2, 3, 5, 12))):
            rows.append((c, k, rng.choice(("user", "assistant")), rng.choice("ab") * 3))
    return rows


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_equals_dictionaries_of_prefixes(spark, limit):
    rows = threads(120, limit)
    assert found(spark, rows, limit) == plain(rows)


def test_disorder(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", ""), (1, 0, "a", "tie"),
            (1, 0, "a", "tie"), (None, 1, "user", "nobody's"), (2, 5, "ü", "日本😀" * 9000),
            (2, 4, "", "x"), (7, 1, "user", "alone"), (12, 1, "u", "y"), (-3, 1, "u", "y"),
            (-5, 2, "u", "z"), (-5, 3, "u", "zz"), (-6, None, None, None)]
    for limit in (1, 100):
        assert found(spark, rows, limit) == plain(rows)


def test_many_copies_and_a_long_common_opening(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    rows = [(c, k, "user", f"copy {k}") for c in range(300) for k in range(3)]
    rows += [(1000 + c, k, "user", f"thread {k}") for c in range(25) for k in range(40 - c % 6)]
    rows += [(1000 + c, 90, "user", f"end {c}") for c in range(25)]
    assert found(spark, rows, 5) == plain(rows)


def test_conversations_left_without_turns_end_at_the_root(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 3)
    rows = [(c, 0, "user", "only one"), (c, 1, "user", "two")]
    got = found(spark, rows, 10)
    assert got == plain(rows) and sum(got.values()) == 1
    assert found(spark, [(None, 0, "user", "x")], 10) == Counter()
