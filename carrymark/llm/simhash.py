"""Operator 10: near-duplicates by SimHash, linked through sharded BK-trees.

1. Every whole text becomes one 64-bit fingerprint (Arrow batches, numpy sums).
2. Distinct fingerprints are dealt to shards. Two fingerprints that differ in at
   most r bits agree in at least (blocks - r) of the blocks the 64 bits are cut
   into, so a shard holds the fingerprints that agree in one choice of blocks, and
   every link lies within some shard. A shard that grows beyond ``max_shard`` is
   dealt again by further bits in the same way, so no link is lost and no tree
   outgrows its task.
3. Each shard builds a BK-tree and follows only the edges within the radius. It
   returns a spanning set of links, never all pairs.
4. Components of the links, by joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrymark.llm.bktree import links
from carrymark.llm.common import join_groups, stored, utf8
from carrymark.llm.components import components

SEED = 42
SEGMENT = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def segments(text: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes that end at white space."""
    start = 0
    while start < len(text):
        cut = SPACE.search(text, start + size)
        end = cut.end() if cut else len(text)
        yield text[start:end]
        start = end


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 without words.

    A-Z are lower-cased. Fewer words than a shingle has make one shingle.
    """
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for part in segments(text):
        tokens = tail + part.lower().split()
        count = len(tokens) - words + 1
        if count > 0:
            shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", count)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += count
            tokens = tokens[count:]
        tail = tokens
    if not total and tail:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``fp`` of every ``text`` beside the other columns of ``docs``."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t, words) for t in utf8(batch.column("text"))),
                                 np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array(values.view(np.int64))],
                names=[*others, "fp"])

    schema = docs.select(*others, F.lit(0).cast("long").alias("fp")).schema
    return docs.mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cut(positions: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` runs of about equal length over bit positions."""
    runs = np.array_split(np.array(positions, dtype=object), parts)
    return [sum(1 << int(p) for p in run) for run in runs]


def _finer(mask: int, radius: int) -> list[int]:
    """The mask with one more block: of r + 1 blocks of the other bits, one agrees."""
    free = [p for p in range(64) if not mask >> p & 1]
    return [mask | block for block in _cut(free, radius + 1)]


def blocks_for(distinct: int, radius: int, shard: int = 256) -> int:
    """Fewest blocks for which an average shard has at most ``shard`` fingerprints."""
    blocks = radius + 1
    while blocks < 2 * radius + 4 and distinct >> (64 * (blocks - radius) // blocks) > shard:
        blocks += 1
    return blocks


def _linked(cells: DataFrame, radius: int) -> DataFrame:
    """Spanning links (u, v) within each shard of ``cells`` (fp, mask, key).

    Rows arrive sorted by shard; a shard's rows are held until the next begins.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held = None, []

        def close() -> list[tuple[int, int]]:
            return links(held, radius) if len(held) > 1 else []

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("mask", "key")], axis=1)
            values = batch.column("fp").to_numpy().view(np.uint64).tolist()
            starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            found = []
            for a, b in zip([0, *starts], [*starts, len(values)], strict=True):
                key = tuple(keys[a].tolist()) if b > a else open_key
                if key != open_key:
                    found += close()
                    open_key, held = key, []
                held += values[a:b]
            if found:
                yield _links(found)
        if found := close():
            yield _links(found)

    sorted_cells = cells.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return sorted_cells.mapInArrow(run, "u long, v long")


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, dtype=np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                      names=["u", "v"])


def link(distinct: DataFrame, radius: int = 3, blocks: int | None = None,
         max_shard: int = 4096) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints connected within ``radius``.

    ``distinct``: one row per ``fp``, from a stored table. ``blocks`` defaults to
    what keeps average shards small for that many fingerprints. ``max_shard`` must
    be 4096 or more, so that shards of few free bits are never dealt again.
    """
    if max_shard < 4096:
        raise ValueError("max_shard must be at least 4096")
    spark = distinct.sparkSession
    blocks = blocks or blocks_for(distinct.count(), radius)
    runs = _cut(list(range(64)), blocks)
    masks = [sum(chosen) for chosen in combinations(runs, blocks - radius)]

    def cells(rows: DataFrame) -> DataFrame:
        return rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))

    rows = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
                           .alias("mask"))
    found = None
    while True:
        dealt = cells(rows)
        large = stored(dealt.groupBy("mask", "key").count().filter(F.col("count") > max_shard)
                       .select("mask", "key"), "large-shards")
        none_large = large.isEmpty()
        small = dealt if none_large else dealt.join(large, ["mask", "key"], "left_anti")
        part = stored(_linked(small, radius), "links")
        found = part if found is None else found.unionByName(part)
        if none_large:
            return found
        finer = {m: _finer(m, radius) for m in masks}
        table = spark.createDataFrame([(_signed(m), _signed(f)) for m, fs in finer.items()
                                       for f in fs], "mask long, finer long")
        masks = sorted({f for fs in finer.values() for f in fs})
        # Each large shard is dealt again, its rows once for each finer mask.
        rows = stored(dealt.join(large, ["mask", "key"], "left_semi")
                      .join(F.broadcast(table), "mask")
                      .select("fp", F.col("finer").alias("mask")).distinct(), "finer-shards")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3,
                    max_shard: int = 4096) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` of every document of ``docs``.

    ``docs`` needs doc_id and text; its columns other than text stay. Documents
    have one root if and only if they are in one group; component_id is the smallest doc_id that can be reached over links of
    ``radius`` bits, null where all of these are null. Null and empty texts have
    fingerprint 0, which links like any other; equal texts always meet. An empty
    table gives no rows. Columns of ``docs`` named fp, root, copies or component_id
    are replaced.
    """
    docs = docs.drop("fp", "root", "copies", "component_id")
    marked = stored(fingerprints(docs, words), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"),
                                              F.count("*").alias("copies")), "classes")
    roots = components(link(classes.select("fp"), radius, max_shard=max_shard))
    classes = stored(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")), "rooted-classes")
    first = classes.groupBy("root").agg(F.min("first_id").alias("component_id"),
                                        F.count("*").alias("members"))
    # A component may hold any share of the fingerprints: its name is sent to them.
    named = join_groups(classes, first, "root", "members", classes.count()).select(
        "fp", "copies", "root", "component_id")
    return join_groups(marked, named, "fp", "copies", marked.count()).drop("copies")


def op10_simhash_neardup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
