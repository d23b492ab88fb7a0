"""Operator 5: best-fit packing of token sequences by minimum bin slack.

The plan needs only how many pieces there are of each length, at most ``capacity``
numbers. Sequences are planned one pattern at a time: the longest piece left opens
it, a bitset subset-sum over the available lengths finds the fullest completion,
and the pattern is used as often as its lengths last. Spark then numbers the
pieces of each length and looks every number up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carrymark.llm.common import stored, texts
from carrymark.llm.tokens import BYTE_BPE, encoder

CAPACITY = 1024
END_ID = 2
PIECE = "piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str = BYTE_BPE, capacity: int = CAPACITY,
        end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids and end id.

    Only documents of more than ``capacity`` ids are cut; the first piece holds what
    is over. A null or empty text is its end id alone. Columns of ``docs`` other than
    text stay; ``with_ids`` adds the ids as little-endian unsigned 32-bit integers.
    """
    names = {"text", "piece", "start", "length", "ids_crc32", "ids"}
    others = [c for c in docs.columns if c not in names]
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_all
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, data in enumerate(encode(texts(batch.column("text")))):
                data += end
                n, at, k = len(data) // 4, 0, 0
                stop = n % capacity or min(n, capacity)
                while at < n:
                    part = data[4 * at:4 * stop]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(stop - at)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
                    at, stop, k = stop, stop + capacity, k + 1
            taken = batch.select(others).take(pa.array(rows, pa.int64())) if others else None
            columns = [*(taken.columns if taken else []), pa.array(piece, pa.int32()),
                       *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[
                *others, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*others).schema]
    return docs.mapInArrow(run, ", ".join([*fields, PIECE, *["ids binary"] * with_ids]))


@dataclass(frozen=True)
class Pattern:
    lengths: tuple[int, ...]  # longest first
    times: int


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each as often as available, with the largest sum of at most ``room``.

    Bit s of ``reach`` says that some choice adds up to s. A length that is there c
    times enters as bundles of 1, 2, 4, ... of it.
    """
    reach, steps, mask = 1, [], (1 << room + 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, bundle = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            bundle = min(bundle, left)
            steps.append((reach, length, bundle))
            reach |= reach << length * bundle & mask
            left, bundle = left - bundle, 2 * bundle
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for before, length, bundle in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * bundle
            total -= length * bundle
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up all pieces, as few sequences as the heuristic finds.

    A pattern is used until one of its lengths has less left than a further use
    takes, which at least halves that length's count; so there are at most capacity
    times log2(pieces) patterns, however many the pieces.
    """
    counts, patterns = {k: n for k, n in counts.items() if n}, []
    while counts:
        first = max(counts)
        rest = counts | {first: counts[first] - 1}
        lengths = [first, *fullest({k: n for k, n in rest.items() if n}, capacity - first)]
        used = {x: lengths.count(x) for x in lengths}
        times = min(counts[x] // n for x, n in used.items())
        for x, n in used.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        patterns.append(Pattern(tuple(sorted(lengths, reverse=True)), times))
    return patterns


def _places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length and pattern: the first number it serves and where that goes."""
    rows, taken, sequence = [], {}, 0
    for pattern in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in pattern.lengths:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            rows.append((length, taken.get(length, 0), sequence, places))
            taken[length] = taken.get(length, 0) + len(places) * pattern.times
        sequence += pattern.times
    rows.sort(key=lambda r: r[:2])
    uses = np.array([len(r[3]) for r in rows], np.int64)
    return {"length": np.array([r[0] for r in rows], np.int64),
            "first": np.array([r[1] for r in rows], np.int64),
            "sequence": np.array([r[2] for r in rows], np.int64), "uses": uses,
            "at": np.cumsum(uses) - uses,
            "offsets": np.array([o for r in rows for o in r[3]], np.int64)}


def pack(pieces: DataFrame, capacity: int = CAPACITY,
         rows_per_bucket: int = 100_000) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, from a stored table) with their
    ``sequence_id`` and ``offset``.

    Pieces of one length are numbered in buckets of bounded size, so a length that
    holds most pieces is still dealt to many tasks. No pieces give no rows. Other
    columns stay, but for those two and for names that end in an underscore.
    """
    pieces = pieces.select(*(c for c in pieces.columns
                             if c not in ("sequence_id", "offset") and not c.endswith("_")))
    buckets = pieces.count() // rows_per_bucket + 1
    pieces = pieces.withColumn("bucket_", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = stored(pieces.groupBy("length", "bucket_").agg(F.count("*").alias("n_")), "lengths")
    counts = {r.length: r.n for r in
              sizes.groupBy("length").agg(F.sum("n_").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket_").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket_",
                          F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    order = Window.partitionBy("length", "bucket_").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank_", F.row_number().over(order) - 1).join(
        starts, ["length", "bucket_"]).withColumn("rank_", F.col("rank_") + F.col("before_"))
    ranked = ranked.drop("bucket_", "before_")
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan(counts, capacity)))
    kept = [c for c in ranked.columns if c != "rank_"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        numbers = (p["length"] << 44) + p["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank_").to_numpy()
            row = np.searchsorted(numbers, (length << 44) + rank, side="right") - 1
            nth = rank - p["first"][row]
            sequence = p["sequence"][row] + nth // p["uses"][row]
            offset = p["offsets"][p["at"][row] + nth % p["uses"][row]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*kept).schema]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ids of the pieces one after the other, and whose they are.

    ``placed`` is ``pack`` of pieces cut ``with_ids``. A sequence holds at most
    ``capacity`` pieces, so each row is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"))


def op5_best_fit_packing(docs: DataFrame) -> DataFrame:
    pieces = stored(cut(docs.select("doc_id", "text")), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32",
                               "sequence_id", "offset")
