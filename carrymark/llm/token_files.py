"""Operator 2: token ids in binary shards, with a perfect-hash index in each.

A shard file, all numbers little-endian:

    payload   ids of its documents one after the other, 2 or 4 bytes each
    records   per document: first id (uint64), number of ids (uint64)
    slots     per distinct key: fingerprint (uint32), documents with the key
              (uint32), first of them (uint64)
    bits      the perfect hash over the keys
    footer    JSON: widths, counts, places of the sections; its length; MAGIC

Documents lie in ascending doc_id order, within a shard and over shards (nulls
first). A shard's name is unique to the attempt that wrote it; the manifest, which
Spark commits, names the shards that count, so lost executors and repeated
attempts leave at most unused files.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrymark.llm.common import new_path, stored, texts
from carrymark.llm.mphash import PerfectHash, fingerprint
from carrymark.llm.tokens import WORD_BPE, encoder

END_ID = 2
MAGIC = b"CMIDS001"
SLOT = np.dtype([("fingerprint", "<u4"), ("count", "<u4"), ("first", "<u8")])
AHEAD = 1 << 23
MANIFEST = ("partition int, part int, path string, first_id long, last_id long, nulls long, "
            "documents long, ids long")


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


class ShardWriter:
    """One shard: payload as it comes, the index when it closes."""

    def __init__(self, path: str, width: int):
        self.path, self.width = path, width
        system, name = _open(path)
        self.out = system.open_output_stream(name)
        self.at, self.keys, self.starts, self.lengths, self.nulls = 0, [], [], [], 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        """Keys come in ascending order, null ones first."""
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.starts.append(self.at)
        self.lengths.append(len(ids))
        self.at += len(ids)
        if key is None:
            self.nulls += 1
        else:
            self.keys.append(key)

    def close(self) -> tuple:
        keys = np.array(self.keys, np.int64)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
        distinct = keys[first].view(np.uint64)
        perfect = PerfectHash.build(distinct)
        slots = np.zeros(len(first), SLOT)
        at = perfect.slots(distinct)
        slots["fingerprint"][at] = fingerprint(distinct)
        slots["count"][at] = np.diff([*first, len(keys)])
        slots["first"][at] = first + self.nulls
        records = np.stack([np.array(self.starts, "<u8"), np.array(self.lengths, "<u8")], axis=1)
        for section in (records, slots, perfect.bits):
            self.out.write(section.tobytes())
        footer = json.dumps({"width": self.width, "ids": self.at, "documents": len(records),
                             "nulls": self.nulls, "slots": len(slots),
                             "levels": perfect.sizes.tolist()}).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()
        ends = (int(keys[0]), int(keys[-1])) if len(keys) else (None, None)
        return (self.path, *ends, self.nulls, len(records), self.at)


class ShardReader:
    """Keyed access to one shard: its index is read once, then one read for each key."""

    def __init__(self, path: str):
        system, name = _open(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a shard of token ids: {path}")
        length = int.from_bytes(tail[:8], "little")
        self.meta = json.loads(self.file.read_at(length, size - 16 - length))
        meta, at = self.meta, self.meta["ids"] * self.meta["width"]
        index = self.file.read_at(size - 16 - length - at, at)
        mid, end = 16 * meta["documents"], 16 * meta["documents"] + SLOT.itemsize * meta["slots"]
        self.records = np.frombuffer(index[:mid], "<u8").reshape(-1, 2)
        self.slots = np.frombuffer(index[mid:end], SLOT)
        self.perfect = PerfectHash(np.array(meta["levels"], np.int64),
                                   np.frombuffer(index[end:], np.uint8))
        self.held_at, self.held = 0, b""

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key the first of its documents and how many there are (0: none)."""
        keys = keys.view(np.uint64)
        at = self.perfect.slots(keys)
        slot = self.slots[np.maximum(at, 0)] if len(self.slots) else np.zeros(len(keys), SLOT)
        known = (at >= 0) & (slot["fingerprint"] == fingerprint(keys))
        return slot["first"].astype(np.int64), np.where(known, slot["count"], 0).astype(np.int64)

    def ids(self, document: int, ahead: int = 0) -> np.ndarray:
        """The ids of one record; reads on by ``ahead`` bytes for records that follow."""
        width = self.meta["width"]
        start, length = (int(x) * width for x in self.records[document])
        if not self.held_at <= start <= start + length <= self.held_at + len(self.held):
            self.held_at, self.held = start, self.file.read_at(max(length, ahead), start)
        at = start - self.held_at
        return np.frombuffer(self.held[at:at + length], f"<u{width}")


@dataclass(frozen=True)
class TokenFiles:
    """A written set of shards; ``manifest`` is a stored table of one row for each."""

    manifest: DataFrame

    def shards(self) -> list:
        """Manifest rows in order; one for each ``shard_ids`` ids, so a small list."""
        return self.manifest.orderBy("partition", "part").collect()


def write(docs: DataFrame, folder: str | None = None, tokenizer: str = WORD_BPE,
          end_id: int = END_ID, shard_ids: int = 1 << 26) -> TokenFiles:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order.

    Every document ends with ``end_id``; null and empty texts hold that alone. Rows
    that repeat a doc_id, or have none, all get a record, next to each other; they
    are dealt on by their text and row number, so no id is bound to one task. An
    empty table writes no shard.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token-files")
    system, name = _open(folder)
    system.create_dir(name, recursive=True)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = 2 if max(encode.vocabulary, end_id + 1) <= 1 << 16 else 4
        partition, part, shard, rows = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for key, text in zip(keys, texts(batch.column("text")), strict=True):
                if shard and shard.at >= shard_ids:
                    rows.append((partition, part, *shard.close()))
                    shard, part = None, part + 1
                if shard is None:
                    shard = ShardWriter(f"{folder}/{partition:06d}-{part:04d}-"
                                        f"{uuid.uuid4().hex}.ids", width)
                shard.add(key, np.frombuffer(encode.encode(text) + end, "<u4"))
        if shard:
            rows.append((partition, part, *shard.close()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
        types = [pa.int32()] * 2 + [pa.string()] + [pa.int64()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["partition", "part", "path", "first_id", "last_id", "nulls", "documents",
                   "ids"])

    spread = [F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = docs.select("doc_id", "text").repartitionByRange(
        "doc_id", *spread).sortWithinPartitions("doc_id")
    return TokenFiles(stored(ordered.mapInArrow(run, MANIFEST), "manifest"))


def read(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """The records of ``keys`` (distinct doc_ids, null for those without one).

    Every key is sent to the shards whose range holds it and found there through
    the index. Returns doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32; a key that is not in the files has no row.
    """
    spark = keys.sparkSession
    shards = files.shards()
    starts = np.concatenate([[0], np.cumsum([s.ids for s in shards])]).astype(np.int64)
    low = np.array([s.first_id if s.first_id is not None else s.last_id or -(1 << 63)
                    for s in shards], np.int64)
    high = np.array([s.last_id if s.last_id is not None else -(1 << 63) for s in shards],
                    np.int64)
    with_nulls = [i for i, s in enumerate(shards) if s.nulls]
    known = spark.sparkContext.broadcast(
        (low, high, with_nulls, starts, [s.path for s in shards]))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, with_nulls, _, _ = known.value
        for batch in batches:
            column = batch.column("doc_id")
            ids = column.drop_null().to_numpy()
            a, b = np.searchsorted(high, ids, "left"), np.searchsorted(low, ids, "right")
            n = np.maximum(b - a, 0)
            shard = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            where = [*shard.tolist(), *(with_nulls if column.null_count else [])]
            keys = [*np.repeat(ids, n).tolist(),
                    *([None] * len(with_nulls) if column.null_count else [])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int32()), pa.array(keys, pa.int64())],
                names=["shard", "doc_id"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *_, starts, paths = known.value
        shard, reader = None, None
        for batch in batches:
            numbers, column = batch.column("shard").to_numpy(), batch.column("doc_id")
            for number in np.unique(numbers).tolist():
                out = []
                if number != shard:
                    shard, reader = number, ShardReader(paths[number])
                mine = column.filter(pa.array(numbers == number))
                if mine.null_count:
                    out += [(None, d) for d in range(reader.meta["nulls"])]
                ids = mine.drop_null().to_numpy()
                first, count = reader.find(ids)
                out += [(key, d) for key, f, c in zip(ids.tolist(), first.tolist(),
                                                      count.tolist(), strict=True)
                        for d in range(f, f + c)]
                found = [(key, int(starts[number] + reader.records[d, 0]),
                          int(reader.records[d, 1]),
                          zlib.crc32(reader.ids(d, AHEAD).astype("<u4").tobytes())) for key, d in out]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found, strict=True)],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    routed = keys.select("doc_id").mapInArrow(route, "shard int, doc_id long")
    # The shuffle holds keys only, but a task reads its shards: as many tasks as shards.
    routed = routed.repartition(max(len(shards), 1), "shard").sortWithinPartitions("shard", "doc_id")
    return routed.mapInArrow(fetch, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(files: TokenFiles, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row with that id), read from its shard alone."""
    found = []
    for shard in files.shards():
        if shard.first_id is not None and shard.first_id <= doc_id <= shard.last_id:
            reader = ShardReader(shard.path)
            (first,), (count,) = reader.find(np.array([doc_id], np.int64))
            found += [reader.ids(d) for d in range(first, first + count)]
    return found


def op2_token_files(docs: DataFrame) -> DataFrame:
    files = write(docs)
    return read(files, docs.select("doc_id").distinct())


def open_files(spark: SparkSession, manifest: str) -> TokenFiles:
    """Files that an earlier session wrote, by the path of their manifest."""
    return TokenFiles(spark.read.parquet(manifest))
