"""Operator 7: byte-level BPE with Spark's higher-order functions.

Texts are dealt in blocks within each task. The words that are new in a block go through
Spark as arrays of bytes: pairs that are certain to merge are merged at once, then a fold
merges the pair of lowest rank until none is left; ranks come from one literal table, a
scalar subquery's value. The words' ids
are then put together to the texts' ids. No text leaves its task, so a lost task is
simply run again. Words that are frequent in a sample are folded once beforehand and
broadcast; that saves work and changes no result, as all others are folded in place.
"""

from __future__ import annotations

import base64
import uuid
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carrymark.llm.common import held, stored, texts
from carrymark.llm.quality import let
from carrymark.llm.tokens import chunk_text, chunks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters of texts in a block; a longer text is a block of its own.
BLOCK = 1 << 21
#: Chunks and words that a task remembers; after a block with more it begins anew.
KEPT = 200_000
WORD_ROWS = 10_000
TEXT_ROWS = 1_000
#: A cell holds, from its lowest bit, a token's id, its place in the word and its pair's rank.
ID_BITS = 17
RANK_AT = 2 * ID_BITS
NONE = (1 << 29) - 1
NO_PAIR = NONE << RANK_AT
END = 1 << 16
#: Words beyond this are cut where no token can reach over.
LONG_WORD = 64
#: Parts beyond this are merged pair by pair wherever the pair occurs, not place by place.
LONG_PART = 512


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def joins(ranks: dict[bytes, int]) -> np.ndarray:
    """Which pairs of bytes stand side by side in some token, as a 256 x 256 table."""
    table = np.zeros((256, 256), bool)
    data = np.frombuffer(b"".join(ranks), np.uint8)
    within = np.ones(max(len(data) - 1, 0), bool)
    within[np.cumsum([len(token) for token in ranks])[:-1] - 1] = False
    table[data[:-1][within], data[1:][within]] = True
    return table


def longest(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """The length of the longest token by its first two bytes."""
    lengths: dict[bytes, int] = {}
    for token in ranks:
        lengths[token[:2]] = max(lengths.get(token[:2], 0), len(token))
    return lengths


def uncrossed(data: bytes, ranks: dict[bytes, int], lengths: dict[bytes, int]) -> list[bytes]:
    """``data`` cut wherever none of its substrings that are tokens reaches over.

    Whatever is merged is such a substring, so the parts are encoded independently.
    """
    parts, start, reach = [], 0, 0
    for at in range(len(data)):
        if at == reach and at:
            parts.append(data[start:at])
            start = at
        for n in range(lengths.get(data[at:at + 2], 1), 1, -1):
            if at + n <= reach:
                break
            if data[at:at + n] in ranks:
                reach = at + n
                break
        reach = max(reach, at + 1)
    return [*parts, data[start:]]


def placed(rows: dict[int, dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """One array for all rows, entry b of row a at ``offsets[a] + b``, and the offsets.

    Rows lie over each other where their entries leave gaps, the longest placed first.
    Free places hold -1.
    """
    size = 1 << (4 * sum(map(len, rows.values()))).bit_length()
    table, offsets = np.full(size + width, -1, np.int64), np.zeros(width, np.int32)
    draw = np.random.default_rng(1)
    for a, row in sorted(rows.items(), key=lambda item: (-len(item[1]), item[0])):
        columns = np.fromiter(row, np.int64, len(row))
        for offset in draw.integers(size, size=1_000):
            if (table[offset + columns] < 0).all():
                break
        else:
            offset = len(table)
            table = np.append(table, np.full(width, -1, np.int64))
        table[offset + columns] = np.fromiter(row.values(), np.int64, len(row))
        offsets[a] = offset
    return table, offsets


def codes(words: list[bytes]) -> pa.ListArray:
    """Each byte of the words with the byte after it, 256 * byte + next, or 256 * 256 + byte at
    a word's end."""
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
    ends = np.cumsum([0, *map(len, words)]).astype(np.int32)
    values = flat << 8
    values[:-1] |= flat[1:]
    last = ends[1:][np.diff(ends) > 0] - 1
    values[last] = END + flat[last]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def rank_table(spark: SparkSession, path: str) -> DataFrame:
    """One row of arrays.

    ``pairs`` at ``offsets[a]`` + b is the cell of token a before token b, if they form a pair;
    a cell of another token, or none, means that they do not. ``alone``: whether a token
    forms a pair of lower rank than its own: such a pair comes before the token's other
    places, so these cannot all be merged together.

    By codes of two bytes: ``single``, the id of the first; ``early``, the id that they merge
    to, but not of an ``alone`` token; ``left`` and ``right``, the lowest rank of a token that ends
    or begins with them. NONE where there is none.
    """
    ranks = load_ranks(path)
    width = max(ranks.values()) + 1
    rows: dict[int, dict[int, int]] = {}
    alone = np.zeros(width, bool)
    early, left, right = np.full((3, END + 256), NONE, np.int32)
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                rows.setdefault(a, {})[b] = rank << RANK_AT | a
                alone[[a, b]] |= rank < np.array([a, b])
        if len(token) > 1:
            head, tail = token[0] << 8 | token[1], token[-2] << 8 | token[-1]
            right[head], left[tail] = min(right[head], rank), min(left[tail], rank)
    for token, rank in ranks.items():
        if len(token) == 2 and not alone[rank] and all(
                bytes([b]) in ranks for b in token):
            early[token[0] << 8 | token[1]] = rank
    byte_ids = [ranks.get(bytes([b])) for b in range(256)]
    single = [b for b in byte_ids for _ in range(256)] + byte_ids
    pairs, offsets = placed(rows, width)
    return spark.createDataFrame(pa.table(
        {"single": pa.array([single], pa.list_(pa.int32()))} |
        {name: pa.array([column]) for name, column in (
            ("early", early), ("left", left), ("right", right), ("pairs", pairs),
            ("offsets", offsets), ("alone", alone))}))


def id_of(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit((1 << ID_BITS) - 1).cast("long"))


def place_of(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(((1 << ID_BITS) - 1) << ID_BITS).cast("long"))


def rank_of(cell: Column) -> Column:
    return F.shiftright(cell, RANK_AT)


def cell_of(a: Column, b: Column, table: Column) -> Column:
    """Token ``a``'s id and above it the rank of its pair with the next token."""
    found = F.get(table["pairs"], (F.get(table["offsets"], a.cast("int")) + b).cast("int"))
    return F.when(id_of(found) == a, found).otherwise(F.lit(NO_PAIR).cast("long") + a)


def cells_of(ids: Column, table: Column) -> Column:
    return let(ids, lambda x: F.transform(x, lambda a, i: cell_of(a, F.get(x, i + 1), table)))


def sure_tokens(data: Column, table: Column) -> Column:
    """Ids after those merges of two bytes that are certain whatever the rest does.

    What else could take one of the two bytes is a token that ends with the byte before
    and the first, or begins with the second and the byte after. If all of these rank above
    the pair, and so do the pairs of what it merges to, then the pair is merged before
    anything beside it changes: merging it at once gives the same.
    """
    def sure(code: Column, i: Column) -> Column:
        """The id that a certain pair merges to, else -1 less the first byte's own id."""
        pair = F.get(table["early"], code)
        return F.when(pair < F.least(
            F.get(table["left"], F.get(data, i - 1)), F.get(table["right"], F.get(data, i + 1)),
            F.lit(NONE)), pair).otherwise(F.lit(-1) - F.get(table["single"], code))

    def tokens(marks: Column) -> Column:
        return F.array_remove(F.transform(marks, lambda mark, i: F.when(
            F.get(marks, i - 1) >= 0, -1).when(mark >= 0, mark).otherwise(F.lit(-1) - mark)), -1)

    return let(F.transform(data, sure), tokens)


def merged(data: Column, table: Column) -> Column:
    """Ids of a word of at most LONG_PART bytes, ``data`` its codes.

    The fold's state is one array of cells, each with its place between rank and id, so that
    no two are equal. The smallest cell is the next pair to merge, the first of those of
    equal rank; merging changes that cell and its neighbour and drops one.
    """
    def step(cells: Column, _: Column) -> Column:
        def merge(least: Column) -> Column:
            def each(cell: Column, i: Column) -> Column:
                return F.when(cell == least, place_of(cell) + cell_of(
                    rank_of(least), id_of(F.get(cells, i + 2)), table)).when(
                    F.get(cells, i + 1) == least, place_of(cell) + cell_of(
                        id_of(cell), rank_of(least), table)).when(
                    F.get(cells, i - 1) == least, F.lit(-1).cast("long")).otherwise(cell)

            return F.array_remove(F.transform(cells, each), F.lit(-1).cast("long"))

        return let(F.array_min(cells), lambda least: F.when(
            least < F.lit(NO_PAIR).cast("long"), merge(least)).otherwise(cells))

    def fold(ids: Column) -> Column:
        start = F.transform(ids, lambda a, i: cell_of(
            a.cast("long"), F.get(ids, i + 1), table) + F.shiftleft(i.cast("long"), ID_BITS))
        return F.aggregate(ids, start, step)

    return F.transform(let(sure_tokens(data, table), fold), lambda x: id_of(x).cast("int"))


def merged_together(data: Column, table: Column) -> Column:
    """As ``merged``, but a step merges the lowest pair in all its places, from the left.

    Pairs that a merge makes rank above it, so the result is that of merging place by place.
    Only a token that is ``alone`` can form a lower pair, with a neighbour or with itself:
    the first place where it does is the step's last. A step costs time with the word's
    length, and there are about as many as different merges: few for repeated letters.
    """
    def merge(cells: Column, least: Column) -> Column:
        token = rank_of(least)

        def mark(c: Column, i: Column) -> Column:
            def lower(a: Column, b: Column) -> Column:
                return rank_of(cell_of(a, b, table)) < token

            before, after = id_of(F.get(cells, i - 1)), id_of(F.get(cells, i + 2))
            last = F.get(table["alone"], token.cast("int")) & F.coalesce(
                lower(before, token) | lower(token, after) | lower(token, token), F.lit(False))
            return F.when(rank_of(c) != token, F.lit("0")).when(last, F.lit("2")).otherwise(
                F.lit("1"))

        def until_last(marks: Column) -> Column:
            taken = F.regexp_replace(marks, "([12]).", "$1x")  # x: merged into the one before
            end = F.instr(taken, "2")
            return F.when(end == 0, taken).otherwise(F.concat(
                F.substring(taken, F.lit(1), end + 1),
                F.translate(F.substring(marks, end + 2, F.length(marks)), "12", "00")))

        places = let(F.array_join(F.transform(cells, mark), ""), until_last)
        left = F.filter(F.zip_with(
            cells, F.split(places, "(?<=.)(?=.)"),
            lambda c, m: F.when(m == "0", id_of(c)).when(m == "x", F.lit(-1).cast("long"))
            .otherwise(token)), lambda x: x >= 0)
        return cells_of(left, table)

    def step(state: Column, _: Column) -> Column:
        cells = state["cells"]
        return F.when(state["done"], state).otherwise(let(F.array_min(cells), lambda least: F.when(
            least < F.lit(NO_PAIR).cast("long"),
            F.struct(merge(cells, least).alias("cells"), F.lit(False).alias("done")))
            .otherwise(F.struct(cells.alias("cells"), F.lit(True).alias("done")))))

    ids = F.transform(data, lambda code: F.get(table["single"], code).cast("long"))
    start = F.struct(cells_of(ids, table).alias("cells"), F.lit(False).alias("done"))
    # Two levels of steps, as many as letters at most: every step copies the state, also when
    # nothing is left to merge, and the outer fold then skips whole rounds of steps.
    steps = F.sequence(F.lit(1), F.ceil(F.sqrt(F.size(data))).cast("int"))
    end = F.aggregate(steps, start, lambda state, _: F.when(state["done"], state).otherwise(
        F.aggregate(steps, state, step)))
    return F.transform(end["cells"], lambda x: id_of(x).cast("int"))


def gather(starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of all elements of the chosen runs, one run after the other."""
    n = lengths[chosen]
    ends = np.cumsum(n)
    return np.repeat(starts[chosen] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


@dataclass(frozen=True)
class Known:
    """Words whose ids are known: the words one after the other, their lengths, their ids."""

    words: bytes
    sizes: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray

    def numbers(self) -> dict[bytes, int]:
        ends = np.cumsum(self.sizes)
        return {self.words[a:b]: i for i, (a, b) in enumerate(
            zip((ends - self.sizes).tolist(), ends.tolist(), strict=True))}


NOTHING = Known(b"", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"))


class Chunks(dict):
    """Numbers of chunks by key; ``number`` gives that of a key seen for the first time."""

    def __init__(self, number: Callable[[str], int]):
        self.number = number

    def __missing__(self, key: str) -> int:
        return self.setdefault(key, self.number(key))


class Words:
    """Numbers of distinct words, and chunks as such numbers in a row.

    ``known`` words have the first numbers; ``words`` are the others, after an empty one
    that marks the beginning.
    """

    def __init__(self, pattern: regex.Pattern, ranks: dict[bytes, int],
                 side_by_side: np.ndarray, known: dict[bytes, int]):
        self.pattern, self.side_by_side, self.known = pattern, side_by_side, known
        self.ranks, self.lengths = ranks, None
        self.letters_stay = pattern.pattern == PATTERN
        self.words = {b"": len(known)}
        self.sent = 0
        self.pieces, self.ends = array("i"), array("i")

    def _parts(self, word: str) -> list[bytes]:
        data = word.encode()
        if len(data) <= LONG_WORD:
            return [data]
        values = np.frombuffer(data, np.uint8)
        cuts = np.flatnonzero(~self.side_by_side[values[:-1], values[1:]]) + 1
        parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]
        if max(map(len, parts)) <= LONG_WORD:
            return parts
        if self.lengths is None:
            self.lengths = longest(self.ranks)
        return [p for part in parts for p in (
            uncrossed(part, self.ranks, self.lengths) if len(part) > LONG_WORD else [part])]

    def _number(self, word: bytes) -> int:
        number = self.known.get(word)
        if number is None:
            number = self.words.setdefault(word, len(self.known) + len(self.words))
        return number

    def chunk(self, text: str) -> int:
        number = self._number
        self.pieces.extend([number(part) for word in self.pattern.findall(text)
                            for part in self._parts(word)])
        self.ends.append(len(self.pieces))
        return len(self.ends) - 1

    def after_space(self, key: str) -> int:
        """PATTERN leaves a space and the letters after it together."""
        if not (self.letters_stay and len(key) < LONG_WORD and key.isascii() and key.isalpha()):
            return self.chunk(chunk_text(key))
        self.pieces.append(self._number(b" " + key.encode()))
        self.ends.append(len(self.pieces))
        return len(self.ends) - 1

    def new(self) -> list[bytes]:
        """The words since the last call."""
        new = list(islice(self.words, self.sent, None))
        self.sent = len(self.words)
        return new


class Block:
    """Each text as numbers of distinct chunks; these are kept when the texts are cleared."""

    def __init__(self, words: Words):
        # Words know nothing of what holds them: without a cycle both are freed at once.
        self.words = words
        self.after_space, self.alone = Chunks(words.after_space), Chunks(words.chunk)
        self.texts: list[np.ndarray] = []

    def add(self, text: str | None) -> None:
        """Null and empty texts have no chunk."""
        if not text:
            self.texts.append(np.zeros(0, np.int32))
            return
        first, keys = chunks(text)
        self.texts.append(np.array(
            [self.alone[first], *map(self.after_space.__getitem__, keys)], np.int32))

    def word_numbers(self) -> Iterator[np.ndarray]:
        """Each text as numbers of words."""
        flat, ends = np.array(self.words.pieces, np.int32), np.array(self.words.ends, np.int64)
        lengths = np.diff(ends, prepend=0)
        starts = ends - lengths
        for text in self.texts:
            yield flat[gather(starts, lengths, text)]


def sampled_words(docs: DataFrame, ranks: str, pattern: str, texts_in_sample: int,
                  max_known: int) -> DataFrame:
    """``word`` (its bytes as integers): those that occur most often, and at least twice,
    as distinct words of sampled texts."""
    share = min(1.0, texts_in_sample / max(docs.count(), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, tokens = regex.compile(pattern), load_ranks(ranks)
        table = joins(tokens)
        block, chars = Block(Words(compiled, tokens, table, {})), 0

        def counted() -> pa.RecordBatch:
            times = np.zeros(len(block.words.words), np.int64)
            for numbers in block.word_numbers():
                times[np.unique(numbers)] += 1
            some = [(word, n) for word, n in zip(block.words.words, times.tolist(), strict=True)
                    if 0 < len(word) <= LONG_WORD]
            return pa.RecordBatch.from_arrays(
                [pa.array([word for word, _ in some], pa.binary()),
                 pa.array([n for _, n in some], pa.int64())], names=["word", "times"])

        for batch in batches:
            for text in texts(batch.column("text")):
                if chars > BLOCK:
                    yield counted()
                    block, chars = Block(Words(compiled, tokens, table, {})), 0
                block.add(text)
                chars += len(text or "")
        yield counted()

    words = docs.select("text").sample(share, 1).mapInArrow(run, "word binary, times long")
    return words.groupBy("word").agg(F.sum("times").alias("count")).filter("count > 1").orderBy(
        F.desc("count"), "word").limit(max_known).select("word")


def known_words(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN,
                texts_in_sample: int = 10_000, max_known: int = 300_000) -> Known:
    """Ids of frequent words; at most ``max_known`` words of at most LONG_WORD bytes."""
    words = sampled_words(docs, ranks, pattern, texts_in_sample, max_known)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("word")
            yield pa.RecordBatch.from_arrays([column, codes(column.to_pylist())],
                                             names=["word", "data"])

    rows = stored(words, "frequent-words").repartition(32, "word").mapInArrow(
        coded, "word binary, data array<int>")
    table = _with_ids(rows, docs.sparkSession, ranks, "data", ["word"]).toArrow()
    words = table.column("word").to_pylist()
    ids = table.column("word_ids_").combine_chunks()
    return Known(b"".join(words), np.array([len(w) for w in words], np.int64),
                 pc.list_value_length(ids).to_numpy().astype(np.int64),
                 pc.list_flatten(ids).to_numpy().astype("<u4"))


def _with_ids(rows: DataFrame, spark: SparkSession, ranks: str, data: str,
              others: list[str]) -> DataFrame:
    """``others`` and ``word_ids_``, the ids of the words in ``data``; null for null."""
    table = rank_table(spark, ranks)
    rows = rows.withColumn("ranks_", F.struct(
        *(table.select(c).scalar().alias(c) for c in table.columns)))
    # Used once, and ``data`` is a plain column, so the optimizer puts the table's value here;
    # else every row would carry a copy of it.
    both = F.when(F.col(data).isNotNull(), F.struct(F.col(data).alias("data"), "ranks_"))
    return rows.select(*others, let(both, lambda w: F.when(
        F.size(w["data"]) > LONG_PART, merged_together(w["data"], w["ranks_"])).when(
        w.isNotNull(), merged(w["data"], w["ranks_"]))).alias("word_ids_"))


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN,
           known: Known = NOTHING) -> DataFrame:
    """``docs`` with ``ids`` in place of text, and ``id_bytes``, the same as little-endian
    unsigned 32-bit integers.

    Each match of ``pattern`` is encoded by itself, as the tiktoken library does;
    strings of special tokens are ordinary text. Null and empty texts have no ids;
    an empty table gives no rows. Columns other than text stay, but for these two
    and for names that end in an underscore.
    A single word that can be cut nowhere, such as one letter repeated, takes time with
    its length times the number of different merges in it.
    """
    others = [f for f in docs.schema if f.name not in ("text", "ids", "id_bytes")
              and not f.name.endswith("_")]
    names = [f.name for f in others]
    spark = docs.sparkSession
    arrow = spark.createDataFrame([], docs.select(*names).schema).toArrow().schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    leading = f"{fields}, " if fields else ""
    shared, key = spark.sparkContext.broadcast(known), uuid.uuid4().hex

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words that are new in a block, then its texts as numbers of words."""
        compiled, tokens = regex.compile(pattern), load_ranks(ranks)
        table = joins(tokens)
        numbers = held("known words", key, shared.value.numbers)
        schema = pa.schema([*arrow, pa.field("word_", pa.list_(pa.int32())),
                            pa.field("numbers_", pa.binary())])
        block, rows, chars = Block(Words(compiled, tokens, table, numbers)), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = block.words.new()
            for a in range(0, len(words), WORD_ROWS):
                part = words[a:a + WORD_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.nulls(len(part), f.type) for f in arrow), codes(part),
                     pa.nulls(len(part), pa.binary())], schema=schema)
            each = block.word_numbers()
            for row in rows:
                for a in range(0, row.num_rows, TEXT_ROWS):
                    some = row.slice(a, TEXT_ROWS)
                    values = [next(each).tobytes() for _ in range(some.num_rows)]
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.nulls(some.num_rows, pa.list_(pa.int32())),
                         pa.array(values, pa.binary())], schema=schema)
            block.texts.clear()

        for batch in batches:
            beside, start = batch.select(names), 0
            for i, text in enumerate(texts(batch.column("text"))):
                if chars and chars + len(text or "") > BLOCK:
                    rows.append(beside.slice(start, i - start))
                    yield from flush()
                    rows, chars, start = [], 0, i
                    if len(block.words.words) + len(block.words.ends) > KEPT:
                        block = Block(Words(compiled, tokens, table, numbers))
                block.add(text)
                chars += len(text or "")
            rows.append(beside.slice(start))
        yield from flush()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids of each text, from those of known words and of the words before it.

        An empty word comes first of those that a task begins anew with.
        """
        # A worker that split texts before drops the words' numbers here.
        first = held("known ids", key, lambda: (shared.value.lengths, shared.value.ids))
        parts, table = [first], None
        for batch in batches:
            is_word = batch.column("numbers_").is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
            for a, b in zip([0, *edges], [*edges, len(is_word)], strict=True):
                if a == b:
                    continue
                run = batch.slice(a, b - a)
                if is_word[a]:
                    lists = run.column("word_ids_")
                    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                    if not lengths[0]:
                        parts = [first]
                    parts.append((lengths, lists.flatten().to_numpy().astype("<u4")))
                    table = None
                    continue
                if table is None:
                    parts = [tuple(map(np.concatenate, zip(*parts, strict=True)))]
                    lengths, flat = parts[0]
                    table = np.cumsum(lengths) - lengths, lengths, flat
                starts, lengths, flat = table
                ids = [flat[gather(starts, lengths, np.frombuffer(n.as_py(), np.int32))]
                       for n in run.column("numbers_")]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*(run.column(c) for c in names), lists,
                     pa.array([i.tobytes() for i in ids], pa.binary())],
                    names=[*names, "ids", "id_bytes"])

    words = docs.select(*names, "text").mapInArrow(
        split, f"{leading}word_ array<int>, numbers_ binary")
    words = _with_ids(words, spark, ranks, "word_", [*names, "numbers_"])
    return words.mapInArrow(join, f"{leading}ids array<int>, id_bytes binary")


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``encoded`` with ``data``, the bytes of all its ``ids`` one piece after the other.

    No ids give no bytes. An id outside the vocabulary raises an error.
    """
    known = load_ranks(ranks)
    pieces = [None] * (max(known.values()) + 1)
    for piece, rank in known.items():
        pieces[rank] = piece
    # Pieces are joined as strings, which keeps every byte; most are not UTF-8 by themselves.
    table = encoded.sparkSession.createDataFrame(
        pa.table({"pieces": pa.array([pieces], pa.list_(pa.binary()))})).select(
        F.transform("pieces", lambda p: p.cast("string")).alias("pieces")).scalar()
    both = F.struct("ids", "pieces_")

    def joined(x: Column) -> Column:
        return F.array_join(F.transform(x["ids"], lambda i: F.coalesce(
            F.get(x["pieces_"], i), F.raise_error(F.lit("an id is not in the vocabulary")))),
            "").cast("binary")

    return encoded.withColumn("pieces_", table).select(
        *(c for c in encoded.columns if c != "data"), let(both, joined).alias("data"))


def op7_byte_bpe(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return decode(encode(docs, known=known_words(docs))).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("id_bytes", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))
