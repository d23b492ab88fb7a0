"""Operator 1: language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram
is its letters' vectors, permuted by their place and bound by multiplication; a
text is the bundle (sum) of its n-grams, a language the bundle of its documents.
The nearest language by cosine wins. Languages are learned from every training
document, as sums that Spark adds up, so only one vector for each language comes
to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrymark.llm.common import crc32_of_id, texts
from carrymark.llm.mphash import mix

DIMENSIONS = 1024
SEED = 7
UNKNOWN = "und"
#: Characters of a text that are handled at once, and texts in a group.
SEGMENT = 1 << 19
GROUP = 256
#: Cells of the group's table of n-gram counts.
CELLS = 1 << 22
CODES = 0x110000


class Letters:
    """Letters seen by this worker: their numbers, and their vectors for each place.

    Number 0 is everything that is not a letter, so words' edges count in n-grams.
    """

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(CODES)), bool, CODES)
        self.number = np.zeros(CODES, np.int32)
        self.places = [np.zeros((0, dimensions), np.int8)] * 3
        self._add(np.array([0]))

    def _add(self, codes: np.ndarray) -> None:
        words = self.dimensions // 64
        at = np.arange(words, dtype=np.uint64) + codes.astype(np.uint64)[:, None] * np.uint64(words)
        bits = np.unpackbits(mix(at.ravel(), SEED).view(np.uint8)).reshape(len(codes), -1)
        base = (2 * bits.astype(np.int8) - 1).astype(np.int8)
        known = len(self.places[0])
        self.number[codes] = np.arange(known, known + len(codes))
        self.places = [np.concatenate([old, np.roll(base, 2 - k, axis=1)])
                       for k, old in enumerate(self.places)]

    def numbers(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each character's number, and the places of the letters."""
        letter = self.is_letter[codes]
        codes = np.where(letter, codes, 0)
        numbers = self.number[codes]
        new = np.unique(codes[letter & (numbers == 0)])
        if len(new):
            self._add(new)
            numbers = self.number[codes]
        return numbers.astype(np.int64), np.flatnonzero(letter)

    def vectors(self, grams: np.ndarray, base: int) -> np.ndarray:
        """The vectors of 3-grams given as numbers in a base."""
        a, b, c = grams // base // base, grams // base % base, grams % base
        return self.places[0][a] * self.places[1][b] * self.places[2][c]


_LETTERS: list[Letters] = []


def letters() -> Letters:
    if not _LETTERS:
        _LETTERS.append(Letters())
    return _LETTERS[0]


def bundles(parts: list[tuple[int, str]], count: int) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of each of ``count`` rows, and its number of n-grams.

    ``parts``: row, and a stretch of its text with the character before and after it
    (any non-letter at the ends of the text). Every letter is the middle of one
    3-gram; what is no letter counts as 0. Sums are exact.
    """
    store = letters()
    codes = np.frombuffer("".join(p for _, p in parts).encode("utf-32-le", "surrogatepass"),
                          np.uint32)
    lengths = np.array([len(p) for _, p in parts])
    row = np.repeat(np.array([r for r, _ in parts]), lengths)
    numbers, middle = store.numbers(codes)
    edge = np.zeros(len(codes), bool)
    ends = np.cumsum(lengths)
    edge[ends - lengths] = edge[ends - 1] = True
    middle = middle[~edge[middle]]
    base = len(store.places[0])
    grams = (numbers[middle - 1] * base + numbers[middle]) * base + numbers[middle + 1]
    row = row[middle]
    if base ** 3 <= CELLS:
        seen = np.zeros(base ** 3, bool)
        seen[grams] = True
        distinct = np.flatnonzero(seen)
        place = (np.cumsum(seen) - 1)[grams]
    else:
        distinct, place = np.unique(grams, return_inverse=True)
    total = np.zeros((count, store.dimensions), np.float32)
    step = min(max(CELLS // count, 1), 8192)
    for at in range(0, len(distinct), step):
        width = min(step, len(distinct) - at)
        here = (place >= at) & (place < at + width)
        counts = np.bincount(row[here] * width + place[here] - at, minlength=count * width)
        total += counts.reshape(count, width).astype(np.float32) @ store.vectors(
            distinct[at:at + width], base).astype(np.float32)
    return total, np.bincount(row, minlength=count)


def grouped(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, lower-cased texts) in groups of bounded size; null is empty."""
    first, held, size = 0, [], 0
    for text in texts(column):
        text = (text or "").lower()
        if held and (len(held) == GROUP or size + len(text) > SEGMENT):
            yield first, held
            first, held, size = first + len(held), [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def profile(group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundles of a group of texts in 64-bit floats, and their numbers of n-grams."""
    total = np.zeros((len(group), DIMENSIONS))
    grams = np.zeros(len(group), np.int64)

    def add(parts: list[tuple[int, str]]) -> None:
        more, n = bundles(parts, len(group))
        total[:] += more
        grams[:] += n

    if sum(map(len, group)) <= SEGMENT:
        add([(row, f"\0{text}\0") for row, text in enumerate(group)])
        return total, grams
    for row, text in enumerate(group):
        text = f"\0{text}\0"
        for start in range(0, len(text) - 2, SEGMENT):
            add([(row, text[start:start + SEGMENT + 2])])
    return total, grams


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    vectors: np.ndarray  # one row of unit length for each language


def learn(training: DataFrame, max_languages: int = 512) -> Profiles:
    """Profiles of the languages of ``training`` (lang, text), nulls left out.

    ``max_languages`` bounds the model: the most frequent values are languages.
    """
    training = training.filter("lang is not null and text is not null").select("lang", "text")
    kept = sorted(r.lang for r in training.groupBy("lang").count().orderBy(
        F.desc("count"), "lang").limit(max_languages).collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(kept), DIMENSIONS))
        number = {lang: i for i, lang in enumerate(kept)}
        for batch in batches:
            langs = [number.get(x, -1) for x in batch.column("lang").to_pylist()]
            for first, group in grouped(batch.column("text")):
                mine = np.array(langs[first:first + len(group)])
                total, _ = profile(group)
                np.add.at(sums, mine[mine >= 0], total[mine >= 0])
        lang, at = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(at, pa.int32()), pa.array(sums[lang, at])],
            names=["lang", "at", "value"])

    sums = np.zeros((len(kept), DIMENSIONS))
    added = training.mapInArrow(run, "lang int, at int, value double").groupBy("lang", "at").agg(
        F.sum("value").alias("value"))
    for r in added.collect():  # one number for each language and dimension
        sums[r.lang, r.at] = r.value
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    return Profiles(kept, sums / np.where(size > 0, size, 1))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and its cosine as ``score`` (0 to 1) in place of text.

    A null text, one without letters, and any text when nothing was learned, is
    ``und`` with score 0. Of languages that are equally near, the first by name. An
    empty table gives no rows; columns other than text stay, but for these two.
    """
    others = [f for f in docs.schema if f.name not in ("text", "lang_pred", "score")]
    names = [f.name for f in others]
    known = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, vectors = known.value.languages, known.value.vectors
        for batch in batches:
            found, score = [], []
            for _, group in grouped(batch.column("text")):
                total, grams = profile(group)
                if not languages:
                    grams[:] = 0
                    near = np.zeros((len(group), 1))
                else:
                    size = np.linalg.norm(total, axis=1, keepdims=True)
                    near = total @ vectors.T / np.where(size > 0, size, 1)
                best = near.argmax(axis=1)
                value = np.clip(near[np.arange(len(group)), best], 0, 1)
                found += [languages[b] if n else UNKNOWN
                          for b, n in zip(best.tolist(), grams.tolist(), strict=True)]
                score += np.where(grams > 0, value, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, pa.string()),
                 pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in others]
    return docs.select(*names, "text").mapInArrow(
        run, ", ".join([*fields, "lang_pred string", "score double"]))


def op1_language_id(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(crc32_of_id() % 3 == 1, F.lit(False)))
    profiles = learn(docs.filter(~F.col("held_out")))
    return identify(docs.drop("lang"), profiles).select(
        "doc_id", "held_out", "lang_pred", "score")
