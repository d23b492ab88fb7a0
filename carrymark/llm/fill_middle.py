"""Operator 13: fill-in-middle by displacement scatter.

A text becomes ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm), or suffix first (spm),
or stays plain. Whole Arrow batches are rearranged at once: the cuts are scanned as
byte positions, a difference array holds by how much the displacement of a byte differs
from that of the byte before it, its cumulative sum gives every byte its place in the
output, and one numpy scatter writes them. The inverse finds the marks in the output,
rebuilds the displacements from them alone, and gathers the bytes back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
#: Bytes that are rearranged at once; a longer text makes a block of its own.
BLOCK = 1 << 22


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers fixed by the id; a null id draws as an empty one."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def _placed(starts: np.ndarray, ends: np.ndarray, places: np.ndarray, total: int) -> np.ndarray:
    """Output position of each of ``total`` bytes, whose segments go to ``places``.

    The segments [starts, ends) follow one another and cover all bytes; empty ones
    carry no byte, and the difference of the next one counts from the last that did.
    """
    some = ends > starts
    shift = (places - starts)[some]
    differences = np.zeros(total, np.int64)
    differences[starts[some]] = np.diff(shift, prepend=0)
    return np.cumsum(differences) + np.arange(total)


def _segments(bounds: np.ndarray, cut1: np.ndarray, cut2: np.ndarray):
    """Starts and ends of prefix, middle, suffix of each text, in the order of the bytes."""
    starts = np.stack([bounds[:-1], cut1, cut2], axis=1)
    ends = np.stack([cut1, cut2, bounds[1:]], axis=1)
    return starts, ends


def _marks(data: np.ndarray, bounds: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where a mark begins and in which text; what two texts only make together is none."""
    hits = (data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])
    at = np.flatnonzero(hits)
    row = np.searchsorted(bounds, at, "right") - 1
    inside = at + 3 <= bounds[row + 1]
    return at[inside], row[inside]


def rearrange(data: np.ndarray, bounds: np.ndarray, cut1: np.ndarray, cut2: np.ndarray,
              forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes and their bounds for texts that lie one after another in ``data``.

    ``cut1`` and ``cut2`` are byte positions in ``data``; those of plain texts are not used.
    """
    moved = forms != PLAIN
    cut1, cut2 = np.where(moved, cut1, bounds[1:]), np.where(moved, cut2, bounds[1:])
    starts, ends = _segments(bounds, cut1, cut2)
    prefix, middle, suffix = (ends - starts).T
    out_bounds = np.concatenate([[0], np.cumsum(np.diff(bounds) + 9 * moved)])
    begin, spm = out_bounds[:-1], forms == SPM
    # Where the marks stand; the segment that each announces follows it.
    mark_p = np.where(spm, begin + 3 + suffix, begin)
    mark_s = np.where(spm, begin, begin + 3 + prefix)
    mark_m = begin + 6 + prefix + suffix
    places = np.stack([mark_p + 3, mark_m + 3, mark_s + 3], axis=1)
    places[~moved, 0] = begin[~moved]
    out = np.empty(out_bounds[-1], np.uint8)
    out[_placed(starts.ravel(), ends.ravel(), places.ravel(), len(data))] = data
    for mark, at in zip(MARKS, (mark_p, mark_s, mark_m), strict=True):
        for k, byte in enumerate(mark):
            out[at[moved] + k] = byte
    return out, out_bounds


def restore(out: np.ndarray, out_bounds: np.ndarray,
            forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts and their bounds, from outputs and forms alone."""
    moved, begin = forms != PLAIN, out_bounds[:-1]
    marks = []
    for mark in MARKS:
        found, row = _marks(out, out_bounds, mark)
        at = begin.copy()
        at[moved] = found[moved[row]]       # a text that is not plain has one of each
        marks.append(at)
    mark_p, mark_s, mark_m = marks
    psm = forms == PSM
    prefix = np.where(moved, np.where(psm, mark_s, mark_m) - mark_p - 3, np.diff(out_bounds))
    suffix = np.where(moved, np.where(psm, mark_m, mark_p) - mark_s - 3, 0)
    middle = np.where(moved, out_bounds[1:] - mark_m - 3, 0)
    bounds = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    starts, ends = _segments(bounds, bounds[:-1] + prefix, bounds[:-1] + prefix + middle)
    places = np.stack([mark_p + 3, mark_m + 3, mark_s + 3], axis=1)
    places[~moved, 0] = begin[~moved]
    return out[_placed(starts.ravel(), ends.ravel(), places.ravel(), bounds[-1])], bounds


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column without nulls."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)),
        pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def _blocks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most BLOCK bytes, or of one row."""
    sizes = np.diff(_bytes_of(column)[1])
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > BLOCK:
            yield first, i
            first, held = i, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes)


def cut(data: np.ndarray, bounds: np.ndarray, ids: list, plain_percent: int, spm_percent: int):
    """Code points, form and the two cuts (code points and byte positions) of each text."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)      # byte positions of code points
    before = np.searchsorted(lead, bounds)            # code points before each text
    n = np.diff(before)
    h = np.array([draws(i) for i in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(h[:, :2] % (n[:, None] + 1), axis=1)
    marked = np.zeros(len(n), bool)
    for mark in MARKS:
        marked[_marks(data, bounds, mark)[1]] = True
    forms = np.where(h[:, 3] % 100 < spm_percent, SPM, PSM)
    forms[(n == 0) | marked | (h[:, 2] % 100 >= 100 - plain_percent)] = PLAIN
    where = np.append(lead, len(data))[before[:-1, None] + cuts]
    return n, forms, cuts, where


def fill_in_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars and output of each document.

    A document's id draws its two cuts and its form. A text stays plain if it is empty
    (null counts as empty), holds one of the marks, or by ``plain_percent``; of the others
    ``spm_percent`` have the suffix first. prefix_chars and middle_chars are null if plain.
    A null id draws as an empty one. Repeated rows give equal rows; other columns of
    ``docs`` are neither used nor returned. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in _blocks(batch.column("text")):
                part = batch.slice(first, last - first)
                data, bounds = _bytes_of(part.column("text"))
                n, forms, cuts, where = cut(data, bounds, part.column("doc_id").to_pylist(),
                                            plain_percent, spm_percent)
                out = rearrange(data, bounds, where[:, 0], where[:, 1], forms)
                none = forms == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()),
                     pa.array([FORMS[f] for f in forms], pa.string()),
                     pa.array(cuts[:, 0], pa.int64(), mask=none),
                     pa.array(cuts[:, 1] - cuts[:, 0], pa.int64(), mask=none), _strings(*out)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
             "output string")


def restored(rows: DataFrame) -> DataFrame:
    """``rows`` with column text, rebuilt from their ``output`` and ``form`` alone."""
    others = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in _blocks(batch.column("output")):
                part = batch.slice(first, last - first)
                forms = np.array([FORMS.index(f) for f in part.column("form").to_pylist()])
                texts = _strings(*restore(*_bytes_of(part.column("output")), forms))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + [texts],
                                                 names=[*others, "text"])

    return rows.select(*others).mapInArrow(
        run, rows.select(*others, F.lit("").alias("text")).schema)


def op13_fill_middle(docs: DataFrame) -> DataFrame:
    """Every document rearranged and restored, with the digests of both."""
    digest = {f"{to}_sha256": F.sha2(F.col(c).cast("binary"), 256)
              for to, c in (("output", "output"), ("restored", "text"))}
    return restored(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        *(value.alias(name) for name, value in digest.items()))
