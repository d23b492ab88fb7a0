import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from carrymark.llm import packing
from carrymark.llm.common import stored
from carrymark.llm.tokens import BYTE_BPE, WORD_BPE, Encoder
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import ROWS, empty, messy
from tokenizers import Tokenizer

ENCODERS = {path: Encoder(path) for path in (BYTE_BPE, WORD_BPE)}
ALPHABET = st.sampled_from(" \n\t.,'s!aA1é́ ßΣ日 \x1c|&<|endoftext|>")


def whole(path, text):
    tokenizer = ENCODERS[path].tokenizer
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.one_of(ALPHABET, st.characters(codec="utf-8")), max_size=40).map("".join))
@settings(max_examples=400, deadline=None)
def test_chunks_give_the_ids_of_the_whole_text(text):
    for path, encoder in ENCODERS.items():
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(path, text)


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=6), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_fullest_completion_against_all_choices(counts, room):
    items = [x for x, n in counts.items() for _ in range(n)]
    best = max(sum(c) for k in range(len(items) + 1) for c in combinations(items, k)
               if sum(c) <= room)
    chosen = packing.fullest(counts, room)
    assert sum(chosen) == best
    assert all(chosen.count(x) <= counts[x] for x in chosen)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
@settings(max_examples=60, deadline=None)
def test_plan_uses_every_piece_once(counts):
    patterns = packing.plan(counts, 64)
    used = {}
    for p in patterns:
        assert sum(p.lengths) <= 64
        for x in p.lengths:
            used[x] = used.get(x, 0) + p.times
    assert used == counts
    assert len(patterns) <= 64 * 10


def test_few_sequences():
    rng = random.Random(1)
    counts = {}
    for _ in range(20_000):
        x = rng.randint(1, 1024)
        counts[x] = counts.get(x, 0) + 1
    least = -(-sum(x * n for x, n in counts.items()) // 1024)
    assert sum(p.times for p in packing.plan(counts)) <= least * 1.01


def check_packed(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_documents_of_every_kind_round_trip(spark):
    capacity = 64
    pieces = stored(packing.cut(messy(spark), capacity=capacity, with_ids=True), "pieces")
    placed = stored(packing.pack(pieces, capacity, rows_per_bucket=50), "placed")
    rows = placed.collect()
    check_packed(rows, capacity)
    assert all(r.digest == "own digest" for r in rows)
    want = sorted((r[0] or 0, tuple(whole(BYTE_BPE, r[1]) + [2])) for r in ROWS)
    got, open_ = [], {}
    for r in sorted(rows, key=lambda r: (r.doc_id or 0, r.piece)):
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length * 4 == len(r.ids)
        assert r.piece == 0 or r.length == capacity
        if (r.doc_id or 0) not in (0, 7):
            open_.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    got = sorted((k, tuple(v)) for k, v in open_.items())
    assert got == [w for w in want if w[0] not in (0, 7)]
    full = packing.sequences(placed).collect()
    by_place = {(r.sequence_id, r.offset): bytes(r.ids) for r in rows}
    for s in full:
        joined = b"".join(by_place[s.sequence_id, p.offset] for p in s.parts)
        assert bytes(s.ids) == joined and len(joined) <= 4 * capacity


def test_query(spark):
    rows = packing.op5_best_fit_packing(messy(spark)).collect()
    check_packed(rows, 1024)
    tokens = {r[0]: len(whole(BYTE_BPE, r[1])) + 1 for r in ROWS}
    mine = [r for r in rows if r.doc_id == 6]
    assert sum(r.length for r in mine) == tokens[6] and len(mine) == -(-tokens[6] // 1024)
    assert sorted(r.start for r in mine)[1] == tokens[6] % 1024
    assert packing.op5_best_fit_packing(empty(spark)).count() == 0


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_new_texts_are_cut_into_chunks_once(path, monkeypatch):
    encoder, cut_texts = Encoder(path), []
    parts = encoder._parts
    monkeypatch.setattr(encoder, "_parts", lambda text: cut_texts.append(text) or parts(text))
    found = ["Some new words, (and) marks!\nin  two lines", "and once more: words", None, ""]
    ids = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(found)]
    assert ids == [whole(path, text) for text in found]
    assert cut_texts == found[:2]
    assert encoder.encode(found[0]) and len(cut_texts) == 3


def test_blocks_of_texts_are_small():
    read = []
    texts = (read.append(i) or f"text {i} " + "word " * 1000 for i in range(5))
    next(ENCODERS[BYTE_BPE].encode_all(texts))
    assert read == [0]
