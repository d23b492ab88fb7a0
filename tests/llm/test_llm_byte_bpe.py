import base64
import hashlib

import numpy as np
import pytest
import tiktoken
from carrymark.llm import byte_bpe
from carrymark.llm.byte_bpe import PATTERN, RANKS, decode, encode, known_words, load_ranks
from messy import ROWS, empty, messy

LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_ranks(RANKS),
                            special_tokens={})
TEXTS = [None, "", "a", " ", "  ", "a  b\n\n c ", "x" * 300, "qzxjvkw" * 200, "日本語テキスト" * 30,
         "<|endoftext|>", "it's we'll don't 'S", "1 22 333", "́a \x00", "é  z",
         "The the THE ther then there. Other others", "a\tb\r\nc", "!!! ??? ... --- 'tis"]


def encoded(spark, texts, known):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    known = known_words(docs) if known else byte_bpe.NOTHING
    return decode(encode(docs, known=known)).collect()


@pytest.mark.parametrize("known", [False, True])
def test_ids_are_those_of_the_library(spark, known):
    texts = TEXTS + [t for t in TEXTS if t] * 2
    for r in encoded(spark, texts, known):
        text = texts[r.doc_id] or ""
        assert list(r.ids) == LIBRARY.encode_ordinary(text), text[:40]
        assert np.frombuffer(r.id_bytes, "<u4").tolist() == list(r.ids)
        assert bytes(r.data) == text.encode()


def test_blocks_of_few_texts(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 20)
    monkeypatch.setattr(byte_bpe, "WORD_ROWS", 3)
    for r in encoded(spark, TEXTS, False):
        assert list(r.ids) == LIBRARY.encode_ordinary(TEXTS[r.doc_id] or "")


LONG = ["a" * 100_000, " " * 5_000, "the" * 3_000, "=-" * 2_000 + "=" * 700, "日本" * 900,
        "abab" * 300 + "ba" * 500, "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(4_000)),
        "-" * 1_001, "aab" * 701, "x\n" * 600, "É" * 1_500]


def test_long_words_that_can_be_cut_nowhere(spark):
    for r in encoded(spark, LONG, False):
        assert list(r.ids) == LIBRARY.encode_ordinary(LONG[r.doc_id]), LONG[r.doc_id][:20]
        assert bytes(r.data) == LONG[r.doc_id].encode()


def test_merging_together_equals_place_by_place(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG_WORD", 3)
    monkeypatch.setattr(byte_bpe, "LONG_PART", 2)
    for r in encoded(spark, TEXTS, False):
        assert list(r.ids) == LIBRARY.encode_ordinary(TEXTS[r.doc_id] or "")


def test_pairs_below_their_token_come_before_its_other_places(spark, tmp_path):
    # z + bc is merged right after the first bc, and takes the z away from zz.
    ranks = {bytes([b]): b for b in range(256)} | {b"bcz": 256, b"bc": 257, b"czz": 258, b"zz": 259}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    own = tiktoken.Encoding("alone", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["bczbcbczz" * 100, "bcbcz" * 200, "zzbczz" * 150]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = byte_bpe.rank_table(spark, str(path)).first()
    assert [i for i, x in enumerate(table.alone) if x] == [257, 259]
    for r in encode(docs, ranks=str(path)).collect():
        assert list(r.ids) == own.encode_ordinary(texts[r.doc_id])


def test_cuts_that_no_token_crosses():
    ranks = load_ranks(RANKS)
    lengths = byte_bpe.longest(ranks)
    for text in TEXTS[1:] + ["antidisestablishmentarianism" * 5, "日本語" * 40, "zqxjkvb" * 30]:
        data = (text or "").encode()
        cuts = [p for p in range(1, len(data)) if not any(
            data[a:b] in ranks for a in range(max(0, p - 130), p)
            for b in range(p + 1, min(len(data), a + 130) + 1))]
        want = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]
        assert byte_bpe.uncrossed(data, ranks, lengths) == want


def test_documents_of_every_kind(spark):
    rows = byte_bpe.op7_byte_bpe(messy(spark)).collect()
    want = []
    for r in ROWS:
        ids = LIBRARY.encode_ordinary(r[1] or "")
        want.append((r[0] or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes())
                     .hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in rows) == sorted(want)
    kept = encode(messy(spark))
    assert "score" in kept.columns and kept.filter("score = 'own score'").count() == len(ROWS)


def test_empty_table_and_foreign_ids(spark):
    assert byte_bpe.op7_byte_bpe(empty(spark)).count() == 0
    bad = spark.createDataFrame([([1, 10**7],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode(bad).collect()


def test_words_are_sent_once_while_they_are_kept(spark, monkeypatch):
    sent, with_ids = [], byte_bpe._with_ids

    def watched(rows, *args):
        sent.append(rows.filter("size(word_) > 0").count())
        return with_ids(rows, *args)

    monkeypatch.setattr(byte_bpe, "_with_ids", watched)
    monkeypatch.setattr(byte_bpe, "BLOCK", 10)
    texts = ["one two three", "two three four", "", "one two three", None, "four  five"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for kept in (1_000, 4):
        monkeypatch.setattr(byte_bpe, "KEPT", kept)
        for r in encode(docs).collect():
            assert list(r.ids) == LIBRARY.encode_ordinary(texts[r.doc_id] or "")
    # one, two, _two, _three, _four, four, _five and a space; with four kept, more often
    assert sent[0] == 8 < sent[1]


def test_no_row_of_known_words_carries_the_ranks(spark, monkeypatch):
    plans, with_ids = [], byte_bpe._with_ids

    def watched(*args):
        found = with_ids(*args)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(byte_bpe, "_with_ids", watched)
    texts = ["some words are there", "some words are here", "é some"]
    known = known_words(spark.createDataFrame([(t,) for t in texts], "text string"))
    for word, number in known.numbers().items():
        a, n = known.lengths[:number].sum(), known.lengths[number]
        assert known.ids[a:a + n].tolist() == LIBRARY.encode_ordinary(word.decode())
    assert sorted(known.numbers()) == [b" are", b" words", b"some"]
    assert " AS ranks_#" not in plans[0]


@pytest.mark.parametrize("seed", range(3))
def test_certain_merges_change_no_ids(spark, tmp_path, seed):
    # Ranks in any order, so that many tokens form pairs below their own rank.
    draw = np.random.default_rng(seed)
    tokens = {bytes([b]) for b in range(256)}
    letters = [b"a", b"b", b"c", b"d"]
    for _ in range(40):
        some = sorted(t for t in tokens if set(t) <= set(b"abcd"))
        tokens.add(some[draw.integers(len(some))] + some[draw.integers(len(some))])
    longer = [t for t in tokens if len(t) > 1]
    draw.shuffle(longer)
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(longer)}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    own = tiktoken.Encoding(f"own{seed}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["".join(letters[i].decode() for i in draw.integers(4, size=n))
             for n in draw.integers(1, 40, size=400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in encode(docs, ranks=str(path)).collect():
        # The library takes a word that is a token as it is, whatever its merges give.
        if texts[r.doc_id].encode() not in ranks:
            assert list(r.ids) == own.encode_ordinary(texts[r.doc_id]), texts[r.doc_id]
