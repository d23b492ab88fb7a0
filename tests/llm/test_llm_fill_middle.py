import hashlib
from collections import Counter

import numpy as np
import pytest
from carrymark.llm import fill_middle
from carrymark.llm.fill_middle import fill_in_middle, op13_fill_middle, rearrange, restore, restored
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import ROWS, empty, messy
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"
PIECES = st.lists(st.sampled_from(["<", "P>", "<S", "<P", ">", "M", "é", "日", "😀", "a", "<M>"]),
                  max_size=6).map("".join)


def plain(doc, text):
    """The row of one document, by slices of the string."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, len(text), "plain", None, None, text
    prefix, middle, suffix = f"<P>{text[:a]}", f"<M>{text[a:b]}", f"<S>{text[b:]}"
    spm = h[3] % 100 < 20
    return (doc, len(text), "spm" if spm else "psm", a, b - a,
            (suffix + prefix if spm else prefix + suffix) + middle)


@given(st.lists(st.tuples(PIECES, st.integers(0, 9), st.integers(0, 9), st.integers(0, 2)),
                min_size=1, max_size=8))
@settings(max_examples=500, deadline=None)
def test_batches_are_rearranged_and_restored(items):
    texts, bounds, cuts, forms, want = [], [0], [], [], []
    for text, a, b, form in items:
        data = text.encode()
        a, b = sorted((a % (len(data) + 1), b % (len(data) + 1)))
        form = 0 if any(m in data for m in fill_middle.MARKS) else form
        p, m, s = data[:a], data[a:b], data[b:]
        want.append([data, b"<P>" + p + b"<S>" + s + b"<M>" + m,
                     b"<S>" + s + b"<P>" + p + b"<M>" + m][form])
        cuts.append((bounds[-1] + a, bounds[-1] + b))
        texts.append(data)
        forms.append(form)
        bounds.append(bounds[-1] + len(data))
    data = np.frombuffer(b"".join(texts), np.uint8)
    cuts, forms, bounds = np.array(cuts), np.array(forms), np.array(bounds)
    out, out_bounds = rearrange(data, bounds, cuts[:, 0], cuts[:, 1], forms)
    assert [out[a:b].tobytes() for a, b in zip(out_bounds, out_bounds[1:])] == want
    back, back_bounds = restore(out, out_bounds, forms)
    assert back.tobytes() == data.tobytes() and back_bounds.tolist() == bounds.tolist()


def many():
    texts = ["", None, "a", "<P>", "x<S>y", "no mark <P", ">", "é日😀" * 50, "plain words " * 400,
             "<", "P>", "ends with <", "M> begins"]
    return [(i, texts[i % len(texts)]) for i in range(400)]


@pytest.mark.parametrize("block", [1 << 22, 64])
def test_equals_slices_of_strings(spark, monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    rows = many()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = fill_in_middle(docs)
    assert Counter(tuple(r) for r in got.collect()) == Counter(plain(*r) for r in rows)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    back = Counter((r.doc_id, r.text) for r in restored(got).collect())
    assert back == Counter((i, t or "") for i, t in rows)


def test_disorder(spark):
    docs = messy(spark).withColumns({c: F.lit(c) for c in ("n", "form", "output", "prefix_chars")})
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((*plain(r[0], r[1])[:5], sha(plain(r[0], r[1])[5]), sha(r[1] or ""))
                   for r in ROWS)
    assert Counter(tuple(r) for r in op13_fill_middle(docs).collect()) == want
    assert op13_fill_middle(empty(spark)).count() == 0
