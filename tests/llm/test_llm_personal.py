import hashlib
import re
import time

import numpy as np
from carrymark.llm import personal
from carrymark.llm.personal import Model, find, learn, op6_personal_data, redact, spans
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import ROWS, empty, messy

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda m: True,
                    "ip": lambda m: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda m, d=digits: 14 <= len(d) <= 19 and luhn(d),
                    "phone": lambda m, d=digits: 10 <= len(d) <= 15}[kind](m)
            if good:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], personal.KINDS.index(s[0])))


@given(st.text(alphabet="a1@.-+ ()9 0%_é4", max_size=60))
@settings(max_examples=500, deadline=None)
def test_base_spans_are_those_of_the_plain_rules(text):
    assert [s[:3] for s in spans(text, Model())] == plain(text)


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("1" * 500_000, "a" * 500_000 + "@", "1.1." * 100_000, "+1" + " " * 500_000,
                 "at (" * 100_000, "1 " * 200_000, "a@b.c " * 20_000):
        spans(text, Model())
    assert time.time() - start < 30


def test_expectation_maximisation_finds_the_good_labelers():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.4
    right = [0.95, 0.9, 0.55]
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) for p in right], axis=1) * 2 - 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    likely, table = personal.reliabilities(patterns, counts.astype(float))
    accuracy = [(table[k, 1, 2] + table[k, 0, 0]) / 2 for k in range(3)]
    assert accuracy[0] > 0.85 and accuracy[1] > 0.8 and accuracy[2] < 0.65
    both_good = {tuple(p): x for p, x in zip(patterns, likely, strict=True)}
    assert both_good[1, 1, -1] > 0.9 and both_good[-1, -1, 1] < 0.1


def test_spans_are_added_and_base_spans_stay(spark):
    texts = [f"call {200 + i}-555-{1000 + i:04d} or write to u{i}@mail.example.com" for i in range(60)]
    texts += [f"contact +1 (2{i:02d}) 555-{1000 + i} today" for i in range(60)]
    texts += [f"version {i}.0.0.1 build 999.{i}.3.4 serial 123456789012{i:04d}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in find(docs, learn(docs)).collect()}
    for i, text in enumerate(texts):
        base = [(s.kind, s.start, s.end) for s in rows[i] if s.base]
        assert base == plain(text)
        taken = sorted((s.start, s.end) for s in rows[i] if not s.base)
        assert all(a[1] <= b[0] for a, b in zip(taken, taken[1:], strict=False))
    assert sum(any(not s.base and s.kind == "phone" for s in rows[i]) for i in range(60)) > 50
    assert not any(s.kind == "card" for i in range(120, 180) for s in rows[i] if not s.base)


def test_documents_of_every_kind(spark):
    rows = op6_personal_data(messy(spark)).collect()
    assert len(rows) == len(ROWS)
    want = sorted(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in plain(r[1])).encode())
                  .hexdigest() for r in ROWS)
    assert sorted(r.base_sha256 for r in rows) == want
    ten = next(r for r in rows if r.doc_id == 10)
    assert (ten.n_email, ten.n_ip, ten.n_card, ten.n_phone) == (1, 1, 1, 1)
    assert op6_personal_data(empty(spark)).count() == 0


def test_redaction(spark):
    model = learn(messy(spark))
    out = redact(messy(spark), model)
    assert out.columns == messy(spark).columns
    ten = out.filter("doc_id = 10").first()
    assert "<EMAIL>" in ten.text and "<IP>" in ten.text and "4111" not in ten.text
    assert out.filter("text is null").count() == 1
    assert out.filter("doc_id = 1").first().text == ROWS[0][1]
