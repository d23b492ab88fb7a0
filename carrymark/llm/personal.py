"""Operator 6: personal data by weak supervision.

Wide patterns propose candidate spans. Labelers of three sorts (regular
expressions with their checks, gazetteers, words of the context) vote on each
candidate: personal, not personal, or nothing. Expectation-maximisation over the
counts of vote patterns, which Spark gathers from all candidates, estimates how
reliable each labeler is and so how likely each pattern is personal. A logistic
span classifier learns those likelihoods from the votes and the span's shape, on a
bounded sample, and decides which spans are added to those of the base rules.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrymark.llm.common import bounded_sample, stored, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban", "ipv6")

EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A run of digits is entered at its start only: a match from within it would also be
# one from there. So each pattern reads a text once, however long its runs are.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Wider patterns, tried on each text; possessive, and not entered within a run.
WIDE = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}+\s?[\[(]\s?at\s?[\])]\s?[\w-]{1,63}+"
                        r"(?:\s?[\[(]\s?dot\s?[\])]\s?[\w-]{1,63}+|\.[\w-]{1,63}+)+", re.I),
    "phone": re.compile(r"(?<![\w+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
                       r"(?!\w)"),
    "ipv6": re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])"),
}

# Gazetteers and words of the context.
TOP_DOMAINS = frozenset("com org net edu gov io de fr es uk eu info biz me us ca".split())
MAIL_WORDS = frozenset("mail email gmail yahoo hotmail outlook proton gmx web icloud inbox".split())
COUNTRIES = frozenset("AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LI LT LU LV MC MT "
                      "NL NO PL PT RO SE SI SK SM".split())
CARD_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
PERSONAL_WORDS = re.compile(
    r"\b(?:e-?mail|mail|contact|call|phone|tel|telephone|mobile|fax|card|visa|credit|account|"
    r"iban|ssn|social|ip|address|from|reach|write|anruf|telefon|karte|konto|correo|carte|compte)"
    r"\b\W{0,4}(?:\w+\W+){0,2}$", re.I)
OTHER_WORDS = re.compile(
    r"(?:\b(?:version|isbn|issn|doi|token|key|secret|sha|hash|commit|build|order|invoice|serial|"
    r"page|chapter|section|model)\b\W{0,5}(?:\w+\W+){0,1}|[#$€£=/\\])$", re.I)
BEFORE = 48


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def good_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
               for p in text.split("."))


def good_card(text: str) -> bool:
    digits = digits_of(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def good_phone(text: str) -> bool:
    return 10 <= len(digits_of(text)) <= 15


def good_ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def good_iban(text: str) -> bool:
    code = text.replace(" ", "")
    moved = code[4:] + code[:4]
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


CHECKS: dict[str, Callable[[str], bool]] = {
    "email": lambda t: True, "ip": good_ip, "card": good_card, "phone": good_phone,
    "ssn": good_ssn, "iban": good_iban, "ipv6": lambda t: True}


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from their hosts: the name before an @ cannot hold
    another @, so it reaches back to the character before it or the last match."""
    end = 0
    for host in EMAIL_HOST.finditer(text):
        start = host.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < host.start():
            yield start, host.end()
            end = host.end()


def base_matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Matches of the base patterns, whether or not they pass their checks."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    if DIGIT.search(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end()


def wide_matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Matches of the wider patterns; each is tried where a sign it needs is there."""
    signs = {"email": "(" in text or "[" in text, "ipv6": ":" in text}
    digit = DIGIT.search(text)
    for kind, pattern in WIDE.items():
        if signs.get(kind, digit):
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end()


def candidates(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, base): base spans pass all base rules; the others are what
    looks like personal data otherwise."""
    for kind, start, end in base_matches(text):
        if CHECKS[kind](text[start:end]):
            yield kind, start, end, True
        elif kind != "card" or end - start >= 12:
            yield kind, start, end, False
    for kind, start, end in wide_matches(text):
        yield kind, start, end, False


LABELERS = ("check", "shape", "gazetteer", "gazetteer_other", "context", "context_other",
            "free_standing", "reserved")
#: Shape of a span: besides its votes, its kind, length and digits.
SHAPE = len(KINDS) + 4


def votes(text: str, kind: str, start: int, end: int) -> list[int]:
    """1 personal, -1 not personal, 0 no vote, by each of LABELERS."""
    span, before = text[start:end], text[max(start - BEFORE, 0):start]
    after = text[end:end + 1]
    digits = digits_of(span)
    passes = CHECKS[kind](span)
    if kind == "email":
        host = span.rpartition("@")[2].lower().split(".")
        shape = 1 if "@" in span else 0
        place = 1 if host[-1] in TOP_DOMAINS else -1 if not host[-1].isalpha() else 0
        other = 1 if any(h.rstrip("0123456789") in MAIL_WORDS for h in host) else 0
    elif kind == "card":
        shape = 1 if len(digits) in (14, 15, 16) else -1
        place = 1 if digits.startswith(CARD_ISSUERS) else 0
        other = -1 if len(set(digits)) <= 2 else 0
    elif kind == "phone":
        shape = 1 if span[0] in "+(" else 0
        place = 1 if 10 <= len(digits) <= 13 else -1
        other = -1 if len(set(digits)) <= 2 else 0
    elif kind == "ip":
        parts = span.split(".")
        shape = -1 if any(len(p) > 1 and p[0] == "0" for p in parts) else 1
        place = -1 if parts[0] in ("0", "10", "127") or max(map(len, parts)) == 1 else 0
        other = -1 if not passes else 0
    elif kind == "iban":
        shape, place = (1 if passes else -1), 1 if span[:2] in COUNTRIES else -1
        other = 0
    else:
        shape, place, other = 0, 0, 0
    context = 1 if PERSONAL_WORDS.search(before) else 0
    against = -1 if OTHER_WORDS.search(before) else 0
    glued = before[-1:].isalnum() or after.isalnum()
    reserved = -1 if (kind == "phone" and "555-01" in span) or span.lower().endswith(
        (".invalid", ".test")) else 0
    return [1 if passes and kind not in ("ipv6",) else 0 if passes else -1, shape, place, other,
            context, against, -1 if glued else 1, reserved]


def values(kind: str, span: str, ballot: list[int]) -> list[float]:
    """Features of the span classifier."""
    out = [float(v == s) for v in ballot for s in (1, -1)]
    out += [float(kind == k) for k in KINDS]
    n = max(len(span), 1)
    digits = len(digits_of(span))
    return out + [min(n, 64) / 64, digits / n, float(" " in span),
                  sum(c.isalpha() for c in span) / n]


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...] = ()
    intercept: float = 0.0

    def probability(self, features: list[float]) -> float:
        """Of being personal; without weights (nothing was learned) none is."""
        if not self.weights:
            return 0.0
        z = self.intercept + float(np.dot(self.weights, features))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50,
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns.

    Returns the probability that each pattern is personal, and p[labeler, truth,
    vote + 1]. Starts from the majority's opinion; smoothing keeps a labeler that
    hardly votes near indifference.
    """
    likely = 1 / (1 + np.exp(-patterns.sum(axis=1, dtype=float)))
    one_hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - likely), counts * likely])
        table = np.einsum("tp,plv->ltv", weight, one_hot) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.log(prior) + np.einsum("plv,ltv->pt", one_hot, np.log(table))
        likely = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return likely, table


def learn(docs: DataFrame, max_spans: int = 50_000) -> Model:
    """The span classifier for ``docs`` (text).

    Vote patterns are counted over all candidates of all texts; there are at most
    3 to the number of labelers of them. The classifier is fitted on about ``max_spans``
    different candidates at most, by a hash, each with the weight of its copies.
    Without candidates nothing is learned, and only base spans will be found.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ballots, features, keys = [], [], []
            for text in texts(batch.column("text")):
                for kind, start, end, _ in candidates(text or ""):
                    ballot = votes(text, kind, start, end)
                    ballots.append(ballot)
                    features.append(values(kind, text[start:end], ballot))
                    keys.append(f"{kind}:{text[start:end]}")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ballots, pa.list_(pa.int32())),
                 pa.array(features, pa.list_(pa.float64())), pa.array(keys, pa.string())],
                names=["ballot", "values", "span"])

    found = stored(docs.select("text").mapInArrow(
        run, "ballot array<int>, values array<double>, span string"), "candidates")
    patterns = found.groupBy("ballot").count().collect()
    if not patterns:
        return Model()
    ballots = [tuple(r.ballot) for r in patterns]
    likely, _ = reliabilities(np.array(ballots), np.array([r["count"] for r in patterns], float))
    spark = docs.sparkSession
    opinion = spark.createDataFrame(
        [(list(b), float(p)) for b, p in zip(ballots, likely, strict=True)],
        "ballot array<int>, likely double")
    alike = stored(found.groupBy("span", "ballot", "values").agg(
        F.count("*").alias("copies")), "different-candidates")
    sample = bounded_sample(alike, max_spans, "span", "ballot", "values").join(
        F.broadcast(opinion), "ballot")
    # Each span counts for both classes, by how likely it is in each.
    copies = F.col("copies")
    both = sample.select("values", F.explode(F.array(
        F.struct(F.lit(1).alias("label"), (copies * F.col("likely")).alias("weight")),
        F.struct(F.lit(0).alias("label"), (copies * (1 - F.col("likely"))).alias("weight"))))
        .alias("x"))
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50).fit(both.select(
        array_to_vector("values").alias("features"), "x.label", "x.weight"))
    return Model(tuple(fitted.coefficients.toArray().tolist()), float(fitted.intercept))


def spans(text: str, model: Model, threshold: float = 0.5) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by start and kind: all base spans, and those of the other
    candidates that the classifier takes and that overlap no base span and no likelier one."""
    base, more = [], []
    for kind, start, end, is_base in candidates(text):
        if is_base:
            base.append((kind, start, end, True))
        else:
            p = model.probability(values(kind, text[start:end], votes(text, kind, start, end)))
            # What fails its kind's checksum or ranges helps to learn, but is never taken.
            if p >= threshold and CHECKS[kind](text[start:end]):
                more.append((-p, start, end, kind))
    taken = bytearray(len(text) if more else 0)
    if more:
        for _, start, end, _ in base:
            taken[start:end] = b"\1" * (end - start)
    for _, start, end, kind in sorted(more):
        if not any(taken[start:end]):
            base.append((kind, start, end, False))
            taken[start:end] = b"\1" * (end - start)
    return sorted(base, key=lambda s: (s[1], KINDS.index(s[0])))


SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the ``spans`` of every whole text in place of text.

    Places are in code points, ends exclusive. Null and empty texts have none; an
    empty table gives no rows. Columns other than text stay, but for ``spans``.
    """
    others = [f for f in docs.schema if f.name not in ("text", "spans")]
    names = [f.name for f in others]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "base"), s, strict=True))
                      for s in spans(t or "", model)] for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, kind)],
                names=[*names, "spans"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in others]
    return docs.select(*names, "text").mapInArrow(run, ", ".join([*fields, f"spans {SPAN}"]))


def redacted(text: str, model: Model) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end, _ in spans(text, model):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the personal data in text replaced; a null text stays null."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [None if t is None else redacted(t, model)
                    for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(text, pa.string()) if c == "text" else batch.column(c)
                 for c in columns], names=columns)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join(fields))


def op6_personal_data(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    found = find(docs, learn(docs))

    def joined(chosen):
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
            ":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        mine = F.filter("spans", lambda s: s["base"] & (s["kind"] == F.lit(kind)))
        return F.size(mine).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base).cast("binary"), 256)
                        .alias("base_sha256"), joined(F.col("spans")).alias("spans"))
