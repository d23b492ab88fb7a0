"""Operator 9: secret scanning, false positives removed by a random forest.

A pattern proposes long runs of key characters, and what is assigned to a secret's name
from six characters on. Shorter values, and passwords that neither are a run of 14
nor are assigned to such a name, are not proposed. A forest trained from labelled
findings decides by the run's length and character transitions, how much of it is
dictionary words, paths, and the words beside it. Only built-in functions and
Spark's own forest run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carrymark.llm.common import bounded_sample, stored

RUN = "[A-Za-z0-9+/_-]"
SECRET_NAME = "(?i:api|auth|access|private|client|secret|token|key|passw(?:or)?d|pwd|credential)"
ASSIGN = r"[:=][\x20\x09]{0,2}"
NAMED = SECRET_NAME + "[A-Za-z0-9_-]{0,12}[\"']?" + r"[\x20\x09]{0,2}" + ASSIGN
#: Behind a secret's name, a value in quotes or up to a separator may hold other signs.
QUOTED = f"(?<={ASSIGN}[\"'])(?<={NAMED}[\"'])" + r"[^\s\"'`]{6,}+(?=[\"'])"
BARE = (f"(?<={ASSIGN})(?<={NAMED})" + r"(?![A-Za-z]+://)[^\s\"'`,;&<>(){}\[\]=]{6,}(?<![.!?:])"
        r"(?:={1,2}+(?![^\s\"'`,;&]))?")
#: '=' ends a run, so that a name before it stays outside, unless it is padding at the end.
CANDIDATE = f"(?:{QUOTED}|{BARE}|(?<!{RUN}){RUN}{{14,}}+(?:={{1,2}}+(?!{RUN}|=))?)"
BEFORE, AFTER = 60, 20
# Words that name a secret, and words that name something else. A name is
# taken apart at separators and changes of case first, so that "monkey" is not a key.
SECRET_WORDS = (r"\b((api|auth|access|secret|private|client|session|refresh)?(key|token|secret)|pwd|"
                r"credential|auth|bearer|signature)s?[0-9]*\b|passw(or)?d[0-9]*\b|passphrase\b")
OTHER_WORDS = (r"\b(sha|md5|hash|digest|commit|checksum|uuid|guid|id|version|build|isbn|phone|card|"
               r"call|order|image|url|href|src)[0-9]*$")
#: Providers' formats, which decide by themselves.
KNOWN_SECRET = (r"(?<![A-Za-z0-9])(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|"
                r"sk_live_[0-9a-zA-Z]{24,}|xox[abpr]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35})"
                r"(?![A-Za-z0-9])")
#: What mixes letters with digits and yet is no secret: digests and ids beside their names,
#: UUIDs, file names and the parts of an address.
HEX = "^(?:[0-9a-f]{14,}|[0-9A-F]{14,})$"
HASH_WORDS = r"(?i)^(sha[0-9]*|md5|hash|digest|commit|checksum|revision|etag|uuid|guid)$"
UUID = "(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
FILE_END = (r"(?i)^\.(html?|php|js|css|json|xml|txt|md|pdf|png|jpe?g|gif|svg|zip|gz|py|java|csv|"
            r"parquet)\b")
ADDRESS = r"(?i)(https?:|www\.)[^\s?#\"'<>]*$"
PASSWORD_NAME = r"(passw(or)?d|pwd|passphrase)[0-9 ]*$"
#: Plain words and numbers between separators, whatever they are assigned to.
WORDY = ("^(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[-_/.:]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*$")
#: Pieces of letters and digits together.
MIXED_PIECE = ("(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]+")
ASSIGNED = r"([A-Za-z][A-Za-z0-9_.-]*)[\"']?[\x20\x09]*[:=][\x20\x09]*[\"']?$"


@dataclass(frozen=True)
class Training:
    max_findings: int = 20_000
    max_words: int = 150       # dictionary words
    min_word: int = 3
    trees: int = 20
    depth: int = 6


def candidates(docs: DataFrame) -> DataFrame:
    """One row for every candidate of every whole text.

    row_ and nth tell candidates apart; start and length are in characters; before
    and after are the text beside it. Other columns of ``docs`` are in ``doc``.
    """
    found = docs.filter(F.col("text").rlike(CANDIDATE)).select(
        F.monotonically_increasing_id().alias("row_"),
        F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"),
        F.split("text", CANDIDATE).alias("between"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"))
    # The text in pieces, gap and candidate in turn: those beside a candidate may be candidates.
    pieces = F.flatten(F.transform("between", lambda b, i: F.array(
        b, F.coalesce(F.get("found", i), F.lit("")))))
    found = found.withColumns({
        "tails": F.transform(pieces, lambda p: F.right(p, F.lit(BEFORE))),
        "heads": F.transform(pieces, lambda p: F.left(p, F.lit(AFTER)))})

    def beside(column, first, count):
        return F.array_join(F.slice(column, first, count), "")

    near = 2 * (BEFORE // 7 + 1)  # a candidate and the gap after it are 7 characters or more
    parts = F.transform("found", lambda c, i: F.struct(
        c.alias("candidate"), F.char_length(F.get("between", i)).alias("gap"),
        F.right(beside("tails", F.greatest(2 * i + 1 - near, F.lit(1)),
                       F.least(2 * i + 1, F.lit(near + 1))), F.lit(BEFORE)).alias("before"),
        F.left(beside("heads", 2 * i + 3, F.lit(near)), F.lit(AFTER)).alias("after")))
    rows = found.select("row_", "doc", F.posexplode(parts).alias("nth", "part")).select(
        "row_", "doc", "nth", "part.*", F.char_length("part.candidate").alias("length"))
    earlier = Window.partitionBy("row_").orderBy("nth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("start", (F.sum(F.col("gap") + F.col("length")).over(earlier)
                                     - F.col("length")).cast("long")).drop("gap")


def dictionary(docs: DataFrame, training: Training) -> list[str]:
    """The most common words of all texts, of which ``max_words`` are kept."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    words = words.filter(F.char_length("word") >= training.min_word).groupBy("word").count()
    return [r.word for r in words.orderBy(F.desc("count"), "word")
            .limit(training.max_words).collect()]


def without(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def features(words: list[str]) -> Column:
    """Features of a candidate as an array of doubles."""
    run, n = F.col("candidate"), F.col("length")
    name, previous = assigned_name(), previous_word()
    changes = F.regexp_count(run, F.lit(
        "(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])|(?<=[0-9])(?![0-9])"))
    known = "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))
    covered = without(F.lower(run), f"({known})") / n if words else F.lit(0.0)
    shares = [without(run, p) / n for p in ("[a-z]", "[A-Z]", "[0-9]", "[+/_=-]", "[g-zG-Z]")]
    distinct = F.size(F.array_distinct(F.split(run, ""))) / F.least(n, F.lit(64))
    return F.array(*(x.cast("double") for x in (
        named_secret(), run.rlike(KNOWN_SECRET), run.rlike(WORDY), without(run, MIXED_PIECE) / n,
        n, *shares, distinct, changes / n, covered,
        without(run, "/"), run.rlike("[A-Za-z]/[A-Za-z]"), F.col("before").rlike(r"[/\\:]$"),
        name != "", name.rlike(PASSWORD_NAME), previous.rlike(SECRET_WORDS),
        previous.rlike(OTHER_WORDS), F.col("before").rlike("[\"'`]$"),
        F.col("after").rlike("^[\"'`]"), F.col("after").rlike(r"^\.[A-Za-z]"),
        F.col("before").rlike(r"[\p{L}\p{N}]$") | F.col("after").rlike(r"^[\p{L}\p{N}]"))))


def in_words(name: Column) -> Column:
    """A name as small-letter words: ``dbPassword``, ``DB_PASSWORD`` are ``db password``."""
    return F.lower(F.regexp_replace(name, r"(?<=[a-z0-9])(?=[A-Z])|[_.\-]+", " "))


def assigned_name() -> Column:
    """The words of the name that a candidate is assigned to; empty without one."""
    return in_words(F.regexp_extract("before", ASSIGNED, 1))


def previous_word() -> Column:
    return in_words(F.regexp_extract("before", r"([\p{L}\p{N}_]+)[^\p{L}\p{N}_]*$", 1))


def named_secret() -> Column:
    """Assigned to a secret's name, or behind ``Bearer``."""
    name = assigned_name()
    return (name.rlike(SECRET_WORDS) & ~name.rlike(OTHER_WORDS)) | (previous_word() == "bearer")


def known_findings(found: DataFrame) -> DataFrame:
    """Candidates whose format and place label them.

    Secrets: a provider's format; what mixes letters with digits and is assigned to a
    password's name; and what does, is 20 characters long, is not just words and numbers
    and is assigned to another secret's name or follows ``Bearer``. Others: words, numbers
    and paths; and without a secret's name digests, UUIDs, file names and parts of an
    address by what stands beside them, and what is assigned to another name and holds no
    unbroken piece of 16 letters and digits. All else has no label and is left out.
    """
    run, named = F.col("candidate"), named_secret()
    mixed = run.rlike("[0-9]") & run.rlike("[A-Za-z]") & ~run.rlike(r"^[$%<{/]")
    password = assigned_name().rlike(PASSWORD_NAME)
    secret = run.rlike(KNOWN_SECRET) | (named & mixed & (
        password | ((F.col("length") >= 20) & ~run.rlike(WORDY))))
    other = (run.rlike(WORDY) & ~password) | (~named & (
        run.rlike(UUID) | (run.rlike(HEX) & previous_word().rlike(HASH_WORDS))
        | F.col("after").rlike(FILE_END) | F.col("before").rlike(ADDRESS)
        | ((assigned_name() != "") & ~run.rlike("[A-Za-z0-9]{16}"))))
    return found.withColumn("label", F.when(secret, 1.0).when(other, 0.0)).filter(
        "label is not null")


def learn(findings: DataFrame, words: list[str],
          training: Training = Training()) -> RandomForestClassificationModel | None:
    """A forest from labelled ``findings`` (candidate, length, before, after, label).

    About ``max_findings`` different ones at most, by a hash, each once. Each label is
    sampled by itself, so that a rare one is in whatever the size, and weighs as many
    as it stands for. None where not both labels occur: then nothing can be told apart,
    and every candidate is reported.
    """
    rows = findings.select("label", "candidate", features(words).alias("values")).distinct()
    rows = stored(rows, "findings")
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    shares = label_quotas(sizes, training.max_findings)
    samples = [bounded_sample(rows.filter(F.col("label") == label), quota, "candidate", "values")
               .withColumn("weight", F.lit(max(sizes[label] / quota, 1.0)))
               for label, quota in shares.items()]
    rows = samples[0].unionByName(samples[1]).select(
        F.col("label").cast("double").alias("label"), array_to_vector("values").alias("features"),
        "weight")
    # Every split may use every feature: that a secret's name is beside it must not be left
    # out by chance. The trees differ by the rows that each one draws.
    return RandomForestClassifier(numTrees=training.trees, maxDepth=training.depth,
                                  featureSubsetStrategy="all", weightCol="weight",
                                  seed=1).fit(rows)


def label_quotas(sizes: dict, most: int) -> dict:
    """How many rows of each of two labels are sampled: the rarer one's up to half."""
    rare, common = sorted(sizes, key=lambda label: (sizes[label], label))
    few = min(sizes[rare], most // 2)
    return {rare: few, common: most - few}


def scan(found: DataFrame, words: list[str],
         forest: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` candidates with the forest's ``score`` and ``kept``: a score of at least 0.5,
    or a provider's format, whatever the forest learned."""
    if forest is None:
        return found.withColumns({"score": F.lit(1.0), "kept": F.lit(True)})
    names = found.columns
    rows = found.select(F.struct(*names).alias("candidate_"),
                        array_to_vector(features(words)).alias("features"))
    rows = forest.transform(rows).select(
        "candidate_.*", vector_to_array("probability")[1].alias("score"))
    return rows.withColumn("kept", (F.col("score") >= 0.5)
                           | F.col("candidate").rlike(KNOWN_SECRET))


def op9_secret_scan(docs: DataFrame) -> DataFrame:
    """Every candidate of every text, and whether it stays as a secret.

    Null and empty texts have no candidates; an empty table gives no rows.
    """
    training = Training()
    docs = docs.select("doc_id", "text")
    words = dictionary(docs, training)
    found = stored(candidates(docs), "secret-candidates")
    forest = learn(known_findings(found), words, training)
    return scan(found, words, forest).select(
        "doc.doc_id", "start", "length", "candidate", "score", "kept")
