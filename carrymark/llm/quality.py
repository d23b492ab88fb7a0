"""Operator 4: quality rules by divergence from the language's own distributions.

A document is held against two reference histograms of its language: character
classes and common words, both learned from all documents of that language. Its
Jensen-Shannon distance to either tells mark-up, shouting and word salad from
prose. Very short texts have noisy histograms and are only held to the base rules.
Only built-in functions run, each document in its own row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carrymark.llm.common import stored

SPACES = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Character classes besides white space, symbols, and the rest (other letters mostly).
CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "mark": r"[.,;:!?()'" + '"' + r"\-]"}
WINDOW = 5
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "base_failed", "kept", "char_distance", "word_distance")
#: A common word's least share of its language's words. The sketch tracks so many words
#: that its error is a fifth of that, so all common words are among those it nominates.
MIN_SHARE = 0.001
NOMINATED, TRACKED = 2000, 16384
#: Common words are looked up in buckets by their hash.
BUCKETS = 256


@dataclass(frozen=True)
class Limits:
    min_words: int = 10          # base rule: fewer words fail
    max_repeat_percent: int = 20  # base rule: more words in repeated windows fail
    common_words: int = 25       # words in a language's reference histogram
    guard_words: int = 30        # with fewer words the distances are not used
    max_char_distance: float = 0.30
    max_word_distance: float = 0.45


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, also where a lambda uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def without(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def repeated_window_words(tokens: Column) -> Column:
    """Words that lie in a 5-word window found twice or more, the first included.

    Windows are compared by 64-bit hashes of their words' hashes. Repeated ones are
    found by sorting, so long texts take n log n.
    """
    def window_hashes(hashes: Column) -> Column:
        return F.slice(F.transform(hashes, lambda h, i: F.xxhash64(
            h, *(F.get(hashes, i + k) for k in range(1, WINDOW)))), 1, F.size(hashes) - WINDOW + 1)

    def repeated_starts(windows: Column) -> Column:
        places = F.sort_array(F.transform(windows, lambda h, i: F.struct(
            h.alias("h"), i.alias("i"))))
        return let(places, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (
                F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, F.when(k > 0, k - 1))["h"] == x["h"], F.lit(False)))),
            lambda x: x["i"])))

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda p, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n)

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            let(repeated_starts(windows), covered))

    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return F.when(F.size(tokens) < WINDOW, 0).otherwise(
        let(hashes, lambda h: let(window_hashes(h), of_windows))).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_SPACE))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with words_, the contract's counts and the character class counts_."""
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    # Small letters and white space are in no class; what is left is short.
    docs = docs.withColumns({"words_": words(F.col("text")),
                             "rest_": F.regexp_replace("text", r"[\p{Ll}\s]+", "")})
    docs = docs.withColumns({
        "n_words": F.size("words_").cast("long"),
        "word_chars": F.char_length(F.array_join("words_", "")).cast("long"),
        "n_symbols": without(F.col("rest_"), SYMBOLS).cast("long"),
    })
    counted = [without(F.col("rest_"), p).cast("long") for p in CLASSES.values()]
    return docs.withColumn("counts_", F.array(
        F.char_length("text") - F.col("word_chars"), F.col("n_symbols"), *counted))


def _with_rest(counts: Column, total: Column) -> Column:
    """Shares of the counted classes and of what is left."""
    return F.transform(F.concat(counts, F.array(total - F.aggregate(
        counts, F.lit(0).cast("long"), lambda a, b: a + b))), lambda n: F.try_divide(n, total))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms, from 0 to 1."""
    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda a, b: half(a, b) + half(b, a))
    total = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2
    return F.sqrt(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def common_words(docs: DataFrame, limits: Limits) -> DataFrame:
    """(lang, top, total): the most common words with their counts, and all words' number.

    A common word makes up a share of at least MIN_SHARE of its language. A sketch
    with an error far below that nominates words, and only these are counted, so
    the many rare words are never shuffled. Ties go to the smaller word.
    """
    spoken = docs.select("lang", F.explode(words(F.col("text"))).alias("word"))
    nominated = spoken.groupBy("lang").agg(
        F.expr(f"approx_top_k(word, {NOMINATED}, {TRACKED})").alias("found"),
        F.count("*").alias("total"))
    nominated = stored(nominated.select("lang", "total", F.transform(
        "found", lambda f: f["item"]).alias("found")), "common-words")
    # At most NOMINATED rows for each language.
    table = F.broadcast(nominated.select("lang", F.explode("found").alias("word")))
    counted = spoken.join(table, ["lang", "word"]).groupBy("lang", "word").count()
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    best = counted.join(nominated.select("lang", "total"), "lang").filter(
        F.col("count") >= MIN_SHARE * F.col("total")).withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= limits.common_words)
    return best.groupBy("lang", "total").agg(F.sort_array(F.collect_list(
        F.struct("word", "count"))).alias("top"))


def word_references(docs: DataFrame, limits: Limits) -> DataFrame:
    """One row per language that has common words: these and their shares.

    Learned from every document of the language; documents without a language form
    one of their own.
    """
    docs = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), "text")
    common = F.transform("top", lambda t: t["word"])
    return stored(common_words(docs, limits).select(
        F.col("lang").alias("lang_"), common.alias("common_"),
        bucketed(common).alias("buckets_"),
        _with_rest(F.transform("top", lambda t: t["count"]), F.col("total"))
        .alias("word_shares_")), "word-references")


def class_references(marks: DataFrame) -> DataFrame:
    """One row per language: the shares of character classes in all its documents."""
    size = len(CLASSES) + 2
    sums = marks.groupBy("lang_").agg(F.sum("n_chars_").alias("n"), *(
        F.sum(F.col("counts_")[i]).alias(f"c{i}") for i in range(size)))
    return stored(sums.select("lang_", _with_rest(
        F.array(*(f"c{i}" for i in range(size))), F.col("n")).alias("class_shares_")),
        "class-references")


def bucket_of(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(BUCKETS))


def bucketed(common: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.filter(
        common, lambda w: bucket_of(w) == b))


def common_counts(tokens: Column, common: Column, buckets: Column | None = None) -> Column:
    """How often each of the sorted ``common`` words is among the tokens.

    Tokens that are common words are sorted, so a word's count is the distance
    between its first place from the left and its first from the right.
    """
    buckets = bucketed(common) if buckets is None else buckets
    # Most words are longer than every common one, which is cheaper to see.
    longest = F.array_max(F.transform(common, F.octet_length))
    present = let(longest, lambda n: F.sort_array(F.filter(tokens, lambda w: (
        F.octet_length(w) <= n) & F.array_contains(F.get(buckets, bucket_of(w)), w))))

    def count(both: Column) -> Column:
        return F.transform(common, lambda c: let(
            F.array_position(both["up"], c), lambda first: F.when(first == 0, F.lit(0).cast("long"))
            .otherwise(F.size(both["up"]) + F.lit(2) - first - F.array_position(both["down"], c))))

    return let(let(present, lambda w: F.struct(w.alias("up"), F.reverse(w).alias("down"))), count)


def quality(docs: DataFrame, limits: Limits = Limits(),
            carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the counts, the distances, ``base_failed`` and ``kept``.

    ``docs`` needs text and lang; its columns stay, or those that ``carry`` names, but
    for those of the result's own names. A null text has no words, so it fails the base
    rules; a null lang is a language of its own; an empty table gives no rows.

    Each text is measured once; what was counted is stored, and its sums are the
    reference that it is then held against.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c not in RESULT]
    marks = measured(docs.select(
        F.struct(F.lit(None).cast("int").alias("none_"), *names).alias("doc_"), "text",
        F.coalesce("lang", F.lit("")).alias("lang_")))
    marks = marks.withColumns({"n_chars_": F.char_length("text").cast("long"),
                               "n_dup_lines": repeated_lines(F.col("text")),
                               "n_repeat_words": repeated_window_words(F.col("words_"))})
    # One small row for each language; Spark measures it before it broadcasts.
    marks = marks.join(word_references(docs, limits), "lang_", "left")
    counted = let(F.struct(
        "words_", "common_", "buckets_", "n_words", "word_shares_"), lambda s: distance(_with_rest(
            common_counts(s["words_"], s["common_"], s["buckets_"]), s["n_words"]),
            s["word_shares_"]))
    marks = stored(marks.select(
        "doc_", "lang_", "n_chars_", "counts_", "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words",
        F.when(F.col("n_words") > 0, counted).alias("word_distance")), "quality-marks")
    marks = marks.join(class_references(marks), "lang_")
    marks = marks.withColumns({
        "char_distance": F.when(F.col("n_chars_") > 0, distance(
            _with_rest(F.col("counts_"), F.col("n_chars_")), F.col("class_shares_"))),
        "base_failed": (F.col("n_words") < limits.min_words)
        | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))})
    # A language of rare words alone has no reference to be far from.
    near = F.coalesce((F.col("char_distance") <= limits.max_char_distance), F.lit(True)) & (
        F.coalesce(F.col("word_distance") <= limits.max_word_distance, F.lit(True)))
    marks = marks.withColumn("kept", ~F.col("base_failed") & (
        (F.col("n_words") < limits.guard_words) | near))
    return marks.select(*(F.col("doc_")[c].alias(c) for c in names), *RESULT)


def op4_quality_rules(docs: DataFrame) -> DataFrame:
    return quality(docs, carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("char_distance", 6).alias("char_distance"),
        F.round("word_distance", 6).alias("word_distance"))
