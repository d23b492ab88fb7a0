"""Documents with every kind of disorder, for all operators."""

from pyspark.sql import functions as F

LONG = "word " * 40_000 + "x" * 5_000
ROWS = [
    (1, "The cat sat on the mat and the dog sat on the rug by the door today.", "en", "s", 10),
    (2, "the cat sat on the MAT and the dog sat on the rug by the door today.", None, None, None),
    (3, None, "en", "s", None),
    (4, "", None, "s", 0),
    (5, "   \n\t ", "de", None, 6),
    (6, LONG, "en", "s", len(LONG)),
    (7, "x", "fr", "s", 1),
    (7, "x", "fr", "s", 1),          # a repeated row
    (7, "another text under the same id", "fr", "s", 1),
    (None, "no id at all", "en", "s", 1),
    (None, "no id at all", "en", "s", 1),
    (8, "naïve façade, Straße – 日本語のテキスト 😀 ́a\u0000b", "de", "s", 1),
    (9, "### $$$ %%% &&& *** <<< >>> ||| ### $$$ %%% &&& ***", "en", "s", 1),
    (10, "mail me at a.b@c.example or 10.0.0.1, +1 (202) 555-0199, 4111 1111 1111 1111", "en", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHES = ("row_", "digest", "fp", "root", "copies", "component_id", "ids", "id_bytes", "score",
           "features", "prediction", "spans", "words_", "lang_", "common", "kept", "piece",
           "length", "offset", "sequence_id", "lang_pred", "count", "doc", "label", "toxic")


def messy(spark, clashes=True):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    if clashes:
        docs = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
