"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import types as T

#: Names that operators use for columns of their own.
CLASHES = [
    "fp", "shard", "slot", "size", "bucket", "block", "line", "hits", "label", "copies", "root", "u", "v", "n", "nth",
    "lost", "lost_lines", "draw", "component_id", "fingerprint", "score", "rows", "mix_rows", "mix_key", "kept_id", "kept_text",
    "identified", "key", "text_key", "target", "data", "doc", "h1",
]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

SHARED = "This line is long enough to count and is shared."
PROSE = "the of and to in that was for with is his he on as by at it from her which"
PROSE_DE = "der die und das nicht von sie ist des sich mit dem dass er es ein ich auf so eine"


def rows() -> list[tuple]:
    rng = random.Random(5)
    long = " ".join(rng.choice(PROSE.split()) for _ in range(30_000))
    out = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, long, "en", "b", len(long)),
        (4, "x" * 60_000, None, "b", 60_000),
        (5, "ab" * 10_000 + "\n" + SHARED, "en", None, 1),
        (6, f"{SHARED}\n{PROSE}\n\t{SHARED.upper()} \n", "en", "c", 1),
        (7, f"{SHARED}\nkept", "en", "c", 1),
        (8, "1 2 3 ... !!!", "de", "c", 1),
        (9, PROSE_DE, "de", "d", 1),
        (10, PROSE, "en", "d", 1),
        (11, PROSE, "en", "d", 1),
        (None, PROSE, "en", "d", 1),
        (None, None, None, None, None),
        (12, f"{SHARED}\r\nLicensed under CC BY 4.0. All rights reserved.", "en", "e", 1),
        (13, "  \t \x0b\x0c\r\n \n", "en", "e", 1),
        (14, "É Ñ ß İ Σ ΑΣ ﬁ é     <|endoftext|> 's 'LL", "fr", "e", 1),
        (15, "and and and and", "en", "f", 1),
    ]
    return out + [(20, PROSE + " again", "en", "g", 7)] * 40


def documents(spark, clashing: bool = True):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("own") for c in CLASHES})
    return df


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
