"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import functions as F

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(number: int, size: int) -> str:
    """Deterministic text whose five-word runs do not recur between numbers."""
    state, out = number * 2654435761 + 12345, []
    for i in range(size):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[state >> 60] + ("." if i % 9 == 8 else ""))
    return " ".join(out)


ROWS = [
    (1, prose(1, 60), "en", "a"),
    (2, prose(1, 60), "en", "a"),  # equal text
    (2, prose(1, 60), "en", "a"),  # the same row again
    (3, None, "en", "a"),
    (4, "", "fr", None),
    (5, " \t\n\r\x0b\x0c ", None, "a"),
    (6, prose(2, 40) + "\n" + prose(1, 40), "en", "b"),
    (7, "é中文😀 x y " + prose(3, 30), "fr", "b"),
    (8, "a", "en", "b"),
    (9, prose(9, 60_000), "en", "b"),  # long
    (10, "z" * 300_000, "en", "b"),  # one long word
    (None, prose(2, 40), "en", "c"),
    (None, None, None, None),
    (11, "....!!!! ???? 0000 ---- 1234", "en", "c"),
    (2**62, prose(12, 25), "de", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# Names that operators use inside or return.
CLASHES = "row_key keys bucket n_words n_chars fp seq verdict leak base spans cands c0 d0 d1 t p0 kept starts posterior items shard size".split()


def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing(spark):
    """The same rows with a string column under every name that might be used inside."""
    return docs(spark).select("*", *[F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(name) for name in CLASHES])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, key="doc_id"):
    """Rows as sorted plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
