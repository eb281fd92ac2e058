"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation rates them.

Every rule reads one statistic of a document and votes good (1), bad (-1) or abstains (0). Documents
are counted per pattern of votes in Spark; there are at most 3^rules patterns however large the corpus,
so the counts, and only they, are collected and the model is fitted on them by
expectation-maximisation: a two-class mixture in which each rule has a rate of voting right and a rate
of voting at all per class. The posterior of a pattern is then a column expression, applied to all rows.

Edge cases: null text is empty; a text without words fails the base rules, as does one of fewer than
`MIN_WORDS`; repeated rows and null ids get a row each; an empty table gives an empty table; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm import common as C
from folioflow.llm.weak import fit
from folioflow.session import stored

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
KEEP_FROM = 0.5
# Where the fit starts, as rates of votes bad, none, good: rules seldom speak against a good document,
# and one in four speaks against a bad one.
GOOD_VOTES, BAD_VOTES = (0.01, 0.07, 0.92), (0.25, 0.15, 0.6)

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_letters long, n_upper long, n_end_lines long, n_distinct_words long, n_plain_words long, n_digits long, n_stutters long"
)


def _ratio(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def rules() -> dict[str, tuple[Column, Column, Column]]:
    """name: (statistic, votes good, votes bad)."""
    words = F.col("n_words").cast("double")
    length = _ratio("word_chars", "n_words")
    symbols = _ratio("n_symbols", "n_words")
    dup = _ratio("n_dup_lines", "n_lines")
    repeat = _ratio("n_repeat_words", "n_words")
    letters = F.col("n_letters") / F.greatest(F.col("word_chars") - F.col("n_digits"), F.lit(1))
    stutter = _ratio("n_stutters", "n_words")
    upper = _ratio("n_upper", "n_letters")
    ended = _ratio("n_end_lines", "n_lines")
    plain = _ratio("n_plain_words", "n_words")
    distinct = _ratio("n_distinct_words", "n_words")
    return {
        "length": (words, words >= 50, words < 25),
        "word_length": (length, length.between(3, 10), (length < 2.5) | (length > 14)),
        "symbols": (symbols, symbols <= 0.05, symbols > 0.3),
        "dup_lines": (dup, dup <= 0.1, dup > 0.4),
        "repeats": (repeat, repeat <= 0.1, repeat > 0.28),
        "letters": (letters, letters >= 0.93, letters < 0.88),
        "upper_case": (upper, upper <= 0.2, upper > 0.5),
        "line_ends": (ended, ended >= 0.5, ended < 0.1),
        "plain_words": (plain, plain >= 0.9, plain < 0.7),
        "stutter": (stutter, stutter <= 0.05, stutter > 0.2),
        "distinct": (distinct, distinct >= 0.25, distinct < 0.08),
    }


def _lookup(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _lookup(SYMBOLS)
_UPPER = _lookup(bytes(range(65, 91)))
_ASCII_LETTER = _lookup(bytes(range(65, 91)) + bytes(range(97, 123)))
_PUNCTUATION = _lookup(b".,;:!?\"'()-")
_ODD = ~(_ASCII_LETTER | _PUNCTUATION | C.BLANK | (np.arange(256) >= 0x80))
_DIGIT = _lookup(b"0123456789")
_END = _lookup(b".!?\"')")


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words in windows that occur twice or more in their row, the first occurrence included."""
    row = C.owners(first)
    size = WINDOW
    windows = C.window_hashes(hashes, size)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(windows):
        at = np.flatnonzero(row[: len(windows)] == row[size - 1 :])
        key = C.mix(windows[at] ^ C.mix(row[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        twin = key[order][1:] == key[order][:-1]
        hit = at[order[np.union1d(np.flatnonzero(twin), np.flatnonzero(twin) + 1)]]
        covered[hit] += 1
        np.subtract.at(covered, hit + size, 1)
    return _per_row(np.cumsum(covered[:-1]) > 0, first)


def _line_stats(text: str) -> tuple[int, int, int]:
    """(lines with a word, those equal to an earlier line, those with a closing mark)"""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    ended = sum(line.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?\"')" for line in lines)
    return len(lines), len(lines) - len(set(lines)), ended


def _stats(text: pa.Array) -> list[np.ndarray]:
    data, offsets = C.text_bytes(text)
    starts, ends, first = C.word_bounds(data, offsets)
    hashes = C.word_hashes(data, starts, ends)
    row = C.owners(first)
    lead = (data & 0xC0) != 0x80
    lines = np.array([_line_stats(t) for t in text.to_pylist()], np.int64).reshape(-1, 3)
    key = C.mix(hashes ^ C.mix(row.astype(np.uint64) + np.uint64(1)))
    # A plain word is letters, with marks of punctuation at most.
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_ODD[data], out=odd[1:])
    plain = odd[ends] == odd[starts]
    stutter = np.zeros(len(hashes), bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    plain &= ends - starts > _PUNCTUATION[data[starts]]
    order = np.argsort(key)
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    return [
        np.diff(first),
        _per_row(lead & ~C.BLANK[data], offsets),
        _per_row(_SYMBOL[data], offsets),
        lines[:, 1],
        repeated_words(hashes, first),
        lines[:, 0],
        _per_row(lead & (_ASCII_LETTER[data] | (data >= 0x80)), offsets),
        _per_row(_UPPER[data], offsets),
        lines[:, 2],
        np.bincount(row[order[fresh]], minlength=len(text)),
        _per_row(plain, first),
        _per_row(_DIGIT[data], offsets),
        _per_row(stutter, first),
    ]


def judged(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns `carry` and, in a struct `verdict`, statistics, votes, posterior and verdict per row."""
    names = list(rules())
    made = [part.split()[0] for part in STATS.split(", ")]
    plain = [f"d{i}" for i in range(len(carry))]
    rows = C.per_row(docs, carry, _stats, STATS).toDF(*plain, *made)
    vote = [F.when(bad, -1).when(good, 1).otherwise(0).cast("int").alias(f"vote_{n}") for n, (_, good, bad) in rules().items()]
    rows = stored(rows.select("*", *vote))
    counted = rows.groupBy(*[f"vote_{n}" for n in names]).count().collect()
    prior, weights = fit(sorted((tuple(r[:-1]), r[-1]) for r in counted), GOOD_VOTES, BAD_VOTES, 0.8)
    odds = F.lit(prior)
    for name, weight in zip(names, weights):
        vote = F.col(f"vote_{name}")
        odds = odds + F.when(vote == 1, F.lit(weight[1])).when(vote == -1, F.lit(weight[-1])).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed)
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM))
    verdict = [c for c in rows.columns if c not in plain]
    return rows.select(*[F.col(p).alias(c) for p, c in zip(plain, carry)], F.struct(*verdict).alias("verdict"))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, statistics, votes, posterior, base_failed and the verdict `kept`."""
    return judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]).select("doc_id", "verdict.*")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the verdict keeps, with all their columns."""
    plain = docs.toDF(*[c if c == "text" else f"p{i}" for i, c in enumerate(docs.columns)])
    kept = judged(plain, plain.columns).where("verdict.kept").drop("verdict")
    return kept.toDF(*docs.columns)
