import re

import edges
import pytest
from folioflow.llm import quality, weak

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


REPEATS = [
    (100, "one two three four five six seven eight " * 5),
    (101, "a b c d e f g h\n" * 3 + edges.prose(5, 100)),
    (102, "x\nx\n \n\nx\r\ny # * $ % & | < >"),
    (103, edges.prose(6, 7) + " " + edges.prose(6, 7)),
]


def test_base_columns(spark):
    docs = edges.docs(spark).select("doc_id", "text").union(spark.createDataFrame(REPEATS, "doc_id long, text string"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = edges.rows(quality.judge(docs).select(*names))
    want = sorted(((r.doc_id, *base(r.text)) for r in docs.collect()), key=repr)
    assert got == want


def test_kept_never_against_the_base_rules_and_no_row_lost(spark):
    found = quality.judge(edges.docs(spark)).collect()
    assert len(found) == len(edges.ROWS)
    assert not [r for r in found if r.kept and r.base_failed]
    assert quality.judge(edges.empty(spark)).collect() == []


def test_filter_keeps_whole_rows(spark):
    docs = edges.clashing(spark)
    kept = quality.quality_filter(docs)
    assert kept.schema.names == docs.schema.names
    assert set(map(repr, edges.rows(kept))) <= set(map(repr, edges.rows(docs)))
    verdict = quality.judge(docs).where("kept").count()
    assert kept.count() == verdict > 0


def test_junk_is_told_from_prose(spark):
    junk = [(i, " ".join(w + "###" for w in edges.prose(i, 80).split())) for i in range(20)]
    clean = [(100 + i, edges.prose(100 + i, 120)) for i in range(180)]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(junk + clean, "doc_id long, text string")).collect()}
    assert all(found[i].kept == (i >= 100) for i in found)


def test_fit_prefers_the_voter_that_agrees():
    # Two voters agree, one votes at random: its vote must weigh least.
    patterns = [((1, 1, 1), 45), ((1, 1, -1), 45), ((-1, -1, 1), 5), ((-1, -1, -1), 5)]
    _, weights = weak.fit(patterns, (0.1, 0.1, 0.8), (0.6, 0.2, 0.2), 0.7)
    assert weights[2][1] - weights[2][-1] < min(w[1] - w[-1] for w in weights[:2])
    assert weak.fit([], (0.1, 0.1, 0.8), (0.6, 0.2, 0.2), 0.5) == (0.0, [])


def test_logistic_separates():
    bias, slopes = weak.logistic([((1, 0), 0.9, 50), ((0, 1), 0.1, 50)])
    assert weak.sigmoid(bias + slopes[0]) == pytest.approx(0.9, abs=0.05)
    assert weak.sigmoid(bias + slopes[1]) == pytest.approx(0.1, abs=0.05)
