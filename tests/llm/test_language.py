import math
import pickle
from collections import Counter
from zlib import crc32

import edges
import numpy as np
import pytest
from folioflow.llm import language

SYLLABLES = {"aa": ["th", "er", "on", "an", "re"], "bb": ["oi", "eau", "ré", "en", "ch"], "cc": ["ung", "sch", "ei", "ß", "ge"]}


def sample(lang, number, words=40):
    parts = SYLLABLES[lang]
    return " ".join("".join(parts[(number * 7 + i * i + 3 * j + number // 5) % 5] for j in range(1 + (i + number) % 3)) for i in range(words))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, sample(lang, i), lang, None) for i in range(300) for lang in [sorted(SYLLABLES)[i % 3]]]
    return spark.createDataFrame(rows, edges.SCHEMA)


def test_held_out_accuracy(corpus):
    found = language.identify(corpus, language.learn(corpus)).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 300
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 50 and sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def brute(training, langs, text):
    """Code lengths by the definition, from dictionaries of counts."""
    out = []
    for lang in langs:
        count = [Counter() for _ in range(5)]
        for t in training[lang]:
            padded = b"\0\0\0" + t.encode()
            for i in range(3, len(padded)):
                for depth in range(1, 5):
                    count[depth][padded[i - depth + 1 : i + 1]] += 1
        total = sum(count[1].values())
        kept = [{g: n for g, n in c.items() if n >= total * language.FLOOR} for c in count]
        follow = [dict() for _ in range(5)]
        for depth in range(1, 5):
            for g, n in kept[depth].items():
                if depth < 2 or g[:-1] in (kept[depth - 1] if depth > 3 else follow_all(depth - 1)):
                    follow[depth].setdefault(g[:-1], []).append(n)
        bits = 0.0
        padded = b"\0\0\0" + text.encode()
        for i in range(3, len(padded)):
            cost = 0.0
            for depth in range(4, 0, -1):
                gram = padded[i - depth + 1 : i + 1]
                own = follow[depth].get(gram[:-1])
                if own is None:
                    continue
                if gram in kept[depth]:
                    cost -= math.log2(kept[depth][gram] / (sum(own) + len(own)))
                    break
                cost -= math.log2(len(own) / (sum(own) + len(own)))
            else:
                cost += 8
            bits += cost
        out.append(bits)
    return out


class follow_all:
    """Contexts of one or two bytes have dense tables: any may be followed."""

    def __init__(self, depth):
        self.depth = depth

    def __contains__(self, _):
        return True


def test_code_lengths_are_those_of_the_definition(spark):
    rows = [(i, sample(lang, i, 12), lang, None) for i in range(24) for lang in [sorted(SYLLABLES)[i % 3]]]
    docs = spark.createDataFrame(rows, edges.SCHEMA)
    model = language.learn(docs)
    training = {}
    for doc_id, text, lang, _ in rows:
        if crc32(str(doc_id).encode()) % 3 != 1:
            training.setdefault(lang, []).append(text)
    texts = [sample("aa", 999, 15), "zzz QQQ", "é", "sch\0x" + sample("bb", 5, 3)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    got = model.code_lengths(data, offsets)
    for i, text in enumerate(texts):
        assert got[:, i] == pytest.approx(brute(training, model.langs, text), rel=1e-4, abs=0.05)


def test_edge_rows(spark, corpus):
    model = language.learn(corpus)
    found = language.identify(edges.clashing(spark), model).collect()
    assert len(found) == len(edges.ROWS)
    lettered = {repr((d, any(c.isalpha() for c in t or ""))) for d, t, *_ in edges.ROWS}
    assert {repr((r.doc_id, r.lang_pred != "und")) for r in found} == lettered
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    assert language.identify(edges.empty(spark), model).collect() == []


def test_nothing_to_learn_from(spark):
    docs = edges.docs(spark)
    found = language.identify(docs, language.learn(edges.empty(spark))).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_predictions_do_not_see_language_source_or_id(spark, corpus):
    model = language.learn(corpus)
    once = {r.text_: r.lang_pred for r in language.predict(corpus.selectExpr("text", "text as text_"), model, ["text_"]).collect()}
    other = corpus.selectExpr("doc_id + 7 as doc_id", "text", "'xx' as lang", "'y' as source")
    again = {r.text_: r.lang_pred for r in language.predict(other.selectExpr("text", "text as text_"), model, ["text_"]).collect()}
    assert once == again


def test_rare_contexts_count_however_few_are_collected(spark, corpus, monkeypatch):
    rows = corpus.collect()
    training = {}
    for r in rows:
        if crc32(str(r.doc_id).encode()) % 3 != 1:
            training.setdefault(r.lang, []).append(r.text)
    odd = [(1000, "zzz QQQ é", "aa", None), (1001, "sch\0x" + sample("bb", 5, 3), "bb", None), (1001, "", None, None), (1002, "zzz QQQ é", None, None)]
    docs = corpus.where("doc_id < 40").union(spark.createDataFrame(odd, edges.SCHEMA))
    whole = edges.rows(language.identify(docs, language.learn(corpus)))
    monkeypatch.setattr(language, "FLOOR", 2.0**-5)
    model = language.learn(corpus)
    assert edges.rows(language.identify(docs, model)) == whole
    monkeypatch.setattr(language, "FLOOR", 0.0)  # every node counts in brute()
    rate = {r[0]: r[4] for r in whole}
    for doc_id, text in [(0, rows[0].text), (7, rows[7].text), (1000, odd[0][1])]:
        assert rate[doc_id] * len(text.encode()) == pytest.approx(min(brute(training, model.langs, text)), rel=1e-6)


def test_many_languages_do_not_swell_the_model(spark):
    """Three hundred languages: what is sent to the tasks stays bounded, and each is told from the others."""
    names = [f"l{i:03d}" for i in range(300)]
    letters = "abcdefghijklmnopqrstuvwxyz"

    def speech(i, number):
        syllables = [letters[(i * 7 + k * k) % 26] + letters[(i // 26 + 5 * k) % 26] + letters[(i + 11 * k) % 26] for k in range(4)]
        return " ".join(syllables[(number + j * (j + 1) // 2) % 4] for j in range(30))

    rows = [(i * 6 + k, speech(i, k), names[i], None) for i in range(300) for k in range(6)]
    corpus = spark.createDataFrame(rows, edges.SCHEMA)
    model = language.learn(corpus)
    assert len(model.langs) > 290 and not model.complete  # a few have all their texts held out
    assert len(pickle.dumps(model)) < language.HELD_BYTES + (4 << 20)
    found = language.identify(corpus, model).join(corpus.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    known = [r for r in found if r.lang in model.langs]
    assert len(known) > 500 and sum(r.lang_pred == r.lang for r in known) >= 0.95 * len(known)


def test_memory_bounds_the_grams_held(spark, corpus, monkeypatch):
    whole = edges.rows(language.identify(corpus, language.learn(corpus)))
    monkeypatch.setattr(language, "HELD_BYTES", 3 * 8 * 50)
    model = language.learn(corpus)
    assert not model.complete and len(model.held[0]) == 50
    assert edges.rows(language.identify(corpus, model)) == whole
