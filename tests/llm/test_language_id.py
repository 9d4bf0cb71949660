"""Language identification: the path against all paths, spans on mixed texts, held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest
from helpers import DOCS, edge_docs, edge_rows, no_docs

from riskloom.llm import language_id as lid


def best_by_trying(scores, fresh, switch):
    n, many = scores.shape
    value = lambda p: sum(scores[t, x] for t, x in enumerate(p)) - sum(switch for t in range(1, n) if p[t] != p[t - 1] and not fresh[t])
    return max(map(value, itertools.product(range(many), repeat=n))), value


@pytest.mark.parametrize("block", [1, 2, 3, 512])
def test_path_is_the_best_of_all(block):
    rng = np.random.default_rng(block)
    for n, many in ((1, 3), (2, 2), (5, 3), (7, 2), (7, 1)):
        for _ in range(20):
            scores, fresh = -rng.integers(0, 9, (n, many)).astype(float), rng.random(n) < 0.2
            best, value = best_by_trying(scores, fresh, 4.0)
            path = lid.best_path(scores, fresh, 4.0, block)
            assert len(path) == n and value(path) == best
    assert len(lid.best_path(np.zeros((0, 2)), np.zeros(0, dtype=bool))) == 0


def corpus(spark):
    words = {"en": "the cat and that house with this", "de": "der hund und das haus mit dieser", "ru": "кот и дом это вода", "fr": "le chat et la maison avec cette"}
    rows = [(k, " ".join(words[lang].split()[(k + j) % 5] for j in range(12)), lang, "s", 0) for lang in words for k in range(40)]
    return spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], DOCS)


@pytest.fixture(scope="module")
def model(spark):
    return lid.fit(corpus(spark))


def test_spans_of_mixed_texts(model):
    assert model.languages == ["de", "en", "fr", "ru"]
    text = "the cat and that house with this cat -- der hund und das haus mit der; кот и дом, 12 кот!"
    ((letters, spans),) = lid.Labeller(model).label([text])
    assert [s[0] for s in spans] == ["en", "de", "ru"]
    assert [text[a:b] for _, a, b in spans] == ["the cat and that house with this cat", "der hund und das haus mit der", "кот и дом, 12 кот"]
    assert letters.sum() == sum(c.isalpha() for c in text)
    (_, one_word), = lid.Labeller(model).label(["the cat and that hund house with this cat"])
    assert [s[0] for s in one_word] == ["en"]  # one foreign word is not worth two changes


def test_scripts_narrow_the_candidates(model):
    known, unknown, unlisted = model.scores(["вода", "незнакомо", "日本"])
    assert known.tolist().count(0.0) == 1 and model.languages[int(unknown.argmax())] == "ru"
    assert not unlisted.any()  # of no learned script: says nothing
    names = [lid._NAMES[k] for k in lid.scripts_of(["a", "é", "ж", "ω", "日", "ひ", "한", "\U00010000", "×"])]
    assert names == ["latin", "latin", "cyrillic", "greek", "han", "kana", "hangul", "other", "latin"]


def test_long_texts_in_portions(model):
    labeller, text = lid.Labeller(model), "the cat and that house with this. " * 40 + "der hund und das haus mit dieser. " * 40
    assert labeller.whole(text, len(text))[1] == labeller.label([text])[0][1]
    letters, spans = labeller.whole(text, 100)
    assert [s[0] for s in spans] == ["en", "de"] and letters.sum() == sum(c.isalpha() for c in text)
    assert abs(spans[1][1] - text.index("der hund")) < 40 and spans[-1][2] == len(text.rstrip(" ."))
    assert labeller.whole("x" * 1000, 64)[0].sum() == 1000  # a word is never cut


def test_rows(spark, model):
    texts = [None, "", "12 — !", "日本", "der hund und das haus"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in lid.identify(docs, model, 8).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[4][0] == "de" and got[3][0] in model.languages
    for clashing in (False, True):
        rows = lid.identify(edge_docs(spark, clashing), lid.fit(edge_docs(spark, clashing))).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in edge_rows())
        assert all(r.lang_pred == "und" for r in rows if r.score == 0)
    assert lid.identify(no_docs(spark), lid.fit(no_docs(spark))).collect() == []
    assert [r.lang_pred for r in lid.identify(docs, lid.Model()).collect()] == ["und"] * 5


def test_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    mark = {r.doc_id: r.h for r in docs.select("doc_id", lid.held_out().alias("h")).collect()}
    assert mark == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in mark}
    model = lid.fit(docs)
    of = {r.doc_id: r.lang for r in docs.collect()}
    got = [(r.lang_pred, of[r.doc_id]) for r in lid.identify(docs, model).collect() if mark[r.doc_id]]
    assert got and np.mean([a == b for a, b in got]) >= 0.97
    # what is held out is not learned from, and neither id nor lang goes into a prediction
    changed = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 'xx' ELSE lang END AS lang")
    assert lid.fit(changed).languages == model.languages
    plain = lid.identify(docs.selectExpr("-1L AS doc_id", "text", "'xx' AS lang"), model)
    assert sorted(r.lang_pred for r in plain.collect()) == sorted(r.lang_pred for r in lid.identify(docs, model).collect())


def test_sample_is_bounded_by_language(spark):
    docs = corpus(spark)
    few = lid.sample(docs, 5).groupBy("lang").count().collect()
    assert {(r.lang, r["count"]) for r in few} == {(lang, 5) for lang in ("de", "en", "fr", "ru")}
