import random
import zlib

import numpy as np
import pytest
from helpers import edge_docs, no_docs

from riskloom.llm import queries, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def planted(spark):
    """400 documents of 1 to 30 sentences; half of them hold one or more bad words in a single sentence."""
    rng = random.Random(4)
    plain, bad = [f"{a}{b}" for a in "mno" for b in ("ar", "el", "is", "ot", "un")], ["zorkish", "zorked", "blargh"]
    docs, truth = [], {}
    for i in range(400):
        sentences = [[rng.choice(plain) for _ in range(rng.randrange(3, 12))] for _ in range(rng.randrange(1, 30))]
        if i % 2:
            n = rng.randrange(len(sentences))
            sentences[n].insert(1, rng.choice(bad))
            truth[i] = n
        docs.append((i, ". ".join(" ".join(s) for s in sentences) + "."))
    labels = [(i, 1, i % 2) for i in range(400)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS), truth


def test_finds_documents_and_sentences(planted):
    docs, labels, truth = planted
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.scores(docs, model).collect()}
    aside = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(aside) > 60
    assert all((got[i] >= toxicity.THRESHOLD) == bool(i % 2) for i in aside)
    places = {r.doc_id: r for r in toxicity.offending(docs, model).collect()}
    assert set(places) == set(truth)
    text = {r.doc_id: r.text for r in docs.collect()}
    for i, n in truth.items():
        assert text[i].split(".")[n] == text[i][places[i].start : places[i].end] == places[i].sentence


def test_held_out_labels_are_never_read(spark, planted):
    docs, labels, _ = planted
    aside = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    flipped = labels.selectExpr("doc_id", "quality", f"IF(doc_id IN ({','.join(map(str, aside))}), 1 - toxic, toxic) AS toxic")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.weights == b.weights and a.bias == b.bias
    assert {r.doc_id for r in docs.where(toxicity.held_out()).collect()} == set(aside)


def test_score_is_the_noisy_or_of_all_sentences():
    model = toxicity.Model({"bad$": 4.0, "bad": 1.0}, -3.0)
    logits = [-3 + 5, -3, -3 + 5 + 1, -3]
    want = 1 - np.prod([1 / (1 + np.exp(z)) for z in logits])
    assert model.score("Bad x. y y! bad badly\n z") == pytest.approx(want)
    assert model.score("") == 0 and model.score("x") == pytest.approx(1 / (1 + np.exp(3)))


def test_gradient_of_the_noisy_or_lowers_the_loss():
    docs = [([[0], [1]], 3, 1), ([[1]], 2, 0), ([[1, 1], [2]], 0, 0), ([[0, 2]], 5, 1), ([], 4, 0)] * 5
    weights, bias = toxicity.fit_noisy_or(docs, 3)
    assert weights[0] > 2 > 0 > bias and weights[0] > weights[1]


def test_edges(spark):
    docs = edge_docs(spark, True)
    none = spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(2, 1, 1), (3, 0, None), (None, 1, 1), (999, 1, 0)], LABELS)
    assert {r.score for r in toxicity.scores(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    one_kind = toxicity.scores(docs, toxicity.fit(docs, some)).collect()
    assert len(one_kind) == docs.count() and {r.score for r in one_kind} <= {0.0, 1.0}
    assert toxicity.scores(no_docs(spark), toxicity.fit(no_docs(spark), some)).count() == 0
    model = toxicity.Model({"eight$": 9.0}, -3.0)
    assert toxicity.remove_toxic(docs, model).columns == docs.columns
    assert docs.count() - toxicity.remove_toxic(docs, model).count() == 1
    assert toxicity.offending(docs, toxicity.Model({}, 0.0, 1.0)).count() == 0


def test_held_out_accuracy_on_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, sf).collect()}
    truth = [(got[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(g.score, g.predicted, y) for g, y in truth if g.held_out]
    assert sum(p == y for _, p, y in held) / len(held) > 0.95
    yes, no = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([a > b for a in yes for b in no]) > 0.95
