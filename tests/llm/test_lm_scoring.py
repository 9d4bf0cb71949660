import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from helpers import edge_docs, no_docs

from pyspark.sql import functions as F

from riskloom.llm import lm_scoring

IDS = "doc_id long"


def by_hand(rows, target):
    """Exact counts of all words and pairs; the start of a text stands before its first word."""
    texts = [(doc, (text or "").encode().lower().split()) for doc, text in rows]
    types = len({w for _, ws in texts for w in ws})

    def model(chosen):
        words, before, pairs = Counter(), Counter(), Counter()
        for ws in chosen:
            words.update(ws)
            before.update([None, *ws][: len(ws)])
            pairs.update(zip([None, *ws], ws, strict=False))
        total, mu = sum(words.values()), lm_scoring.SMOOTHING
        return lambda v, w: -math.log((pairs[v, w] + mu * (words[w] + 1) / (total + types)) / (before[v] + mu))

    wanted, general = model([ws for d, ws in texts if d in target]), model([ws for _, ws in texts])
    out = []
    for doc, ws in texts:
        losses = [sum(m(*p) for p in zip([None, *ws], ws, strict=False)) / len(ws) if ws else None for m in (wanted, general)]
        out.append((doc, len(ws), *losses))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(131_072, 1024, 1 << 21, 1 << 23), (40, 5, 1000, 2000)])
def test_scores_equal_brute_force(spark, small, sizes):
    for docs, target in ((edge_docs(spark, True), [6, 7, 8, 8, None, 999]), (spark.read.parquet(f"{small}/documents.parquet"), list(range(0, 200, 3)))):
        want = by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], set(target) - {None})
        ids = spark.createDataFrame([(i,) for i in target], IDS)
        got = sorted((tuple(r)[:4] for r in lm_scoring.score(docs, ids, *sizes).collect()), key=str)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(g[2:] == (pytest.approx(w[2:], rel=1e-9) if w[1] else w[2:]) for g, w in zip(got, want, strict=True))


def test_very_many_words_of_one_count(spark):
    rows = [(i, " ".join(f"w{i * 1000 + k}" for k in range(1000)) + " the the") for i in range(140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r)[:4] for r in lm_scoring.score(docs, spark.createDataFrame([(1,), (2,)], IDS)).collect()), key=str)
    for g, w in zip(got, by_hand(rows, {1, 2}), strict=True):
        assert g[:2] == w[:2] and g[2:] == pytest.approx(w[2:], rel=1e-9)


def test_one_pair_in_a_third_of_all_tokens_stays_out_of_the_groups(spark):
    rows = [(i, "hot pair " * 50 + f"rare{i} other{i % 7}") for i in range(300)]
    marked = lm_scoring._marked(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1,)], IDS))
    counts = lm_scoring.word_counts(marked)
    top = lm_scoring.hot_words(counts, 10)
    pairs = {r.cell: (r.n, r.t) for r in lm_scoring.frequent_pairs(marked, [r.word for r in top[:2]]).collect()}
    assert pairs == {1: (300, 1), 3 * 1 + 2: (15_000, 50), 3 * 2 + 1: (14_700, 49)}
    totals = counts.agg(*[F.sum(c).alias(c) for c in ("n", "t", "n_last", "t_last")], F.count("*").alias("types")).first()
    sent = lm_scoring._Sender(lm_scoring.Models(totals, top, 2, pa.table({"cell": [1], "n": [300], "t": [1]})), 64).sent(
        [i for i, _ in rows], [i for i, _ in rows], [t.encode() for _, t in rows], [i == 1 for i, _ in rows])
    tokens = sum(len(lm_scoring._unpacked(d.as_py(), "u8", "u4", "u4")[0]) for k, d in zip(sent["kind"].to_pylist(), sent["data"], strict=True) if k == 0)
    assert tokens <= 300


def test_hashes_of_words_do_not_depend_on_their_place(monkeypatch):
    rng = random.Random(5)
    texts = [b" ".join(bytes(rng.choices(b"abAB\xc3\xa9\x1c\x85 \t\n\x0b\x0c\r", k=rng.randrange(0, 12))) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += [b"", b"word", b" word", b"x" * 500, b"x" * 501, b"long text " * 300]
    whole = lm_scoring.hashes(texts)
    words = [t.lower().split() for t in texts]
    assert whole[1].tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    alone = {w: int(lm_scoring.hashes([w])[0][0]) for w in flat}
    assert whole[0].tolist() == [alone[w] for w in flat] and len(set(alone.values())) == len(alone)
    monkeypatch.setattr(lm_scoring, "_AT_ONCE", 64)
    lm_scoring._kept_powers.cache_clear()
    assert lm_scoring.hashes(texts)[0].tolist() == whole[0].tolist()
    lm_scoring._kept_powers.cache_clear()


def test_target_texts_score_lower(spark):
    rows = [(i, ("good plain words here " if i % 2 else "other noise stuff there ") * 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score(docs, spark.createDataFrame([(i,) for i in range(1, 20, 2)], IDS)).collect()}
    assert max(s for i, s in got.items() if i % 2) < min(s for i, s in got.items() if not i % 2)


def test_no_target_and_no_documents(spark):
    none = spark.createDataFrame([], IDS)
    docs = edge_docs(spark)
    uniform = {round(r.target_loss, 9) for r in lm_scoring.score(docs, none).collect() if r.n_tokens}
    assert len(uniform) == 1
    assert lm_scoring.score(no_docs(spark), none).count() == 0


def test_hot_words_are_whole_classes_of_counts(spark):
    table = spark.createDataFrame([(1, 5), (2, 5), (3, 2), (4, 1), (5, 1)], "word long, n long")
    for most, want in ((5, [1, 2, 3, 4, 5]), (4, [1, 2, 3]), (1, [])):
        assert [r.word for r in lm_scoring.hot_words(table, most)] == want
