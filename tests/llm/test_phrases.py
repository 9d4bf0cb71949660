"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from helpers import edge_docs, edge_rows, no_docs

from riskloom.llm import phrases


def brute(rows, least: int, top: int = 2000) -> list[tuple]:
    counts: dict[str, Counter] = {}
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = total[lang]
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        best = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["a", "b", "C", "ä", "Ä", "d", "\x00", "日本", "x" * 300]
    rows = []
    for _ in range(120):
        gaps = [rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ; ", "\x0b", "\x1c", "\x85"]) for _ in range(40)]
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(rng.choice(words) + g for g in gaps)))
    rows += [("en", "one two three four five six seven")] * 9 + [("en", None), (None, ""), ("fr", "...")]
    return rows


@pytest.mark.parametrize("flush,bits", [(phrases.FLUSH, phrases.FILTER_BITS), (37, 1 << 12)])
def test_phrases_equal_brute_force(spark, flush, bits):
    rows = texts(3)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for least, top in ((4, 2000), (9, 7)):
        got = found(phrases.collocations(docs, least, top, flush=flush, bits=bits))
        assert got == brute(rows, least, top) and got


def test_edges(spark):
    want = brute([(r[2], r[1]) for r in edge_rows()], 2)
    assert found(phrases.collocations(edge_docs(spark), 2)) == want
    assert found(phrases.collocations(edge_docs(spark, clashing=True), 2)) == want
    assert found(phrases.collocations(no_docs(spark))) == []


def test_runs_of_long_texts_lose_nothing(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 50)
    rows = [(lang or "und", (text or "").encode()) for lang, text in texts(5)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], names=["lang", "data"])
    seen = []
    for run in phrases.runs([batch], 23):
        assert len(run.ids) <= 23 + 60
        seen += [(run.names[lang], run.vocabulary[w]) for lang, w in zip(run.langs[run.new :], run.ids[run.new :])]
    want = []
    for lang, data in rows:
        data = data.translate(phrases._TABLE).replace(b"\xff", b" \xff ")
        want += [(lang, w) for w in data.split()] + [(lang, b"\xff")]
    assert seen == want


def test_products_beyond_64_bits_are_exact(spark):
    a, n, left, right = 9 * 10**11, 7 * 10**14, 10**12 + 7, 10**12 + 13
    rows = [("en", "", None, n - left - right), ("en", "", "x", left), ("en", "", "y", right), ("en", "x", "y", a)]
    merged = spark.createDataFrame(rows, "lang string, prefix string, next string, n long")
    (row,) = phrases.scored(merged).collect()
    assert row.score == int(Decimal(1000) * a * n // (Decimal(left) * right)) == 1000 * a * n // (left * right)
    assert (row.l, row.r, row.n) == (left, right, n)


def test_marks_have_no_gaps():
    values = np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64)
    bitmap = np.zeros((1 << 16) // 8, np.uint8)
    place = values & np.uint64((1 << 16) - 1)
    np.bitwise_or.at(bitmap, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    assert phrases.marked(bitmap, values).all() and not phrases.marked(bitmap ^ 255, values).any()
