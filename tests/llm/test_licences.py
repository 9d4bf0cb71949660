import random
import re

import numpy as np
from helpers import edge_docs, no_docs

from riskloom.llm import licences, queries


def words_by_hand(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base_by_hand(text):
    words = words_by_hand(text)
    return len(words), sorted((i, label) for phrase, label in licences.PHRASES.items() for i in range(len(words))
                              if words[i : i + len(phrase.split())] == phrase.split())


def test_matching_statistics_equal_brute_force():
    rng = random.Random(3)
    for letters in (1, 2, 3, 6):
        notices = [[rng.randrange(1, letters + 1) for _ in range(rng.randrange(1, 14))] for _ in range(6)]
        notices.append(list(notices[0]))
        automaton = licences.Automaton.of(notices)
        parts = {tuple(n[i:j]) for n in notices for i in range(len(n)) for j in range(i + 1, len(n) + 1)}
        text = [rng.randrange(1, letters + 2) for _ in range(300)]
        for end, (state, length) in enumerate(automaton.matches(text), 1):
            want = max((k for k in range(1, 15) if k <= end and tuple(text[end - k : end]) in parts), default=0)
            assert length == want
            if length:
                run = text[end - length : end]
                holders = {i for i, n in enumerate(notices) for p in range(len(n)) if n[p : p + length] == run}
                assert set(automaton.ends[state]) == holders
                assert all(notices[i][p - length : p] == run for i, p in automaton.ends[state].items())


def test_notices_are_found_whole_and_in_pieces():
    scanner = licences.Scanner(licences.NOTICES, licences.PHRASES)

    def labels(text):
        return {x[0] for x in scanner.scan(text.encode())[2]}

    for label, text in licences.NOTICES:
        words = text.split()
        assert label in labels(f"some words of {text.title()}. and after")
        assert label in labels(" ,\n".join(words))
        if len(words) > 12:
            assert label in labels(" ".join(words[: len(words) // 2] + ["inserted", "word"] + words[len(words) // 2 :]))
    _, places, kept, score = scanner.scan(b"x Licensed under CC BY-NC 4.0. y")
    assert places == [(3, "cc-by")]
    assert [k[:3] for k in kept if k[0] == "cc-by-nc"] == [("cc-by-nc", 1, 8)]
    assert score == 1.0
    assert labels("the work is of the public and in the software to the license") == set()


def test_a_gap_ends_a_chain():
    scanner = licences.Scanner([("x", "a b c d e f g h")], {})
    assert scanner.chains(np.array([1, 2, 3, 4, 0, 0, 5, 6, 7, 8])) == [(0, 0, 10, 8)]
    assert scanner.chains(np.array([1, 2, 3, 4] + [0] * 20 + [5, 6, 7, 8])) == [(0, 0, 4, 4)]
    assert scanner.chains(np.array([5, 6, 7, 8, 0, 1, 2, 3])) == [(0, 0, 4, 4)]


def test_base_of_documents_equals_brute_force(spark, small):
    for docs in (edge_docs(spark, True), spark.read.parquet(f"{small}/documents.parquet"), spark.createDataFrame(
            [(1, "CC-BY cc\nby CC BY ccby c cc by"), (2, "All rights reserved all RIGHTS, reserved"), (3, "General Public\tLicenseé")],
            "doc_id long, text string")):
        want = sorted((str(r.doc_id), *base_by_hand(r.text)) for r in docs.select("doc_id", "text").collect())
        got = sorted((str(r.doc_id), r.n_words, [tuple(p) for p in r.phrases]) for r in licences.find(docs).collect())
        assert got == want
    assert licences.find(no_docs(spark)).count() == 0


def test_query(spark, small):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op8_licences(spark, small).collect()
    assert len(rows) == len(text)
    for r in rows:
        n, places = base_by_hand(text[r.doc_id])
        starts = [s for s, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    for line, label in (("MIT License.", "mit"), ("Apache License", "apache-2.0"), ("CC BY-NC 4.0", "cc-by-nc"), ("version 3.", "gpl-3.0")):
        assert all(label in r.labels.split(",") for r in rows if line in (text[r.doc_id] or ""))
    plain = [r for r in rows if not re.search("(?i)licen|reserved", text[r.doc_id] or "")]
    assert plain and all(r.labels == "" for r in plain)
