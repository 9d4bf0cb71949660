"""Licence notices in texts, by matching statistics against a suffix automaton of their words.

The notices of all licences form one generalised suffix automaton over words. A text is streamed through it once:
at every word the automaton gives the longest run of words, ending there, that occurs in some notice, so the work
does not grow with the number of notices. Maximal runs are chained per notice, in order and with small gaps, and
the part of the notice that a chain covers is its score. A notice covered by at least ``COVERED``, or by a run that
``LONG`` words long, adds its label.

Defined results: words are runs of characters other than ASCII punctuation, space and control characters, with A-Z
lower-cased; null and empty texts have no words and no labels; labels are distinct, sorted and comma-joined, the
empty string where there is none; repeated rows are scanned each; a null doc_id is kept; an empty table gives an
empty one; other columns are not looked at.
"""

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_bytes

#: Share of a notice that must be covered; words of a single run that suffice; shortest run; widest gap in a chain.
COVERED, LONG, SHORTEST, GAP = 0.75, 12, 3, 6

# Phrases whose every place is reported, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Usual licence notices.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
                   "http www apache org licenses license 2 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without prior written permission"),
]

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(data: bytes) -> list[bytes]:
    """Words of a UTF-8 text; characters beyond ASCII are word characters."""
    return _WORDS.findall(data.lower())


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers. A state knows the length of its longest run and one place in
    every notice it occurs in (``ends``: notice number to the number of words up to the end of the run)."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for runs as long as ``state`` allows; edges to the longer one are moved."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return new

    @classmethod
    def of(cls, notices: list[list[int]]) -> "Automaton":
        made = cls()
        for words in notices:
            last = 0
            for word in words:
                last = made._extend(last, word)
        for number, words in enumerate(notices):
            state = 0
            for end, word in enumerate(words, 1):
                state = made.next[state][word]
                up = state
                while up > 0 and number not in made.ends[up]:
                    made.ends[up][number] = end
                    up = made.link[up]
        return made

    def matches(self, words: list[int]):
        """(state, length) after every word: the longest run ending there that occurs in a notice."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            after = self.next[state].get(word)
            if after is None:
                state = length = 0
            else:
                state, length = after, length + 1
            yield state, length


class Scanner:
    """Notices, phrases and their automaton; built once in every worker."""

    def __init__(self, notices: list[tuple[str, str]], phrases: dict[str, str]):
        self.labels = [label for label, _ in notices]
        split = [text.encode().split() for _, text in notices]
        self.numbers: dict[bytes, int] = {}
        for words in [*split, *(p.encode().split() for p in phrases)]:
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        self.sizes = [len(words) for words in split]
        self.automaton = Automaton.of([[self.numbers[w] for w in words] for words in split])
        self.phrases = [([self.numbers[w] for w in p.encode().split()], label) for p, label in phrases.items()]

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(start, end) of the stretches of known words that are long enough to matter."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= SHORTEST
        return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))

    def maximal(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(end in the text, length, state) of the runs that cannot be made longer on either side."""
        out = []
        for start, end in self.runs(ids):
            before = (0, 0)
            for at, found in enumerate(self.automaton.matches(ids[start:end].tolist()), start):
                if found[1] <= before[1] and before[1] >= SHORTEST:
                    out.append((at, before[1], before[0]))
                before = found
            if before[1] >= SHORTEST:
                out.append((end, before[1], before[0]))
        return out

    def chains(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, words covered) of the best chain of every notice that has one.

        A chain goes on where the next run follows in the notice and after at most ``GAP`` words of the text.
        """
        open_: dict[int, list[int]] = {}
        best: dict[int, tuple[int, int, int]] = {}
        for end, length, state in self.maximal(ids):
            for notice, place in self.automaton.ends[state].items():
                start, covered, fresh = end - length, length, length
                held = open_.get(notice)
                if held and end - length - held[1] <= GAP and place > held[2]:
                    fresh = min(length, place - held[2], end - held[1])
                    start, covered = held[0], held[3] + max(0, fresh)
                    if covered < length:
                        start, covered = end - length, length
                open_[notice] = [start, end, place, covered]
                if covered > best.get(notice, (0, 0, 0))[2]:
                    best[notice] = (start, end, covered)
        return [(n, *b) for n, b in sorted(best.items())]

    def scan(self, data: bytes):
        """(number of words, phrase places, notice chains) of a text."""
        words, get = words_of(data), self.numbers.get
        ids = np.array([get(w, 0) for w in words], dtype=np.int32)
        places = []
        for phrase, label in self.phrases:
            n = len(ids) - len(phrase) + 1
            if n > 0:
                hit = np.logical_and.reduce([ids[k : k + n] == w for k, w in enumerate(phrase)])
                places += [(int(p), label) for p in np.flatnonzero(hit)]
        chains = self.chains(ids) if len(ids) else []
        kept = [(self.labels[n], a, b, c / self.sizes[n]) for n, a, b, c in chains
                if c >= COVERED * self.sizes[n] or c >= LONG]
        score = max((c / self.sizes[n] for n, _, _, c in chains), default=0.0)
        return len(words), sorted(places), kept, min(1.0, score)


_scanners: dict[str, Scanner] = {}


def find(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """(doc_id, n_words, phrases, notices, score): phrase places and covered notices of every row.

    ``phrases`` holds (start, label), ``notices`` (label, start, end, covered), in words from 0. ``score`` is the
    largest part of a notice that a chain covers.
    """
    place = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())]))

    def run(batches):
        key = repr((notices, phrases))
        scanner = _scanners.get(key) or _scanners.setdefault(key, Scanner(notices, phrases))
        for batch in batches:
            found = [scanner.scan(data) for data in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n for n, _, _, _ in found], pa.int64()),
                pa.array([[{"start": s, "label": x} for s, x in p] for _, p, _, _ in found], place),
                pa.array([[dict(zip(("label", "start", "end", "covered"), k, strict=True)) for k in c] for _, _, c, _ in found], span),
                pa.array([s for _, _, _, s in found], pa.float64())], names=["doc_id", "n_words", "phrases", "notices", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    return rows.mapInArrow(
        run, "doc_id long, n_words long, phrases array<struct<start:long,label:string>>, "
        "notices array<struct<label:string,start:long,end:long,covered:double>>, score double")
