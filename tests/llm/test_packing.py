import random
import zlib

import numpy as np
import pytest
from helpers import edge_docs, no_docs
from tokenizers import Tokenizer

from riskloom.llm import packing


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


@pytest.mark.parametrize("group", [8192, 3])
def test_every_id_lies_in_exactly_one_place(spark, small, group):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for docs in (edge_docs(spark, True), spark.read.parquet(f"{small}/documents.parquet")):
        want = {}
        for r in docs.select("doc_id", "text").collect():
            ids = ids_of(tokenizer, r.text)
            for start in range(0, len(ids), 2048):
                piece = ids[start : start + 2048]
                key = (r.doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                want[key] = want.get(key, 0) + 1
        got, sequences = {}, {}
        for r in packing.pack_documents(docs, group=group).collect():
            key = (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
            got[key] = got.get(key, 0) + 1
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert got == want
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048


def test_remembered_words_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    tokenizer, encoder = Tokenizer.from_file(packing.default_tokenizer()), packing.Encoder(packing.default_tokenizer())
    texts = ["The QUICK brown-fox, jumps. over... 12 Über straße! ÇA été, ľ İi ŉ ſ µ K Å ﬁ", "ABC,. d,e. .f",  "a b c", "d e f g", "it's a b x1y22 z...", "ΣΑΣ ς q", "ẛ̣ ¼ don't<|endoftext|>x", "á b﻿c", "x" * 5000, ""] * 2
    want = [ids_of(tokenizer, t)[:-1].tobytes() for t in texts]
    assert encoder.encode(texts) == want
    assert [encoder.encode([t])[0] for t in texts] == want
    assert encoder.encode([]) == [] and len(encoder.known) <= 3


def test_texts_are_cut_into_few_at_a_time():
    texts = ["a" * n for n in (5, 30, 1, 1, 1, 99, 0, 4)]
    cuts = list(packing._few(texts, 10))
    assert [i for lo, hi in cuts for i in range(lo, hi)] == list(range(8))
    assert all(hi - lo == 1 or sum(map(len, texts[lo:hi])) <= 10 for lo, hi in cuts)
    assert list(packing._few([])) == []


def test_first_fit_decreasing_equals_plain_scan():
    rng = random.Random(2)
    for n in (0, 1, 2, 5, 64, 300):
        lengths = sorted((rng.choice([rng.randrange(1, 60), rng.randrange(1, 100), 100]) for _ in range(n)), reverse=True)
        room, want = [], []
        for x in lengths:
            b = next((i for i, r in enumerate(room) if r >= x), len(room))
            if b == len(room):
                room.append(100)
            want.append((b, 100 - room[b]))
            room[b] -= x
        assert packing.first_fit_decreasing(lengths, 100) == want


def test_no_documents(spark):
    assert packing.pack_documents(no_docs(spark)).count() == 0


def test_control_characters_and_special_tokens_give_the_tokenizers_ids():
    tokenizer, encoder = Tokenizer.from_file(packing.default_tokenizer()), packing.Encoder(packing.default_tokenizer())
    texts = [f"a{chr(c)}B {chr(c)} {chr(c)}{chr(c)}1" for c in range(0x180)]
    texts += ["\x1b[31mred\x1b[0m", "<|ENDOFTEXT|>", "a <|EndOfText|> b", "x<|endoftext|>Y <|startoftext|>", "< |endoftext|>", "<|", "|>"]
    assert encoder.encode(texts) == [ids_of(tokenizer, t)[:-1].tobytes() for t in texts]
    for unit in ("\x00", "\x1b[", "\x7f~"):
        assert encoder._unit(unit) == ids_of(tokenizer, unit)[:-1].tobytes()
