"""Fill-in-the-middle rewriting: exact round trips and the plain way on whole texts."""

import hashlib
import random
import re

import pytest
from helpers import CLASHES, edge_docs, edge_rows, no_docs

from riskloom.llm import fill_middle as fim


def plain_way(doc_id, text) -> tuple:
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def mixed(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(["ab", "Z", " ", "é", "日", "😀", "\n", "7", "<", ">", "P", "<S", "M>", "\x00", "longerword"]) for _ in range(n))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 16])
def test_frames_of_any_size_give_the_same(size):
    rng = random.Random(size)
    for doc_id in range(60):
        text = mixed(rng, rng.choice([0, 1, 2, 5, 40]))
        want = plain_way(doc_id, text)
        frames = fim.Frames.of(text.encode(), size)
        assert frames.units == want[1]
        form, parts = fim.chosen(frames, bool(re.search("<[PSM]>", text)), doc_id)
        assert form == want[2]
        if parts:
            assert (parts[0][1][2], parts[1][1][2] - parts[1][0][2]) == want[3:5]
        out = b"".join(fim.output(frames, form, parts))
        assert out.decode() == want[5]
        for step in (1, 2, 5, len(out) + 1):  # whatever pieces the output comes in
            stream = [out[k : k + step] for k in range(0, len(out), step)]
            assert b"".join(fim.restored(stream, form, size)).decode() == text


def test_a_cut_opens_one_frame(monkeypatch):
    text = " ".join(f"word{k}" for k in range(20_000))
    frames = fim.Frames.of(text.encode(), 4096)
    opened = []
    read = fim.Frames.read
    monkeypatch.setattr(fim.Frames, "read", lambda self, k: opened.append(k) or read(self, k))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    for unit in (0, 1, 777, 30_000, len(units) - 1, len(units)):
        opened.clear()
        assert frames.place(unit)[2] == sum(map(len, units[:unit])) and len(opened) <= 1


def test_output_without_its_marks_is_refused():
    for broken in (b"<P>a<M>b", b"x<P>a<S>b<M>c", b""):
        with pytest.raises(ValueError):
            list(fim.restored([broken], "psm"))


def test_documents(spark):
    rng = random.Random(8)
    rows = [(r[0], r[1]) for r in edge_rows()] + [(100 + k, mixed(rng, k % 90)) for k in range(300)] + [(k, "a<M>b") for k in (900, 901)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'x' AS {c}" for c in CLASHES], "'y' AS frames").repartition(3)
    want = [plain_way(*r) for r in rows]
    store = fim.framed(docs, 256)
    got = sorted((tuple(r) for r in fim.rewrites(store).collect()), key=str)
    assert got == sorted(((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows)), key=str)
    assert sorted((tuple(r) for r in fim.texts(store).collect()), key=str) == sorted(((w[0], w[2], w[5]) for w in want), key=str)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_edges(spark):
    for clashing in (False, True):
        got = fim.rewrites(fim.framed(edge_docs(spark, clashing)))
        assert sorted((r.doc_id is None, r.doc_id, r.n, r.form) for r in got.collect() if r.doc_id is not None) == sorted(
            (False, *plain_way(r[0], r[1])[:3]) for r in edge_rows() if r[0] is not None)
    assert fim.rewrites(fim.framed(no_docs(spark))).collect() == []
