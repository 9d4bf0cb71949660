import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from helpers import edge_docs, no_docs, plain, roots

from riskloom.llm import bitslice, components, exact_dedup, simhash_dedup


def exact_by_hand(rows):
    groups = {}
    for n, (doc, text) in enumerate(rows):
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc is None, doc or 0, n))
    out = []
    for key, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(key.encode()).hexdigest()
        for m in members:
            out.append((None if m[1] else m[2], None if best[1] else best[2], len(members), sha))
    return out, len(groups)


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_decisions_equal_brute_force(spark, clashing):
    docs = edge_docs(spark, clashing)
    want, groups = exact_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = exact_dedup.decisions(docs).selectExpr("doc_id", "keep_id", "group_size", "lower(hex(digest)) sha", "kept").collect()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_deduplicate_keeps_one_whole_row_of_each_text(spark):
    docs = edge_docs(spark, True)
    stays = exact_dedup.deduplicate(docs)
    assert stays.columns == docs.columns
    _, groups = exact_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert stays.count() == groups


def test_exact_frequent_digest_is_found_and_decided_alike(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 3 = 0, concat('hot', space(cast(id % 7 as int))), concat('t', id)) AS text")
    digests = docs.select("doc_id", *exact_dedup._keyed(docs))
    heavy = exact_dedup.frequent_digests(digests)
    hot = hashlib.sha256(b"hot").digest()
    assert bytes(hot) in [bytes(r.digest) for r in heavy.collect()]
    got = exact_dedup.decisions(docs).where("group_size > 1").selectExpr("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in got] == [(6, 1334)]


def test_empty_tables(spark):
    assert exact_dedup.decisions(no_docs(spark)).count() == 0
    assert exact_dedup.deduplicate(no_docs(spark)).count() == 0
    assert simhash_dedup.classes(no_docs(spark)).count() == 0
    assert simhash_dedup.deduplicate(no_docs(spark)).count() == 0


def slow_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, "A", "a b", "a B c", "É é x y z", "a\x85b c d \x1c e", "x y x y x y x"])
def test_fingerprint_equals_definition(text):
    assert int.from_bytes(simhash_dedup.block_sketch()((text or "").encode())[0], "big") == slow_fingerprint(text)


def classes_by_hand(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    up = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for (doc, _), r in zip(rows, up, strict=True):
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return [(doc, p, least.get(r)) for (doc, _), p, r in zip(rows, prints, up, strict=True)]


def test_simhash_classes_equal_brute_force(spark, small):
    for docs in (edge_docs(spark, True), spark.read.parquet(f"{small}/documents.parquet")):
        want = classes_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        got = [(r.doc_id, int.from_bytes(r.fp, "big"), r.component_id) for r in simhash_dedup.classes(docs).collect()]
        key = lambda r: tuple((v is None, str(v)) for v in r)
        assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("chunk", [8192, 40])
def test_links_connect_all_close_fingerprints(spark, monkeypatch, chunk):
    """A dense cluster, copies of it far away, and noise; with small chunks every bucket is cut up."""
    monkeypatch.setattr(simhash_dedup, "CHUNK", chunk)
    rng = random.Random(3)
    values = set()
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        values |= {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 7))) & (2**64 - 1) for _ in range(150)}
    values = sorted((v & (2**64 - 1)) for v in values | {rng.getrandbits(64) for _ in range(300)})
    masks = simhash_dedup._masks()
    rows = [(v.to_bytes(8, "big"), [v & m if v & m < 2**63 else (v & m) - 2**64 for m in masks]) for v in values]
    nodes = spark.createDataFrame(rows, "fp binary, keys array<long>").repartition(4)
    found = simhash_dedup.links(nodes, 3).collect()
    at = {v.to_bytes(8, "big"): i for i, v in enumerate(values)}
    near = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3]
    assert roots(len(values), [(at[bytes(r.a)], at[bytes(r.b)]) for r in found]) == roots(len(values), near)


@pytest.mark.parametrize("nearest", [False, True])
@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 9])
def test_bit_sliced_groups_of_all_sizes(monkeypatch, radius, nearest):
    rng = np.random.default_rng(radius)
    monkeypatch.setattr(bitslice, "LARGE", 40)
    monkeypatch.setattr(bitslice, "LANES", 150)
    monkeypatch.setattr(bitslice, "BLOCK", 1)
    sizes = np.array([1, 2, 3, 70, 1, 40, 130, 17, 2, 5])
    parts = []
    for n in sizes:
        centre = rng.integers(0, 2**63, dtype=np.uint64)
        flips = rng.integers(0, 64, size=(n, 4)).astype(np.uint64)
        parts.append(centre ^ np.bitwise_xor.reduce(np.uint64(1) << flips, axis=1))
    values = np.concatenate(parts)
    a, b = bitslice.spanning_links(values[:, None], sizes, radius, nearest)
    a, b = values[a], values[b]
    order = {}
    for v in values:
        order.setdefault(int(v), len(order))
    got = roots(len(order), [(order[int(x)], order[int(y)]) for x, y in zip(a, b, strict=True)])
    near = [(order[int(x)], order[int(y)]) for p in parts for x in p for y in p if (int(x) ^ int(y)).bit_count() <= radius]
    assert got == roots(len(order), near)


def test_components_of_chain_star_and_loop(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 8), (8, 9), (9, 7), (3, 3)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(90)]
    nodes = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    up = roots(len(nodes), [(at[a], at[b]) for a, b in pairs])
    want = [(x, nodes[up[at[x]]]) for x in nodes if nodes[up[at[x]]] != x]
    links = spark.createDataFrame(pairs + [(None, 4)], "a long, b long").repartition(3)
    assert plain(components.connected(links)) == sorted(want, key=lambda r: tuple((False, str(v)) for v in r))


def test_near_deduplicate_keeps_the_first_of_each_class(spark):
    docs = edge_docs(spark, True)
    stays = simhash_dedup.deduplicate(docs)
    assert stays.columns == docs.columns
    want = [r for r in simhash_dedup.near_classes(docs).collect() if r.doc_id is None or r.doc_id == r.component_id]
    ids = lambda rows: sorted(str(r.doc_id) for r in rows)
    assert ids(stays.collect()) == ids(want)


def test_near_classes_find_edited_copies_and_leave_others(spark):
    rng = random.Random(8)
    texts = {}
    for i in range(120):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 400))]
        texts[10 * i] = " ".join(words)
        for j in range(1, rng.randrange(1, 4)):
            copy = list(words)
            for _ in range(max(1, len(words) // 120)):
                copy[rng.randrange(len(copy))] = "changed"
            texts[10 * i + j] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_classes(docs).collect()}

    def grams(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    similar = [i for i in texts if i % 10 and len(grams(texts[i]) & grams(texts[i // 10 * 10])) / len(grams(texts[i]) | grams(texts[i // 10 * 10])) >= 0.8]
    assert len(similar) > 50
    assert sum(got[i] == i // 10 * 10 for i in similar) >= 0.98 * len(similar)
    assert all(got[i] // 10 == i // 10 for i in texts)
    one = spark.createDataFrame([(1, "word " * 400), (2, "word " * 300), (3, "other " * 300)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash_dedup.near_classes(one).collect()} == {1: 1, 2: 1, 3: 3}


def test_nearest_forest_has_the_least_total():
    rng = random.Random(6)
    for n in (1, 2, 9, 40):
        edges = [(i, j, rng.randrange(6)) for i in range(n) for j in range(i) if rng.random() < 0.3]
        left, right, d = (np.array([e[k] for e in edges], dtype=np.int64) for k in range(3))
        chosen = bitslice.nearest_forest(n, left, right, d)
        total, up = 0, list(range(n))
        for i, j, x in sorted(edges, key=lambda e: e[2]):
            if up[i] != up[j]:
                up = [up[j] if u == up[i] else u for u in up]
                total += x
        assert d[chosen].sum() == total
        assert len(chosen) == n - len(set(up))


def test_equal_fingerprints_of_different_texts_are_not_merged(spark):
    """One passage so frequent that it alone would fix every bit of a fingerprint that counts repeats."""
    rng = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(15))
    texts = [" ".join([passage] * 100 + [f"w{rng.randrange(10**6)}" for _ in range(400)]) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash_dedup.near_classes(docs).collect()} == {0: 0, 1: 1, 2: 2}


def test_repeats_do_not_part_texts_of_equal_shingles(spark):
    """Equal and similar sets of shingles, one passage repeated in one of the texts."""
    rng = random.Random(13)
    texts = {}
    for i in range(20):
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        texts[10 * i] = " ".join(words)
        texts[10 * i + 1] = " ".join([*words[:24] * 30, *words[24:]])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_classes(docs).collect()}
    assert got == {i: i // 10 * 10 for i in texts}


@pytest.mark.parametrize(("common", "left", "right"), [(400, 50, 50), (40, 5, 5), (8, 1, 1), (4, 0, 1), (8, 0, 2)])
def test_radius_holds_similarity_of_just_the_limit(common, left, right):
    """``common`` shingles in both texts and some of their own: similarity 0.8, over many random sets."""
    rng = np.random.default_rng(common + right)
    beyond = 0
    for _ in range(2000):
        bits = rng.integers(0, 2, size=(common + left + right, 256), dtype=np.int8)
        a, b = bits[: common + left], np.concatenate([bits[:common], bits[common + left :]])
        beyond += int(((2 * a.sum(axis=0) > len(a)) != (2 * b.sum(axis=0) > len(b))).sum() > simhash_dedup.NEAR_RADIUS)
    assert beyond <= 1


def test_near_classes_of_copies_around_the_limit_equal_brute_force(spark):
    """Copies of one text with similarities on both sides of 0.8: many nearest links fail, others must be tried."""
    rng = random.Random(15)
    texts = {}
    for i in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(154)]
        for j in range(25):
            copy = list(base)
            for at in rng.sample(range(len(copy)), rng.choice([1, 2, 2, 3, 3, 3])):
                copy[at] = f"w{rng.randrange(10**6)}"
            texts[100 * i + j] = " ".join(copy + [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 12))])
    sets = []
    for text in texts.values():
        words = text.split()
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    up = roots(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    ids = list(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_classes(docs).collect()}
    assert got == {i: ids[r] for i, r in zip(ids, up, strict=True)}
    assert 12 < len(set(up)) < 120


@pytest.mark.parametrize(("chunk", "chunk_bytes", "looked_up"), [(8192, 8 << 20, 1 << 20), (20, 15_000, 500)])
def test_template_below_the_limit_makes_no_rows_of_pairs(spark, monkeypatch, chunk, chunk_bytes, looked_up):
    """Texts of one template, most pairs below 0.8: few rows leave the tasks, and the classes are those of all pairs."""
    monkeypatch.setattr(simhash_dedup, "CHUNK", chunk)
    monkeypatch.setattr(simhash_dedup, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(simhash_dedup, "LOOKED_UP", looked_up)
    rng = random.Random(21)
    base, texts = [f"w{k}" for k in range(150)], []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.choice([2, 4, 5, 5])):
            copy[at] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    want = roots(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    counted, stored = {}, simhash_dedup.stored

    def counting(df, name):
        out = stored(df, name)
        counted[name] = max(counted.get(name, 0), out.count())
        return out

    monkeypatch.setattr(simhash_dedup, "stored", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_classes(docs).collect()}
    assert got == dict(enumerate(want))
    assert len(set(want)) > 10
    assert counted["open"] <= 60 * 16
    if chunk == 8192:
        assert counted["joining"] < 60


def test_close_pairs_are_all_pairs(monkeypatch):
    monkeypatch.setattr(bitslice, "LARGE", 20)
    monkeypatch.setattr(bitslice, "LANES", 50)
    rng = np.random.default_rng(4)
    sizes = np.array([3, 1, 45, 20, 2, 150])
    values = rng.integers(0, 2**63, size=(sizes.sum(), 1), dtype=np.uint64) & np.uint64(0xFFFF)
    group = np.repeat(np.arange(len(sizes)), sizes)
    got = sorted(tuple(sorted(p)) for i, j in bitslice.close_pairs(values, sizes, 5) for p in zip(i.tolist(), j.tolist(), strict=True))
    n = len(values)
    want = [(i, j) for i in range(n) for j in range(i + 1, n) if group[i] == group[j] and (int(values[i, 0]) ^ int(values[j, 0])).bit_count() <= 5]
    assert got == sorted(want)
