"""Near duplicates by SimHash, compared bit-sliced.

Every text becomes one fingerprint. Equal ones are merged first (``near_classes``: equal sets of shingles), so exact
copies cost one row. Fingerprints are sent to buckets in which close ones meet, and every bucket is compared with vertical bit planes (``bitslice``).
A bucket with more than ``CHUNK`` members is cut into chunks and each pair of chunks is compared in a task of its
own, so no bucket is held by one task. A task returns links to the smallest reachable member, never all pairs;
components over these links give the classes. Two kinds of fingerprint:

* ``classes``: 64 bits over three-word shingles. Those within three bits agree wholly in at least two of five
  blocks, so the ten buckets named by two blocks lose no link.
* ``near_classes``: 256 bits over the different five-word shingles, for a Jaccard similarity of 0.8 or more. Similarity
  0.8 lies at 39 bits with a deviation of 5.7, with four shingles against five (ties) at 48 with 6.2; the radius of 73
  is four deviations beyond the latter. Texts meet where the least values of three hash functions over their
  shingles agree, in any of 16 such triples (similarity 0.8 misses all of them once in 100,000). The links of a
  bucket are first those of a minimum spanning forest, so that a copy is linked with what it was copied from rather
  than with another copy; each is then verified by the exact similarity of the two sets of shingles. So is, after
  that, every other pair of a bucket within the radius whose texts are not yet in one class: no link is lost because
  another one failed. Those pairs are never rows: a task names the members that have one, their sets of shingles
  are brought to the bucket in chunks bounded by bytes, and the task that compares two chunks returns only links
  that join two classes, fewer than it has members. A pair is looked at only in the first bucket that both share.

Defined results: a null text counts as empty, and a text without words has fingerprint zero; rows with equal
doc_id are rows of their own; a null doc_id is never a component's id unless all its rows have none (and
``near_classes`` links no text all of whose rows have none); an empty table gives an empty one; other columns of the input are not looked at.
"""

from collections.abc import Callable
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import bitslice
from riskloom.llm.common import broadcast_checked, stored, text_bytes
from riskloom.llm.components import connected

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Widths of the blocks, from the lowest bit; blocks that must agree; members of a bucket in a chunk.
BLOCKS, AGREE, CHUNK = (13, 13, 13, 13, 12), 2, 8192
#: Bytes of shingle hashes in a chunk (one longer set makes a longer chunk); hashes looked up at once.
CHUNK_BYTES, LOOKED_UP = 8 << 20, 1 << 20
#: Bytes that a task takes in, so that no Arrow batch is larger; bytes of a member without its set; most tasks.
TASK_BYTES, MEMBER_BYTES, MOST_TASKS = 16 << 20, 256, 20_000
#: For a similarity of 0.8: words of a shingle, fingerprint words, radius, and the least values that name a bucket.
NEAR_SHINGLE, SIMILARITY, NEAR_WORDS, NEAR_RADIUS, BANDS, BAND_ROWS = 5, 0.8, 4, 73, 16, 3
_STEP = 4096

Sketch = Callable[[bytes], tuple[bytes, list[int]]]


def _hashes(data: bytes, shingle: int, seed: int = SEED):
    """XXH64 of the word shingles of a UTF-8 text, in arrays of bounded size; a shorter text is one shingle."""
    words = data.lower().split()
    if not words:
        return
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False)), len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _STEP):
        size = min(_STEP, n - at)
        yield np.fromiter((digest(g, seed) for g in islice(grams, size)), dtype="<u8", count=size)


def _majority(counts: np.ndarray, n: int) -> bytes:
    """The bits set in more than half of the n hashes, the highest bit first."""
    return np.packbits((counts * 2 > n)[::-1]).tobytes()


def _masks() -> list[int]:
    starts = [sum(BLOCKS[:k]) for k in range(len(BLOCKS))]
    blocks = [((1 << width) - 1) << start for start, width in zip(starts, BLOCKS, strict=True)]
    return [sum(chosen) for chosen in combinations(blocks, AGREE)]


def block_sketch(shingle: int = SHINGLE) -> Sketch:
    """64-bit SimHash and one key for every choice of blocks."""
    masks = np.array(_masks(), dtype=np.uint64)

    def sketch(data: bytes) -> tuple[bytes, list[int]]:
        counts, n = np.zeros(64, dtype=np.int64), 0
        for h in _hashes(data, shingle):
            counts += bitslice.bits_of(h[:, None]).sum(axis=0, dtype=np.int64)
            n += len(h)
        fp = _majority(counts, n)
        return fp, (np.frombuffer(fp, ">u8").astype(np.uint64) & masks).view(np.int64).tolist()

    return sketch


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Another 64-bit hash of a hash: multiply and fold."""
    x = (h ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _distinct(data: bytes, shingle: int) -> np.ndarray:
    """The different shingle hashes of a text, in order."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *_hashes(data, shingle)]))


def band_sketch(shingle: int = NEAR_SHINGLE) -> Callable[[bytes], tuple[bytes, int, bytes, list[int]]]:
    """A 128-bit digest of the set of shingles, its size, 256-bit SimHash and one key for every triple of least values."""
    rng = np.random.default_rng(11)
    salts = [int(x) for x in rng.integers(1, 2**63, NEAR_WORDS)]
    factors = rng.integers(1, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sketch(data: bytes) -> tuple[bytes, int, bytes, list[int]]:
        own = _distinct(data, shingle)
        counts = np.zeros(64 * NEAR_WORDS, dtype=np.int64)
        least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for h in (own[at : at + _STEP] for at in range(0, len(own), _STEP)):
            wide = np.stack([_mixed(h, s) for s in salts], axis=1)
            counts += bitslice.bits_of(wide).sum(axis=0, dtype=np.int64)
            least = np.minimum(least, (wide[:, 0] * factors[:, None]).min(axis=1))
        keys = least.reshape(BANDS, BAND_ROWS)
        named = [xxhash.xxh64_intdigest(k.tobytes()) - (1 << 63) for k in keys]
        return xxhash.xxh128_digest(own.tobytes()), len(own), _majority(counts, len(own)), named

    return sketch


def _mark() -> Column:
    return F.xxhash64(text_bytes()).alias("mark")


def sketches(docs: DataFrame, sketch: Sketch) -> DataFrame:
    """(doc_id, mark, fp, keys): a hash of the text, the fingerprint and the names of buckets of every row."""

    def run(batches):
        for batch in batches:
            found = [sketch(data) for data in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([fp for fp, _ in found], pa.binary()), pa.array([k for _, k in found], pa.list_(pa.int64()))],
                names=["doc_id", "mark", "fp", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(), text_bytes().alias("data"))
    return rows.mapInArrow(run, "doc_id long, mark long, fp binary, keys array<long>")


def _in_buckets(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """(t, key, n, columns): the members of every bucket of ``nodes(keys, columns)`` with n > 1 of them."""
    keys = nodes.select(*columns, F.posexplode("keys").alias("t", "key"))
    shared = keys.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    return keys.join(shared, ["t", "key"]).select("t", "key", "n", *columns)


def _chunk_pairs(members: DataFrame, columns: list[str], chunk: int | None = None, tasks: int | None = None) -> DataFrame:
    """(columns: arrays) of every pair of chunks of every bucket, whose ``n`` is cut into parts of about ``chunk``; the
    first column names a member. ``tasks`` sets their number, else Spark does."""
    chunks = F.ceil(F.col("n") / (chunk or CHUNK))
    own = F.pmod(F.xxhash64(columns[0]), chunks)
    dealt = members.select(
        "t", "key", F.struct(*columns).alias("m"), own.alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other"))
    dealt = dealt.select("t", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "m")
    at = ["t", "key", "lo", "hi"]
    dealt = dealt.repartition(tasks, *at) if tasks else dealt
    return dealt.groupBy(*at).agg(
        F.collect_list("m").alias("m")).where(F.size("m") > 1).select(*[F.col(f"m.{c}").alias(c) for c in columns])


def _tasks(parts: DataFrame, size: Column) -> int:
    """How many tasks the sum of ``size``, in bytes, over all ``parts`` takes."""
    total = parts.agg(F.sum(size.cast("double"))).first()[0] or 0
    return min(MOST_TASKS, max(parts.sparkSession.sparkContext.defaultParallelism, int(total // TASK_BYTES) + 1))


def _portions(batch: pa.RecordBatch):
    """Sizes and flattened columns of a few lists at a time: a list may hold two chunks."""
    sizes = np.diff(batch.column(0).offsets.to_numpy())
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // (4 * CHUNK))) + 1).tolist(), len(sizes)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if hi > lo:
            yield sizes[lo:hi], [lists.slice(lo, hi - lo).flatten() for lists in batch.columns]


def _words(binaries: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(binaries.to_pylist()), "<u8").reshape(len(binaries), -1)


def _spanning(pairs: DataFrame, radius: int, nearest: bool) -> DataFrame:
    """(a, b): names of members, from lists of names and, in the last column, of fingerprints."""

    def run(batches):
        for batch in batches:
            for sizes, columns in _portions(batch):
                a, b = bitslice.spanning_links(_words(columns[-1]), sizes, radius, nearest)
                yield pa.RecordBatch.from_arrays([columns[0].take(pa.array(x)) for x in (a, b)], names=["a", "b"])

    return pairs.mapInArrow(run, "a binary, b binary")


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between different fingerprints of ``nodes(fp, keys)`` that meet in a bucket.

    They connect all fingerprints of a bucket that lie within ``radius`` of each other.
    """
    return _spanning(_chunk_pairs(_in_buckets(nodes, ["fp"]), ["fp"]), radius, False)


def _sketched(docs: DataFrame, sketch: Sketch) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and of the different fingerprints, each with its first row (``least``)."""
    rows = stored(sketches(docs, sketch), "sketches")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))).alias("least")
    return rows, stored(rows.groupBy("fp").agg(first, F.min("keys").alias("keys")), "nodes")


def _near_sketched(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``_sketched`` with ``band_sketch``; a node is a different set of shingles (``set_id``, of ``size``)."""

    def run(batches):
        sketch = band_sketch()
        for batch in batches:
            found = [sketch(data) for data in batch.column(2).to_pylist()]
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            made = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made], names=["doc_id", "mark", "set_id", "size", "fp", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(), text_bytes().alias("data"))
    rows = stored(rows.mapInArrow(run, "doc_id long, mark long, set_id binary, size long, fp binary, keys array<long>"), "sketches")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))).alias("least")
    same = [F.min(c).alias(c) for c in ("size", "fp", "keys")]
    return rows, stored(rows.groupBy("set_id").agg(first, *same), "nodes")


def _named(rows: DataFrame, nodes: DataFrame, found: DataFrame, node: str = "fp") -> DataFrame:
    """Rows with the component that the links ``found`` give the node that they belong to."""
    roots = connected(found)
    rooted = nodes.join(roots, nodes[node] == roots["node"], "left").select(
        node, "least.doc_id", F.coalesce("root", node).alias("root"))
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(ids, "root").select(node, "component_id")
    return rows.select(*dict.fromkeys(["doc_id", "mark", "fp", node])).join(named, node).select("doc_id", "mark", "fp", "component_id")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, mark, shingles): the different shingle hashes of every row."""

    def run(batches):
        for batch in batches:
            sets = [_distinct(data, shingle).view(np.int64) for data in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "mark", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(), text_bytes().alias("data"))
    return rows.mapInArrow(run, "doc_id long, mark long, shingles array<long>")


def _sets_of(docs: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """(set_id, shingles) of the nodes ``asked(set_id)``; only one row of ``docs`` for each of them is read again."""
    chosen = stored(nodes.join(asked, "set_id").where("least IS NOT NULL").select("set_id", "least.doc_id", "least.mark"), "asked")
    rows = docs.select("doc_id", "text", F.col("doc_id").cast("long").alias("__id"), _mark().alias("__mark"))
    few = broadcast_checked(chosen.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")))
    sets = shingle_sets(rows.join(few, ["__id", "__mark"], "left_semi").dropDuplicates(["__id", "__mark"]), NEAR_SHINGLE)
    return stored(sets.join(chosen, ["doc_id", "mark"]).select("set_id", "shingles"), "shingle-sets")


def verified(docs: DataFrame, nodes: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """The links of ``found(a, b)`` whose texts have at least the Jaccard similarity, shingle by shingle."""
    found = stored(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "close")
    sets = _sets_of(docs, nodes, found.select(F.explode(F.array("a", "b")).alias("set_id")).distinct())
    left, right = (sets.select(F.col("set_id").alias(c), F.col("shingles").alias(f"{c}_set")) for c in ("a", "b"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    whole = F.size("a_set") + F.size("b_set") - F.col("common")
    both = found.join(left, "a").join(right, "b").select("a", "b", "a_set", "b_set", common.alias("common"))
    return both.where((whole == 0) | (F.col("common") / whole >= similarity)).select("a", "b")


#: What a task must know of the members of a bucket to see which of their pairs are open.
_MEMBER = ["set_id", "root", "size", "fp", "keys", "t"]


class _Members:
    """Members of some buckets, group after group, from Arrow arrays in the order of ``_MEMBER``."""

    def __init__(self, sizes: np.ndarray, ids, roots, many, fps, keys, t):
        self.groups, self.ids, self.values = sizes, ids, _words(fps)
        self.label = roots.dictionary_encode().indices.to_numpy().copy()
        self.many, self.t = many.to_numpy(), t.to_numpy()
        self.keys = keys.flatten().to_numpy().reshape(-1, BANDS)

    def open_pairs(self, radius: int, similarity: float):
        """Places ``(i, j)``, some at a time, of the pairs within ``radius`` whose classes differ, whose sizes allow
        the similarity, and that meet in no bucket before this one."""
        for i, j in bitslice.close_pairs(self.values, self.groups, radius):
            less, more = np.minimum(self.many[i], self.many[j]), np.maximum(self.many[i], self.many[j])
            apart = (self.label[i] != self.label[j]) & (less >= similarity * more - 1e-6)
            i, j = i[apart], j[apart]
            for at in range(0, len(i), 1 << 16):
                x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                first = (self.keys[x] == self.keys[y]).argmax(axis=1) == self.t[x]
                if first.any():
                    yield x[first], y[first]

    def joined(self, radius: int, similarity: float, sets: pa.ListArray) -> tuple[list[int], list[int]]:
        """Links ``(i, j)`` of similar sets, each of which joins two classes."""
        ends = np.cumsum(sets.value_lengths().to_numpy())
        words, place = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        of = np.split(place, ends[:-1])
        mark, links = np.zeros(len(words), dtype=bool), ([], [])
        for i, j in self.open_pairs(radius, similarity):
            order = np.argsort(i, kind="stable")
            each, starts = np.unique(i[order], return_index=True)
            for x, others in zip(each.tolist(), np.split(j[order], starts[1:]), strict=True):
                mark[of[x]] = True
                cuts = np.flatnonzero(np.diff(np.cumsum(self.many[others]) // LOOKED_UP)) + 1
                for part in np.split(others, cuts):
                    part = part[self.label[part] != self.label[x]]
                    for y in part[self._similar(x, part, of, mark) >= similarity].tolist():
                        if self.label[y] != self.label[x]:
                            self.label[self.label == self.label[y]] = self.label[x]
                            links[0].append(x)
                            links[1].append(y)
                mark[of[x]] = False
        return links

    def _similar(self, x: int, others: np.ndarray, of: list[np.ndarray], mark: np.ndarray) -> np.ndarray:
        """Jaccard similarities of the set of ``x``, which is marked, and others, none of them empty."""
        if not len(others):
            return np.zeros(0)
        sizes = self.many[others]
        hits = mark[np.concatenate([of[y] for y in others.tolist()])]
        common = np.add.reduceat(hits, np.cumsum(sizes) - sizes, dtype=np.int64)
        return common / (sizes + self.many[x] - common)


def _open_members(members: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(t, key, set_id): the ``members(t, key, n, set_id, root, size, fp, keys)`` that have an open pair in a bucket."""

    def run(batches):
        for batch in batches:
            for sizes, (*known, key) in _portions(batch):
                own = _Members(sizes, *known)
                asked = np.zeros(len(own.many), dtype=bool)
                for i, j in own.open_pairs(radius, similarity):
                    asked[i] = asked[j] = True
                at = pa.array(np.flatnonzero(asked))
                yield pa.RecordBatch.from_arrays([known[-1].take(at), key.take(at), own.ids.take(at)], names=["t", "key", "set_id"])

    tasks = _tasks(members, F.ceil(F.col("n") / CHUNK) * MEMBER_BYTES)
    return _chunk_pairs(members, [*_MEMBER, "key"], tasks=tasks).mapInArrow(run, "t int, key long, set_id binary")


def _joining(members: DataFrame, radius: int, similarity: float, tasks: int) -> DataFrame:
    """(a, b): links of similar ``members(t, key, n, set_id, root, size, fp, keys, shingles)`` of a bucket that join two
    classes; ``n`` is the bytes of the bucket."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                *known, sets = (lists[row].values for lists in batch.columns)
                own = _Members(np.array([len(sets)]), *known)
                ends = [own.ids.take(pa.array(x, pa.int64())) for x in own.joined(radius, similarity, sets)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return _chunk_pairs(members, [*_MEMBER, "shingles"], CHUNK_BYTES, tasks).mapInArrow(run, "a binary, b binary")


def similar_links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): verified links that connect all ``nodes`` that meet within the radius and have the similarity.

    The links of the forests are verified first. Pairs that stay in different classes after that are verified
    themselves, whatever became of the forests' links.
    """
    met = stored(_in_buckets(nodes, ["set_id", "size", "fp"]), "met")
    forests = _spanning(_chunk_pairs(met, ["set_id", "fp"]), NEAR_RADIUS, True)
    sure = stored(verified(docs, nodes, forests, SIMILARITY), "similar")
    roots = connected(sure)
    rooted = met.join(roots, met["set_id"] == roots["node"], "left").select(
        "t", "key", "n", "set_id", F.coalesce("root", "set_id").alias("root"), "size", "fp")
    mixed = rooted.groupBy("t", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    rooted = rooted.join(mixed.select("t", "key"), ["t", "key"]).join(nodes.select("set_id", "keys"), "set_id")
    rooted = stored(rooted, "mixed")
    asked = stored(_open_members(rooted, NEAR_RADIUS, SIMILARITY).distinct(), "open")
    if asked.isEmpty():
        return sure
    asked = rooted.drop("n").join(asked, ["t", "key", "set_id"])
    weight = stored(asked.groupBy("t", "key").agg(F.sum(F.col("size") * 8 + MEMBER_BYTES).alias("n")), "weights")
    tasks = _tasks(weight, F.col("n") * F.ceil(F.col("n") / CHUNK_BYTES))
    sets = _sets_of(docs, nodes, asked.select("set_id").distinct())
    joining = _joining(asked.join(weight, ["t", "key"]).join(sets, "set_id"), NEAR_RADIUS, SIMILARITY, tasks)
    return sure.unionByName(stored(joining, "joining"))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp, component_id) for every row, with all links up to three bits of 64.

    ``component_id`` is the smallest doc_id reachable, ``mark`` a hash of the text.
    """
    rows, nodes = _sketched(docs, block_sketch())
    return _named(rows, nodes, links(nodes.select("fp", "keys"), RADIUS))


def near_classes(docs: DataFrame) -> DataFrame:
    """As ``classes``, for five-word shingles and a similarity of 0.8 or more."""
    rows, nodes = _near_sketched(docs)
    return _named(rows, nodes, similar_links(docs, nodes), "set_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is that of their near class; rows without a doc_id stay."""
    gone = near_classes(docs).where("doc_id <> component_id").select(
        F.col("doc_id").alias("__gone"), F.col("mark").alias("__mark")).distinct()
    gone = broadcast_checked(stored(gone, "near-copies"))
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["__gone"]) & (F.xxhash64(text_bytes()) == gone["__mark"]), "left_anti")
