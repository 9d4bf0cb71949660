"""Cross-entropy difference of documents under two matched n-gram models.

A target model is counted over the target documents and a background model over all documents. Both share one
vocabulary (every word of the documents), order and smoothing: bigrams, smoothed by the model's own word probabilities.
A token's loss is its negative log probability; a document's score is the mean over its tokens of target loss less
background loss, so low scores look like the target.

All counts are exact and grow with the corpus (words and pairs are compared by hashes of 63 bits). Three passes read
the texts. The first counts words; the ``HOT`` most frequent get numbers and their counts are broadcast. The second
counts pairs of the ``FREQUENT`` first of these, at most ``(FREQUENT + 1) ** 2`` sums. The third sends every other token
to the group of its pair, or of its word if that has no number; the group counts what it was sent and answers with a
sum of losses for each document. What is sent to one group has a bound: a word without a number holds at most one in
``HOT`` of all tokens, a pair that was not counted before at most one in ``FREQUENT``.

Defined results: words are runs of characters other than ASCII white space, with A-Z lower-cased; null and empty texts
have no token and null losses; a target row whose doc_id is null or missing counts for nothing, repeated ids count
once; without target documents the target model is uniform over the vocabulary; repeated rows are counted and scored
each; words of equal count may have numbers or not, which changes no score; very long texts are held by one task, as
one text; an empty table gives an empty one; other columns are not looked at. The documents are read three times, so give
a table that reads the same every time.
"""

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import BROADCAST_ROWS, stored, text_bytes

#: Words whose counts are broadcast; how many of them have their pairs counted beforehand.
HOT, FREQUENT, SMOOTHING = 131_072, 1024, 50.0
#: Bytes of text that a task holds before it hands counts on, and before it sends its tokens; tokens of a group, on
#: average; least number of groups.
HELD, SENT, GROUP, GROUPS = 1 << 24, 1 << 23, 1 << 21, 64

#: Marks the code of a word without a number, which is its hash.
_HASHED = np.uint64(1 << 63)
_BY_PAIR, _BY_WORD, _DOCUMENTS = range(3)
_BLANKS = re.compile(rb"[ \t\n\x0b\x0c\r]")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        found = np.full(n, base, dtype=np.uint64)
        found[0] = 1
        out.append(np.cumprod(found))
    return out[0], out[1]


#: An odd number; what a byte stands for in a hash; bytes that part words; powers for the bytes hashed at once.
_BASE = 0x5851F42D4C957F2F
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_AT_ONCE = 1 << 20


@lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_AT_ONCE)


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of 63 bits of the words of ``data``, and where they begin. Sums over the powers of a base, moved to the
    start of the word, so a word has one hash wherever it stands."""
    raw = np.frombuffer(data.lower(), np.uint8)
    blank = np.concatenate([[True], _BLANK[raw], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    first, end = edges[::2], edges[1::2]
    up, down = _kept_powers() if len(raw) <= _AT_ONCE else _powers(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    return _mixed((sums[end] - sums[first]) * down[first]) >> np.uint64(1), first


def _parts(data: bytes):
    """A text in parts of about ``_AT_ONCE`` bytes that begin and end at blanks."""
    at = 0
    while len(data) - at > _AT_ONCE:
        found = _BLANKS.search(data, at + _AT_ONCE // 2)
        end = found.end() if found else len(data)
        yield data[at:end]
        at = end
    yield data[at:]


def hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts in a row, and how many words each has."""
    found, sizes = [], np.zeros(len(texts), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) < _AT_ONCE):
            size += len(texts[hi]) + 1
            hi += 1
        if hi == lo + 1:
            own = [_hashes(p)[0] for p in _parts(texts[lo])]
            sizes[lo] = sum(map(len, own))
            found += own
        else:
            own, first = _hashes(b"\n".join(texts[lo:hi]))
            ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
            sizes[lo:hi] = np.diff(np.searchsorted(first, ends), prepend=0)
            found.append(own)
        lo = hi
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64), sizes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _marked(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(row, doc_id, data, hit) of all rows. What a shuffle would deal anew after a lost executor is written down."""
    ids = target.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("hit")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        hits = rows.join(F.broadcast(ids), "doc_id", "left")
    else:
        hits = stored(rows.join(ids, "doc_id", "left"), "marked")
    return hits.select(F.monotonically_increasing_id().alias("row"), "doc_id", "data", F.coalesce("hit", F.lit(False)).alias("hit"))


class _Words:
    """Words of some texts in a row: their hashes, text by text, and which end a text or are of a hit."""

    def __init__(self, texts: list[bytes], hits: list[bool]):
        self.hashes, self.sizes = hashes(texts)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.hit = np.array(hits, dtype=bool)[self.doc]
        ends, some = np.cumsum(self.sizes), self.sizes > 0
        self.last, self.firsts = np.zeros(len(self.doc), dtype=bool), (ends - self.sizes)[some]
        self.last[ends[some] - 1] = True

    def before(self, codes: np.ndarray) -> np.ndarray:
        """The code before each; 0 stands before a text."""
        found = np.roll(codes, 1)
        found[self.firsts] = 0
        return found


class _Numbers:
    """Codes of words from their hashes: numbers from 1, or the marked hash."""

    def __init__(self, known: np.ndarray):
        self.order = np.argsort(known)
        self.known = known[self.order]

    def codes(self, found: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return found | _HASHED
        at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        return np.where(self.known[at] == found, self.order[at].astype(np.uint64) + np.uint64(1), found | _HASHED)


def _held(batches, *columns: str, most: int):
    """Rows of batches as lists of values, as many as have about ``most`` bytes of text."""
    held: list[list] = [[] for _ in columns]
    size = 0
    for batch in batches:
        for part in range(0, batch.num_rows, 256):
            values = [batch.column(c).slice(part, 256).to_pylist() for c in columns]
            for column, found in zip(held, values, strict=True):
                column.extend(found)
            size += sum(map(len, values[columns.index("data")])) + len(values[0])
            if size >= most:
                yield held
                held, size = [[] for _ in columns], 0
    if held[0]:
        yield held


# --- first and second pass -------------------------------------------------------------------------------


def word_counts(marked: DataFrame) -> DataFrame:
    """(word, n, t, n_last, t_last): occurrences of every word (its hash) everywhere and in the target, and those that
    end a text."""

    def run(batches):
        for data, hits in _held(batches, "data", "hit", most=HELD):
            words = _Words(data, hits)
            word, place = np.unique(words.hashes, return_inverse=True)
            n = [np.bincount(place[x], minlength=len(word)) for x in (slice(None), words.hit, words.last, words.last & words.hit)]
            columns = [pa.array(x) for x in (word.astype(np.int64), *n)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "t", "n_last", "t_last"])

    found = marked.select("data", "hit").mapInArrow(run, "word long, n long, t long, n_last long, t_last long")
    return found.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "t", "n_last", "t_last")])


def hot_words(counts: DataFrame, most: int = HOT) -> list[Row]:
    """Rows of the words of the highest counts, the most frequent first; words of equal count are all in or all out."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("words"))  # few rows: one for each different count
    running = by_count.select("n", F.sum("words").over(W.orderBy(F.desc("n"))).alias("total"))
    least = running.where(F.col("total") <= most).agg(F.min("n")).first()[0]
    if least is None:
        return []
    rows = counts.where(F.col("n") >= least).collect()  # at most ``most``
    return sorted(rows, key=lambda r: (-r.n, r.word))


def frequent_pairs(marked: DataFrame, words: list[int]) -> DataFrame:
    """(cell, n, t): counts of the pairs of ``words``; 0 stands before a text, and a cell is (first, second)."""
    width = len(words) + 1
    known = np.array(words, dtype=np.uint64)

    def run(batches):
        numbers, counts = _Numbers(known), np.zeros((2, width * width), dtype=np.int64)
        for data, hits in _held(batches, "data", "hit", most=_AT_ONCE):
            found = _Words(data, hits)
            own = numbers.codes(found.hashes)
            before = found.before(own)
            near = (own < width) & (before < width)
            cell = (before[near] * np.uint64(width) + own[near]).astype(np.int64)
            for k, cells in enumerate((cell, cell[found.hit[near]])):
                place, n = np.unique(cells, return_counts=True)
                counts[k, place] += n
        cells = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cells, *counts[:, cells])], names=["cell", "n", "t"])

    found = marked.select("data", "hit").mapInArrow(run, "cell long, n long, t long")
    return found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


class Models:
    """Both models as far as they are broadcast. The first axis of every array is background, target."""

    def __init__(self, totals: Row, hot: list[Row], frequent: int, pairs: pa.Table):
        self.words = np.array([r.word for r in hot], dtype=np.uint64)
        self.frequent = min(frequent, len(hot))
        self.sums, self.types = np.array([totals.n or 0, totals.t or 0], dtype=float), totals.types
        counts = np.array([[0, 0, 0, 0], *([r.n, r.t, r.n_last, r.t_last] for r in hot)], dtype=float).T
        self.single = self.smoothed(counts[:2])
        before = counts[:2] - counts[2:]
        before[:, 0] = totals.n_last or 0, totals.t_last or 0  # every text with words has a first and a last one
        self.context = np.log(before + SMOOTHING)
        width = self.frequent + 1
        both = np.zeros((2, width * width))
        both[:, pairs.column("cell").to_numpy()] = pairs.column("n").to_numpy(), pairs.column("t").to_numpy()
        self.pair = -np.log(both + np.tile(self.single[:, :width], width))

    def smoothed(self, counts: np.ndarray) -> np.ndarray:
        """What smoothing adds to the counts of pairs that end in words of these counts."""
        return SMOOTHING * (counts + 1.0) / np.maximum(self.sums + self.types, 1.0)[:, None]


# --- third pass ------------------------------------------------------------------------------------------


def _packed(*columns: np.ndarray) -> bytes:
    """Columns byte by byte, so that equal leading bytes of sorted numbers lie together."""
    return zstandard.ZstdCompressor(1).compress(b"".join(c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns))


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    ends = np.cumsum(sizes) * (len(raw) // sum(sizes))
    return [np.ascontiguousarray(x.reshape(size, -1).T).reshape(-1).view(kind) for x, size, kind in zip(np.split(raw, ends[:-1]), sizes, kinds, strict=True)]


def _sums(weights: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(places, w, n) for w in weights])


class _Sender:
    """What the rows of some texts send to the groups."""

    def __init__(self, models: Models, groups: int):
        self.models, self.groups, self.numbers = models, groups, _Numbers(models.words)

    def _group(self, keys: np.ndarray) -> np.ndarray:
        """Group of keys of 63 bits, rising with the key."""
        return ((keys >> np.uint64(31)) * np.uint64(self.groups) >> np.uint64(32)).astype(np.int64)

    def _dealt(self, kind: int, first: int, keys: np.ndarray, *columns: np.ndarray):
        order = np.argsort(keys)
        columns = [c[order] for c in (keys, *columns)]
        group = self._group(columns[0])
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if hi > lo:
                yield int(group[lo]), kind, first, _packed(*(c[lo:hi] for c in columns))

    def sent(self, rows: list[int], docs: list, data: list[bytes], hits: list[bool]) -> pa.RecordBatch:
        """(part, kind, first, data) of texts that follow each other."""
        m, words, first = self.models, _Words(data, hits), rows[0]
        own, doc, sizes = self.numbers.codes(words.hashes), words.doc, words.sizes
        before = words.before(own)
        known = before < _HASHED
        sums = _sums(m.context[:, before[known].astype(np.int64)], doc[known], len(sizes))
        near = (own <= m.frequent) & (before <= m.frequent)
        cells = before[near].astype(np.int64) * (m.frequent + 1) + own[near].astype(np.int64)
        sums += _sums(m.pair[:, cells], doc[near], len(sizes))
        tag = (doc * 4 + words.hit * 2 + words.last).astype(np.uint32)
        numbered, hashed = ~near & (own < _HASHED), own >= _HASHED
        pairs = _mixed(_mixed(before[numbered]) + own[numbered]) >> np.uint64(1)
        ids, no_id = np.array([d or 0 for d in docs], dtype=np.int64), np.array([d is None for d in docs])
        place = int(self._group(_mixed(np.array([first], dtype=np.uint64)) >> np.uint64(1))[0])
        out = [*self._dealt(_BY_PAIR, first, pairs, own[numbered].astype(np.uint32), tag[numbered]),
               *self._dealt(_BY_WORD, first, own[hashed] ^ _HASHED, before[hashed], tag[hashed]),
               (place, _DOCUMENTS, first, _packed(sizes, ids, no_id, *sums))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["part", "kind", "first", "data"])


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, int]:
    """For sorted columns: the number of the run of equal values at each place, and how many there are."""
    new = np.zeros(len(columns[0]), dtype=bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    run = np.cumsum(new)
    return run, int(run[-1]) + 1


def _counts(run: np.ndarray, n: int, hit: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(run, minlength=n), np.bincount(run, hit, n)])


def _by_pair(models: Models, keys: np.ndarray, words: np.ndarray, hit: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    run, n = _runs(keys[order])
    losses = np.empty((2, len(keys)))
    losses[:, order] = -np.log(_counts(run, n, hit[order])[:, run] + models.single[:, words[order]])
    return losses


def _by_word(models: Models, keys: np.ndarray, before: np.ndarray, hit: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Losses of the words but for their contexts, and what they add to the loss of the next word as its context."""
    order = np.lexsort((before, keys))
    keys, before, hit, last = keys[order], before[order], hit[order], last[order]
    word, n_words = _runs(keys)
    pair, n_pairs = _runs(keys, before)
    counts = _counts(word, n_words, hit)
    contexts = np.log(counts - _counts(word[last], n_words, hit[last]) + SMOOTHING)
    losses = np.empty((2, len(keys)))
    losses[:, order] = np.where(last, 0.0, contexts[:, word]) - np.log(_counts(pair, n_pairs, hit)[:, pair] + models.smoothed(counts)[:, word])
    return losses


def _answers(models: Models, sent: pa.Table) -> pa.Table:
    """(row, doc_id, n_tokens, background, target) for what a group was sent; ids and numbers of tokens only once."""
    kind, first, data = sent.column("kind").to_numpy(), sent.column("first").to_numpy(), sent.column("data")
    out: list[list] = [[], [], [], [], []]
    found = []
    for wanted, kinds in ((_BY_PAIR, ("u8", "u4", "u4")), (_BY_WORD, ("u8", "u8", "u4"))):
        parts = [_unpacked(data[i].as_py(), *kinds) for i in np.flatnonzero(kind == wanted).tolist()]
        if not parts:
            continue
        sizes = [len(p[0]) for p in parts]
        keys, other, tag = (np.concatenate(c) for c in zip(*parts, strict=True))
        rows = np.repeat(first[kind == wanted], sizes) + (tag >> 2)
        hit, last = (tag & 2) > 0, (tag & 1) > 0
        losses = _by_pair(models, keys, other, hit) if wanted == _BY_PAIR else _by_word(models, keys, other, hit, last)
        found.append((rows, losses))
    if found:
        rows, place = np.unique(np.concatenate([r for r, _ in found]), return_inverse=True)
        sums = _sums(np.concatenate([x for _, x in found], axis=1), place, len(rows))
        nothing = pa.nulls(len(rows), pa.int64())
        for column, values in zip(out, (pa.array(rows), nothing, nothing, *map(pa.array, sums)), strict=True):
            column.append(values)
    for i in np.flatnonzero(kind == _DOCUMENTS).tolist():
        sizes, ids, no_id, *sums = _unpacked(data[i].as_py(), "i8", "i8", "?", "f8", "f8")
        values = (pa.array(first[i] + np.arange(len(sizes))), pa.array(ids, mask=no_id), pa.array(sizes), *map(pa.array, sums))
        for column, value in zip(out, values, strict=True):
            column.append(value)
    return pa.table([pa.chunked_array(c) for c in out], names=["row", "doc_id", "n_tokens", "background", "target"])


def score(docs: DataFrame, target: DataFrame, hot: int = HOT, frequent: int = FREQUENT, group: int = GROUP, sent: int = SENT) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score); ``target`` names the target documents by doc_id."""
    spark = docs.sparkSession
    marked = _marked(docs, target)
    counts = stored(word_counts(marked), "word-counts")
    totals = counts.agg(*[F.sum(c).alias(c) for c in ("n", "t", "n_last", "t_last")], F.count("*").alias("types")).first()
    top = hot_words(counts, hot)
    pairs = frequent_pairs(marked, [r.word for r in top[:frequent]])
    models = spark.sparkContext.broadcast(Models(totals, top, frequent, pairs.toArrow()))
    groups = max(GROUPS, -(-(totals.n or 0) // group))

    def send(batches):
        sender = _Sender(models.value, groups)
        for held in _held(batches, "row", "doc_id", "data", "hit", most=sent):
            yield sender.sent(*held)

    dealt = marked.mapInArrow(send, "part long, kind int, first long, data binary")
    answers = dealt.groupBy("part").applyInArrow(
        lambda table: _answers(models.value, table), "row long, doc_id long, n_tokens long, background double, target double")
    whole = answers.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("target").alias("t"), F.sum("background").alias("b"))
    some = F.col("n_tokens") > 0
    return whole.select(
        "doc_id", "n_tokens", F.when(some, F.col("t") / F.col("n_tokens")).alias("target_loss"),
        F.when(some, F.col("b") / F.col("n_tokens")).alias("background_loss")).withColumn("score", F.col("target_loss") - F.col("background_loss"))
