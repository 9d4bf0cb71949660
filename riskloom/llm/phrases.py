"""Collocations by stripes: every prefix keys an associative counter of the words that follow it.

``stripes`` is the one structure. A stripe belongs to a prefix of up to four words and counts each frequent next word;
the empty prefix counts all others under null, so that its stripe sums up to the number of words. An entry is the
frequency of prefix and word together, which makes it the total of the next longer prefix as well, and the largest
entry tells whether a longer phrase subsumes the prefix. Tasks build stripes over half a million words at a time; they
are merged elementwise, that is by prefix and next word, so a prefix that a third of all rows hold is spread over many
tasks.

Most phrases are rare, and those cannot matter: no part of a phrase is rarer than the phrase. So before stripes are
built, three passes count hashes of phrases of one and two, then three, then four and five words, each only where
the shorter ones are frequent. A pass leaves a bitmap of ``FILTER_BITS`` bits in which every frequent phrase is marked.
The bitmaps are broadcast; their size does not depend on the data, and a wrongly marked phrase costs a row and changes
no result, because stripes hold the words themselves and are counted exactly. Words are not counted before pairs of words: that
would spare shuffled pairs where little is frequent, but costs a pass over all texts, and less and less is spared as data grow.

Defined results: a null text has no words; a null lang is ``und``, together with rows that say ``und``; a lang without
candidates has no row; repeated rows count as often as they occur; ties are settled by the least cut, then by a and
phrase; very long texts are cut into blocks that overlap by the longest prefix, so nothing is lost between two blocks;
an empty table gives an empty one; other columns are not looked at.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import broadcast_checked, stored, text_bytes

#: Words of the longest phrase, least frequency, and phrases returned per lang.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Bits of a bitmap of frequent phrases, words worked on at once, bytes of a long text taken at once.
FILTER_BITS, FLUSH, BLOCK = 1 << 26, 1 << 19, 1 << 21
#: Entries of stripes that are handed to Spark as one row; a row for each stripe would cost more than what is in it.
TOGETHER = 1 << 15
#: Bits of a hash that is shuffled (equal ones only add up, which marks too much and never too little); bits of a row of a bitmap.
_HASH_BITS, _ROW_BITS = 40, 32_768

# Capitals become small, piece ends one byte that UTF-8 never has, tabs spaces.
_END = b"\xff"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + _END * 10 + b" ")

#: A row holds stripes one after another: each entry's prefix, next word and count.
STRIPES = "lang string, prefixes array<string>, nexts array<string>, counts array<long>"
HASHES = "k int, phrase long, n long"


@dataclass
class Words:
    """A run of words: numbers into ``vocabulary`` (0 ends a piece), and of their langs. Those before ``new`` were
    counted with the run before and only give the beginnings of phrases."""

    ids: np.ndarray
    langs: np.ndarray
    new: int
    vocabulary: list[bytes]
    names: list[str]


def _blocks(data: bytes) -> Iterator[list[bytes]]:
    """Words and piece ends of a text, some at a time; blocks end between words."""
    data, at = data.translate(_TABLE), 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        if end < len(data):
            cut = max(data.rfind(b" ", at, end), data.rfind(_END, at, end))
            if cut < 0:  # one word fills the block: go on to its end
                later = [p for p in (data.find(b" ", end), data.find(_END, end)) if p >= 0]
                cut = min(later, default=len(data) - 1)
            end = cut + 1
        yield data[at:end].replace(_END, b" \xff ").split()
        at = end


def runs(batches, flush: int = FLUSH) -> Iterator[Words]:
    """The words of all rows (lang, text) in runs of about ``flush``."""
    names: dict[str, int] = defaultdict(lambda: len(names))

    def fresh():
        numbers: dict[bytes, int] = defaultdict(lambda: len(numbers))
        return numbers, numbers[_END]

    numbers, _ = fresh()
    ids, langs, size, new = [], [], 0, 0

    def made() -> Words:
        return Words(np.concatenate(ids), np.concatenate(langs), new, list(numbers), list(names))

    def add(words: list[bytes], lang: int) -> None:
        ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        langs.append(np.full(len(words), lang, np.int32))

    for batch in batches:
        for lang, data in zip(*batch.columns, strict=True):
            code = names[lang.as_py()]
            for words in _blocks(data.as_py()):
                add(words, code)
                size += len(words)
                if size >= flush:
                    yield (run := made())
                    last = [run.vocabulary[i] for i in run.ids[-(LONGEST - 1):]]
                    numbers, _ = fresh()
                    ids, langs, size, new = [], [], 0, len(last)
                    add(last, code)
            add([_END], code)
            size += 1
    if size:
        yield made()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _phrases(run: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, hash, valid) for phrases of k words by the place of their first word; shorter arrays for longer phrases."""
    of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in run.vocabulary), np.uint64, len(run.vocabulary))
    of_lang = np.fromiter((xxhash.xxh64_intdigest(n.encode(), 1) for n in run.names), np.uint64, len(run.names))
    words, inside = of_word[run.ids], run.ids > 0
    phrase, valid = _mixed(words ^ of_lang[run.langs]), inside
    yield 1, phrase, valid
    for k in range(2, LONGEST + 1):
        if len(phrase) <= 1:
            return
        phrase = _mixed(phrase[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[k - 1 :])
        valid = valid[:-1] & inside[k - 1 :]
        yield k, phrase, valid


def marked(bitmap: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    place = phrase & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_bytes().alias("data"))


def hash_counts(docs: DataFrame, lengths: tuple[int, ...], bitmaps, flush: int = FLUSH) -> DataFrame:
    """(``HASHES``): how often phrases of the given lengths occur whose shorter parts are marked. ``bitmaps`` is a
    broadcast of a bitmap for some of the shorter lengths."""

    def run(batches):
        known = bitmaps.value
        for words in runs(batches, flush):
            open_: dict[int, np.ndarray] = {}  # by length: where a phrase may be frequent
            for k, phrase, valid in _phrases(words):
                if k > max(lengths):
                    break
                may = valid
                if k > 1:  # both parts of one word less must be
                    may = may & open_[k - 1][: len(phrase)] & open_[k - 1][1 : len(phrase) + 1]
                if k in known:
                    may = may & marked(known[k], phrase)
                open_[k] = may
                if k in lengths:
                    first = max(0, words.new - k + 1)  # phrases that end in a new word
                    found, n = np.unique(phrase[first:][may[first:]] & np.uint64((1 << _HASH_BITS) - 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), k, np.int32)), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["k", "phrase", "n"])

    return _rows(docs).mapInArrow(run, HASHES)


def frequent(counts: DataFrame, least: int, bits: int) -> dict[int, np.ndarray]:
    """For each length a bitmap in which all phrases that occur ``least`` times are marked."""
    # The tasks have combined what they could; what they send is dealt out as it is and added up where it arrives.
    total = counts.repartition("phrase").groupBy("k", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    place = F.col("phrase").bitwiseAND(F.lit(bits - 1).cast("long"))
    row = F.shiftright(place, _ROW_BITS.bit_length() - 1)
    rows = total.groupBy("k", row.alias("row")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(_ROW_BITS - 1))).alias("bits"))
    found: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(max(bits, _ROW_BITS) // 8, np.uint8))
    for r in rows.toLocalIterator():  # at most bits / 32,768 rows of 4 KB for each length
        found[r.k][r.row * _ROW_BITS // 8 : (r.row + 1) * _ROW_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return {k: b[: bits // 8] for k, b in found.items()}


def partial_stripes(docs: DataFrame, bitmaps, flush: int = FLUSH) -> DataFrame:
    """(``STRIPES``): for each run of words a stripe per marked prefix, with what follows it and is marked too. In the
    stripe of the empty prefix a null word counts all others."""

    def run(batches):
        known = bitmaps.value
        none = np.zeros(1, np.uint8)  # nothing is marked
        for words in runs(batches, flush):
            size = len(words.vocabulary)
            followers = pa.array([None, *[w.decode() for w in words.vocabulary[1:]]], pa.string())
            names = pa.array(words.names, pa.string())
            # The empty prefix stands before every word. A prefix is a number, and the place of one occurrence.
            at, number = np.flatnonzero(words.ids > 0), words.langs[words.ids > 0].astype(np.int64)
            where = at
            for k, phrase, valid in _phrases(words):
                # ``at``: beginnings of prefixes of k - 1 words, all of which are followed by a word or an end
                joined = valid[at] & marked(known.get(k, none), phrase[at])
                slot = at + (k - 1)
                new = slot >= words.new if k == 1 else (slot >= words.new) & joined
                entry, n = np.unique(number[new] * size + np.where(joined, words.ids[slot], 0)[new], return_counts=True)
                if len(entry):
                    prefix, follower = np.divmod(entry, size)
                    first = where[prefix] if k > 1 else None
                    langs = words.langs[first] if k > 1 else prefix  # rising, as prefixes are numbered lang by lang
                    heads = np.flatnonzero((langs != np.roll(langs, 1)) | (np.arange(len(langs)) % TOGETHER == 0))
                    offsets = pa.array(np.concatenate([heads, [len(entry)]]).astype(np.int32))
                    text = (pc.binary_join_element_wise(*[followers.take(pa.array(words.ids[first + j])) for j in range(k - 1)], " ")
                            if k > 1 else pa.array([""] * len(entry)))
                    columns = [text, followers.take(pa.array(follower)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(langs[heads])), *[pa.ListArray.from_arrays(offsets, c) for c in columns]],
                        names=["lang", "prefixes", "nexts", "counts"])
                # prefixes of one word more: those that are marked and have something behind them
                at, key = at[joined], (number * size + np.where(joined, words.ids[slot], 0))[joined]
                _, where, number = np.unique(key, return_index=True, return_inverse=True)
                where = at[where]
                behind = at + k < len(words.ids)
                at, number = at[behind], number[behind]

    return _rows(docs).mapInArrow(run, STRIPES)


def stripes(docs: DataFrame, least: int = LEAST, bits: int = FILTER_BITS, flush: int = FLUSH) -> DataFrame:
    """(lang, prefix, next, n): entries of the merged stripes of all prefixes that may be frequent.

    Every entry is exact, and none of ``least`` or more is missing.
    """
    context = docs.sparkSession.sparkContext
    known: dict[int, np.ndarray] = {}
    for lengths in ((1, 2), (3,), tuple(range(4, LONGEST + 1))):
        shared = context.broadcast(known)
        known = known | frequent(hash_counts(docs, lengths, shared, flush), least, bits)
        shared.destroy()
    parts = partial_stripes(docs, context.broadcast(known), flush)
    entries = parts.select("lang", F.explode(F.arrays_zip("prefixes", "nexts", "counts")).alias("e"))
    return entries.groupBy("lang", F.col("e.prefixes").alias("prefix"), F.col("e.nexts").alias("next")).agg(F.sum("e.counts").alias("n"))


def _whole(x: str) -> Column:
    return F.col(x).cast("decimal(19,0)")


def scored(merged: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that no longer one subsumes; ``merged``: stored stripes."""
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    common = merged.where(F.col("next").isNotNull() & (F.col("n") >= least)).select("lang", "prefix", phrase.alias("phrase"), F.col("n").alias("a"))
    common = stored(common, "common-phrases")
    found = common.where(F.col("prefix") != "")
    # One word more is enough to look at: between a phrase and a longer one as frequent all others are as frequent.
    behind = found.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("a").alias("behind"))
    rest = F.substring("phrase", F.instr("phrase", " ") + 1, F.length("phrase"))
    before = found.where(F.col("prefix").contains(" ")).groupBy("lang", rest.alias("phrase")).agg(F.max("a").alias("before"))
    alone = found.join(behind, ["lang", "phrase"], "left").join(before, ["lang", "phrase"], "left").where(
        (F.coalesce("behind", F.lit(0)) < F.col("a")) & (F.coalesce("before", F.lit(0)) < F.col("a"))).select("lang", "phrase", "a")
    cut = alone.withColumn("words", F.split("phrase", " ")).select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    parts = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"))
    left, right = (common.select("lang", F.col("phrase").alias(c), F.col("a").alias(t)) for c, t in (("first", "l"), ("rest", "r")))
    everything = merged.where("prefix = ''").groupBy("lang").agg(F.sum("n").alias("n"))
    whole = parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(broadcast_checked(everything), "lang")
    top, below = F.lit(1000).cast("decimal(4,0)") * _whole("a") * _whole("n"), _whole("l") * _whole("r")
    score = F.call_function("div", top, below)
    least_cut = whole.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least_cut.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The best ``top`` of each lang with their rank; every task keeps no more than these before they meet."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, rank): each lang's best phrases."""
    return ranked(scored(stored(stripes(docs, least, **options), "stripes"), least), top)
