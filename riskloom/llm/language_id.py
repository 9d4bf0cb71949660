"""Language identification: scripts narrow the candidates, a Viterbi path over words labels spans.

Every word gets a score for each learned language: the log share of the word there, or, for words that were not
learned, of its letter triples. Only languages that are written in the word's script are candidates; a word in a script of none
says nothing. Scores are relative to the best candidate and at most ``WORST`` below it, so one odd word cannot turn a
text. A path through the words that pays ``SWITCH`` for each change of language cuts a text into spans, which is
what mixed-language texts need; the document's language is the one that most of its letters are labelled with.

All words of a batch form one sequence in which a change costs nothing where a document begins. The sequence is
cut into blocks that are worked on side by side: each yields a matrix with the best way from any language before
it to any behind it, and a short walk over these matrices joins them, so the path is exact. Texts of more than a
million code points are labelled in portions of that size, each with a path of its own.

The model is fitted on a bounded sample: of every language the ``SAMPLE`` documents with the lowest hash of doc_id,
whole texts, never one whose crc32(doc_id) mod 5 is 0. It keeps the ``FEATURES`` most frequent words and triples.

Defined results: a null text, or one without letters, is ``und`` with score 0; without anything learned every text is
``und``; a null doc_id is labelled like any other, not held out and not learned from; ties go to the name that sorts
first; repeated rows are labelled alike; an empty table gives an empty one; other columns are not looked at.
"""

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import stored, whole_text

#: Documents of a language to learn from, features kept and how often each must occur at least.
SAMPLE, FEATURES, LEAST_SEEN = 4_000, 200_000, 3
#: Cost of a change of language, most that a word can speak against one, and share of words that makes a script one of a language.
SWITCH, WORST, SCRIPT_SHARE = 12.0, 6.0, 0.005
#: Words of a block, words that a worker remembers, letters up to which a word is looked at as a whole.
BLOCK, REMEMBERED, LONG = 512, 400_000, 64
UNKNOWN = "und"

# First and last code points of the letters of scripts, from the Unicode block list.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
_BOUNDS = sorted((lo, hi, name) for name, ranges in SCRIPTS.items() for lo, hi in ranges)
_LOWS, _HIGHS = (np.array([b[k] for b in _BOUNDS]) for k in (0, 1))
#: Names of scripts; letters of no listed one have the last.
_NAMES = [*SCRIPTS, "other"]
_SCRIPT = np.array([_NAMES.index(b[2]) for b in _BOUNDS])

_WORD, _INSIDE = regex.compile(r"(\p{L}[\p{L}\p{M}]*)"), regex.compile(r"[\p{L}\p{M}]")


def scripts_of(words: list[str]) -> np.ndarray:
    """Places in ``_NAMES`` of the scripts of the words' first letters."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    at = np.searchsorted(_LOWS, first, side="right") - 1
    return np.where((at >= 0) & (first <= _HIGHS[at]), _SCRIPT[at], len(SCRIPTS))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def triples(word: str) -> list[str]:
    edged = f"^{word}$"
    return [edged[k : k + 3] for k in range(len(edged) - 2)]


def _small(word: str) -> str:
    return word.lower()[:LONG]


@dataclass
class Model:
    """Log shares of words and triples, as rows over the languages, and the scripts of each language.

    ``words`` names the rows of words; ``keys`` are the triples as sorted numbers, whose rows follow from ``first`` on; the
    last row is that of triples that were not learned.
    """

    languages: list[str] = field(default_factory=list)
    words: dict[str, int] = field(default_factory=dict)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    first: int = 0
    shares: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    scripts: dict[str, np.ndarray] = field(default_factory=dict)

    def _spelled(self, words: list[str]) -> np.ndarray:
        """Sums over the triples of some words, all found together."""
        codes = _codes("".join([f"^{w}$" for w in words]))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 2)
        inside = np.ones(len(codes), dtype=bool)
        inside[ends - 1] = inside[ends - 2] = False  # triples do not reach into the next word
        key = _keys(codes)[inside[:-2]]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rows = np.where(self.keys[at] == key, self.first + at, len(self.shares) - 1)
        return np.add.reduceat(self.shares[rows], np.cumsum(sizes) - sizes, axis=0)

    def scores(self, words: list[str]) -> np.ndarray:
        """How far each language lies behind the best for each word; zeros where the word says nothing."""
        small = list(map(_small, words))
        row = np.fromiter((self.words.get(w, -1) for w in small), np.int64, len(words))
        found = self.shares[row]
        if len(new := np.flatnonzero(row < 0)):
            found[new] = self._spelled([small[k] for k in new])
        none = np.ones(len(self.languages), dtype=bool)
        script = scripts_of(words)
        found = np.where(np.array([self.scripts.get(name, none) for name in _NAMES])[script], found, -np.inf)
        found = np.maximum(found - found.max(axis=1, keepdims=True), -WORST)
        found[~np.array([name in self.scripts for name in _NAMES])[script]] = 0.0
        return found


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def _keys(codes: np.ndarray) -> np.ndarray:
    """Three code points each, of at most 21 bits, as one number."""
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]


def _learned_features(text: str) -> Counter:
    """How often words, triples and scripts occur; scripts begin with a tab."""
    words = Counter(_WORD.findall(text))
    found: Counter = Counter()
    for (word, n), script in zip(words.items(), scripts_of(list(words)).tolist(), strict=True):
        small = _small(word)
        found[f" {small}"] += n
        found[f"\t{_NAMES[script]}"] += n
        for t in triples(small):
            found[t] += n
    return found


def sample(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(lang, text): of each language the ``most`` documents with the lowest hash of doc_id that are not held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    draw = F.xxhash64(F.lit(5), F.col("doc_id").cast("long"))
    ranked = usable.select("lang", draw.alias("draw")).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw")))
    last = stored(ranked.where(F.col("rank") <= most).groupBy("lang").agg(F.max("draw").alias("last")), "sample-bounds")
    return usable.withColumn("draw", draw).join(last, "lang").where("draw <= last").select("lang", whole_text().alias("text"))


def fit(docs: DataFrame, most: int = SAMPLE, features: int = FEATURES) -> Model:
    """A model of the languages in ``docs(doc_id, text, lang)``; counting is done by Spark, the driver gets the model."""

    def run(batches):
        counts: Counter = Counter()

        def made():
            keys, n = list(counts), list(counts.values())
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(n, pa.int64())], names=["lang", "feature", "n"])
            counts.clear()
            return out

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for name, n in _learned_features(text).items():
                    counts[lang, name] += n
                if len(counts) > REMEMBERED:
                    yield made()
        yield made()

    counted = sample(docs, most).mapInArrow(run, "lang string, feature string, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    counted = stored(counted, "language-features")
    kind = F.when(F.col("feature").startswith(" "), "word").when(F.col("feature").startswith("\t"), "script").otherwise("triple")
    totals = {(r.lang, r.kind): r.n for r in counted.groupBy("lang", kind.alias("kind")).agg(F.sum("n").alias("n")).collect()}
    languages = sorted({lang for lang, _ in totals})
    if not languages:
        return Model()
    place = {lang: k for k, lang in enumerate(languages)}
    often = counted.where(kind != "script").groupBy("feature").agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST_SEEN)
    best = often.orderBy(F.desc("all"), "feature").limit(features).select("feature")
    kept = counted.join(F.broadcast(best), "feature").collect()
    seen: dict[str, np.ndarray] = {}
    for r in kept:
        seen.setdefault(r.feature, np.zeros(len(languages)))[place[r.lang]] = r.n

    def total(name: str) -> np.ndarray:
        return np.array([totals.get((lang, name), 0) for lang in languages], dtype=float)

    words, parts = total("word"), total("triple")
    n_words = sum(1 for f in seen if f.startswith(" "))

    def share(n: np.ndarray | float, whole: np.ndarray, kinds: int) -> np.ndarray:
        return np.log((n + 0.5) / (whole + 0.5 * (kinds + 1)))

    learned = sorted(f for f in seen if f.startswith(" "))
    spelled = {int(_keys(_codes(f))[0]): f for f in seen if not f.startswith(" ")}
    keys = sorted(spelled)
    shares = [share(seen[f], words, n_words) for f in learned] + [share(seen[spelled[k]], parts, len(keys)) for k in keys]
    shares.append(share(0.0, parts, len(keys)))
    scripts: dict[str, np.ndarray] = {}
    for r in counted.where(kind == "script").collect():  # scripts times languages
        if r.n >= SCRIPT_SHARE * totals[r.lang, "word"]:
            scripts.setdefault(r.feature[1:], np.zeros(len(languages), dtype=bool))[place[r.lang]] = True
    return Model(languages, {f[1:]: k for k, f in enumerate(learned)}, np.array(keys, np.int64), len(learned), np.array(shares), scripts)


def best_path(scores: np.ndarray, fresh: np.ndarray, switch: float = SWITCH, block: int = BLOCK) -> np.ndarray:
    """The language of each word on the best path. ``scores``: (words, languages); at ``fresh`` words a change is free.

    Of equal ways the one that stays wins, then the language that comes first.
    """
    n, many = scores.shape
    if not n:
        return np.zeros(0, dtype=np.int64)
    blocks = -(-n // block)
    padded = np.zeros((blocks * block, many))
    padded[:n] = scores
    cost = np.full(blocks * block, switch)
    cost[:n][fresh] = 0.0
    cost[n:] = 0.0
    padded, cost = padded.reshape(blocks, block, many), cost.reshape(blocks, block)
    # best[b, i, l]: from language i before block b to language l at the word reached; came: the language before it
    best = np.where(np.eye(many, dtype=bool), 0.0, -np.inf)[None].repeat(blocks, axis=0)
    for t in range(block):
        best, _ = _step(best, padded[:, t, None, :], cost[:, t, None, None])
    before = np.zeros((blocks, many))
    for b in range(1, blocks):
        before[b] = (before[b - 1][:, None] + best[b - 1]).max(axis=0)
        before[b] -= before[b].max()
    reach = before[:, None, :]  # as one row per block: the best way to each language from the very beginning
    came = np.empty((block, blocks, many), dtype=np.int32)
    for t in range(block):
        reach, back = _step(reach, padded[:, t, None, :], cost[:, t, None, None])
        came[t] = back[:, 0]
    # Where a path that ends block b with language l has begun it: the last block then decides all others.
    ends = np.broadcast_to(np.arange(many, dtype=np.int64), (blocks, many)).copy()
    rows = np.arange(blocks)[:, None]
    for t in range(block - 1, -1, -1):
        ends = came[t][rows, ends]
    last = np.empty(blocks, dtype=np.int64)
    last[-1] = int(reach[-1, 0].argmax())
    for b in range(blocks - 1, 0, -1):
        last[b - 1] = ends[b, last[b]]
    path = np.empty((block, blocks), dtype=np.int64)
    at, rows = last, np.arange(blocks)
    for t in range(block - 1, -1, -1):
        path[t] = at
        at = came[t][rows, at]
    return path.T.reshape(-1)[:n]


def _step(best: np.ndarray, gain: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One word further: stay, or change from the best language at a cost."""
    top = best.argmax(axis=-1)
    moved = np.take_along_axis(best, top[..., None], axis=-1) - cost
    stays = best >= moved
    here = np.arange(best.shape[-1], dtype=np.int32)
    return np.where(stays, best, moved) + gain, np.where(stays, here, top[..., None].astype(np.int32))


class Labeller:
    """Spans of texts by a model; the scores of words are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if new:
            if len(self.rows) + len(new) > REMEMBERED:  # forget all and begin anew with what is needed now
                self.rows, self.scores = {}, self.scores[:0]
                new = list(dict.fromkeys(words))
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, self.model.scores(new)])
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def label(self, texts: list[str]) -> list[tuple[np.ndarray, list[tuple[str, int, int]]]]:
        """Letters in each language and spans (language, first and last code point, the last exclusive) of each text."""
        many = len(self.model.languages)
        parts = [_WORD.split(t) for t in texts] if many else []
        words = [w for p in parts for w in p[1::2]]
        if not words:
            return [(np.zeros(many), [])] * len(texts)
        counts = np.array([len(p) // 2 for p in parts])
        firsts = np.cumsum(counts) - counts
        fresh = np.zeros(len(words) + 1, dtype=bool)
        fresh[firsts] = True
        numbers = self._numbers(words)
        path = best_path(self.scores[numbers], fresh[:-1])
        length = np.fromiter(map(len, words), np.int64, len(words))
        return [self._summed(p, path[a : a + n], length[a : a + n]) for p, a, n in zip(parts, firsts, counts, strict=True)]

    def _summed(self, parts: list[str], path: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, list[tuple[str, int, int]]]:
        letters = np.bincount(path, length, len(self.model.languages))
        place = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        heads = np.flatnonzero(np.concatenate([[True] if len(path) else [], path[1:] != path[:-1]]))
        tails = np.concatenate([heads[1:], [len(path)]]).astype(np.int64)[: len(heads)] - 1
        return letters, [(self.model.languages[path[a]], int(place[2 * a]), int(place[2 * b + 1])) for a, b in zip(heads, tails, strict=True)]

    def whole(self, text: str, portion: int) -> tuple[np.ndarray, list[tuple[str, int, int]]]:
        """The same for one long text, portion by portion; they end between words, and spans that meet there are joined."""
        letters, spans, at = np.zeros(len(self.model.languages)), [], 0
        while at < len(text):
            end = min(len(text), at + portion)
            if end < len(text):
                inside = _WORD.match(text, self._word_start(text, end))
                end = inside.end() if inside and inside.end() > end else end
            more, found = self.label([text[at:end]])[0]
            letters = letters + more
            for lang, a, b in found:
                if spans and spans[-1][0] == lang:
                    spans[-1] = (lang, spans[-1][1], at + b)
                else:
                    spans.append((lang, at + a, at + b))
            at = end
        return letters, spans

    @staticmethod
    def _word_start(text: str, end: int) -> int:
        while end and _INSIDE.match(text, end - 1):
            end -= 1
        return end

    def verdict(self, letters: np.ndarray) -> tuple[str, float]:
        """The language of most letters and its share of them."""
        whole = float(letters.sum()) if len(letters) else 0.0
        return (self.model.languages[int(letters.argmax())], float(letters.max()) / whole) if whole else (UNKNOWN, 0.0)


_SPAN = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def identify(docs: DataFrame, model: Model, few: int = 1 << 20) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row; about ``few`` characters are labelled at once."""

    def run(batches):
        labeller = Labeller(model)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            found, held, size = [], [], 0
            for text in [*texts, None]:
                if text is None or size + len(text) > few:  # what was held, then a text too long to be held with others
                    found += labeller.label(held)
                    held, size = [], 0
                if text is not None and len(text) > few:
                    found.append(labeller.whole(text, few))
                elif text is not None:
                    held.append(text)
                    size += len(text)
            verdicts = [labeller.verdict(letters) for letters, _ in found]
            spans = [[{"lang": lang, "start": a, "end": b} for lang, a, b in row] for _, row in found]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([v[0] for v in verdicts], pa.string()), pa.array([v[1] for v in verdicts], pa.float64()), pa.array(spans, pa.list_(_SPAN))],
                names=["doc_id", "lang_pred", "score", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<lang string, start long, end long>>")
