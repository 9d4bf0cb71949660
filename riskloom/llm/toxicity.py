"""Toxicity by multiple-instance learning.

Only documents carry labels, sentences are what offends. A sentence's probability is logistic in the weights of
its words (a word counts by itself and by its beginnings); a document's is the noisy-or of its sentences:
one minus the product of their complements. The weights are fitted to the document labels through that noisy-or,
and the same sentence probabilities then say where a document offends.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled documents, those with the lowest hash of
doc_id, never one whose crc32(doc_id) mod 4 is 2. Scoring covers every document and whole texts.

Defined results: null and empty texts have no sentence and score 0; labels without a value are ignored, of
several labels of a document the highest holds; without any usable label, or with only one kind, every score is
the share of label 1 (0 without labels); a null doc_id is scored like any other and is not held out; repeated
rows are scored alike; an empty table gives an empty one; other columns are not looked at.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, stored, whole_text

#: Labelled documents to learn from; word features kept; documents in which a feature must occur; score that counts.
SAMPLE, FEATURES, LEAST_SEEN, THRESHOLD = 20_000, 4096, 3, 0.3
#: Lengths of word beginnings; words whose weight a worker remembers.
PREFIXES, REMEMBERED = range(3, 8), 500_000
STEPS, RATE, DECAY = 400, 0.1, 0.02

_SENTENCE, _WORD = re.compile(r"[^.!?\n]+"), re.compile(r"[^\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def features(word: str) -> list[str]:
    return [f"{word}$", *[word[:k] for k in PREFIXES if k <= len(word)]]


@dataclass
class Model:
    """``share`` is set where nothing could be learned: then it is the score of every document with a sentence."""

    weights: dict[str, float]
    bias: float
    share: float | None = None

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            found = sum(self.weights.get(f, 0.0) for f in features(word))
            if len(self.known) < REMEMBERED:
                self.known[word] = found
        return found

    def sentences(self, text: str):
        """(start, end, logit) of the sentences that hold a word with a weight."""
        known, slow = self.known, self.word
        for m in _SENTENCE.finditer(text):
            logit = 0.0
            for w in _WORD.findall(m.group().lower()):
                x = known.get(w)
                logit += slow(w) if x is None else x
            if logit:
                yield m.start(), m.end(), self.bias + logit

    def score(self, text: str) -> float:
        count = sum(1 for _ in _SENTENCE.finditer(text))
        if not count or self.share is not None:
            return (self.share or 0.0) if count else 0.0
        total, base = count * _softplus(self.bias), _softplus(self.bias)
        known, slow = self.known, self.word
        for w in set(_WORD.findall(text.lower())):
            x = known.get(w)
            if slow(w) if x is None else x:
                total += sum(_softplus(z) - base for _, _, z in self.sentences(text))
                break
        return float(-np.expm1(-total))


def _softplus(z):
    return np.logaddexp(0.0, z)


def _sigmoid(z):
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def _bags(text: str, chosen: dict[str, int]) -> tuple[list[list[int]], int]:
    """Feature numbers (repeats included) of the sentences that have any, and the number of the others."""
    bags, others = [], 0
    for sentence in _SENTENCE.findall(text):
        bag = [chosen[f] for w in _WORD.findall(sentence.lower()) for f in features(w) if f in chosen]
        if bag:
            bags.append(bag)
        else:
            others += 1
    return bags, others


def train_set(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents that are not held out."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = stored(known, "toxic-labels")
    # a share of the labels by hash, somewhat more than asked for, so that few rows are ranked however many there are
    share = min(1.0, (1.2 * sample + 1000) / max(1, known.count()))
    few = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    chosen = stored(few.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id").limit(sample), "toxic-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "toxic")


def choose_features(train: DataFrame, positives: int, negatives: int) -> list[str]:
    """The features that speak most for label 1, by document counts added up by Spark."""

    def run(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in {f for w in set(_WORD.findall(text.lower())) for f in features(w)}:
                    seen.setdefault(f, [0, 0])[toxic] += 1
            cells = list(seen.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen)), *[pa.array([c[k] for c in cells], pa.int64()) for k in (1, 0)]], names=["f", "yes", "no"])

    counts = train.select("text", "toxic").mapInArrow(run, "f string, yes long, no long").groupBy("f").agg(
        F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    odds = F.log((F.col("yes") + 0.5) / (positives + 1)) - F.log((F.col("no") + 0.5) / (negatives + 1))
    best = counts.where(F.col("yes") >= LEAST_SEEN).select("f", "yes", odds.alias("odds")).where("odds >= 1")
    return [r.f for r in best.orderBy(F.desc(F.col("yes") * F.col("odds")), "f").limit(FEATURES).collect()]


def fit_noisy_or(docs: list[tuple[list[list[int]], int, int]], n_features: int) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of document labels under the noisy-or (Adam, full batch).

    ``docs``: per document its bags of feature numbers, the number of sentences without any, and its label.
    """
    lengths = np.array([len(bag) for bags, _, _ in docs for bag in bags], dtype=np.int64)
    index = np.array([f for bags, _, _ in docs for bag in bags for f in bag], dtype=np.int64)
    sizes = np.array([len(bags) for bags, _, _ in docs], dtype=np.int64)
    others, label = (np.array([d[k] for d in docs], dtype=float) for k in (1, 2))
    return _fitted(lengths, index, sizes, others, label, n_features)


def _fitted(
    lengths: np.ndarray, index: np.ndarray, sizes: np.ndarray, others: np.ndarray, label: np.ndarray, n_features: int,
) -> tuple[np.ndarray, float]:
    """As ``fit_noisy_or``, from arrays: features of a bag, feature numbers, bags of a document, bags without any, label."""
    sentence = np.repeat(np.arange(len(lengths)), lengths)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    theta = np.zeros(n_features + 1)
    theta[-1] = -6.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        bias = theta[-1]
        z = bias + np.bincount(sentence, theta[index], len(lengths))
        total = np.bincount(doc, _softplus(z), len(sizes)) + others * _softplus(bias)
        # d(loss)/d(total): 1 for label 0, -1/(exp(total)-1) for label 1
        slope = np.where(label > 0, -1.0 / np.expm1(np.clip(total, 1e-9, 500)), 1.0)
        inner = slope[doc] * _sigmoid(z)
        grad = np.append(np.bincount(index, inner[sentence], n_features), 0.0) + 2 * DECAY * np.append(theta[:-1], 0.0)
        grad[-1] = inner.sum() + (slope * others).sum() * _sigmoid(bias)
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the labels. What reaches the driver is bounded by the sample: feature numbers, never texts."""
    train = stored(train_set(docs, labels, sample), "toxic-train")
    by_label = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    yes, no = by_label.get(1, 0), by_label.get(0, 0)
    chosen = choose_features(train, yes, no) if yes and no else []
    if not chosen:
        return Model({}, 0.0, yes / (yes + no) if yes + no else 0.0)
    place = {f: i for i, f in enumerate(chosen)}

    def run(batches):
        for batch in batches:
            found = [_bags(t, place) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([b for b, _ in found], pa.list_(pa.list_(pa.int64()))),
                 pa.array([n for _, n in found], pa.int64())], names=["id", "toxic", "bags", "others"])

    # Arrow arrays: as Python lists the numbers would take some ten times the memory, which the driver does not get back.
    rows = train.mapInArrow(run, "id long, toxic int, bags array<array<long>>, others long").withColumn("size", F.size("bags"))
    rows = rows.toArrow().sort_by([(c, "ascending") for c in ("id", "others", "size")]).combine_chunks()
    bags = pc.list_flatten(rows["bags"])
    weights, bias = _fitted(
        pc.list_value_length(bags).to_numpy().astype(np.int64), pc.list_flatten(bags).to_numpy(), rows["size"].to_numpy().astype(np.int64),
        rows["others"].to_numpy().astype(float), rows["toxic"].to_numpy().astype(float), len(chosen))
    del rows, bags
    give_back()
    return Model(dict(zip(chosen, map(float, weights), strict=True)), bias)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches):
        for batch in batches:
            found = [model.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def offending(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """(doc_id, start, end, probability, sentence) of the sentences that reach ``least`` by themselves."""

    def run(batches):
        for batch in batches:
            found: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for start, end, z in model.sentences(text) if model.share is None else ():
                    p = float(_sigmoid(z))
                    if p >= least:
                        for column, value in zip(found, (doc, start, end, p, text[start:end]), strict=True):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names=["doc_id", "start", "end", "probability", "sentence"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, end long, probability double, sentence string")


def remove_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns. The score is computed beside each row."""

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(model.score)

    return docs.where(score(whole_text()) < threshold)
