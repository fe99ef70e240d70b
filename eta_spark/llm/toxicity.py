"""Toxic documents and their offending sentences, learned from labels of whole documents.

Multiple-instance learning: a sentence is toxic with probability
sigmoid(bias + sum of the weights of its distinct words), and a document is
toxic if any sentence is: 1 - product of (1 - sentence), the noisy-or. Bias
and weights are fitted on document labels alone, by gradient steps on the
log-likelihood with a penalty on the weights. Words are runs of letters in
lower case; a word's weight is the sum of its own and those of its beginnings
of three to six letters, so that inflected forms are known by their stem. The
vocabulary holds features of at least ``MIN_DOCS`` training documents.

The fit uses a bounded sample of the labelled rows: of each class the
``SAMPLE`` documents whose ids have the smallest hashes, among texts of at
most ``SAMPLE_CHARS`` characters. It fits on the driver; scoring runs over
Arrow batches and reads every whole text.

Null and empty texts have no sentence and the score 0. Without labels of both
classes every text scores the toxic share of the sample, 0 if it is empty.
Repeated documents are scored each and count once in the sample; of repeated
labels the largest counts; null labels, and labels or documents without
doc_id, teach nothing. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.llm.common import slices

SAMPLE, SAMPLE_CHARS, MIN_DOCS = 2500, 16_000, 5
STEPS, RATE, PENALTY = 100, 0.2, 1e-4
#: Words whose weight a worker remembers, about 50 MB.
CACHE = 1 << 19
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")

SPANS = "array<struct<start:int,end:int,score:double>>"


def features(word: str) -> list[str]:
    """The word, and its beginnings with a mark."""
    return [word, *(word[:k] + "*" for k in range(3, min(7, len(word))))]


class Model:
    """Bias, feature weights, and the constant score that stands in for them if nothing could be learned."""

    def __init__(self, bias: float, weights: dict[str, float], constant: float | None = None):
        self.bias, self.weights, self.constant = bias, weights, constant
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        """The word's weight, from a bounded cache."""
        value = self.known.get(word)
        if value is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            value = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """Start, end and logit of each sentence with a word."""
        for match in _SENTENCE.finditer(text):
            words = _WORD.findall(match[0].lower())
            if words:
                yield match.start(), match.end(), self.bias + math.fsum(map(self.word, set(words)))

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        """The document's score and its sentences of at least 0.5."""
        found, clean = [], 0.0
        for start, end, logit in self.sentences(text or ""):
            clean -= math.log1p(math.exp(min(logit, 50.0)))
            if logit >= 0:
                found.append({"start": start, "end": end, "score": 1 / (1 + math.exp(-logit))})
        if self.constant is not None:
            return self.constant, []
        return -math.expm1(clean), found


def fit(texts: list[str], labels: list[int], share: float | None = None) -> Model:
    """Maximum likelihood under the noisy-or, by Adam on the whole sample, weighted to the true toxic share.

    Each step pulls the weights towards 0 by ``PENALTY`` of its size (lasso),
    which leaves few features with a weight.
    """
    y = np.array(labels, dtype=float)
    if len(set(labels)) < 2:
        return Model(0.0, {}, float(y.mean()) if len(y) else 0.0)
    seen = Counter(f for t in texts for f in {f for w in set(_WORD.findall(t.lower())) for f in features(w)})
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= MIN_DOCS))}
    del seen
    document, sentence, word = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for part in _SENTENCE.findall(text):
            if words := set(_WORD.findall(part.lower())):
                ids = [vocabulary[f] for w in sorted(words) for f in features(w) if f in vocabulary]
                word.extend(ids)
                sentence.extend([len(document)] * len(ids))
                document.append(d)
    k = len(document)
    document, sentence, word = (np.array(x, dtype=np.int32) for x in (document, sentence, word))
    theta = np.zeros(len(vocabulary) + 1)
    theta[-1] = -5.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    share = y.mean() if share is None else share
    balance = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    for step in range(1, STEPS + 1):
        logit = theta[-1] + np.bincount(sentence, theta[word], minlength=k)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        toxic = -np.expm1(np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)))
        toxic = np.clip(toxic, 1e-9, 1)
        pull = np.where(y == 1, (1 - toxic) / toxic, -1.0) * balance
        slope = pull[document] * p
        gradient = np.append(np.bincount(word, slope[sentence], minlength=len(vocabulary)), slope.sum()) / len(y)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        size = RATE / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        theta += size * mean / (1 - 0.9**step)
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(0.0, np.abs(theta[:-1]) - PENALTY * size[:-1])
    return Model(float(theta[-1]), {w: float(theta[i]) for w, i in vocabulary.items() if theta[i]})


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on the bounded sample of rows that are not held out."""
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    truth = truth.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    ids = texts.select("doc_id").join(truth, "doc_id").distinct()
    first = [ids.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for c in (0, 1)]
    # At most two times SAMPLE rows.
    chosen = F.broadcast(first[0].unionByName(first[1]))
    rows = texts.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).collect()
    rows = sorted(rows, key=lambda r: r.doc_id)
    share = truth.agg(F.avg("toxic")).first()[0]
    return fit([r.text for r in rows], [r.toxic for r in rows], share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, and the offending sentences as character spans."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores, spans = zip(*map(shared.value.score, batch.column(1).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, f"doc_id long, score double, spans {SPANS}")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, text = docs.columns, "_toxicity_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = [shared.value.score(t)[0] < 0.5 for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_())).select(names)

    return docs.withColumn(text, F.col("text").cast("string")).mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
