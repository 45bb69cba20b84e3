"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability, a logistic
function of its words and stretches of words; the document's is their noisy-or. Their weights are
learned from document labels alone, and the sentence probabilities then tell
where the offence is.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import column, held_out, per_row, table

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


GRAM = 5


def parts(word: str) -> list[str]:
    """A word's features: itself, and its stretches of GRAM characters, which a sign sets apart from words."""
    return [word, *{"~" + word[k : k + GRAM] for k in range(len(word) - GRAM + 1)}] if len(word) > GRAM else [word]


class WordWeights(dict):
    """A word's summed weight. Remembers a bounded number of words."""

    def __init__(self, weights: dict[str, float], remembered: int = 300_000):
        super().__init__()
        self.weights, self.remembered = weights, remembered

    def __missing__(self, word: str) -> float:
        total = sum(self.weights.get(p, 0.0) for p in parts(word))
        if len(self) >= self.remembered:
            self.clear()
        self[word] = total
        return total


@dataclass
class BagModel:
    """weights: of words and stretches of words. bias: the log-odds of a sentence without any of them. slope, shift: from the log-odds of the noisy-or to those of the score."""

    weights: dict[str, float]
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        self.of_word = WordWeights(self.weights)

    def __reduce__(self):
        return BagModel, (self.weights, self.bias, self.slope, self.shift)

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over all sentences, and (start, end, probability) of those likelier than a bare one; code points, end exclusive.

        A text without a sentence counts as a bare one.
        """
        get, total, n, found = self.of_word.__getitem__, 0.0, 0, []
        for m in SENTENCE.finditer(text or ""):
            n += 1
            if weight := sum(map(get, set(WORD.findall(m[0].lower())))):
                z = self.bias + weight
                total += softplus(z) - softplus(self.bias)
                if weight > 0:
                    found.append((*m.span(), 1 / (1 + math.exp(-min(z, 500.0)))))
        total += max(n, 1) * softplus(self.bias)
        odds = math.log(max(math.expm1(min(max(total, 0.0), 700.0)), 1e-300))
        return 1 / (1 + math.exp(-min(max(self.slope * odds + self.shift, -700.0), 700.0))), found


def softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


@dataclass
class Bags:
    """sentence, word: of each word in a sentence. doc: of each sentence. of, has: of each feature of a word. y: the documents' labels."""

    sentence: np.ndarray
    word: np.ndarray
    doc: np.ndarray
    of: np.ndarray
    has: np.ndarray
    words: int
    y: np.ndarray

    def totals(self, w: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of the sentences, and minus the logarithm of each document's chance to be free of all."""
        by_word = np.bincount(self.of, w[self.has], self.words)
        z = np.clip(bias + np.bincount(self.sentence, by_word[self.word], len(self.doc)), -60, 60)
        return z, np.bincount(self.doc, np.logaddexp(0, z), len(self.y))

    def gradient(self, w: np.ndarray, bias: float, ridge: float) -> np.ndarray:
        """Of the mean loss by the weights, then by the bias."""
        z, total = self.totals(w, bias)
        pull = np.where(self.y == 1, -1 / np.maximum(np.expm1(np.minimum(total, 300)), 1e-9), 1.0)
        dz = pull[self.doc] / (1 + np.exp(-z))
        back = np.bincount(self.word, dz[self.sentence], self.words)
        return np.concatenate([np.bincount(self.has, back[self.of], len(w)) + ridge * w, [dz.sum()]]) / len(self.y)


def train(texts: list[str | None], labels: list[int], least: int = 4, steps: int = 140, rate: float = 0.08, ridge: float = 1.0) -> BagModel:
    """Full-batch Adam on the noisy-or likelihood of the document labels.

    Features of at least `least` documents take part. ridge is the strength of
    the pull of each weight to 0, in documents.
    """
    number: dict[str, int] = {}
    sentence, word, doc = array("i"), array("i"), array("i")
    held: Counter = Counter()
    for d, text in enumerate(texts):
        of_doc: set[str] = set()
        for s in SENTENCE.findall(text or "") or [""]:
            ws = dict.fromkeys(WORD.findall(s.lower()))
            word.extend(number.setdefault(w, len(number)) for w in ws)
            sentence.extend([len(doc)] * len(ws))
            doc.append(d)
            of_doc.update(ws)
        held.update({p for w in of_doc for p in parts(w)})
    sentence, word, doc = (np.frombuffer(x, np.int32) for x in (sentence, word, doc))
    feature = {p: k for k, p in enumerate(sorted(p for p, n in held.items() if n >= least))}
    pairs = np.array([(k, feature[p]) for w, k in number.items() for p in parts(w) if p in feature], np.int64).reshape(-1, 2)
    of, has = pairs[:, 0], pairs[:, 1]
    y, n = np.array(labels, np.float64), len(texts)
    w, bias = np.zeros(len(feature)), -4.0
    a, b = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    bags = Bags(sentence, word, doc, of, has, len(number), y)
    for step in range(1, steps + 1):
        grad = bags.gradient(w, bias, ridge)
        a += 0.1 * (grad - a)
        b += 0.01 * (grad * grad - b)
        move = rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9) * min(1.0, 3 * (1 - step / (steps + 1)))
        w -= move[:-1]
        bias -= move[-1]
    return BagModel({t: float(w[k]) for t, k in feature.items() if abs(w[k]) >= 0.02}, float(bias))


def calibrate(texts: list[str], labels: list[int]) -> tuple[float, float]:
    """Slope and shift that make noisy-ors of documents unseen in training probabilities: logistic regression over two folds."""
    odds = np.empty(len(texts))
    for fold in range(2):
        model = train(texts[1 - fold :: 2], labels[1 - fold :: 2])
        p = np.clip([model.score(t)[0] for t in texts[fold::2]], 1e-6, 1 - 1e-6)
        odds[fold::2] = np.log(p / (1 - p))
    x, y, beta = np.stack([odds, np.ones(len(odds))], axis=1), np.array(labels, float), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta -= np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - y) + 1e-3 * (beta - [1, 0])), -2, 2)
    return max(0.1, float(beta[0])), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", most: int = 6000, longest: int = 20_000) -> BagModel:
    """Learns from the labelled documents.

    labels has doc_id and toxic; a doc_id labelled twice is toxic if one label
    says so, and of several documents of one doc_id the first text in order counts.
    The bound: at most `most` labelled documents, picked by a hash of
    doc_id among those whose text is there and has at most `longest` characters.
    Without labels of both kinds every score is about 0.02.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.where(F.length(column(text)) <= longest).select("doc_id", column(text).alias("t"))
    picked = rows.select("doc_id").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("t").alias("t")).collect()
    chosen.sort(key=lambda r: (r["t"], r["toxic"]))
    if len({int(r["toxic"]) for r in chosen}) < 2:
        return BagModel({}, -4.0)
    texts, toxic = [r["t"] for r in chosen], [int(r["toxic"]) for r in chosen]
    model = train(texts, toxic)
    if min(sum(toxic), len(toxic) - sum(toxic)) >= 20:
        model.slope, model.shift = calibrate(texts, toxic)
    return model


SPANS = "array<struct<start:int,end:int,score:double>>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def score(docs: DataFrame, model: BagModel, text: str = "text", out: str = "score", spans: str = "offending", least: float = 0.3) -> DataFrame:
    """Adds each whole text's toxicity and its offending sentences, those of at least `least`.

    Each row by itself, without a shuffle: null and empty texts get the score of
    one bare sentence and no span, repeated rows stay, an empty table stays
    empty, columns already named as the new ones are replaced.
    """
    share = docs.sparkSession.sparkContext.broadcast(model)  # words of a bounded sample

    def start():
        def made(texts: pa.Array) -> list[pa.Array]:
            scored = [share.value.score(t.as_py()) for t in texts]
            return [pa.array([s for s, _ in scored], pa.float64()), pa.array([[{"start": a, "end": b, "score": p} for a, b, p in found if p >= least] for _, found in scored], ARROW_SPANS)]

        return made

    return per_row(docs, text, {out: "double", spans: SPANS}, start)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labels that aren't held out, and scores all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    scored = score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))
