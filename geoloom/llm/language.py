"""Language identification by a byte convolutional network trained in numpy.

Texts are cut into windows of a fixed number of bytes. Bytes are embedded,
filters of several widths slide over them, the largest answer of each filter
over a window is kept, and a softmax names the language. A text's windows are
averaged, weighted by how many bytes they hold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.llm.common import column, held_out, per_row, table

#: Letters and some other numerals, like ½ and ①.
LETTERLIKE = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
WIDTHS = (2, 3, 4)
WINDOW = 192
REACH = max(WIDTHS)


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTERLIKE.finditer(text))


def windows(text: str, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The whole text's UTF-8 bytes in rows of `size`, the last one filled with zeros; bytes in each row."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = -(-len(raw) // size)
    out = np.zeros(n * size, np.uint8)
    out[: len(raw)] = raw
    held = np.full(n, size)
    if n:
        held[-1] = len(raw) - (n - 1) * size
    return out.reshape(n, size), held


@dataclass
class ByteNet:
    """embed: 256 x e. filters: REACH*e x f, with zeros beyond a filter's width. Then f x languages."""

    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    languages: list[str]

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """For each place of each row, the embedded bytes from there on that a filter sees."""
        n, size = rows.shape
        e = self.embed.shape[1]
        places = size - REACH + 1
        embedded = self.embed[rows].reshape(n, size * e)
        s = embedded.strides
        return np.lib.stride_tricks.as_strided(embedded, (n, places, REACH * e), (s[0], s[1] * e, s[1])).reshape(n * places, REACH * e)

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        answers = (self.columns(rows) @ self.filters).reshape(len(rows), -1, self.filters.shape[1])
        return answers, answers.max(axis=1)

    def log_probabilities(self, rows: np.ndarray, batch: int = 512) -> np.ndarray:
        out = np.empty((len(rows), len(self.languages)), np.float32)
        for k in range(0, len(rows), batch):
            _, top = self.pooled(rows[k : k + batch])
            logits = np.maximum(top + self.shift, 0) @ self.out + self.bias
            logits -= logits.max(axis=1, keepdims=True)
            out[k : k + batch] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return out


def gradient(net: ByteNet, x: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of the windows x, by each of the net's arrays."""
    n, f, embed = len(x), net.filters.shape[1], net.embed.shape[1]
    seen_columns, places = net.columns(x), x.shape[1] - REACH + 1
    answers = (seen_columns @ net.filters).reshape(n, -1, f)
    where = answers.argmax(axis=1)
    top = np.take_along_axis(answers, where[:, None, :], 1)[:, 0] + net.shift
    hidden = np.maximum(top, 0)
    logits = hidden @ net.out + net.bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), target] -= 1
    p /= n
    back = (p @ net.out.T) * (top > 0)
    chosen = seen_columns.reshape(n, places, -1)[np.arange(n)[:, None], where]  # n x f x REACH*e
    grad = {"out": hidden.T @ p, "bias": p.sum(axis=0), "shift": back.sum(axis=0), "filters": np.einsum("nf,nfe->ef", back, chosen), "embed": np.zeros_like(net.embed)}
    into = (back[:, :, None] * net.filters.T[None]).reshape(n, f, REACH, embed)
    for k in range(REACH):
        np.add.at(grad["embed"], x[np.arange(n)[:, None], where + k], into[:, :, k])
    return grad


def train(texts: list[str], labels: list[str], seed: int = 7, embed: int = 8, per_width: int = 12, epochs: int = 14, batch: int = 64, rate: float = 0.01) -> ByteNet:
    """Adam on cross-entropy over one window a text, cut short at random so that short texts are learned too."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    rows = np.zeros((len(texts), WINDOW), np.uint8)
    for k, t in enumerate(texts):
        raw = np.frombuffer(t.encode("utf-8", "surrogatepass")[:WINDOW], np.uint8)
        rows[k, : len(raw)] = raw
    f = per_width * len(WIDTHS)
    seen = np.concatenate([np.repeat(np.arange(REACH) < w, embed).repeat(per_width).reshape(-1, per_width) for w in WIDTHS], axis=1).astype(np.float32)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    net = ByteNet(normal(256, embed, scale=0.5), normal(REACH * embed, f, scale=0.3) * seen, np.zeros(f, np.float32), normal(f, len(languages), scale=0.2), np.zeros(len(languages), np.float32), languages)
    names = ("embed", "filters", "shift", "out", "bias")
    moments = {n: [np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))] for n in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            pick = order[at : at + batch]
            x = rows[pick].copy()
            keep = rng.integers(24, WINDOW + 1, len(pick))
            keep[rng.random(len(pick)) < 0.5] = WINDOW
            x[np.arange(WINDOW)[None, :] >= keep[:, None]] = 0
            grad = gradient(net, x, target[pick])
            grad["filters"] *= seen
            step += 1
            for name in names:
                g, (a, b) = grad[name], moments[name]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                getattr(net, name)[...] -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 600, most_languages: int = 1000) -> ByteNet | None:
    """Learns from docs with text and lang; None if there are none.

    The bound: of each language at most `per_language` different stretches of
    WINDOW characters, one of each text at a place that a hash names, and the texts
    picked by a hash; so copies of a text count once. How many texts a language has
    is estimated from all rows. More than `most_languages` languages raise an error.
    """
    ready = docs.where(column(lang).isNotNull() & column(text).rlike(r"\p{L}")).select(column(lang).cast("string").alias("l"), column(text).alias("t"))
    found = ready.groupBy("l").agg(F.approx_count_distinct(F.xxhash64("t")).alias("n")).limit(most_languages + 1).collect()
    if len(found) > most_languages:
        raise ValueError(f"more than {most_languages} languages in {lang}")
    if not found:
        return None
    share = F.create_map(*[F.lit(x) for r in found for x in (r.l, min(1.0, 1.5 * per_language / r.n))])
    draw = F.pmod(F.xxhash64("t"), F.lit(1_000_003))
    place = (1 + F.pmod(F.xxhash64("t", "l"), F.greatest(F.lit(1), F.length("t") - WINDOW + 1))).cast("int")
    picked = ready.where(draw / 1_000_003 < share[F.col("l")]).select("l", draw.alias("draw"), F.col("t").substr(place, F.lit(WINDOW)).alias("t")).groupBy("l", "t").agg(F.min("draw").alias("draw"))
    first = F.row_number().over(Window.partitionBy("l").orderBy("draw", "t"))
    rows = picked.withColumn("place", first).where(F.col("place") <= per_language).select("l", "place", "t").collect()
    rows.sort(key=lambda r: (r.l, r.place))
    return train([r.t for r in rows], [r.l for r in rows]) if rows else None


def predict(texts: list[str | None], net: ByteNet | None) -> tuple[list[str], list[float]]:
    """Language and probability of each whole text; UNKNOWN and 0 for null texts, those without a letter, and without a net."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if net is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    of = [k for k, t in enumerate(texts) if t and has_letter(t)]
    group: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def close() -> None:
        if not group:
            return
        logs = net.log_probabilities(np.concatenate([rows for _, rows, _ in group]))
        at = 0
        for k, rows, weights in group:
            mean = np.average(logs[at : at + len(rows)].astype(np.float64), axis=0, weights=weights)
            at += len(rows)
            p = np.exp(mean - mean.max())
            p /= p.sum()
            best = int(p.argmax())
            out[k] = net.languages[best], float(p[best])
        group.clear()

    for k in of:
        group.append((k, *windows(texts[k])))
        held += len(group[-1][1])
        if held >= 4096:
            close()
            held = 0
    close()
    return [a for a, _ in out], [b for _, b in out]


def identify(docs: DataFrame, net: ByteNet | None, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language of each whole text and its probability.

    Each row is judged by itself, without a shuffle: null, empty and letterless
    texts get UNKNOWN and 0, repeated rows stay, an empty table stays empty.
    Equal probabilities go to the first language in order. Columns already
    named as the new ones are replaced.
    """
    share = docs.sparkSession.sparkContext.broadcast(net)  # some 10,000 numbers

    def start():
        def made(texts: pa.Array) -> list[pa.Array]:
            names, scores = predict(texts.to_pylist(), share.value)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return made

    return per_row(docs, text, {pred: "string", score: "double"}, start)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents that aren't held out, and predicts all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), net).select("doc_id", "held_out", "lang_pred", "score")
