"""Trained models against plain versions and numeric gradients, and their fits on odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import language, toxicity


def small_net(rng, languages=3, f=6, embed=4):
    draw = lambda *shape: rng.standard_normal(shape)
    return language.ByteNet(draw(256, embed), draw(language.REACH * embed, f), draw(f), draw(f, languages), draw(languages), [f"l{k}" for k in range(languages)])


def plain_logits(net, row):
    """Filters over windows of one row of bytes, by loops."""
    e = net.embed.shape[1]
    top = []
    for f in range(net.filters.shape[1]):
        answers = []
        for at in range(len(row) - language.REACH + 1):
            answers.append(sum(net.embed[row[at + k]][j] * net.filters[k * e + j][f] for k in range(language.REACH) for j in range(e)))
        top.append(max(0.0, max(answers) + net.shift[f]))
    return np.array(top) @ net.out + net.bias


def test_byte_net_equals_a_plain_convolution():
    rng = np.random.default_rng(2)
    net = small_net(rng)
    rows = rng.integers(0, 256, (5, 24)).astype(np.uint8)
    for row, got in zip(rows, net.log_probabilities(rows)):
        logits = plain_logits(net, row)
        assert got == pytest.approx(logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max(), abs=1e-4)


def test_byte_net_gradient_is_the_numeric_one():
    rng = np.random.default_rng(4)
    net = small_net(rng)
    rows, target = rng.integers(0, 256, (6, 20)).astype(np.uint8), rng.integers(0, 3, 6)

    def loss():
        out = 0.0
        for row, t in zip(rows, target):
            z = plain_logits(net, row)
            out += np.log(np.exp(z).sum()) - z[t]
        return out / len(rows)

    grad = language.gradient(net, rows, target)
    for name, g in grad.items():
        x = getattr(net, name)
        for at in zip(*np.nonzero(np.abs(g) > 1e-3)):
            if rng.random() < min(1.0, 8 / max(1, (np.abs(g) > 1e-3).sum())):
                old = x[at]
                x[at] = old + 1e-5
                up = loss()
                x[at] = old - 1e-5
                assert (up - loss()) / 2e-5 == pytest.approx(g[at], rel=1e-3, abs=1e-6)
                x[at] = old


def test_letters_are_letters(spark):
    texts = ["½", "²", "①", "12 ½.", "é", "日本", "ª", "_1", "٣"]
    assert [language.has_letter(t) for t in texts] == [False, False, False, False, True, True, True, False, False]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert [r[0] for r in df.orderBy("doc_id").select(F.col("text").rlike(r"\p{L}")).collect()] == [language.has_letter(t) for t in texts]


def test_language_fit_of_odd_rows(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["the and of to", "der die das und"][k % 2].split()) for _ in range(20)), ["en", "de"][k % 2]) for k in range(200)]
    rows += [(7, "a copy of the text and the same to all", "en")] * 3000 + [(None, None, "en"), (1, "text", None), (2, "", "de"), (3, "123", "xx"), (4, "the and of " * 30_000, "en")]
    rows += [(5, rows[0][1], "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language.fit(df, per_language=50)
    assert net.languages == ["de", "en"]
    got, _ = language.predict([r[1] for r in rows[:200]], net)
    assert np.mean([g == r[2] for g, r in zip(got, rows)]) > 0.95
    with pytest.raises(ValueError):
        language.fit(df, most_languages=1)


def plain_score(model, text):
    """One minus the product of the sentences' chances to be free of offence."""
    free = 1.0
    for s in toxicity.SENTENCE.findall(text or "") or [""]:
        z = model.bias + sum(model.weights.get(p, 0.0) for w in set(toxicity.WORD.findall(s.lower())) for p in toxicity.parts(w))
        free *= 1 - 1 / (1 + math.exp(-z))
    odds = math.log((1 - free) / free)
    return 1 / (1 + math.exp(-(model.slope * odds + model.shift)))


def test_noisy_or_equals_a_plain_one():
    model = toxicity.BagModel({"vile": 3.0, "fine": -1.0, "~words": 0.5, "wordsmith": 0.25}, -3.0, 1.2, 0.4)
    for text in (None, "", "!!", "vile", "A vile wordsmith. Fine fine words! And\nso on? vile vile.", "Words."):
        assert model.score(text)[0] == pytest.approx(plain_score(model, text))
    assert 0 <= model.score("vile " * 50_000)[0] <= 1 and 0 <= model.score("vile. " * 50_000)[0] <= 1


def test_noisy_or_gradient_is_the_numeric_one():
    rng = np.random.default_rng(1)
    docs, words, features = 5, 7, 6
    doc = np.sort(rng.integers(0, docs, 14))
    doc[:docs] = np.arange(docs)
    doc = np.sort(doc)
    sentence, word = rng.integers(0, len(doc), 40), rng.integers(0, words, 40)
    of, has = rng.integers(0, words, 15), rng.integers(0, features, 15)
    y = np.array([1, 0, 1, 0, 1.0])
    bags, w, bias = toxicity.Bags(sentence, word, doc, of, has, words, y), rng.standard_normal(features), -1.5

    def loss(w, bias):
        _, total = bags.totals(w, bias)
        return (np.where(y == 1, -np.log(-np.expm1(-total)), total).sum() + 0.35 * (w @ w)) / docs

    got = bags.gradient(w, bias, 0.7)
    for k in range(features):
        step = np.eye(features)[k] * 1e-6
        assert (loss(w + step, bias) - loss(w - step, bias)) / 2e-6 == pytest.approx(got[k], rel=1e-4, abs=1e-7)
    assert (loss(w, bias + 1e-6) - loss(w, bias - 1e-6)) / 2e-6 == pytest.approx(got[-1], rel=1e-4)


def test_toxicity_fit_of_odd_rows(spark):
    rng = random.Random(1)
    text = lambda bad: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(12)) + (" vile." if bad else ".")
    docs = [(k, text(k % 3 == 0)) for k in range(240)] + [(5, "again")] * 500 + [(None, "x"), (300, None), (301, ""), (302, "vile " * 6000)]
    labels = [(k, int(k % 3 == 0)) for k in range(240)] + [(1, None), (None, 1), (4, 0), (4, 0), (999, 1), (302, 0)] + [(k, 0) for k in range(1000, 1500)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"), most=239)  # labels without a document take no place
    scores = {r.doc_id: r.score for r in toxicity.score(d.where("doc_id < 240 and text <> 'again'"), model).collect()}
    assert all((s >= 0.3) == (k % 3 == 0) for k, s in scores.items()) and model.slope > 0
    assert toxicity.fit(d, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")).weights == {}
    assert toxicity.fit(d.where("false"), spark.createDataFrame([], "doc_id long, toxic int")).weights == {}
