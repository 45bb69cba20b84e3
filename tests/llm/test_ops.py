"""The corpus operators against plain versions, on small cases."""

import datetime
import hashlib
import random
import re
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import common, decontam, language, neardup, neighbours, pii, queries, tokens, toxicity
from geoloom.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "word " * 20_000), (5, "same text here"), (6, "same text here"), (None, "no id"), (7, "é😀")]


@pytest.fixture
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators use."""
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in ODD], "doc_id long, text string, score string, found string, dotted string")
    return df.withColumnRenamed("dotted", "a.b")


@pytest.fixture
def none(odd):
    return odd.where("false")


def test_tokens_equal_the_library(spark, odd, none):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", " ", "  a  b ", "<s> </s> <unk>", "\n\n", "▁▁x", "日本 12345", "x" * 3000, "　\x00\r é"]
    counter = tokens.Counter(tokens.load_pieces(path), remembered=10)
    assert [counter.count(t) for t in texts] == [len(library.encode(t)) for t in texts]
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(odd, path).collect()}
    assert got == {i: len(library.encode(t or "")) for i, t in ODD}
    assert tokens.count_tokens(none, path).count() == 0


def test_decontamination_equals_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        letters = [chr(97 + k) for k in range(rng.choice([1, 2, 4]))]
        text = lambda n: " ".join(rng.choice([*letters, "Z"]) for _ in range(rng.randint(0, n)))
        docs, bench, window = [(k, text(40)) for k in range(8)], [(str(k % 3), text(8)) for k in range(5)], rng.choice([2, 3, 13])
        counts, spans, items = decontam.find([t for _, t in docs], decontam.Phrases(bench, window))
        want = decontam.brute_force(docs, bench, window)
        assert [(int(n), sum(b - a for a, b in s), len(i)) for n, s, i in zip(counts, spans, items)] == [r[1:4] for r in want]


def test_decontamination_in_blocks_and_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "same text here"), (2, "word word word"), (3, None), (None, "x"), (4, "")], "item_id long, text string")
    odd = odd.drop("score").withColumn("both", F.lit("z"))
    one, many = (decontam.decontaminate(odd, bench, block_bytes=n).select("doc_id", "text", "found", decontam.is_contaminated().alias("c")).collect() for n in (1000, 12))
    assert sorted(map(repr, one)) == sorted(map(repr, many))
    assert {r.doc_id for r in one if r.c} == {4, 5, 6}
    assert decontam.decontaminate(odd, bench, block_bytes=12).columns == ["doc_id", "text", "a.b", "both", "found"]
    assert decontam.decontaminate(none, bench).count() == 0
    assert decontam.decontaminate(odd, bench.where("false")).where("size(found.items) > 0").count() == 0
    assert decontam.removal_spans("Oh, Same text HERE.", [(1, 4)]) == [(4, 18)]


def test_language(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.where("lang is not null and text is not null").select("text", "lang", "doc_id").collect()
    net = language.train([r.text[:192] for r in rows if r.doc_id % 3], [r.lang for r in rows if r.doc_id % 3])
    test = [r for r in rows if r.doc_id % 3 == 0]
    got, score = language.predict([r.text for r in test], net)
    assert np.mean([g == r.lang for g, r in zip(got, test)]) > 0.97 and all(0 <= s <= 1 for s in score)
    found = {r.doc_id: r.lang_pred for r in language.identify(odd, net).collect()}
    assert found[1] == found[2] == found[3] == "und" and found[4] != "und"
    assert language.identify(none, net).count() == 0
    assert language.fit(none.withColumn("lang", F.lit("en"))) is None and language.predict(["a"], None) == (["und"], [0.0])


def test_toxicity_learns_and_locates(odd, none):
    rng = random.Random(1)
    sentence = lambda bad: " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(6)) + (" vile" if bad else "") + "."
    labels = [k % 4 == 0 for k in range(300)]
    texts = [" ".join(sentence(bad and n == 1) for n in range(4)) for bad in labels]
    model = toxicity.train(texts, [int(x) for x in labels])
    assert all((model.score(t)[0] >= 0.3) == bad for t, bad in zip(texts, labels))
    text = "Fine words here. You vile one. Fine."
    (a, b, p), = [s for s in model.score(text)[1] if s[2] >= 0.3]
    assert text[a:b].strip() == "You vile one"
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, model).count() == 0


def test_pseudonyms_round_trip(spark, odd, none):
    texts = [
        "a.b7@x.example.com", "4845168114407329 and 4845 1681 1440 7329", "97.51.17.173", "+1 (017) 555-7713 212-555-1234", "123-45-6789",
        "GB82 WEST 1234 5698 7654 32", "2021-03-04 31/12/1999 12/31/1999 3/4/2001",
    ]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    there = pii.pseudonymize(df, "k")
    new = [r.text for r in there.orderBy("doc_id").collect()]
    assert all(a != b for a, b in zip(texts, new)) and all(len(texts[k]) == len(new[k]) for k in (0, 1, 3, 4, 5))
    assert new[1].split(" and ")[1].replace(" ", "") == new[1].split(" and ")[0]
    assert [r.text for r in pii.pseudonymize(there, "k", back=True).orderBy("doc_id").collect()] == texts
    left = ["9807915762804490", "256.1.1.1", "666-45-6789", "2021-02-30", "XX00ABCD12345678"]
    kept = pii.pseudonymize(spark.createDataFrame([(k, t) for k, t in enumerate(left)], "doc_id long, text string"), "k")
    assert [r.text for r in kept.orderBy("doc_id").collect()] == left
    assert {(r.doc_id, r.text) for r in pii.pseudonymize(odd, "k").collect()} == set(ODD)
    assert pii.pseudonymize(none, "k").count() == 0


def test_pseudonyms_of_values_side_by_side(spark):
    card, ip = "4845168114407329", "97.51.17.173"
    grouped = "4845 1681 1440 7329"
    texts = [
        f"{card} 12/25", f"7 {card}", f"{grouped} 123", f"{card} {ip}", f"{card}-123", f"12-{card}", f"{card} 2021-03-04", f"2021-03-04 {card}", f"{card} {card}", f"1234 {grouped} word",
        "48451681 14407329 123", f"AB12 {grouped}", f"4845168114407320 {ip}", "BE68 5390 0754 7034 EUR", "BE68539007547034 1234 5678", f"{ip} 1234 212 555 1234",
    ]
    counts = [1, 1, 1, 2, 1, 1, 2, 2, 2, 1, 1, 1, 1, 1, 1, 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    there = pii.pseudonymize(df, "k")
    rows = there.orderBy("doc_id").collect()
    assert [r.n_pseudonyms for r in rows] == counts
    assert not any(x in r.text for r in rows for x in (card, grouped, ip, "48451681 14407329", "BE68"))
    alone = rows[0].text.split()[0]
    assert all(alone in r.text for r in rows[:9] if card in texts[r.doc_id]) and [rows[k].text.split()[-1] for k in (2, 13)] == ["123", "EUR"]
    assert [r.text for r in pii.pseudonymize(there, "k", back=True).orderBy("doc_id").collect()] == texts


def plain_feistel(a, b, sizes, key, tweak):
    """The permutation of pairs by hand."""
    draw = lambda turn, other: int(hashlib.sha256(f"{key}|{tweak}|{turn}|{other}".encode()).hexdigest()[:15], 16)
    for turn in range(1, pii.ROUNDS + 1):
        if turn % 2:
            a = (a + draw(turn, b) % sizes[0]) % sizes[0]
        else:
            b = (b + draw(turn, a) % sizes[1]) % sizes[1]
    return a, b


def plain_digits(digits, key, kind):
    u = len(digits) // 2
    v = len(digits) - u
    a, b = plain_feistel(int(digits[:u]), int(digits[u:]), (10**u, 10**v), key, f"{kind}{len(digits)}")
    return f"{a:0{u}}{b:0{v}}"


def plain_day(day, key):
    m0, months = (10, 3) if day.month > 9 else (1, 9)
    d0, days = (13, 19) if day.day > 12 else (10, 3) if day.day > 9 else (1, 9)
    a, b = (day.year - 1900) * months + day.month - m0, day.day - d0
    while True:
        a, b = plain_feistel(a, b, (200 * months, days), key, f"date|{m0}|{d0}")
        try:
            return datetime.date(1900 + a // months, a % months + m0, b + d0)
        except ValueError:
            pass


def test_pseudonyms_equal_plain_ones_and_link_all_formats(spark):
    rng = random.Random(8)
    numbers = ["".join(rng.choice("0123456789") for _ in range(10)) for _ in range(12)]
    ways = ["+1 {0} {1} {2}", "+1{0}{1}{2}", "+1-{0}-{1}-{2}", "+1 ({0}) {1}-{2}", "({0}) {1}-{2}", "{0}-{1}-{2}", "{0}.{1}.{2}"]
    others = ["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+44-20-7946-0958", "+358 9 1234 5678", "+35891234 5678"]
    days = [datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73049)) for _ in range(12)]
    dates = ["{0:04}-{1:02}-{2:02}", "{0:04}/{1:02}/{2:02}", "{2}/{1}/{0:04}", "{2:02}.{1:02}.{0:04}", "{1}/{2}/{0:04}"]
    cards = ["4845168114407329", "4845 1681 1440 7329", "4845-1681-1440-7329"]
    mails = ["Anna.Berg7@mail.example.com", "anna.berg7@mail.example.com", "ANNA.BERG7@mail.example.com"]
    made = [("phone", n, w.format(n[:3], n[3:6], n[6:])) for n in numbers for w in ways] + [("other", x[:3], x) for x in others]
    made += [("day", d, w.format(d.year, d.month, d.day)) for d in days for w in dates if d.day > 12 or not w.startswith("{1}")]
    made += [("card", cards[0], c) for c in cards] + [("mail", "", x) for x in mails]
    df = spark.createDataFrame([(k, f"see {x[2]} please") for k, x in enumerate(made)], "doc_id long, text string")
    there = pii.pseudonymize(df, "k")
    got = {r.doc_id: r.text[4:-7] for r in there.collect()}
    linked = {}
    for k, (kind, value, written) in enumerate(made):
        assert got[k] != written
        digits = "".join(c for c in got[k] if c.isdigit())
        if kind == "phone":
            assert digits[-10:] == plain_digits(value, "k", "phone1:") and digits[:-10] == ("1" if written[0] == "+" else "")
        elif kind == "day":
            new = plain_day(value, "k")
            w = dates[[w.format(value.year, value.month, value.day) for w in dates].index(written)]
            number = lambda x: [int(n) for n in re.split(r"[-/.]", x)]
            assert number(got[k]) == number(w.format(new.year, new.month, new.day))
        elif kind == "card":
            assert digits[:15] == plain_digits(cards[0][:15], "k", "card")
        else:
            linked.setdefault((kind, value), set()).add(digits.replace("440", "44", 1) if "(0)" in written else digits if kind == "other" else got[k].lower())
    assert all(len(x) == 1 for x in linked.values()) and "(0)" in got[made.index(("other", "+44", others[2]))]
    assert [r.text for r in pii.pseudonymize(there, "k", back=True).orderBy("doc_id").collect()] == [f"see {x[2]} please" for x in made]
    other = {r.doc_id: r.text[4:-7] for r in pii.pseudonymize(df.limit(40), "other").collect()}
    assert sum(got[k] == x for k, x in other.items()) == 0


def test_pseudonyms_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "call 212-555-1234", "a", "b", 7, "c")], "doc_id long, text string, _found string, `a.b` string, N_pseudonyms long, row string")
    out = pii.pseudonymize(df, "k")
    assert out.columns == ["doc_id", "text", "_found", "a.b", "row", "n_pseudonyms"]
    assert [(r[0], r[2], r[3], r[4], r[5]) for r in out.collect()] == [(1, "a", "b", "c", 1)]
    assert pii.pseudonymize(df.select("text"), "k").columns == ["text", "n_pseudonyms"]


def plain_probability_jaccard(a, b):
    a, b = (dict(zip(x[0].tolist(), x[1].tolist())) for x in (a, b))
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())


def classes(rows, least=0.8, weighted=False):
    """Components of equal texts and of shingles of at least this similarity, by comparing all pairs."""
    of_word = neardup.WordHash()
    sets = [neardup.shingles(t, of_word) for _, t in rows]
    alike = plain_probability_jaccard if weighted else lambda a, b: neardup.jaccard(a[0], b[0])
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][1] is not None and (rows[a][1] == rows[b][1] or alike(sets[a], sets[b]) >= least):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return [root(k) for k in range(len(rows))]


def test_near_duplicates_equal_all_pairs(spark, odd, none):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    rows = [(0, None), (1, None), (2, ""), (3, "!!"), (4, "!!")]
    for k in range(5, 110):  # around the similarity, so that links chain
        ws = list(base) if k % 3 else [f"v{rng.randint(0, 4000)}" for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 3)):
            ws[rng.randrange(len(ws))] = f"n{rng.randint(0, 10**6)}"
        rows.append((k, " ".join(ws)))
    rows.append((200, rows[60][1].upper()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert got == {rows[k][0]: rows[c][0] for k, c in enumerate(classes(rows))}
    kept = sorted(r.doc_id for r in neardup.keep_one(df).collect())
    assert kept == sorted(set(got.values()))
    again = neardup.keep_one(odd.unionByName(odd))
    assert sorted(repr(r.text) for r in again.collect()) == sorted(repr(t) for t in [None, None, *{t for _, t in ODD if t is not None}])
    assert again.columns == odd.columns and neardup.keep_one(none).count() == 0


def test_weighted_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(9)
    rows = []
    for k in range(20):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(80)]
        for c in range(4):
            ws = list(base)
            ws[rng.randrange(80)] = f"n{rng.randint(0, 10**6)}"
            rows.append((4 * k + c, " ".join([" ".join(ws[:20])] * rng.choice([1, 1, 3, 30]) + ws[20:])))
    of_word = neardup.WordHash()
    sets = [neardup.shingles(t, of_word) for _, t in rows]
    pairs = [(a, b) for k in range(0, 80, 4) for a in range(k, k + 4) for b in range(k, a)]
    same = [plain_probability_jaccard(sets[a], sets[b]) for a, b in pairs]
    assert [neardup.probability_jaccard(sets[a], sets[b]) for a, b in pairs] == pytest.approx(same)
    registers = neardup.signatures(sets, weighted=True)
    estimates = [(registers[a] == registers[b]).mean() for a, b in pairs]
    assert min(same) < 0.4 and np.mean(np.subtract(estimates, same)) == pytest.approx(0, abs=0.01) and np.abs(np.subtract(estimates, same)).max() < 0.2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for weighted in (False, True):
        got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df, weighted=weighted).collect()}
        assert got == {rows[k][0]: rows[c][0] for k, c in enumerate(classes(rows, weighted=weighted))}


def test_hot_groups_meet_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(common, "GROUP", 10)
    rows = spark.range(500).select(F.col("id").alias("key"), F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 70).alias("g"))
    groups = rows.groupBy("g").agg(F.count("*").alias("size"), F.min("key").alias("first"))
    got = common.met(rows, groups, "g", 500, "key").collect()
    assert sorted((r.key, r.g, r.first) for r in got) == sorted((r.key, r.g, r.first) for r in rows.join(groups, "g").collect()) and len(got) == 500
    edges = spark.createDataFrame([(0, k) for k in range(1, 300)] + [(k, k + 1000) for k in range(1, 100)] + [(5000, 5001)], "a long, b long")
    assert {r.label for r in components(edges).collect()} == {0, 5000} and components(edges).count() == 401


def test_small_checkpoints_go_to_few_files(spark):
    """Only the nodes and the verified links, which are costly to make, keep the partitions of their shuffles."""
    texts = [(k, " ".join(f"w{k // 3}x{j}" for j in range(30)) + (f" tail{k}" if k % 3 else "")) for k in range(60)]
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    folder = Path(common.shared_folder(spark).removeprefix("file:"))
    old = set(folder.iterdir())
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(texts, "doc_id int, text string").repartition(48)
        got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k: k - k % 3 for k in range(60)}
    files = [len(list(f.glob("part-*"))) for f in set(folder.iterdir()) - old if f.name.startswith("rdd-")]
    assert len(files) > 5 and sum(n > common.PARTS * spark.sparkContext.defaultParallelism for n in files) <= 2


def test_near_duplicates_that_differ_in_repeats(spark):
    of_word, rows = neardup.WordHash(), []
    for k in range(12):
        passage, rest = (" ".join(f"{c}{k}x{n}" for n in range(size)) for c, size in (("p", 54), ("r", 104)))
        rows += [(2 * k, f"{passage} {rest}"), (2 * k + 1, f"{' '.join([passage] * 2000)} {rest}")]
    sets = [neardup.shingles(t, of_word) for _, t in rows]
    registers = neardup.signatures(sets)
    for k in range(0, 24, 2):
        assert neardup.jaccard(sets[k][0], sets[k + 1][0]) > 0.95
        assert (registers[k] == registers[k + 1]).mean() >= neardup.ESTIMATE
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()} == {k: k - k % 2 for k in range(24)}


def test_components(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    assert {r.node: r.label for r in components(edges).collect()} == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 16)) * 3
    vectors = [(k, (centres[k % 20] + rng.standard_normal(16)).tolist()) for k in range(3000)]
    vectors += [(k, vectors[100][1]) for k in range(3000, 3300)]
    bad = [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [None] * 16), (5400, [1.0])]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x, ids = np.array([v for _, v in vectors]), np.array([k for k, _ in vectors])
    hit = 0
    for q in (k for k in range(0, 3300, 100)):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [ids[k] for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 11)) and all(s == pytest.approx(d[v]) for _, v, s in found)
        hit += len(set(want) & {v for _, v, _ in found})
    assert set(got) == set(range(0, 3300, 100)) and hit / (33 * 10) >= 0.9
    few = neighbours.search(df.where("vec_id < 4"), F.col("vec_id") % 100 == 0).collect()
    assert {r.vec_id for r in few} == {1, 2, 3}
    assert neighbours.search(df.where("false"), F.lit(True)).count() == 0


def test_neighbours_of_repeated_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(8)) for k in range(1500) for _ in range(1 + k % 2)]
    rows += rows
    rows += [(7, rows[0][1] + 1e-3 * rng.standard_normal(8)) for _ in range(200)]  # near id 0, and in many rows
    df = spark.createDataFrame([(k, v.tolist()) for k, v in rows], "vec_id long, embedding array<double>")
    got, hit = {}, 0
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    x, ids = np.array([v for _, v in rows]), np.array([k for k, _ in rows])
    for q in range(0, 1500, 100):
        v = x[ids == q][0]
        d = {}
        for k, s in zip(ids.tolist(), np.sqrt(((x - v) ** 2).sum(axis=1)).tolist()):
            d[k] = min(s, d.get(k, s))
        want = sorted((s, k) for k, s in d.items() if k != q)[:10]
        assert [r for r, _ in sorted(got[q])] == list(range(1, 11)) and len({v for _, v in got[q]}) == 10
        hit += len({k for _, k in want} & {v for _, v in got[q]})
    assert set(got) == set(range(0, 1500, 100)) and hit / 150 >= 0.9 and sorted(got[0])[0] == (1, 7)
    few = rng.standard_normal((30, 8))  # one leaf: exact
    twice = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(few)] * 2, "vec_id long, embedding array<double>")
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.search(twice, F.lit(True)).collect())
    near = lambda q: [k for k in np.argsort(((few - few[q]) ** 2).sum(axis=1)).tolist() if k != q][:10]
    assert found == [(q, n, k) for q in range(30) for n, k in enumerate(near(q), 1)]


def test_queries_run_and_equal_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, run in queries.QUERIES.items():
        df = run(spark, SF)
        found = df.collect()
        assert found
        if name in queries.SQL:
            want = con.execute(f"select {', '.join(df.columns)} from ({queries.SQL[name]})").fetchall()
            assert sorted(map(tuple, found)) == sorted(want)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids)) and set(docs.columns) <= set(out[0].__fields__)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    first = {rows[c][0] for c in classes(rows)}
    bad = {r[0] for r in decontam.brute_force(rows, [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]) if r[5]}
    lettered = {i for i, t in rows if t and language.has_letter(t)}
    assert set(ids) <= (first - bad) & lettered and len(set(ids)) >= len((first - bad) & lettered) - 2
    empty = docs.where("false")
    for extra in ("language", "found", "pseudonyms", "key", "row", "a.b"):
        empty = empty.withColumn(extra, F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, empty, SF)
        assert done.count() == 0 and done.columns[: len(empty.columns)] == empty.columns
        assert done.columns == empty.columns or name == corpus_pipeline.STAGES[-1][0]
