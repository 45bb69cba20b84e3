"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

Each of a document's distinct shingles is a Poisson process whose rate is its
weight; every arrival falls into one of the registers, and a register keeps its
earliest arrival. A shingle stops arriving once it is later than the document's
latest register. Two documents' registers agree with probability equal to the
probability Jaccard similarity of their weights. Documents that agree on a band
of registers are candidates, and candidates are verified by exactly that similarity.

A shingle weighs 1, or as often as it occurs. With weights of 1 the probability
Jaccard similarity is the Jaccard similarity of the shingle sets.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import column, cut, met, ship, table, words
from geoloom.llm.components import components

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 32, 5
#: Registers that agree estimate the similarity with a standard error of 0.032 at 0.8; five of them below 0.8 lie here.
ESTIMATE = 0.64
#: Rows and shingles in a block, about.
BLOCK, MOST = 2048, 1_000_000


class WordHash(dict):
    """64-bit hashes of words. Remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, of_word: WordHash, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of `size` consecutive words (a shorter text, but not an empty one, is one shingle) and their counts."""
    ws = words(text)
    if not ws:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(of_word.__getitem__, ws), np.uint64, len(ws))
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return np.unique(mixed(out), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], weighted: bool = False, m: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash registers, one row a set; a set without shingles has all ones. weighted: by the counts."""
    q = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    flat = q.reshape(-1)
    sizes = [len(s) for s, _ in sets]
    if not sum(sizes):
        return q.astype(np.uint32)
    element = np.concatenate([s for s, _ in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    rest = 1 / np.concatenate([n for _, n in sets]) if weighted else np.ones(len(element))  # mean time between arrivals
    at = np.zeros(len(element))
    step = 0
    while len(element):
        step += 1
        draw = mixed(element + np.uint64((step * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        at = at - rest * np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        register = ((mixed(draw) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        packed = at.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | element >> np.uint64(32)
        np.minimum.at(flat, doc * m + register, packed)
        active = packed < q.max(axis=1)[doc]
        element, doc, at, rest = element[active], doc[active], at[active], rest[active]
    return q.astype(np.uint32)  # the low half: which shingle holds the register


def bands(registers: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of registers, with the band's number in it."""
    r = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), r.shape[:2])
    for k in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + r[:, :, k])
    return out.view(np.int64)


def sketch(registers: np.ndarray) -> np.ndarray:
    """A byte of each register, to estimate similarities by."""
    return (mixed(registers.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - both
    return both / total if total else 0.0


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of weighted shingles: the sum, over those d of both, of 1 / sum over all e of max(a(e) / a(d), b(e) / b(d))."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    after = np.searchsorted(ratio, ratio, "right")  # beyond it a(e) / a(d) is the larger one
    larger, smaller = x.sum() - np.concatenate([[0], np.cumsum(x)])[after], np.concatenate([[0], np.cumsum(y)])[after]
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    return float((1 / ((only_a + larger) / x + (only_b + smaller) / y)).sum()) if len(x) else 0.0


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weighted: bool) -> float:
    return probability_jaccard(a, b) if weighted else jaccard(a[0], b[0])


def _signed(texts: DataFrame, weighted: bool) -> DataFrame:
    """key, id, text -> key, id, n (distinct shingles), bands, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = WordHash()
        for batch in batches:
            column, at = batch.column("text"), 0
            while at < len(batch):
                sets, held, begin = [], 0, at
                while at < len(batch) and (not sets or held < 400_000):
                    sets.append(shingles(column[at].as_py(), of_word))
                    held += len(sets[-1][0])
                    at += 1
                registers = signatures(sets, weighted)
                named, marks = bands(registers), sketch(registers)
                some = [len(s) > 0 for s, _ in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(begin, at - begin),
                        batch.column("id").slice(begin, at - begin),
                        pa.array([len(s) for s, _ in sets], pa.int64()),
                        pa.array([b if x else [] for b, x in zip(named, some, strict=True)], pa.list_(pa.int64())),
                        pa.array([s.tobytes() if x else b"" for s, x in zip(marks, some, strict=True)], pa.binary()),
                    ],
                    ["key", "id", "n", "bands", "sketch"],
                )

    schema = texts.select("key", "id").schema.add("n", "long").add("bands", T.ArrayType(T.LongType())).add("sketch", "binary")
    return texts.mapInArrow(run, schema)


def _verified(pairs: DataFrame, texts: DataFrame, least: float, weighted: bool) -> DataFrame:
    """The pairs (a, b) of keys whose texts have a similarity of at least `least`."""
    first = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("size")).join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    second = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    joined = met(pairs.select("a", "b"), first, "a", pairs.count(), "b").join(second, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word, known = WordHash(), OrderedDict()

        def of(key: bytes, text: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
            if key not in known:
                known[key] = shingles(text.as_py(), of_word)
                if len(known) > 64:
                    known.popitem(last=False)
            known.move_to_end(key)
            return known[key]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ok = pa.array([similarity(of(x, batch.column("text_a")[k]), of(y, batch.column("text_b")[k]), weighted) >= least for k, (x, y) in enumerate(zip(a, b, strict=True))], pa.bool_())
            yield batch.select(["a", "b"]).filter(ok)

    return joined.mapInArrow(run, pairs.select("a", "b").schema)


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The stretches of rows that agree in the `by` columns, over batch ends too."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in by]
        edges = [0, *(np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1).tolist(), len(batch)]
        if held and any(held[0].column(c)[0].as_py() != batch.column(c)[0].as_py() for c in by):
            yield pa.Table.from_batches(held)
            held = []
        for begin, end in zip(edges, edges[1:], strict=False):
            held.append(batch.slice(begin, end - begin))
            if end < len(batch):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over 0..n-1; the root is the least."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.root(x), self.root(y)))
        self.up[y] = x


def _stars(keys: list[bytes], forest: Forest) -> pa.RecordBatch:
    """(a, b): each member but the root with its root, so that links leave a task in linear number."""
    ends = [(keys[r], keys[k]) for k in range(len(keys)) if (r := forest.root(k)) != k]
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in ends], pa.binary()), pa.array([y for _, y in ends], pa.binary())], ["a", "b"])


def _dealt(members: DataFrame, by: str, total: int) -> DataFrame:
    """Members of each group `by` in blocks of about BLOCK rows and MOST shingles; every two blocks (i, j) meet in one task."""
    sizes = members.groupBy(by).agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / MOST)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("size"))
    dealt = met(members, sizes, by, total, "key").withColumn("own", F.pmod(F.xxhash64("key"), F.greatest("blocks", F.lit(1))).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("own", "other", "blocks")
    return dealt.repartition(by, "i", "j").sortWithinPartitions(by, "i", "j", "key")


def _alike(members: DataFrame, least: float, weighted: bool, total: int) -> DataFrame:
    """Links (a, b) between members of a band that may be similar but have different labels, by estimate and, without weights, size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["band", "i", "j"]):
            keys = group.column("key").to_pylist()
            label = np.unique(group.column("label").to_numpy(), return_inverse=True)[1]
            if len(keys) < 2 or label.max() == 0:
                continue
            n = group.column("n").to_numpy()
            marks = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(keys), -1)
            forest = Forest(len(keys))
            for k in range(len(keys) - 1):
                rest = slice(k + 1, None)
                fits = (label[rest] != label[k]) & (weighted | (np.minimum(n[rest], n[k]) >= least * np.maximum(n[rest], n[k])))
                where = np.flatnonzero(fits) + k + 1
                if len(where):
                    same = (marks[where] == marks[k]).mean(axis=1)
                    for other in where[(same - 1 / 256) / (255 / 256) >= ESTIMATE]:
                        forest.join(k, int(other))
            yield _stars(keys, forest)

    return _dealt(members, "band", total).mapInArrow(run, "a binary, b binary").distinct()


def _linked(members: DataFrame, least: float, weighted: bool, total: int) -> DataFrame:
    """Links (a, b) that hold together what is truly similar within each cluster: every pair is met, by exact similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = WordHash()
        for group in _runs(batches, ["cluster", "i", "j"]):
            keys = group.column("key").to_pylist()
            if len(keys) < 2:
                continue
            counted = [shingles(t.as_py(), of_word) for t in group.column("text")]
            sets = [s for s, _ in counted]
            n = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), n)
            number = np.unique(np.concatenate(sets), return_inverse=True)[1]
            order = np.argsort(number, kind="stable")
            holders, often = owner[order], np.bincount(number)
            first = np.concatenate([[0], np.cumsum(often)])
            ends = np.concatenate([[0], np.cumsum(n)])
            forest = Forest(len(keys))
            for k in range(len(keys)):  # the holders of each of its shingles, counted by holder
                own = number[ends[k] : ends[k + 1]]
                lengths = often[own]
                at = np.repeat(first[own] + lengths - np.cumsum(lengths), lengths) + np.arange(lengths.sum())
                both = np.bincount(holders[at], minlength=len(keys))
                close = both > 0 if weighted else both >= least * (n + n[k] - both)
                for other in np.flatnonzero(close):
                    if other > k and (not weighted or probability_jaccard(counted[k], counted[other]) >= least):
                        forest.join(k, int(other))
            yield _stars(keys, forest)

    return _dealt(members, "cluster", total).mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST, weighted: bool = False) -> DataFrame:
    """(id, key, class_id, class_size, class_key): one row for each row of docs.

    Classes are the connected components of the links: equal texts, and texts whose
    five-word shingles have a similarity of at least `least`: that of their sets, or
    with `weighted` the probability Jaccard similarity of their counts. class_id is
    the least id of the class, class_size its number of rows, key the text's md5,
    class_key the least key of the class.

    First each distinct text is a node. In each band the node with the least
    key leads and the others are verified against it. Bands that still hold
    several components are then compared across them in blocks by estimate.
    What may be similar forms clusters, whose pairs are all met in blocks by
    exact similarity, so that no link is lost to the choice of leaders. Tasks
    give out a spanning star of what they link, not the pairs. Hot bands,
    clusters and nodes are joined over several tasks; nothing is collected.

    Null texts are each a class of their own (class_id is their id). Texts
    without a word link only to equal texts. Texts of fewer than five words are
    one shingle. Repeated rows, also of one id, are copies. Rows with a null id
    belong to classes; a class of null ids only has a null class_id. An empty
    table gives no rows.
    """
    ship(docs.sparkSession)
    base = docs.select(column(id).alias("id"), F.unhex(F.md5(column(text).cast("binary"))).alias("key"), column(text).alias("text"))
    signed = _signed(base.where("text is not null"), weighted)
    nodes = cut(
        signed.groupBy("key")
        .agg(F.min(F.struct("id", "n", "bands", "sketch")).alias("x"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .select("key", "id", F.col("x.id").alias("at"), "copies", "x.n", "x.bands", "x.sketch")
    )
    total = nodes.count() * BANDS
    exploded = nodes.select("key", "n", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("key", "n")).alias("first")).where("size > 1")
    within = cut(met(exploded, cut(shared, total), "band", total, "key"), total)
    fits = F.lit(True) if weighted else F.expr(f"least(n, first.n) >= {least} * greatest(n, first.n)")
    stars = cut(within.where(F.col("first.key") != F.col("key")).where(fits).select(F.col("first.key").alias("a"), F.col("key").alias("b")).distinct(), total)

    wanted = stars.select(F.col("a").alias("key")).unionByName(stars.select(F.col("b").alias("key"))).distinct().join(nodes.select("key", "at"), "key")
    texts = base.where("text is not null").join(wanted, "key").where("id <=> at").select("key", "text").dropDuplicates(["key"])
    links = cut(_verified(stars, texts, least, weighted))
    labels = components(links, rows=total)
    labelled = within.join(labels, within.key == labels.node, "left").select("band", "key", "n", F.coalesce("label", "key").alias("label"))
    split = labelled.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size")).where("x <> y").select("band", "size")
    members = met(labelled, split, "band", total, "key").join(nodes.select("key", "sketch"), "key")
    clusters = components(_alike(members.select("band", "key", "label", "n", "sketch"), least, weighted, total), rows=total).select(F.col("node").alias("key"), F.col("label").alias("cluster"))
    clusters = cut(clusters.join(nodes.select("key", "n", "at"), "key"), total // BANDS)
    alike = base.where("text is not null").join(clusters, "key").where("id <=> at").dropDuplicates(["key"]).select("key", "cluster", "n", "text")
    late = _linked(alike, least, weighted, total)
    ends = late.join(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), "a", "left").join(labels.select(F.col("node").alias("b"), F.col("label").alias("y")), "b", "left")
    contracted = components(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")), rows=total)
    top = contracted.select(F.col("node").alias("label"), F.col("label").alias("top"))
    # nodes of a component of stars, or that only a late link reaches
    final = labels.join(top, "label", "left").select(F.col("node").alias("key"), F.coalesce("top", "label").alias("label"))
    alone = contracted.join(labels.select("node"), "node", "left_anti").select(F.col("node").alias("key"), "label")
    linked = final.unionByName(alone)
    placed = nodes.select("key", "id", "copies").join(linked, "key", "left").where("copies > 1 or label is not null")
    placed = placed.withColumn("label", F.coalesce("label", "key"))
    classes = placed.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("copies").alias("class_size"))
    of_key = cut(placed.select("key", "label").join(classes, "label").select("key", "class_id", "class_size", F.col("label").alias("class_key")), total // BANDS)
    found = base.select("id", "key").join(of_key.withColumn("known", F.lit(True)), "key", "left")
    return found.select(
        F.col("id").alias(id),
        "key",
        F.when(F.col("known"), F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce("class_key", "key").alias("class_key"),
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST, most_broadcast: int = 200_000) -> DataFrame:
    """The rows of docs without near duplicates: of each class the row of the least id stays, of its rows the one of the least key.

    Null texts all stay. A null id loses to any other; of several equal rows one
    stays. The rows that go are told to all tasks if they are at most
    `most_broadcast`, else by a join.
    """
    found = near_duplicates(docs, id, text, least).where("class_size > 1")
    found = cut(found.select(column(id).alias("i"), F.col("key").alias("k"), F.col("class_id").eqNullSafe(column(id)).alias("first"), F.col("class_key").alias("class")))
    gone = found.where("not first").select("i", "k")
    again = found.where("first").groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k"), F.first("i").alias("i")).where("n > 1")
    marked = docs.select(F.struct(*map(column, docs.columns)).alias("row"), column(id).alias("id"), F.unhex(F.md5(column(text).cast("binary"))).alias("key"))
    same = lambda side: marked["id"].eqNullSafe(side["i"]) & (marked["key"] == side["k"])
    n = gone.count()
    kept = marked.join(F.broadcast(gone) if n <= most_broadcast else gone, same(gone), "left_anti")
    if not again.isEmpty():  # rows of one id
        several = cut(found.where("first").join(again.select("class"), "class").select("i", "k").distinct())
        kept = kept.join(several, same(several), "left_anti").unionByName(marked.join(again, same(again), "left_semi").dropDuplicates(["key"]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "class_size")
