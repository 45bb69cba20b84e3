"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is indexed under the leaf that
it falls into. A search walks the tree best bin first: a priority queue holds
branches by their centre's distance, and the nearest is opened next. How many
leaves a search visits is calibrated: brute force over all rows gives the true
neighbours of some queries, and visits widen until the wanted share is found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.llm.common import ship, table

BLOCK = 50_000


@dataclass
class Tree:
    """children[k]: the nodes below node k, none for a leaf. leaf[k]: a leaf's number, else -1."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the nearest centre at each node, to the first at ties."""
        node = np.zeros(len(vectors), np.int64)
        while True:
            inner = [k for k in np.unique(node) if self.children[k]]
            if not inner:
                return np.array(self.leaf)[node]
            for k in inner:
                at, below = np.flatnonzero(node == k), np.array(self.children[k])
                node[at] = below[distances(vectors[at], self.centres[below]).argmin(axis=1)]

    def order(self, vector: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if below := self.children[node]:
                for d, child in zip(distances(vector[None], self.centres[below])[0].tolist(), below, strict=True):
                    heapq.heappush(queue, (d, child))
            else:
                yield self.leaf[node]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of rows, up to rounding."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T), 0)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Number of the cluster of each row; some may be empty."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = distances(x, centres).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return own


def grow(sample: np.ndarray, branches: int = 8, leaf: int = 64, seed: int = 5) -> Tree:
    """Splits by k-means until a node holds at most `leaf` rows of the sample or can't be split."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.empty((0, 0)), [], [])
    centres: list[np.ndarray] = []

    def add(rows: np.ndarray) -> int:
        number = len(centres)
        centres.append(rows.mean(axis=0) if len(rows) else np.zeros(sample.shape[1]))
        tree.children.append([])
        tree.leaf.append(-1)
        if len(rows) > leaf:
            own = kmeans(rows, branches, rng)
            if len(parts := np.unique(own)) > 1:
                tree.children[number] = [add(rows[own == p]) for p in parts]
        if not tree.children[number]:
            tree.leaf[number] = tree.leaves
        return number

    add(sample)
    tree.centres = np.stack(centres)
    return tree


def nearest(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k nearest other ids, each at its nearest row: (query's number, row's number, distance), ties to the smaller id.

    A matrix product finds who may be among them; the distances given are those of the vectors' differences.
    """
    out = []
    by_id = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[:1]] - 1))
    last = min(k, len(starts)) - 1
    for begin in range(0, len(queries) if len(rows) else 0, 64):
        q = queries[begin : begin + 64]
        near = distances(q, rows)
        near[ids[None] == own[begin : begin + 64, None]] = np.inf
        of_ids = near if len(starts) == len(rows) else np.minimum.reduceat(near[:, by_id], starts, axis=1)
        kth = np.partition(of_ids, last, axis=1)[:, last]
        slack = 1e-9 * (1 + (q * q).sum(axis=1) + float((rows * rows).sum(axis=1).max(initial=0)))
        for r in range(len(q)):
            at = np.flatnonzero((near[r] <= kth[r] + slack[r]) & np.isfinite(near[r]))
            exact = np.sqrt(((q[r] - rows[at]) ** 2).sum(axis=1))
            best = np.lexsort((ids[at], exact))
            if len(starts) < len(rows):
                best = best[np.sort(np.unique(ids[at[best]], return_index=True)[1])]
            best = best[:k]
            out.append((np.full(len(best), begin + r), at[best], exact[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 2 + (np.empty(0),)


def usable(vector: str) -> F.Column:
    """Not null or zero, and without a null or non-finite component."""
    v = F.col(vector)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def stacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def search(
    rows: DataFrame,
    queries: F.Column,
    k: int = 10,
    recall: float = 0.98,
    sample_rows: int = 20_000,
    calibration: int = 128,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of other ids for every row where `queries` holds.

    Fitted on at most `sample_rows` rows and calibrated on at most `calibration`
    queries, both picked by a hash of the id; the calibration's true neighbours
    and the index cover every row. A search that meets no more than k ids goes
    on until it does or all leaves are visited.

    Unusable vectors, null ids and vectors whose length isn't the commonest (the
    shorter at ties) take no part. Rows of one id are that id's, at their least
    distance; such a query is its first vector in order. Fewer than k other rows
    give them all; an empty table gives no rows. Leaves of many rows are dealt
    into blocks of about BLOCK, so that a common vector isn't one task's.
    """
    spark = rows.sparkSession
    ship(spark)
    ready = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asked")).where("vec_id is not null").where(usable("v"))
    lengths = ready.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    ready = ready.where(F.size("v") == lengths[0].d)
    total = lengths[0]["count"]
    draw = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_003))
    sample = ready.where(draw < min(1.0, 1.2 * sample_rows / total) * 1_000_003).orderBy(draw, "vec_id", "v").limit(sample_rows).select("v").collect()
    tree = grow(np.array([r.v for r in sample] or [[0.0] * lengths[0].d]))
    asked = ready.where("asked").groupBy("vec_id").agg(F.min("v").alias("v"))
    trial = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(calibration).collect()
    share = spark.sparkContext.broadcast((tree, np.array([r.vec_id for r in trial]), np.array([r.v for r in trial])))  # both bounded

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = share.value[0]
        for batch in batches:
            if len(batch):
                leaf = tree.assign(stacked(batch.column("v")))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), batch.column("vec_id"), batch.column("v")], ["leaf", "vec_id", "v"])

    indexed = ready.select("vec_id", "v").mapInArrow(index, "leaf int, vec_id bigint, v array<double>")

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, own, vectors = share.value
        for batch in batches:
            if len(batch) and len(own):
                ids, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
                q, r, d = nearest(vectors, own, stacked(batch.column("v")), ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(ids[r]), pa.array(leaf[r]), pa.array(d)], ["query_id", "vec_id", "leaf", "score"])

    true = indexed.mapInArrow(truth, "query_id bigint, vec_id bigint, leaf int, score double").groupBy("query_id", "vec_id")
    true = best(true.agg(F.min(F.struct("score", "leaf")).alias("x")).select("query_id", "vec_id", "x.leaf", "x.score"), k).collect()
    position = {r.vec_id: {leaf: n for n, leaf in enumerate(tree.order(np.array(r.v)), 1)} for r in trial}
    needed = sorted(position[r.query_id][r.leaf] for r in true)
    visits = needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1
    held = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # as many as leaves
    homes = indexed.groupBy("vec_id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").count()  # an id counts in one leaf only
    others = {r.leaf: r["count"] for r in homes.collect()}
    plan = spark.sparkContext.broadcast((tree, visits, held, others))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, visits, held, others = plan.value
        for batch in batches:
            at, leaves, blocks = [], [], []
            for n, v in enumerate(stacked(batch.column("v"))):
                met = 0
                for place, leaf in enumerate(tree.order(v)):
                    if place >= visits and met > k:
                        break
                    met += others.get(leaf, 0)
                    for block in range(-(-held.get(leaf, 0) // BLOCK)):
                        at.append(n)
                        leaves.append(leaf)
                        blocks.append(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves, pa.int32()), pa.array(blocks, pa.int32()), batch.column("vec_id").take(pa.array(at, pa.int64())), batch.column("v").take(pa.array(at, pa.int64()))],
                ["leaf", "block", "query_id", "q"],
            )

    wanted = asked.mapInArrow(ask, "leaf int, block int, query_id bigint, q array<double>")
    blocks = F.create_map(*[F.lit(x) for leaf, n in held.items() for x in (leaf, -(-n // BLOCK))])
    stored = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), blocks[F.col("leaf")]).cast("int"))

    def meet(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(stored):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        own, ids = asked["query_id"].to_numpy(), stored["vec_id"].to_numpy()
        q, r, d = nearest(np.stack(asked["q"]), own, np.stack(stored["v"]), ids, k)
        return pd.DataFrame({"query_id": own[q], "vec_id": ids[r], "score": d})

    met = wanted.groupBy("leaf", "block").cogroup(stored.groupBy("leaf", "block")).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    return best(met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), k)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k least scores of each query, ranked from 1; ties to the smaller vec_id."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score")
