"""Greedy selections without a sequential pass.

Going through ranked things and keeping each that conflicts with none kept so
far gives one set only. Of a stretch of the order it is found in rounds: whatever no undecided thing
ahead of it conflicts with is kept, and what it conflicts with goes. A round is
two anti-joins on the conflicts left; their number shrinks fast, as for a random
order. Every round is checkpointed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators import spatial
from geoloom.operators.graph import shared


def beaten(conflicts: DataFrame) -> DataFrame:
    """(id): all that a greedy pass drops. conflicts is (ahead, behind), each pair once, by a total order without ties."""
    left = shared(conflicts.select("ahead", "behind").distinct())
    dropped = left.select(F.col("behind").alias("id")).limit(0)
    while not left.isEmpty():
        kept = left.select(F.col("ahead").alias("id")).distinct().join(left.select(F.col("behind").alias("id")).distinct(), "id", "left_anti")
        gone = shared(left.join(kept, left.ahead == kept.id, "left_semi").select(F.col("behind").alias("id")).distinct())
        dropped = dropped.unionByName(gone)
        left = left.join(gone, left.behind == gone.id, "left_anti")
        left = shared(left.join(gone, left.ahead == gone.id, "left_anti"))
    return dropped


def conflict_free(ranked: DataFrame, conflicts: DataFrame, rank: list[Column]) -> DataFrame:
    """Rows of ranked (id, ...) that a pass in the order of rank keeps; conflicts is (a, b). Ties of rank go to the smaller id.

    Conflicts with an id that ranked lacks, or of an id with itself, count for nothing.
    """
    place = ranked.select("id", F.struct(*rank, F.col("id").alias("_id")).alias("place"))
    pairs = conflicts.where("a <> b").join(place.select(F.col("id").alias("a"), F.col("place").alias("pa")), "a").join(place.select(F.col("id").alias("b"), F.col("place").alias("pb")), "b")
    first = F.col("pa") < F.col("pb")
    order = pairs.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("ahead"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("behind"))
    return ranked.join(beaten(order), "id", "left_anti")


#: Things in the first stretch of a greedy selection, and how many sampled ranks its end is found among.
FIRST, RANKS = 8192, 4096


def in_stretches(ranked: DataFrame, conflicts: Callable[[DataFrame, DataFrame], DataFrame], rank: list[Column]) -> DataFrame:
    """Rows of ranked (id, ...) that a pass in the order of rank keeps, where conflicts(left, right) finds the (a, b) of things of left and right in conflict.

    Stretches of the order are done one after another, each about twice as long as the one
    before. What is kept of a stretch takes out all behind it that it conflicts with, so
    conflicts among things that go early are never listed. Ties of rank go to the smaller id.
    """
    columns, kept, size = ranked.columns, [], FIRST
    left = ranked.withColumn("_place", F.struct(*rank, F.col("id").alias("_id")))
    kinds = left.schema["_place"].dataType
    while True:
        share = max(size // RANKS, 1)
        end = left.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).select("_place").orderBy("_place").offset(size // share).limit(1).collect()
        upto = F.col("_place") <= F.struct(*[F.lit(v).cast(k.dataType).alias(k.name) for v, k in zip(end[0]._place, kinds)]) if end else F.lit(True)
        stretch = left.where(upto).drop("_place")
        kept.append(shared(conflict_free(stretch, conflicts(stretch, stretch).where("a < b").distinct(), rank)))
        if not end:
            break
        rest = left.where(~upto)
        hit = conflicts(kept[-1], rest).select(F.col("b").alias("id")).distinct()
        left, size = shared(rest.join(hit, "id", "left_anti")), size * 2
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out.select(*columns)


def spaced(points: DataFrame, reach: str, most: float, rank: list[Column]) -> DataFrame:
    """Points (id, x, y, reach, ...) kept in the order of rank, each at least the larger of both reaches from all kept.

    most bounds the reaches: larger ones raise an error.
    """
    checked = F.when(F.col(reach) <= most, F.col(reach)).otherwise(F.raise_error(F.lit(f"a reach is over {most}")))

    def near(a: DataFrame, b: DataFrame) -> DataFrame:
        at = lambda df, n: df.select("id", "x", "y", checked.alias("r")).withColumnsRenamed({c: c + n for c in ("id", "x", "y", "r")})
        left = spatial.near_cells(at(a, "a"), most, "xa", "ya")
        right = at(b, "b").withColumns({"gx": spatial.cell(F.col("xb"), most), "gy": spatial.cell(F.col("yb"), most)})
        dx, dy = F.col("xa") - F.col("xb"), F.col("ya") - F.col("yb")
        met = left.join(right, ["gx", "gy"]).where(F.sqrt(dx * dx + dy * dy) < F.greatest("ra", "rb"))
        return met.select(F.col("ida").alias("a"), F.col("idb").alias("b"))

    return in_stretches(points, near, rank)


def best_pairs(candidates: DataFrame) -> DataFrame:
    """Pairs (a, b, score) taken best first, each end once; ties by a, then b.

    A pair that is the best of both its ends is certain, so a round takes all such pairs.
    """
    left, taken = shared(candidates.select("a", "b", "score")), []
    while not left.isEmpty():
        ends = left.select(F.explode(F.array("a", "b")).alias("end"), F.struct("score", "a", "b").alias("p"))
        best = ends.groupBy("end").agg(F.min("p").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n = 2")
        won = shared(best.select("p.a", "p.b", "p.score"))
        taken.append(won)
        used = won.select(F.explode(F.array("a", "b")).alias("end"))
        left = shared(left.join(used, left.a == used.end, "left_anti").join(used, F.col("b") == used.end, "left_anti"))
    out = candidates.select("a", "b", "score").limit(0)
    for won in taken:
        out = out.unionByName(won)
    return out


def prune_spurs(edges: DataFrame, least: float, rounds: int = 4) -> DataFrame:
    """Edges (a, b, length) less the leaf edges shorter than least, in at most `rounds` rounds."""
    now = edges
    for _ in range(rounds):
        ends = now.select(F.explode(F.array("a", "b")).alias("node"))
        leaves = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("node")
        at = lambda end, flag: leaves.select(F.col("node").alias(end), F.lit(True).alias(flag))
        marked = now.join(at("a", "la"), "a", "left").join(at("b", "lb"), "b", "left")
        alone = F.coalesce("la", F.lit(False)) | F.coalesce("lb", F.lit(False))
        marked = shared(marked.select(*edges.columns, (alone & (F.col("length") < least)).alias("_spur")))
        now = marked.where("not _spur").drop("_spur")
        if marked.where("_spur").isEmpty():
            break
    return now
