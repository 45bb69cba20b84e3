"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks. With the share w of the mixture, a source's
block k (from 0) is released at slot floor(k / w) and due by slot ceil((k+1) / w).
Earliest deadline first gives each slot to a released block. As the shares sum
to one, every block is in time, so at any slot a source is less than one block
from its share.

At any slot a source has had the whole part of its share, or one block more. So
the state of the schedule is small, and stretches of slots are scheduled side by
side: each starts from a state that can go on (the sources one block ahead are
those of the earliest deadlines), and is done again while the stretch before it
ends in another one. When all agree, the stretches are the one schedule. All in
DataFrame functions.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.llm.common import column, cut, table

#: The shares are whole parts of this; over 2**40 slots that moves a source by less than 2**-20 of a block for each source.
SCALE = 2**60
#: Slots in a stretch.
STRETCH = 512
#: Later deadlines count as this one.
LATEST = 2**62


def shares(weights: dict[str, float]) -> dict[str, int]:
    """The positive weights in parts of SCALE, at least one each; what rounding leaves goes to the greatest."""
    exact = {k: Fraction(w) for k, w in weights.items() if w > 0}
    total = sum(exact.values())
    out = {k: max(1, math.floor(w * SCALE / total)) for k, w in exact.items()}
    if out:
        out[max(sorted(out), key=out.__getitem__)] += SCALE - sum(out.values())
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is made once."""
    return F.transform(F.array(value), body)[0]


def wide(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("decimal(19,0)")


def parts(a: Column, b: Column, by: Column) -> Column:
    """a * b div `by` and whether a rest stays; exact up to 38 digits."""
    return let(wide(a) * wide(b), lambda x: F.struct(F.call_function("div", x, wide(by)).alias("whole"), (x % wide(by)).cast("long").alias("rest")))


def able(slot: Column, share: Column) -> Column:
    """Blocks of each source before a slot: its share's whole part, and one more for as many sources of the earliest deadlines as slots are left."""
    scale = F.lit(SCALE)
    due = lambda k, p: let(parts(k + 1, scale, p), lambda x: x["whole"] + F.when(x["rest"] > 0, 1).otherwise(0))
    had = F.transform(share, lambda p, i: let(parts(slot, p, scale), lambda x: F.struct(x["whole"].alias("k"), x["rest"].alias("rest"), due(x["whole"], p).alias("due"), i.cast("int").alias("i"))))

    def ahead(had: Column) -> Column:
        left = slot - F.aggregate(had, F.lit(0).cast("long"), lambda n, x: n + x["k"])
        first = F.slice(F.array_sort(F.transform(F.filter(had, lambda x: x["rest"] > 0), lambda x: F.struct(x["due"], x["i"]))), F.lit(1), left.cast("int"))
        return let(F.transform(first, lambda x: x["i"]), lambda chosen: F.transform(had, lambda x: x["k"] + F.when(F.array_contains(chosen, x["i"]), 1).otherwise(0)))

    return let(had, ahead)


PLACED = "array<struct<i:int,k:bigint,release:bigint,deadline:bigint>>"


def scheduled(starts: DataFrame, share: Column, stretch: int) -> DataFrame:
    """m, start (blocks of each source before the stretch) -> also placed, one block a slot, and stop: the blocks after it."""
    scale = F.lit(SCALE)
    source = F.zip_with(
        F.col("start"),
        share,
        lambda k, p: let(
            F.struct(parts(k, scale, p).alias("now"), parts(k + 1, scale, p).alias("next"), parts(F.lit(1), scale, p).alias("step")),
            lambda x: F.struct(k.alias("k"), x["now"]["whole"].alias("release"), x["next"]["whole"].alias("then"), x["next"]["rest"].alias("rest"), p.alias("p"), x["step"]["whole"].alias("a"), x["step"]["rest"].alias("b")),
        ),
    )

    def after(x: Column) -> Column:
        over = x["rest"] + x["b"] >= x["p"]
        return F.struct(
            (x["k"] + 1).alias("k"), x["then"].alias("release"), (x["then"] + x["a"] + F.when(over, 1).otherwise(0)).alias("then"),
            (x["rest"] + x["b"] - F.when(over, x["p"]).otherwise(0)).alias("rest"), x["p"].alias("p"), x["a"].alias("a"), x["b"].alias("b"),
        )

    def give(state: Column, slot: Column) -> Column:
        waiting = F.transform(
            state["sources"],
            lambda x, i: F.when(x["release"] <= slot, F.struct((x["then"] + F.when(x["rest"] > 0, 1).otherwise(0)).alias("deadline"), i.cast("int").alias("i"), x["k"].alias("k"), x["release"].alias("release"))),
        )
        return let(
            F.array_min(waiting),
            lambda b: F.struct(
                F.transform(state["sources"], lambda x, i: F.when(i == b["i"], after(x)).otherwise(x)).alias("sources"),
                F.concat(state["placed"], F.array(F.struct(b["i"].alias("i"), b["k"].alias("k"), b["release"].alias("release"), b["deadline"].alias("deadline")))).alias("placed"),
            ),
        )

    slots = F.sequence(F.col("m") * stretch, F.col("m") * stretch + (stretch - 1))
    done = F.aggregate(slots, F.struct(source.alias("sources"), F.array().cast(PLACED).alias("placed")), give, lambda s: F.struct(s["placed"].alias("placed"), F.transform(s["sources"], lambda x: x["k"]).alias("stop")))
    return starts.select("m", "start", done.alias("done")).select("m", "start", "done.placed", "done.stop")


def schedule(spark: SparkSession, share: list[int], slots: int, stretch: int = STRETCH) -> DataFrame:
    """i, k, release, deadline, slot: earliest deadline first over at least `slots` slots, ties to the first source."""
    ps = F.array(*[F.lit(p).cast("long") for p in share])
    starts = spark.range(-(-slots // stretch)).select(F.col("id").alias("m"), able(F.col("id") * stretch, ps).alias("start"))
    done = cut(scheduled(starts, ps, stretch))
    while not (late := cut(done.select((F.col("m") + 1).alias("m"), F.col("stop").alias("real")).join(done.select("m", "start"), "m").where("real <> start").select("m", F.col("real").alias("start")))).isEmpty():
        done = cut(done.join(late, "m", "left_anti").unionByName(scheduled(late, ps, stretch)))
    return done.select("m", F.posexplode("placed").alias("n", "x")).select("x.i", "x.k", "x.release", "x.deadline", (F.col("m") * stretch + F.col("n")).alias("slot"))


def remaining(spark: SparkSession, share: list[int], had: list[int], blocks: list[int], slot: int) -> DataFrame:
    """The blocks beyond those had, as schedule() names them: from `slot` on in order of deadlines, then sources, whatever their releases.

    A block's place is counted, not sorted: of each source, how many blocks are due before it.
    """
    starts = [sum(b - h for b, h in zip(blocks[:i], had[:i], strict=True)) for i in range(len(share))]
    known = F.from_json(F.lit(json.dumps([{"p": p, "h": h, "n": n, "f": f} for p, h, n, f in zip(share, had, blocks, starts, strict=True)])), "array<struct<p:bigint,h:bigint,n:bigint,f:bigint>>")
    scale, latest = F.lit(SCALE), F.lit(LATEST)
    rows = spark.range(sum(blocks) - sum(had)).withColumn("i", (F.size(F.filter(known, lambda x: (x["f"] <= F.col("id")) & (x["n"] > x["h"]))) - 1).cast("int"))
    some = F.filter(F.transform(known, lambda x, i: F.struct(x["p"], x["h"], x["n"], x["f"], i.cast("int").alias("i"))), lambda x: x["n"] > x["h"])
    rows = rows.select("id", F.get(some, F.col("i")).alias("own")).select("own.i", (F.col("own.h") + F.col("id") - F.col("own.f")).alias("k"), "own.p")
    capped = lambda k: let(wide(k) * wide(scale), lambda x: F.when(x >= wide(latest) * wide(F.col("p")), latest).otherwise(let(parts(k, scale, F.col("p")), lambda y: y["whole"])))
    rows = rows.withColumn("release", capped(F.col("k"))).withColumn("floor", capped(F.col("k") + 1))
    rows = rows.withColumn("deadline", F.when((F.col("floor") < latest) & (parts(F.col("k") + 1, scale, F.col("p"))["rest"] > 0), F.col("floor") + 1).otherwise(F.col("floor")))
    due = lambda x, by: F.greatest(x["h"], F.least(x["n"], parts(by, x["p"], scale)["whole"])) - x["h"]
    before = F.aggregate(
        some,
        F.lit(0).cast("long"),
        lambda n, x: n
        + F.when(x["i"] == F.col("i"), F.col("k") - x["h"])
        .when(x["i"] > F.col("i"), due(x, F.col("deadline") - 1))
        .when(F.col("deadline") == latest, x["n"] - x["h"])
        .otherwise(due(x, F.col("deadline"))),
    )
    return rows.select("i", "k", "release", "deadline", (before + slot).alias("slot"))


def named(source: Column) -> Column:
    """Null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


NEW = ["mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position", "in_mix"]


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source", id: str = "doc_id", block: int = 16, rows_per_bucket: int = 500, stretch: int = STRETCH, most_sources: int = 20_000) -> DataFrame:
    """Adds mix_block, mix_release, mix_deadline, mix_slot, mix_position and in_mix to every row.

    mix_position orders the mixture: slot * block + place in the block; it is
    unique. in_mix holds for slots before the first block that some source lacks:
    there the shares are kept to within a block. The other blocks follow in the
    order of their deadlines. weights: by source, of any scale; by default the
    square roots of the sources' row counts. Sources without a positive weight keep
    null columns and in_mix false. Weights of absent sources are ignored. No row is
    dropped.

    Rows follow each other within a source by a hash of the id, then of all other
    columns, at every size of the table. They are counted in buckets of that hash,
    so that a hot source is spread; only rows equal in all columns can't be. The
    rows, whatever they hold, are exchanged once, by about where they land in the
    mixture; each bucket's slots come to them in the same exchange. A count and a
    few numbers of each source reach the driver: more than `most_sources` of
    them raise an error, as hosts or authors are no sources to weigh one by one.

    Null sources are a source; null and repeated ids are rows like others; an
    empty table gives no row. Columns already named as the new ones are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in NEW]
    name = named(column(source))
    found = docs.groupBy(name.alias("s")).count().limit(most_sources + 1).collect()
    if len(found) > most_sources:
        raise ValueError(f"more than {most_sources} sources; merge them into classes first")
    counts = {r["s"]: r["count"] for r in found}
    if weights is None:
        chosen = {s: n**0.5 for s, n in counts.items()}
    else:
        given = {"-" if k is None else f"={k}": w for k, w in weights.items()}
        chosen = {s: given.get(s, 0.0) for s in counts}
    share = shares(chosen)
    names = sorted(share)
    ps, blocks = [share[s] for s in names], [-(-counts[s] // block) for s in names]
    slots = min((-(-(n + 1) * SCALE // p) for p, n in zip(ps, blocks, strict=True)), default=0)  # by then some source has run out

    listed = [{"s": s, "i": i, "n": counts[s], "b": blocks[i]} for i, s in enumerate(names)]
    known = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(listed)), "array<struct<s:string,i:int,n:bigint,b:bigint>>")))
    if names:
        plan = cut(schedule(spark, ps, slots, stretch))
        horizon = plan.join(F.broadcast(known), "i").where("k >= b").agg(F.min("slot")).first()[0]
        seen = {r.i: r.n for r in plan.where(F.col("slot") < horizon).groupBy("i").agg((F.max("k") + 1).alias("n")).collect()}
        had = [seen.get(i, 0) for i in range(len(names))]
        plan = plan.where(F.col("slot") < horizon).unionByName(remaining(spark, ps, had, blocks, horizon))
    else:
        horizon, had = 0, []
        none = [F.lit(None).cast(kind).alias(c) for c, kind in (("i", "int"), ("k", "long"), ("release", "long"), ("deadline", "long"), ("slot", "long"))]
        plan = spark.range(0).select(*none)

    # where in the mixture a bucket lands, about: the same for its rows and its slots
    places = [{"s": s, "i": i, "n": counts[s], "h": had[i], "b": blocks[i], "w": ps[i] / SCALE} for i, s in enumerate(names)]
    known = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(places)), "array<struct<s:string,i:int,n:bigint,h:bigint,b:bigint,w:double>>")))
    rest = sum(blocks) - sum(had)
    bits = max(1, min(20, math.ceil(math.log2(max(1, sum(counts.values()) / rows_per_bucket)))))
    about = (F.col("bucket") / 2.0**bits + 0.5) * F.col("n") / block
    about = F.when(about < F.col("h"), about / F.col("w")).otherwise(horizon + (about - F.col("h")) / F.greatest(F.col("b") - F.col("h"), F.lit(1)) * rest)
    part = F.coalesce(F.floor(about / max(1, horizon + rest) * 100_000), F.lit(100_000) + F.pmod(F.col("bucket"), F.lit(1000))).cast("int")

    draw = F.xxhash64(column(id))
    kinds = docs.select(*map(column, kept)).dtypes
    others = [column(c) for c, kind in kinds if c.lower() != id.lower() and not kind.startswith(("map", "variant", "interval"))]
    own = docs.select(F.struct(*map(column, kept)).alias("row"), name.alias("s"), draw.alias("draw"), F.xxhash64(F.lit(1), *others).alias("again"))
    own = own.join(F.broadcast(known), "s", "left").withColumn("bucket", F.shiftright("draw", 64 - bits))
    sizes = docs.select(name.alias("s"), F.shiftright(draw, 64 - bits).alias("bucket")).groupBy("s", "bucket").count().join(F.broadcast(known), "s")
    sizes = sizes.withColumn("before", F.sum("count").over(Window.partitionBy("i").orderBy("bucket")) - F.col("count"))
    of_bucket = sizes.select("i", "bucket", "before", part.alias("part"), F.explode(F.sequence(F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("count") - 1) / block))).alias("k"))
    of_bucket = of_bucket.join(plan, ["i", "k"]).groupBy("part", "i", "bucket", "before").agg(F.sort_array(F.collect_list(F.struct("k", "release", "deadline", "slot"))).alias("slots"))
    both = own.select(part.alias("part"), "i", "bucket", F.lit(1).alias("is_row"), "draw", "again", "row").unionByName(of_bucket.withColumn("is_row", F.lit(0)), allowMissingColumns=True)
    inside = Window.partitionBy("part", "i", "bucket").orderBy("is_row", "draw", "again")
    met = both.repartitionByRange("part").select("row", "is_row", F.first("slots").over(inside).alias("slots"), (F.first("before").over(inside) + F.row_number().over(inside) - 2).alias("rank")).where("is_row = 1")
    own_block = F.floor(F.col("rank") / block)
    met = met.select("row", "rank", F.get("slots", (own_block - F.col("slots")[0]["k"]).cast("int")).alias("at"))
    return met.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        F.col("at.k").alias("mix_block"),
        F.col("at.release").alias("mix_release"),
        F.col("at.deadline").alias("mix_deadline"),
        F.col("at.slot").alias("mix_slot"),
        (F.col("at.slot") * block + F.col("rank") % block).alias("mix_position"),
        F.coalesce(F.col("at.slot") < horizon, F.lit(False)).alias("in_mix"),
    )


def op4_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
