"""The mixture against a plain scheduler in exact fractions."""

import random
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import mixing


def plain(weights, slots):
    """Earliest deadline first, slot by slot, by exact shares: the source, block, release and deadline of each slot."""
    total = sum(Fraction(w) for w in weights)
    share = [Fraction(w) / total for w in weights]
    had, out = [0] * len(share), []
    for slot in range(slots):
        _, i = min((ceil((had[i] + 1) / w), i) for i, w in enumerate(share) if floor(had[i] / w) <= slot)
        out.append((i, had[i], floor(had[i] / share[i]), ceil((had[i] + 1) / share[i])))
        had[i] += 1
    return out


@pytest.mark.parametrize("weights", [[5, 3, 2], [1 / 3, 1.1547, 0.1234567], [2.0**-k for k in range(12)], [1, 1e-3, 0.7, 1e-5, 2e-4], [random.Random(3).random() ** 3 for _ in range(20)], [1.0]])
def test_schedule_equals_a_plain_one(spark, weights):
    names = [f"s{k:02}" for k in range(len(weights))]
    share = mixing.shares(dict(zip(names, weights)))
    assert sum(share.values()) == mixing.SCALE
    got = sorted((r.slot, r.i, r.k, r.release, r.deadline) for r in mixing.schedule(spark, [share[s] for s in names], 1500, stretch=64).collect())
    assert [r[1:] for r in got] == plain([share[s] for s in names], len(got)) and len(got) >= 1500
    n = np.arange(1, len(got) + 1)
    for i, w in enumerate(weights):
        assert np.abs(np.cumsum([r[1] == i for r in got]) - n * (w / sum(weights))).max() < 1 + 1e-9


def test_shares_hold_over_a_million_slots(spark):
    weights = [1 / 3, 1.1547, 0.1234567]
    share = mixing.shares(dict(zip("abc", weights)))
    got = mixing.schedule(spark, [share[s] for s in "abc"], 1_000_000).select("slot", "i").toPandas().sort_values("slot")
    assert got["slot"].tolist() == list(range(len(got))) and len(got) >= 1_000_000
    n = np.arange(1, len(got) + 1)
    for i, w in enumerate(weights):
        assert np.abs(np.cumsum(got["i"].to_numpy() == i) - n * (w / sum(weights))).max() < 1


def placed_by_hand(weights, blocks):
    """Slots of all blocks: the plain schedule up to the first block that a source lacks, then by deadline and source."""
    total = sum(Fraction(w) for w in weights)
    share, out, had = [Fraction(w) / total for w in weights], {}, [0] * len(weights)
    for slot, (i, k, _, _) in enumerate(plain(weights, sum(blocks) + len(blocks) + 1)):
        if k == blocks[i]:
            break
        out[i, k], had[i] = slot, k + 1
    rest = sorted((min(mixing.LATEST, ceil((k + 1) / share[i])), i, k) for i in range(len(blocks)) for k in range(had[i], blocks[i]))
    return out | {(i, k): slot + n for n, (_, i, k) in enumerate(rest)}, slot


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 3, "c": 2}, {"a": 1.0, "b": 1e-3 / 3, "c": 0.7, None: 1e-300}, {"c": 1}, {}])
def test_mixture_equals_a_plain_one(spark, weights):
    rows = [(k, "abc"[min(k % 4, 2)]) for k in range(4000)] + [(None, None)] * 40 + [(3, "a")] * 30
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(df, weights, block=7, stretch=32, rows_per_bucket=300).collect()
    assert sorted((repr(r.doc_id), repr(r.source)) for r in got) == sorted((repr(a), repr(b)) for a, b in rows)
    counts = {s: sum(x == s for _, x in rows) for s in ("a", "b", "c", None)}
    chosen = {s: n**0.5 for s, n in counts.items()} if weights is None else weights
    order = sorted(chosen, key=lambda s: "-" if s is None else f"={s}")
    placed = [r for r in got if r.mix_position is not None]
    assert {r.source for r in placed} == set(chosen) and len(placed) == sum(counts[s] for s in chosen)
    if not chosen:
        return
    share = mixing.shares({"-" if s is None else f"={s}": w for s, w in chosen.items()})
    want, horizon = placed_by_hand([share[s] for s in sorted(share)], [ceil(counts[s] / 7) for s in order])
    assert {(order.index(r.source), r.mix_block): r.mix_slot for r in placed} == want
    assert len({r.mix_position for r in placed}) == len(placed) and all(r.mix_position // 7 == r.mix_slot for r in placed)
    assert all(r.in_mix == (r.mix_slot < horizon) for r in placed) and not any(r.in_mix for r in got if r.mix_position is None)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in placed if r.in_mix)


def test_mixture_of_odd_rows(spark):
    rows = [(k % 50, f"s{k % 3}", "t" * (k % 7), "a", "b", "c") for k in range(900)] + [(None, None, None, None, None, None)] * 5 + [(1, "", "x " * 50_000, "", "", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, _draw string, draw string, x string").withColumnRenamed("x", "a.b").withColumn("MIX_SLOT", F.lit("old"))
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "source", "text", "_draw", "draw", "a.b", *mixing.NEW]
    got = out.collect()
    assert len(got) == len(rows) == len({r.mix_position for r in got})
    again = mixing.mix(df.repartition(7), rows_per_bucket=20).collect()  # neither files nor buckets matter
    key = lambda r: repr((r.mix_position, r.doc_id, r.text))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, most_sources=2)
