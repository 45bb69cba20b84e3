"""Places of a pattern's matches, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256


def running(steps: Column) -> Column:
    """Inclusive running sums of an array of numbers, as longs. In chunks, so that the work is near linear."""
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("long")

    def sums(values: Column, start: Column) -> Column:
        grown = F.aggregate(
            values,
            F.struct(start.alias("at"), none.alias("all")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"] + x)).alias("all")),
        )
        return grown["all"]

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int")), lambda c: F.slice(steps, c * CHUNK + 1, F.lit(CHUNK)))
    totals = F.transform(chunks, lambda values: F.aggregate(values, zero, lambda acc, x: acc + x))
    ends = sums(totals, zero)
    return F.flatten(F.zip_with(chunks, F.zip_with(ends, totals, lambda e, t: e - t), lambda values, start: sums(values, start)))


def steps(found: Column, between: Column) -> Column:
    """From each match's start to the next one's: running() of it gives the starts, in code points.

    found: the matches; between: the text split by the same pattern.
    """
    return F.transform(
        F.sequence(F.lit(1), F.size(found)),
        lambda k: (F.char_length(F.element_at(between, k)) + F.when(k > 1, F.char_length(F.element_at(found, k - 1))).otherwise(0)).cast("long"),
    )
