"""Register scans: current versions, first-seen rows, priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_versions(rows: DataFrame, id: str, ended: str, seq: str) -> DataFrame:
    """Rows whose end is null or empty; the first seen of each non-empty id, and all without an id.

    First-seen is a grouped minimum, which combines before the shuffle; rows
    without an id take no part in it.
    """
    now = rows.where(F.coalesce(F.col(ended), F.lit("")) == "")
    named = F.coalesce(F.col(id), F.lit("")) != ""
    first = now.where(named).groupBy(id).agg(F.min_by(F.struct(*[c for c in rows.columns if c != id]), seq).alias("row"))
    return first.select(id, "row.*").select(*rows.columns).unionByName(now.where(~named))


def first_seen(rows: DataFrame, keys: list[Column], seq: str) -> DataFrame:
    """The row of least seq for each key."""
    named = {f"_k{n}": k for n, k in enumerate(keys)}
    return rows.withColumns(named).groupBy(*named).agg(F.min_by(F.struct(*rows.columns), seq).alias("row")).select("row.*")


def first_rule(value: Column, rules: list[tuple[str, object]], otherwise: object) -> Column:
    """The outcome of the first needle that the value holds."""
    out = None
    for needle, result in rules:
        out = (F.when if out is None else out.when)(F.contains(value, F.lit(needle)), F.lit(result))
    return out.otherwise(F.lit(otherwise))
