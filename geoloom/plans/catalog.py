"""Every query of the reference's operators, by name, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoloom.plans import checks, expressions, frames, ground, joins, shapes, stages, streams

FLAGSHIP = "s2_current_versions"
MODULES = (expressions, joins, checks, shapes, stages, ground, streams, frames)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: run for m in MODULES for name, run in m.QUERIES.items()}
SQL: dict[str, str] = {name: sql for m in MODULES for name, sql in m.SQL.items()}
