"""Windowed counts over the events, by the plan that streams run too."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.sources.views import read
from geoloom.streaming.registers import counts_by_window


def hourly(spark, sf_dir):
    """Events by kind and hour."""
    return counts_by_window(read(spark, sf_dir, "events"), "ts", "event_type", "1 hour").withColumn("start", F.unix_timestamp("start"))


def sliding(spark, sf_dir):
    """Events by kind in hours that begin every half hour."""
    return counts_by_window(read(spark, sf_dir, "events"), "ts", "event_type", "1 hour", "30 minutes").withColumn("start", F.unix_timestamp("start"))


QUERIES = {"stream_hourly": hourly, "stream_sliding": sliding}
SQL = {
    "stream_hourly": "select cast(floor(epoch(ts) / 3600) * 3600 as bigint) as start, event_type, count(*) as n from events group by 1, 2",
    "stream_sliding": """select start, event_type, count(*) as n from (select event_type, cast(floor(epoch(ts) / 1800) * 1800 as bigint) - 1800 * k as start from events, (select unnest([0, 1]) as k)) group by 1, 2""",
}
