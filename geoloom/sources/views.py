"""Geospatial tables derived from the plain test tables by integer arithmetic.

The text of each view is SQL that Spark and DuckDB read alike, so both engines
see the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The area is 100 x 100 cells of 10 m, whatever the tables hold; each cell takes the least of all its line items.
#: Both triangles of each square of the raster that has its four corners, cut from south-west to north-east; 10 m cells.
RAS = """select l_partkey % 100 as r, l_orderkey % 100 as c, cast(floor(min(l_extendedprice) * 100 + 0.5) as bigint) as zc
        from {lineitem} group by l_partkey % 100, l_orderkey % 100"""

#: View -> (tables it reads, SQL with the tables in braces).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "versions": (
        ("events",),
        """select event_id as seq, case when event_id % 97 = 0 then null else concat(cast(user_id as string), ':', event_type) end as object_id,
        event_type as kind, case when event_type = 'error' then '2024-01-01' else '' end as ended from {events}""",
    ),
    "pts": (
        ("events",),
        """select event_id as id, ((event_id * 7919) % 100000) / 100.0e0 as x, ((event_id * 104729 + 12345) % 100000) / 100.0e0 as y,
        event_type as kind, value as v from {events}""",
    ),
    "ras": (
        ("lineitem",),
        RAS,
    ),
    "tris": (
        ("lineitem",),
        f"""with cells as ({RAS}), squares as (select a.r, a.c, a.zc / 100.0e0 as sw, b.zc / 100.0e0 as se, d.zc / 100.0e0 as ne, e.zc / 100.0e0 as nw from cells a
        join cells b on b.r = a.r and b.c = a.c + 1 join cells d on d.r = a.r + 1 and d.c = a.c + 1 join cells e on e.r = a.r + 1 and e.c = a.c)
        select (r * 100 + c) * 2 as tri, c * 10.0e0 as x1, r * 10.0e0 as y1, sw as z1, c * 10.0e0 + 10 as x2, r * 10.0e0 as y2, se as z2, c * 10.0e0 + 10 as x3, r * 10.0e0 + 10 as y3, ne as z3,
        r * 100 + c as v1, r * 100 + c + 1 as v2, r * 100 + c + 101 as v3 from squares
        union all select (r * 100 + c) * 2 + 1, c * 10.0e0, r * 10.0e0, sw, c * 10.0e0 + 10, r * 10.0e0 + 10, ne, c * 10.0e0, r * 10.0e0 + 10, nw, r * 100 + c, r * 100 + c + 101, r * 100 + c + 100 from squares""",
    ),
    "poly": (
        ("customer",),
        """select c_custkey as id, ((c_custkey * 6151) % 100000) / 100.0e0 as cx, ((c_custkey * 39916801) % 100000) / 100.0e0 as cy,
        3.0e0 + c_nationkey as rad, case when c_custkey % 5 = 0 then (3.0e0 + c_nationkey) / 2 else 0.0e0 end as hole, c_acctbal as lev, c_nationkey as cls from {customer}""",
    ),
    "lines": (
        ("orders",),
        """select o_custkey as line, o_orderkey as vertex, ((o_orderkey * 7919) % 100000) / 100.0e0 as x, ((o_orderkey * 104729) % 100000) / 100.0e0 as y,
        o_orderpriority as kind from {orders}""",
    ),
    "network": (
        ("orders",),
        """select distinct least(o_custkey, o_orderkey) as a, greatest(o_custkey, o_orderkey) as b from {orders} where o_custkey <> o_orderkey""",
    ),
    "buildings": (
        ("part",),
        """select concat('NL.X.', cast(p_partkey as string)) as id, cast(p_size as double) as height_m, cast(floor(p_size / 3) as bigint) as floors,
        case when p_partkey % 11 = 0 then null else 1850 + p_partkey % 175 end as build_year, 10.0e0 * (p_partkey % 300) as footprint_m2,
        p_partkey % 8 <> 0 as storeys_known, case when p_partkey % 7 = 6 then null else p_partkey % 6 end as function, p_brand as brand from {part}""",
    ),
    "units": (
        ("lineitem",),
        """select cast(l_partkey as string) as pand, case l_linenumber when 1 then 'woonfunctie' when 2 then 'Winkelfunctie, woonfunctie' when 3 then ' kantoorfunctie'
        when 4 then 'industriefunctie,overige gebruiksfunctie' when 5 then 'sportfunctie' when 6 then 'onbekend' else '' end as purposes from {lineitem}""",
    ),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, sql = VIEWS[name]
    return spark.sql(sql, **{t: read(spark, sf_dir, t) for t in tables})


def oracle(sql: str, *names: str) -> str:
    """DuckDB SQL: the views as common table expressions before the query."""
    ctes = ", ".join(f"{n} as ({VIEWS[n][1].format(**{t: t for t in VIEWS[n][0]})})" for n in names)
    if not ctes:
        return sql
    head = sql.lstrip()
    return f"with recursive {ctes}, {head[len('with '):]}" if head.startswith("with ") else f"with recursive {ctes} {head}"
