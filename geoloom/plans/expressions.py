"""Queries whose SQL Spark and DuckDB read alike: projections, filters and plain aggregates over the derived views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoloom.functions import vocabulary as V
from geoloom.sources.views import VIEWS, oracle, read, view


def cases(value: str, rules: list[tuple[str, str]], otherwise: str) -> str:
    """The first needle that the value holds; plain CASE, so that it stays in generated code."""
    return "case " + " ".join(f"when {value} like '%{needle}%' then '{result}'" for needle, result in rules) + f" else {otherwise} end"


#: Name -> (views, tables, SQL with both in braces).
STATEMENTS: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "s14_sources_down": (
        (), ("events",),
        """select user_id % 50 as source, count(*) as probes from {events} where event_type <> 'signup'
        group by user_id % 50 having max(case when event_type = 'click' and value > 95 then 1 else 0 end) = 0""",
    ),
    "s18_speed_factor": (
        (), ("lineitem",),
        """select least(greatest(max(ratio), 0.25e0), 4.0e0) as factor, max(n) as runs from (
        select ratio, n, row_number() over (order by ratio) as k from (
          select ratio, count(*) over () as n from (
            select sum(l_quantity) / count(*) / 25.0e0 as ratio from {lineitem} group by extract(year from l_shipdate), extract(month from l_shipdate)) a) b) c
        where k = cast(floor(n / 2) as bigint) + 1""",
    ),
    "f2_points_in_box": (("pts",), (), "select id, x, y, kind from {pts} where x between 250.0e0 and 750.0e0 and y between 100.0e0 and 600.5e0"),
    "f3_box_contains": (("poly",), (), "select id from {poly} where cx - rad >= 0 - 1e-6 and cx + rad <= 1000 + 1e-6 and cy - rad >= 0 - 1e-6 and cy + rad <= 1000 + 1e-6"),
    "f4_centre_clip": (
        ("lines",), (),
        """select line, (min(x) + max(x)) / 2 as mid_x, (min(y) + max(y)) / 2 as mid_y from {lines} group by line
        having (min(x) + max(x)) / 2 between 300 and 700 and (min(y) + max(y)) / 2 between 300 and 700""",
    ),
    "f5_plausible_height": (
        ("buildings",), (),
        """select count(*) as all_buildings, cast(sum(case when height_m < 2.5 then 1 else 0 end) as bigint) as too_low, cast(sum(case when height_m > 45 then 1 else 0 end) as bigint) as too_high,
        cast(sum(case when height_m between 2.5 and 45 then 1 else 0 end) as bigint) as kept from {buildings}""",
    ),
    "f6_extent_can_reach": (("poly",), (), "select id from {poly} where lev is null or not (cx + rad < 200 or cx - rad > 400 or cy + rad < 200 or cy - rad > 400)"),
    "f7_valid_cells": (("ras",), (), "select r, c, zc from {ras} where zc / 10000.0e0 > -25 and zc / 10000.0e0 < 400 and zc < 1e30"),
    "f8_nodata_share": (("ras",), (), "select count(*) as present, 1 - count(*) / 10000.0e0 as missing_share, 1 - count(*) / 10000.0e0 > 0.5 as too_many from {ras}"),
    "f11_deck_bands": (
        ("pts",), (),
        """select id, case when v / 2 between -3 and 80 and v / 2 >= y / 25 - 0.5 then v / 2 else null end as deck_z,
        case when v / 2 - y / 25 between 1.5 and 25 then v / 2 else y / 25 end as rail_z from {pts}""",
    ),
    "f13_long_enough": (
        ("lines",), (),
        """select line, kind, count(*) as vertices, (max(x) - min(x)) + (max(y) - min(y)) as reach from {lines} group by line, kind
        having (max(x) - min(x)) + (max(y) - min(y)) >= case when kind = '1-URGENT' then 800 when kind = '2-HIGH' then 1000 else 200 end""",
    ),
    "f17_safe_names": ((), ("part",), "select p_partkey, p_name from {part} where p_name <> '' and p_name not in ('.', '..') and length(regexp_replace(p_name, '[A-Za-z0-9._-]', '', 'g')) = 0"),
    "f18_markup_answers": ((), ("pages",), "select page_id, " + " or ".join(f"ltrim(html, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) like '{m}%'" for m in V.MARKUP_STARTS) + " as is_markup from {pages}"),
    "p1_local_shift": (("pts",), (), "select id, x - 500.0e0 as local_x, y - 500.0e0 as local_y from {pts}"),
    "p3_box_checks": (
        ("poly",), (),
        """select id, cx - rad between -7000 and 300000 and cy + rad between 0 and 629000 as in_domain, 2 * rad < 9 or 2 * rad > 50 as odd_side,
        case when hole > 0 then (2 * rad) / (rad + hole) > 1.1 else false end as odd_aspect from {poly}""",
    ),
    "p6_dequantise": (
        (), ("lineitem", "orders"),
        """select l.l_orderkey, l.l_linenumber, l.l_partkey * (0.001e0 * (1 + o.o_custkey % 3)) + o.o_custkey as vx, l.l_suppkey * (0.001e0 * (1 + o.o_custkey % 3)) - o.o_custkey as vy
        from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey""",
    ),
    "p7_road_class": (
        (), ("lineitem",),
        f"""select f, m, case when {cases("lower(trim(f))", V.ROAD_FUNCTIONS, "'road'")} in ('road', 'parking') and ({" or ".join(f"lower(trim(m)) like '%{b}%'" for b in V.BRICK_MATERIALS)})
        then 'road_brick' else {cases("lower(trim(f))", V.ROAD_FUNCTIONS, "'road'")} end as class, count(*) as parts from (
        select case l_linenumber when 1 then 'Rijbaan lokale weg' when 2 then 'voetpad op trap' when 3 then ' fietspad' when 4 then 'parkeervlak' when 5 then 'OV-baan' when 6 then 'inrit' else '' end as f,
        case l_suppkey % 4 when 0 then 'asfalt' when 1 then 'Gebakken klinker' when 2 then 'tegels' else '' end as m from {{lineitem}}) t group by f, m""",
    ),
    "p9_type_coalesce": (
        ("versions",), (),
        """select seq, coalesce(nullif(nullif(trim(case when seq % 3 = 0 then 'niet-bgt' when seq % 3 = 1 then '' else kind end), ''), 'niet-bgt'),
        nullif(nullif(case when seq % 5 = 0 then 'none' else kind end, 'none'), '')) as type from {versions}""",
    ),
    "p10_kind_decode": (
        (), ("lineitem",),
        f"""select kind, cast(sum(n) as bigint) as tracks from (select {"case f " + " ".join(f"when '{k}' then '{v}'" for k, v in V.RAILS.items()) + " end"} as kind, n from (
        select case l_linenumber when 1 then 'trein' when 2 then 'tram' when 3 then 'sneltram' when 4 then 'metro' else 'haven' end as f, count(*) as n from {{lineitem}}
        group by l_linenumber) a) b where kind is not null group by kind""",
    ),
    "p12_facade_era": (
        ("buildings",), (),
        f"""select id, case {" ".join(f"when build_year is not null and build_year <= {y} then {k}" for k, y in enumerate(V.ERAS))}
        else least({" + ".join(f"case when height_m >= {h} then 1 else 0 end" for h in V.ERA_HEIGHTS)}, {len(V.ERAS) - 1}) end as era from {{buildings}}""",
    ),
    "p14_archetype": (
        ("buildings",), (),
        """select id, case when not storeys_known and height_m >= 15 and (build_year is null or build_year < 1940) then 'monumental'
        when function = 4 and height_m >= 12 and build_year < 1900 then 'monumental' when function = 3 then 'industrial'
        when footprint_m2 >= 2000 and floors <= 3 then 'industrial' when function = 1 then 'retail' when function = 2 then 'office'
        when function = 0 then case when footprint_m2 < 250 and floors <= 4 then 'house' else 'apartment' end
        when (not storeys_known and height_m >= 15) or height_m >= 25 or floors >= 8 then 'apartment' else 'house' end as archetype from {buildings}""",
    ),
    "p15_storeys": (
        ("buildings",), (),
        """select id, case when storeys_known and floors > 0 and height_m / nullif(floors, 0) between 2.2 and 5.0 then floors
        else greatest(1, cast(floor(height_m / 3 + 0.5) as bigint) - case when height_m / 3 - floor(height_m / 3) = 0.5 and cast(floor(height_m / 3) as bigint) % 2 = 0 then 1 else 0 end) end as storeys from {buildings}""",
    ),
    "p16_tree_sizes": (
        ("pts",), (),
        """select id, h, least(greatest(0.26e0 * h, 0.8e0), 7.0e0) as crown, least(greatest(0.38e0 * h, 0.6e0), 6.0e0) as trunk
        from (select id, least(greatest(v / 3, 2.0e0), 35.0e0) as h from {pts}) t""",
    ),
    "p17_stand_on_deck": (
        ("pts",), (),
        """select id, case when deck is null or deck < ground + 1 or (measured and ground + height < deck - 1) then 'keep'
        when detected and (not (measured and ground + height - deck >= 2) or ground + height - deck > 15) then 'drop' else 'move' end as action,
        case when deck is null or deck < ground + 1 or (measured and ground + height < deck - 1) then height
        when measured and ground + height - deck >= 2 then ground + height - deck else 6.0e0 end as new_height from (
        select id, y / 100 as ground, v / 5 as height, id % 3 <> 0 as measured, id % 4 = 0 as detected, case when id % 5 = 0 then null else x / 60 end as deck from {pts}) t""",
    ),
    "p19_vertical_span": (
        ("pts",), (),
        """select id, case when kind = 'view' then y / 10 + 2.4e0 else y / 10 - 0.15e0 end as z0, case when kind = 'view' then y / 10 + 2.4e0 + v / 50 else y / 10 + v / 50 end as z1 from {pts}""",
    ),
    "p21_tile_width": (("buildings",), (), "select id, case when function = 3 then 9.0e0 when function in (1, 2) then 7.0e0 else 4.0e0 end as tile_m from {buildings}"),
    "p35_cost_estimate": (
        (), ("orders",),
        """select o_custkey, (sum(case o_orderpriority when '1-URGENT' then 1 + 8 * km2 when '2-HIGH' then 1 + 30 * km2 + 2.5e0 * mpx when '3-MEDIUM' then 2 + 75 * km2 else 0.5e0 + 5 * km2 end) + 12) as seconds
        from (select o_custkey, o_orderpriority, 1 + o_custkey % 3 as km2, 4.0e0 * (1 + o_custkey % 4) as mpx from {orders}) t group by o_custkey""",
    ),
    "p36_titles": ((), ("pages",), "select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from {pages}"),
    "p37_short_errors": (
        (), ("documents",),
        f"""select doc_id, {cases("t", V.ERRORS, "case when length(t) < 160 then t else concat(substr(t, 1, 157), '...') end")} as message from (
        select doc_id, case doc_id % 12 when 1 then 'x NameResolutionError y' when 2 then 'pool: Read timed out.' when 3 then 'SSLError(1)' else coalesce(text, '') end as t from {{documents}}) d""",
    ),
    "p38_quantise_normals": (
        ("pts",), (),
        """select distinct cast(least(greatest(floor(dx / n * 127 + 0.5), -127), 127) as bigint) as qx, cast(least(greatest(floor(dy / n * 127 + 0.5), -127), 127) as bigint) as qy from (
        select x - 500 as dx, y - 500 as dy, sqrt((x - 500) * (x - 500) + (y - 500) * (y - 500)) as n from {pts}) t where n > 0""",
    ),
    "j1_usage_join": (
        ("buildings", "units"), (),
        """select b.id, count(u.pand) as units from {buildings} b left join {units} u on replace(b.id, 'NL.X.', '') = u.pand group by b.id""",
    ),
    "j18_semi_anti": (
        (), ("lineitem", "orders"),
        """select o_orderkey, exists (select 1 from {lineitem} l where l.l_orderkey = o.o_orderkey and l.l_discount > 0.09) as big_discount from {orders} o
        where not exists (select 1 from {lineitem} l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'R')""",
    ),
    "j27_dimension_lookup": (
        (), ("customer", "nation", "region"),
        "select c_custkey, n_name, r_name from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey",
    ),
    "a1_block_mean": (
        ("ras",), (),
        "select cast(floor(r / 4) as bigint) as br, cast(floor(c / 4) as bigint) as bc, sum(zc) / (count(*) * 100.0e0) as mean_z, count(*) as hits from {ras} group by cast(floor(r / 4) as bigint), cast(floor(c / 4) as bigint)",
    ),
    "a2_fetch_stats": (
        ("versions",), (),
        "select kind, count(*) as raw, cast(sum(case when ended = '' then 1 else 0 end) as bigint) as running, cast(sum(case when ended <> '' then 1 else 0 end) as bigint) as superseded from {versions} group by kind",
    ),
    "a3_height_summary": (
        ("buildings",), (),
        "select count(*) as n, min(height_m) as low, max(height_m) as high, median(height_m) as mid, cast(sum(case when storeys_known then 1 else 0 end) as bigint) as known from {buildings}",
    ),
    "a4_archetype_spread": (("buildings",), (), "select function, count(*) as n, sum(footprint_m2) as area, min(height_m) as low, max(height_m) as high from {buildings} group by function"),
    "a9_look_slots": (
        ("buildings",), (),
        """select era, looks, cast(sum(looks) over (order by era) - looks as bigint) as slot from (
        select era, least(greatest(cast(floor(n / 80.0e0 + 0.5) as bigint), 1), 4) as looks from (
        select case when build_year <= 1920 then 0 when build_year <= 1945 then 1 when build_year <= 1975 then 2 when build_year <= 2000 then 3 else 4 end as era, count(*) as n
        from {buildings} where build_year is not null group by 1) a) b""",
    ),
    "a10_bays": (
        ("lines",), (),
        """select line, vertex, (x - low) / (high - low) * bays as bay from (select line, vertex, x, low, high, greatest(cast(floor((high - low) / 40 + 0.5) as bigint), 1) as bays from (
        select line, vertex, x, min(x) over (partition by line) as low, max(x) over (partition by line) as high from {lines}) a) b where high > low""",
    ),
    "a15_bit_flags": ((), ("events",), "select user_id, bit_or(case event_type when 'view' then 1 when 'click' then 2 when 'error' then 4 when 'purchase' then 8 else 16 end) as flags, min(event_id) as first_event from {events} group by user_id"),
    "a18_correlation": ((), ("lineitem",), "select l_linenumber, round(corr(l_quantity, l_extendedprice), 6) as r, count(*) as n from {lineitem} group by l_linenumber"),
    "a20_class_shares": (("poly",), (), "select cls, count(*) as n, count(*) / (sum(count(*)) over () * 1.0e0) as share from {poly} group by cls"),
    "a22_plan_density": (
        ("pts",), (),
        """select gx, gy, count(*) as places from (select distinct cast(floor(x / 50) as bigint) as gx, cast(floor(y / 50) as bigint) as gy, x, y from {pts}) t group by gx, gy having count(*) > 3""",
    ),
    "a23_problem_spots": (
        ("pts",), (),
        """select cast(floor(x / 100) as bigint) as gx, cast(floor(y / 100) as bigint) as gy, count(*) as n, min(x) as west, max(y) as north, count(distinct kind) as kinds from {pts}
        where kind <> 'view' group by cast(floor(x / 100) as bigint), cast(floor(y / 100) as bigint)""",
    ),
    "a24_junction_degree": (("network",), (), "select node, count(*) as degree from (select a as node from {network} union all select b as node from {network}) t group by node"),
    "a25_pooling": (("ras",), (), "select cast(floor(r / 8) as bigint) as pr, cast(floor(c / 8) as bigint) as pc, max(zc) as top, min(zc) as low from {ras} group by cast(floor(r / 8) as bigint), cast(floor(c / 8) as bigint)"),
    "a26_zero_filled_counts": ((), ("nation", "supplier"), "select n_name, coalesce(count(s_suppkey), 0) as suppliers from {nation} left join {supplier} on s_nationkey = n_nationkey and s_acctbal > 5000 group by n_name"),
    "a28_model_bounds": (("pts",), (), "select kind, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1, abs((min(x) + max(x)) / 2 - 500) <= 0.5 * greatest(max(x) - min(x) - 1000, 0) + 1 as centred from {pts} group by kind"),
    "a29_light_statistics": (("ras",), (), "select avg(case when zc > 5000000 then r end) as lit, avg(case when zc <= 5000000 then r end) as dark, count(case when zc > 5000000 then 1 end) as n_lit from {ras}"),
    "a30_sorted_distinct": (("poly",), (), "select distinct cls, cast(floor(cx / 100) as bigint) as column_no from {poly}"),
    "w1_running_length": (
        ("lines",), (),
        """select line, vertex, round(sum(coalesce(sqrt((x - px) * (x - px) + (y - py) * (y - py)), 0)) over (partition by line order by vertex rows between unbounded preceding and current row), 3) as along from (
        select line, vertex, x, y, lag(x) over (partition by line order by vertex) as px, lag(y) over (partition by line order by vertex) as py from {lines}) t""",
    ),
    "w2_previous_next": (("lines",), (), "select line, vertex, coalesce(lag(x) over (partition by line order by vertex), x) as before, coalesce(lead(x) over (partition by line order by vertex), x) as after from {lines}"),
    "w3_ring_neighbours": (
        ("lines",), (),
        """select line, vertex, coalesce(lag(vertex) over (partition by line order by vertex), max(vertex) over (partition by line)) as before,
        coalesce(lead(vertex) over (partition by line order by vertex), min(vertex) over (partition by line)) as after from {lines}""",
    ),
    "w4_worst_of_group": (("pts",), (), "select kind, id, v from (select kind, id, v, row_number() over (partition by kind order by v desc, id) as k from {pts}) t where k = 1"),
    "w9_painters_order": (
        ("poly",), (),
        """select gx, gy, id, cls from (select gx, gy, id, cls, row_number() over (partition by gx, gy order by cls desc, id desc) as k from (
        select cast(floor(cx / 20) as bigint) as gx, cast(floor(cy / 20) as bigint) as gy, id, cls from {poly}) a) b where k = 1""",
    ),
    "w15_step_allowance": (
        ("ras",), (),
        """select r, c, greatest(10000, coalesce(abs(zc - lag(zc) over (partition by r order by c)), 0), coalesce(abs(zc - lead(zc) over (partition by r order by c)), 0),
        coalesce(abs(zc - lag(zc) over (partition by c order by r)), 0), coalesce(abs(zc - lead(zc) over (partition by c order by r)), 0)) as allowance from {ras}""",
    ),
    "w17_runs": (
        ("ras",), (),
        """select r, min(c) as c0, max(c) as c1, count(*) as cells from (select r, c, c - row_number() over (partition by r order by c) as island from {ras}) t group by r, island""",
    ),
    "w19_bed_level": (("poly",), (), "select cast(floor(cx / 20) as bigint) as gx, cast(floor(cy / 20) as bigint) as gy, min(lev - rad) as bed from {poly} group by cast(floor(cx / 20) as bigint), cast(floor(cy / 20) as bigint)"),
    "v1_box_checks": (
        ("poly",), (),
        """select 'bbox_width' as name, min(2 * rad) >= 4 as passed, 'warning' as severity from {poly} union all
        select 'bbox_in_domain', min(cx) >= -7000 and max(cx) <= 300000, 'error' from {poly}""",
    ),
    "v2_terrain_checks": (
        ("ras",), (),
        """select 'terrain_no_holes' as name, count(*) = 10000 as passed from {ras} union all select 'nap_plausible', min(zc) > -250000 and max(zc) < 4000000000 from {ras}
        union all select 'gap_fill', 1 - count(*) / 10000.0e0 < 0.75 from {ras}""",
    ),
    "v3_building_checks": (
        ("buildings",), (),
        """select 'buildings_present' as name, count(*) > 0 as passed from {buildings} union all select 'heights_positive', min(height_m) > 0 from {buildings}
        union all select 'under_ceiling', max(height_m) <= 200 from {buildings}""",
    ),
}


def statement(name: str, views: tuple[str, ...], tables: tuple[str, ...], sql: str):
    spark_sql = sql.replace(", '', 'g')", ", '')")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(spark_sql, **{v: view(spark, sf_dir, v) for v in views}, **{t: read(spark, sf_dir, t) for t in tables})

    run.__doc__ = f"The query {name}."
    return run


def build(statements: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]]):
    """The queries of statements, and their SQL for DuckDB."""
    assert all(v in VIEWS for views, _, _ in statements.values() for v in views)
    queries = {name: statement(name, *parts) for name, parts in statements.items()}
    return queries, {name: oracle(sql.replace("percentile(", "quantile_cont(").format(**{x: x for x in (*views, *tables)}), *views) for name, (views, tables, sql) in statements.items()}


QUERIES, SQL = build(STATEMENTS)
