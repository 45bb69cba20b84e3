"""Checks, outputs, orders and set operations: statements that Spark and DuckDB read alike."""

from __future__ import annotations

from geoloom.functions import vocabulary as V
from geoloom.plans.expressions import build

#: Every check gives its name, whether it passed and how severe a failure is.
CHECKS: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "v4_buildings_meet_terrain": (
        ("buildings", "ras"), (),
        """select 'buildings_meet_terrain' as name, count(*) > 0 and max(case when base > low + 0.75 then 1 else 0 end) = 0 as passed, 'error' as severity, count(*) as checked from (
        select p.id, p.base, min(n.zc) / 100000.0e0 as low from (
          select id, height_m / 50 as base, floors * 3 as r, cast(floor(footprint_m2 / 100) as bigint) as c from {buildings}) p
        join {ras} n on n.r between p.r - 1 and p.r + 1 and n.c between p.c - 1 and p.c + 1 group by p.id, p.base) t""",
    ),
    "v5_tree_checks": (
        ("pts",), (),
        """select 'trees_present' as name, count(*) > 0 as passed, 'error' as severity from {pts} union all
        select 'trees_inside', coalesce(min(x) >= 0 and max(x) <= 1000 and min(y) >= 0 and max(y) <= 1000, false), 'error' from {pts} union all
        select 'tree_heights', coalesce(max(v / 3) <= 45, false), 'error' from {pts} union all
        select 'found_tree_heights', coalesce(max(case when id % 4 = 0 then v / 3 end) <= 32, true), 'error' from {pts} union all
        select 'no_two_share_a_spot', count(*) = 0, 'error' from (select floor(x) as gx, floor(y) as gy from {pts} group by floor(x), floor(y) having count(*) > 1) t""",
    ),
    "v6_water_checks": (
        ("poly",), (),
        """select 'water_present' as name, count(*) > 0 as passed, 'error' as severity from {poly} union all
        select 'water_levels', coalesce(min(lev / 100) >= -10 and max(lev / 100) <= 60, false), 'error' from {poly} union all
        select 'one_level_per_water', coalesce(max(spread) < 0.01, true), 'error' from (select max(lev) - min(lev) as spread from {poly} group by cls) t union all
        select 'bed_below_bank', coalesce(min(case when bed < bank then 1 else 0 end) = 1, false), 'error' from (select min(lev - rad) as bed, percentile(lev, 0.25) - 0.4 as bank from {poly} group by cls) b union all
        select 'land_cover_coverage', coalesce(sum(2 * rad * rad - 2 * hole * hole) / 1000000.0e0 > 0.25, false), 'warning' from {poly}""",
    ),
    "v7_road_checks": (
        ("tris", "pts"), (),
        """select 'road_surface_present' as name, count(*) > 0 as passed, 'error' as severity from {tris} union all
        select 'mostly_quads', coalesce(sum(case when n = 2 then 2 else 0 end) >= 0.5 * sum(n), false), 'warning' from (select floor(tri / 2) as q, count(*) as n from {tris} group by floor(tri / 2)) t union all
        select 'follows_terrain', coalesce(avg(case when abs(v - 50) > 49 then 1.0e0 else 0.0e0 end) <= 0.002, true), 'error' from {pts} union all
        select 'terrain_stays_under', coalesce(avg(case when v > 99.9 then 1.0e0 else 0.0e0 end) <= 0.001, true), 'error' from {pts}""",
    ),
    "v8_furniture_inside": (("pts",), (), "select kind, count(*) as n, count(case when not (x between 0 and 1000 and y between 0 and 1000) then 1 end) = 0 as passed from {pts} group by kind"),
    "v9_barrier_checks": (
        ("tris", "lines"), (),
        """select 'manifold' as name, coalesce(max(users) <= 2, true) as passed, 'error' as severity from (select count(*) as users from (
          select least(v1, v2) as a, greatest(v1, v2) as b from {tris} union all select least(v2, v3), greatest(v2, v3) from {tris} union all select least(v3, v1), greatest(v3, v1) from {tris}) e group by a, b) t
        union all select 'not_degenerate', coalesce(min(abs((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2) > 1e-9, true), 'error' from {tris}
        union all select 'height_plausible', coalesce(max(x / 125) <= 8, true), 'error' from {lines}
        union all select 'sits_on_ground', coalesce(avg(case when y > 999 then 1.0e0 else 0.0e0 end) <= 0.30, true), 'error' from {lines}""",
    ),
    "v10_vehicle_checks": (
        ("pts", "poly"), (),
        """select 'vehicles_inside' as name, coalesce(min(x) >= 0 and max(x) <= 1000 and min(y) >= 0 and max(y) <= 1000, true) as passed from {pts} where kind in ('click', 'view')
        union all select 'cars_finite', coalesce(max(abs(v)) < 1e30, true) from {pts} where kind = 'click'
        union all select 'boats_at_water_level', count(*) = 0 from {poly} where lev is null or abs(lev) > 100000""",
    ),
    "v11_rail_checks": (("pts",), (), "select kind, min(case when kind = 'view' then v - 2.4e0 else v end) >= -0.05 as passed, count(case when v > 6 then 1 end) as elevated from {pts} group by kind"),
    "v12_structure_checks": (
        ("pts",), (),
        """select 'structures_measured' as name, coalesce(avg(case when id % 5 = 0 then 0.0e0 else 1.0e0 end) >= 0.5, false) as passed, 'warning' as severity from {pts}
        union all select 'decks_above', coalesce(avg(case when v >= y / 100 then 1.0e0 else 0.0e0 end) > 0.98, true), 'error' from {pts} where kind = 'click'
        union all select 'tunnels_below', coalesce(max(v - y) < 0, true), 'error' from {pts} where kind = 'error'
        union all select 'portals', count(*) >= 2 or count(*) = 0, 'error' from {pts} where kind = 'purchase'""",
    ),
    "v13_world_file": (("poly",), (), "select id, abs(floor((cx - rad + rad / 64) * 1000 + 0.5) / 1000 - rad / 64 - (cx - rad)) < 4e-4 as passed from {poly}"),
    "v15_quay_checks": (
        ("poly",), (),
        "select cls, min(rad - 2) >= 1 as quay_below, coalesce(min(abs(lev) / 1000) >= 0.1 and max(abs(lev) / 1000) <= 6, false) as deck_height from {poly} group by cls",
    ),
    "v16_closed_sheet": (
        ("tris",), (),
        """select (select count(*) from {tris}) as triangles, (select sum((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2 from {tris}) as area,
        count(case when users = 1 then 1 end) as outline, count(case when users > 2 then 1 end) as broken from (select count(*) as users from (
          select least(v1, v2) as a, greatest(v1, v2) as b from {tris} union all select least(v2, v3), greatest(v2, v3) from {tris} union all select least(v3, v1), greatest(v3, v1) from {tris}) e group by a, b) t""",
    ),
    "v17_mesh_problems": (
        ("tris",), (),
        """select tri, case when area <= 1e-9 then 'flipped' when 4 * sqrt(3.0e0) * surface / (a2 + b2 + c2) < 0.05 then 'sliver' else 'ok' end as problem from (
        select tri, area, a2, b2, c2, sqrt(nx * nx + ny * ny + 4 * area * area) / 2 as surface from (select tri,
          ((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2 as area, (y2 - y1) * (z3 - z1) - (z2 - z1) * (y3 - y1) as nx, (z2 - z1) * (x3 - x1) - (x2 - x1) * (z3 - z1) as ny,
          (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) + (z2 - z1) * (z2 - z1) as a2, (x3 - x2) * (x3 - x2) + (y3 - y2) * (y3 - y2) + (z3 - z2) * (z3 - z2) as b2,
          (x1 - x3) * (x1 - x3) + (y1 - y3) * (y1 - y3) + (z1 - z3) * (z1 - z3) as c2 from {tris}) s) t""",
    ),
}

#: What the stages hand on: the tables that sinks write.
OUTPUTS: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "k1_terrain_grid": (("ras",), (), "select cast(floor(r / 50) as bigint) as tile_r, cast(floor(c / 50) as bigint) as tile_c, r, c, zc / 100.0e0 as height, true as measured from {ras}"),
    "k2_buildings_table": (("buildings",), (), "select id, height_m, coalesce(build_year, 0) as build_year, coalesce(function, 5) as function, coalesce(function, 5) in (1, 4) as ground_style from {buildings}"),
    "k3_water_rings": (
        ("poly",), (),
        """select id, 'outer' as ring, 0 as hole_no, lev, 4 as vertices, rad as size from {poly} union all select id, 'hole', 1, lev, 4, hole from {poly} where hole > 0""",
    ),
    "k4_land_cover": (
        ("poly",), (),
        """select 49 - gy as north_up_row, gx, max(cls) as class from (select cast(floor(cx / 20) as bigint) as gx, cast(floor(cy / 20) as bigint) as gy, cls from {poly}) t group by gx, gy""",
    ),
    "k5_tree_list": (
        ("pts",), (),
        """select id, round(x - 500, 3) as local_x, round(500 - y, 3) as local_z, round(v / 3, 2) as height_m, round(least(greatest(0.26e0 * (v / 3), 0.8e0), 7.0e0), 2) as crown_radius_m,
        id % 3 <> 0 as height_measured, id % 4 = 0 as detected from {pts}""",
    ),
    "k6_vehicle_list": (
        ("pts",), (),
        """select id, case when kind = 'view' then 'boat' when kind = 'error' then 'post' else 'car' end as kind, round(x - 500, 3) as local_x, round(500 - y, 3) as local_z,
        round(((90 - (v * 3.6e0 - 180)) + 360) - 360 * floor(((90 - (v * 3.6e0 - 180)) + 360) / 360), 1) as heading_deg from {pts}""",
    ),
    "k7_columns_of_kinds": (
        ("lines",), (),
        "select kind, line, cast(count(*) as bigint) as vertices, min(vertex) as first_vertex, max(vertex) as last_vertex from {lines} group by kind, line",
    ),
    "k8_metadata": (
        ("pts", "buildings", "poly"), (),
        """select 'RD New' as crs, (select min(x) from {pts}) as xmin, (select min(y) from {pts}) as ymin, (select max(x) from {pts}) as xmax, (select max(y) from {pts}) as ymax,
        (select count(*) from {buildings}) as buildings, (select count(*) from {poly}) as water, (select count(*) from {pts}) as trees""",
    ),
    "k10_run_report": (
        (), ("lineitem",),
        """select step, seconds, failed, cast(sum(seconds) over (order by step rows between unbounded preceding and current row) as bigint) as elapsed from (
        select l_linenumber as step, cast(sum(l_quantity) as bigint) as seconds, count(case when l_returnflag = 'R' then 1 end) > 100000000 as failed from {lineitem} group by l_linenumber) t""",
    ),
    "k11_world_file": (
        ("poly",), (),
        """select id, 2 * rad / 64 as a, 0.0e0 as d, 0.0e0 as b, -(2 * rad / 64) as e, cx - rad + rad / 64 as c, cy + rad - rad / 64 as f from {poly}""",
    ),
}

ROWS: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "o1_tallest_first": (("pts",), (), "select id, cast(row_number() over (partition by floor(x / 50), floor(y / 50) order by v desc, x, y, id) as bigint) as place from {pts}"),
    "o2_top_four": ((), ("events",), "select score, az, el from (select sum(value) as score, user_id % 72 as az, event_id % 8 as el from {events} group by user_id % 72, event_id % 8) t order by score desc, az desc, el desc limit 4"),
    "o3_coarsest_level": (
        (), ("part",),
        """select p_brand, coalesce(min(case when p_size <= 25 then p_size end) , max(p_size)) as finest, coalesce(max(case when p_size <= 25 then p_size end), min(p_size)) as chosen from {part} group by p_brand""",
    ),
    "o4_stride_sample": (
        ("pts",), (),
        """select kind, id from (select kind, id, row_number() over (partition by kind order by id) - 1 as k, greatest(floor(count(*) over (partition by kind) / 400), 1) as stride from {pts}) t
        where k % stride = 0""",
    ),
    "o5_newest": ((), ("orders",), "select o_orderkey, o_orderdate from {orders} order by o_orderdate desc, o_orderkey desc limit 24"),
    "o6_listing": ((), ("part",), "select p_brand, n, cast(row_number() over (order by n desc, p_brand) as bigint) as place from (select p_brand, count(*) as n from {part} group by p_brand) t"),
    "o7_composite_key": (("poly",), (), "select cls, id, cast(row_number() over (partition by cls order by 2 * rad * rad - 2 * hole * hole, lev desc, id) as bigint) as place from {poly}"),
    "o8_page_budget": ((), ("orders",), "select o_custkey, o_orderkey from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as k from {orders}) t where k <= 5"),
    "u1_tagged_union": (
        ("pts", "poly", "lines"), (),
        """select 'car' as kind, id, x, y from {pts} where kind = 'click' union all select 'boat', id, cx, cy from {poly} where cls % 3 = 0
        union all select 'post', line, min(x), min(y) from {lines} group by line""",
    ),
    "u2_union_distinct": (("network",), (), "select a as node from {network} union select b from {network}"),
    "u3_difference": ((), ("customer", "orders"), "select c_custkey from {customer} c where not exists (select 1 from {orders} o where o.o_custkey = c.c_custkey and o.o_orderpriority = '1-URGENT')"),
    "u4_uncovered_intervals": (
        ("poly",), (),
        """select id, greatest(cx - rad, 200) as from_x, least(cx + rad, 400) as to_x, least(cx + rad, 400) - greatest(cx - rad, 200) as length from {poly} where cx + rad > 200 and cx - rad < 400""",
    ),
    "u5_key_overlap": (
        (), ("lineitem",),
        """select a.l_suppkey as s, count(*) as shared from (select distinct l_suppkey, l_partkey from {lineitem} where l_returnflag = 'R') a
        join (select distinct l_suppkey, l_partkey from {lineitem} where l_returnflag = 'A') b on a.l_suppkey = b.l_suppkey and a.l_partkey = b.l_partkey group by a.l_suppkey""",
    ),
    "u6_row_sets": ((), ("orders", "customer"), "(select o_custkey as k from {orders} intersect select c_custkey from {customer}) except select c_custkey from {customer} where c_acctbal < 0"),
    "f12_area_floor": (("poly",), (), "select id, 2 * rad * rad - 2 * hole * hole as area, (rad * rad) / (2 * rad * rad) >= 0.2 as wet_enough from {poly} where 2 * rad * rad - 2 * hole * hole >= 40"),
    "f15_quay_walls": (
        (), ("part",),
        """select p_partkey, type from (select p_partkey, case p_partkey % 5 when 0 then 'Kademuur' when 1 then 'muur' when 2 then 'niet-bgt' when 3 then 'kademuur laag' else '' end as type from {part}) t
        where lower(type) like '%kademuur%'""",
    ),
    "p8_ground_layer": (
        (), ("lineitem",),
        f"""select kind, material, count(*) as n from (select kind, case when kind = 'water' then 'water' when kind = 'road' and ({" or ".join(f"m like '%{b}%'" for b in V.BRICK_MATERIALS)}) then 'brick'
        when kind = 'road' then 'asphalt' when kind = 'green' and m = 'gras' then 'grass' when kind = 'green' then 'soil' end as material from (
        select case l_linenumber when 1 then 'road' when 2 then 'green' when 3 then 'water' else 'other' end as kind, case l_suppkey % 4 when 0 then 'asfalt' when 1 then 'klinker' when 2 then 'gras' else '' end as m
        from {{lineitem}}) a) b where material is not null group by kind, material""",
    ),
    "p18_barrier_style": (
        ("pts",), (),
        """select id, case when v > 90 then v / 50 else height end as height, greatest(thick, 0.2e0) as collider from (select id, v, case kind when 'view' then 1.0e0 when 'click' then 1.8e0 when 'error' then 0.5e0 else 2.2e0 end as height,
        case kind when 'view' then 0.05e0 when 'click' then 0.12e0 else 0.4e0 end as thick from {pts}) t""",
    ),
    "p20_bay_fit": (
        ("lines",), (),
        """select line, vertex, (x - low) / ((high - low) / bays) as u, (high - low) / bays < 22 as narrow from (select line, vertex, x, low, high, greatest(cast(floor((high - low) / 40 + 0.5) as bigint), 1) as bays from (
        select line, vertex, x, min(x) over (partition by line) as low, max(x) over (partition by line) as high from {lines}) a) b where high > low""",
    ),
    "p22_position_dice": (
        ("pts",), (),
        """select id, round(h1 - floor(h1), 5) as d1, round(h2 - floor(h2), 5) as d2 from (select id, sin((x * 1000 + y) * 0.0001e0 + 1.0e0) * 43758.5453e0 as h1, sin((x * 1000 + y) * 0.0001e0 + 2.0e0) * 43758.5453e0 as h2 from {pts}) t""",
    ),
    "p24_object_names": (
        (), ("lineitem",),
        """select l_orderkey, case when bridge then concat('bridge_', name) when n >= 3 then concat('junction_', name) when paved then concat('paving_', name) else concat('road_', name) end as label from (
        select l_orderkey, min(l_shipdate) < timestamp '1993-01-01 00:00:00' as bridge, max(l_discount) > 0.08 as paved, count(distinct l_suppkey) as n,
        concat(cast(min(l_suppkey) as string), '_x_', cast(max(l_suppkey) as string)) as name from {lineitem} group by l_orderkey) t""",
    ),
    "p29_line_clip": (
        ("lines",), (),
        """select line, vertex, t0, t1, px + t0 * dx as x0, py + t0 * dy as y0, px + t1 * dx as x1, py + t1 * dy as y1 from (
        select line, vertex, px, py, dx, dy, greatest(0.0e0, case when dx > 0 then (200 - px) / dx when dx < 0 then (800 - px) / dx else 0.0e0 end, case when dy > 0 then (200 - py) / dy when dy < 0 then (800 - py) / dy else 0.0e0 end) as t0,
        least(1.0e0, case when dx > 0 then (800 - px) / dx when dx < 0 then (200 - px) / dx else 1.0e0 end, case when dy > 0 then (800 - py) / dy when dy < 0 then (200 - py) / dy else 1.0e0 end) as t1 from (
        select line, vertex, px, py, x - px as dx, y - py as dy from (select line, vertex, x, y, lag(x) over (partition by line order by vertex) as px, lag(y) over (partition by line order by vertex) as py from {lines}) a
        where px is not null) b where (dx <> 0 or px between 200 and 800) and (dy <> 0 or py between 200 and 800)) c where t0 < t1""",
    ),
    "p32_triangle_normals": (
        ("tris",), (),
        """select tri, round(nx / n, 9) as nx, round(ny / n, 9) as ny, round(nz / n, 9) as nz, n / 2 as area from (select tri, nx, ny, nz, sqrt(nx * nx + ny * ny + nz * nz) as n from (select tri,
        (y2 - y1) * (z3 - z1) - (z2 - z1) * (y3 - y1) as nx, (z2 - z1) * (x3 - x1) - (x2 - x1) * (z3 - z1) as ny, (x2 - x1) * (y3 - y1) - (y2 - y1) * (x3 - x1) as nz from {tris}) a) b where n > 0""",
    ),
    "p39_quaternions": (
        ("pts",), (),
        """select id, case when ct > -0.5 then round(sqrt(1 + 1 + 2 * ct) / 2, 9) else round(abs(sin(t)) / sqrt(2 - 2 * ct), 9) end as w,
        case when ct > -0.5 then round(2 * sin(t) / (2 * sqrt(2 + 2 * ct)), 9) else round(case when sin(t) < 0 then -sqrt(2 - 2 * ct) / 2 else sqrt(2 - 2 * ct) / 2 end, 9) end as z from (select id, t, cos(t) as ct from (select id, v / 16 - 3.1e0 as t from {pts}) a) b""",
    ),
    "a13_deck_quartile": (
        ("pts",), (),
        "select kind, case when count(case when v between 50.1e0 and 56 then 1 end) >= 10 then percentile(case when v between 50.1e0 and 56 then v end, 0.25) else 1.5e0 end as deck from {pts} group by kind",
    ),
    "a21_edge_multiplicity": (
        ("tris",), (),
        """select users, count(*) as edges from (select a, b, count(*) as users from (select least(v1, v2) as a, greatest(v1, v2) as b from {tris} union all select least(v2, v3), greatest(v2, v3) from {tris}
        union all select least(v3, v1), greatest(v3, v1) from {tris}) e group by a, b) t group by users""",
    ),
    "a12_deck_median": (
        ("pts",), (),
        """select kind, case when avg(case when v > 20 then 1.0e0 else 0.0e0 end) >= 0.3 then median(case when v > 20 then v end) end as deck, avg(case when v > 20 then 1.0e0 else 0.0e0 end) as support from {pts} group by kind""",
    ),
    "a17_channel_gain": (
        ("ras",), (),
        """select c.class, case when c.n < 50 or c.dark < 1 then o.lit / o.dark else c.lit / c.dark end as gain from (
        select c % 7 as class, count(*) as n, median(case when zc > 5000000 then zc / 100.0e0 end) as lit, median(case when zc <= 5000000 then zc / 100.0e0 end) as dark from {ras} group by c % 7) c
        cross join (select median(case when zc > 5000000 then zc / 100.0e0 end) as lit, median(case when zc <= 5000000 then zc / 100.0e0 end) as dark from {ras}) o""",
    ),
    "a27_stage_totals": ((), ("lineitem",), "select l_linenumber as step, sum(l_quantity) as seconds, cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as failed from {lineitem} group by l_linenumber"),
    "j17_mask_class": (
        ("pts", "ras"), (),
        """select p.id, coalesce(m.zc > 5000000, false) as inside from (select id, cast(floor(y / 10 + 0.5) as bigint) as r, cast(floor(x / 10 + 0.5) as bigint) as c from {pts}) p left join {ras} m on m.r = p.r and m.c = p.c""",
    ),
    "w18_noise_lookup": (
        ("ras",), (),
        """select a.r, a.c, a.zc + n.zc / 100 as grained from {ras} a join {ras} n on n.r = cast(floor(a.r / 3) as bigint) % 8 and n.c = cast(floor(a.c / 3) as bigint) % 8""",
    ),
}

_built = [build(s) for s in (CHECKS, OUTPUTS, ROWS)]
QUERIES = {k: v for q, _ in _built for k, v in q.items()}
SQL = {k: v for _, s in _built for k, v in s.items()}
