"""Whole stages, made of the operators, and the scans that feed them."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import vocabulary as V
from geoloom.operators import greedy, lines as L, raster, registers, spatial, triangulate
from geoloom.plans import expressions
from geoloom.plans.joins import PIP, RANKED, collector, usage_rank
from geoloom.plans.shapes import WALK
from geoloom.sources import pages

QUERIES, SQL = expressions.build(
    {
        "s4_building_pages": (
            (), ("lineitem",),
            """select part, page, qx * (0.001e0 * (1 + page % 3)) + page as vx from (select l_partkey as part, min(l_orderkey) as page, min(l_suppkey) as qx from {lineitem} group by l_partkey) t""",
        ),
        "s5_tile_scan": (
            ("poly",), (),
            """select id, tile from (select id, cx, cy, rad, cast(floor(cx / 250) as bigint) * 4 + cast(floor(cy / 250) as bigint) as tile from {poly}) t
            where tile in (0, 1, 4, 5) and not (cx + rad < 100 or cx - rad > 400 or cy + rad < 100 or cy - rad > 400)""",
        ),
        "s7_coverage_scan": (("ras",), (), "select r, c, zc from {ras} where r between 20 and 59 and c between 10 and 79"),
        "s9_image_level": (
            (), ("part",),
            "select p_type, coalesce(max(case when p_size / 100.0e0 <= 0.25 then p_size end), min(p_size)) as level from {part} group by p_type",
        ),
        "s13_reachable": ((), ("events",), "select user_id % 50 as source, max(case when event_type = 'click' then 1 else 0 end) = 1 as up from {events} group by user_id % 50"),
        "s10_road_lines": (
            ("lines",), (),
            """select line, vertex, x, y from (select line, vertex, x, y, lag(x) over (partition by line order by vertex) as px, lag(y) over (partition by line order by vertex) as py from {lines} where line % 11 <> 0) t
            where px is null or abs(x - px) > 1e-6 or abs(y - py) > 1e-6""",
        ),
    }
)
query = collector(QUERIES, SQL)


@query("s8_mosaic", ("ras",), "select r, c, zc from ras")
def s8(ras):
    """Four tiles of a raster, each counted from its own corner, put together."""
    tiles = [(ras.where(f"floor(r / 50) = {a} and floor(c / 50) = {b}").select((F.col("r") - 50 * a).alias("r"), (F.col("c") - 50 * b).alias("c"), "zc"), 50 * a, 50 * b) for a in (0, 1) for b in (0, 1)]
    return pages.mosaic(tiles)


@query("p34_triangulate", ("poly",), "select id, case when hole > 0 then 8 else 2 end as triangles, round(2 * rad * rad - 2 * hole * hole, 6) as area from poly")
def p34(poly):
    """The triangles that cover each polygon less its hole, and their area."""
    ring = lambda r: F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in [(F.col("cx") + F.col(r), F.col("cy")), (F.col("cx"), F.col("cy") + F.col(r)), (F.col("cx") - F.col(r), F.col("cy")), (F.col("cx"), F.col("cy") - F.col(r))]])
    rings = poly.select("id", F.when(F.col("hole") > 0, F.array(ring("rad"), ring("hole"))).otherwise(F.array(ring("rad"))).alias("rings"))
    area = F.expr("((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2")
    return triangulate.triangulate(rings).groupBy("id").agg(F.count(F.lit(1)).alias("triangles"), F.round(F.sum(area), 6).alias("area"))


@query("x1_terrain", ("ras",), None)
def x1(ras):
    """Valid cells to a coarser grid of means, holes filled, and the filled cells smoothed."""
    blocks = ras.where("zc > 0").groupBy(F.floor(F.col("r") / 4).alias("r"), F.floor(F.col("c") / 4).alias("c")).agg(F.floor(F.avg("zc")).cast("long").alias("zc"))
    full = raster.fill_holes(blocks, 25, 25)
    smooth = raster.focal(full, 1, [F.avg(F.col("zc") / 100).alias("mean")])
    measured = blocks.select("r", "c", F.lit(True).alias("measured"))
    return smooth.join(measured, ["r", "c"], "left").select("r", "c", F.coalesce("measured", F.lit(False)).alias("measured"), F.when(F.col("measured"), F.col("zc") / 100).otherwise(F.col("mean")).alias("z"))


@query("x2_waters", ("pts", "poly"), f"with {PIP} select polygon, count(*) as samples, min(p.v) as low, max(p.v) as high from pip join pts p on p.id = pip.point where cls % 2 = 0 group by polygon")
def x2(pts, poly):
    """The height samples in each water, summed up by place before they meet it."""
    seen = pts.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    found = spatial.places_in_polygons(seen, poly.where("cls % 2 = 0"))
    return found.groupBy("polygon").agg(F.sum("n").alias("samples"), F.min("low").alias("low"), F.max("high").alias("high"))


@query("x3_buildings", ("buildings", "units"), f"""select b.id, coalesce(u.rank, {V.PRIORITY.index("other")}) as function, case when height_m < 2.5 or height_m > 45 then 'implausible' when footprint_m2 < 250 and floors <= 4 then 'small' else 'large' end as size
  from buildings b left join (select pand, min(k) as rank from (select pand, case when trim(p) = '' then null else {RANKED.replace("case p", "case lower(trim(p))")} end as k from (select pand, unnest(string_split(purposes, ',')) as p from units)) group by pand) u
  on u.pand = replace(b.id, 'NL.X.', '')""")
def x3(buildings, units):
    """Buildings with the function of their units and a class of size; units are reduced before the join."""
    ranks = units.groupBy("pand").agg(F.min(usage_rank("purposes")).alias("rank"))
    size = F.when((F.col("height_m") < 2.5) | (F.col("height_m") > 45), "implausible").when((F.col("footprint_m2") < 250) & (F.col("floors") <= 4), "small").otherwise("large")
    return buildings.join(ranks, F.substring_index("id", ".", -1) == ranks.pand, "left").select("id", F.coalesce("rank", F.lit(V.PRIORITY.index("other"))).alias("function"), size.alias("size"))


@query("x4_detected_trees", ("ras", "poly"), None)
def x4(ras, poly):
    """Peaks of a surface off the roofs, tallest first, spaced by their crowns, with their sizes."""
    peaks = raster.local_peaks(ras, 1).select((F.col("r") * 100 + F.col("c")).alias("id"), ((F.col("c") + 0.5) * 10).alias("x"), ((F.col("r") + 0.5) * 10).alias("y"), F.least(F.greatest(F.col("zc") / 400000, F.lit(2.0)), F.lit(35.0)).alias("h"))
    roofs = spatial.points_in_polygons(peaks, poly.where("cls % 3 = 0")).select(F.col("point").alias("id")).distinct()
    sized = peaks.join(roofs, "id", "left_anti").withColumns({"crown": F.least(F.greatest(0.26 * F.col("h"), F.lit(0.8)), F.lit(7.0)), "trunk": F.least(F.greatest(0.38 * F.col("h"), F.lit(0.6)), F.lit(6.0))})
    kept = greedy.spaced(sized.withColumn("reach", F.col("crown") * 2), "reach", 14.0, [-F.col("h"), F.col("x"), F.col("y")])
    return kept.select("id", "x", "y", "h", "crown", "trunk")


@query("x5_furniture", ("versions", "pts", "ras"), """select p.id, p.kind, zc from (select *, row_number() over (partition by object_id order by seq) as k from versions where ended = '') v join pts p on p.id = v.seq and p.x between 100 and 900
  left join ras on r = cast(floor(p.y / 10) as bigint) and c = cast(floor(p.x / 10) as bigint) where (k = 1 or object_id is null) and p.kind in ('view', 'click')""")
def x5(versions, pts, ras):
    """Current objects of known kinds in the box, on the ground."""
    now = registers.current_versions(versions.where("kind in ('view', 'click')"), "object_id", "ended", "seq").select(F.col("seq").alias("id"))
    placed = pts.where("x between 100 and 900").join(now, "id").select("id", "kind", F.floor(F.col("y") / 10).alias("r"), F.floor(F.col("x") / 10).alias("c"))
    return placed.join(ras, ["r", "c"], "left").select("id", "kind", "zc")


@query("x7_vehicles", ("pts", "poly"), f"with {PIP} select p.id, case when w.cls is null then 'car' else 'boat' end as kind, w.polygon as water from pts p left join (select point, arg_min(cls, polygon) as cls, min(polygon) as polygon from pip where cls % 2 = 1 group by point) w on w.point = p.id where p.kind = 'click'")
def x7(pts, poly):
    """Vehicles on land, boats on the first water that holds them."""
    spots = pts.where("kind = 'click'")
    water = spatial.points_in_polygons(spots, poly.where("cls % 2 = 1")).groupBy(F.col("point").alias("id")).agg(F.min("polygon").alias("water"))
    return spots.join(water, "id", "left").select("id", F.when(F.col("water").isNull(), "car").otherwise("boat").alias("kind"), "water")


@query("x8_rails", ("lines", "ras"), f"""with {WALK} select d.line, count(*) as points, count(zc) as measured, max(zc) as top from (select line, px + part / n * (x - px) as x, py + part / n * (y - py) as y from (
  select *, unnest(range(1, n + 1)) as part from (select *, greatest(cast(ceil(len / 150.0) as bigint), 1) as n from walk where px is not null))) d
  left join ras on r = least(cast(floor(d.y / 10) as bigint), 99) and c = least(cast(floor(d.x / 10) as bigint), 99) group by d.line""")
def x8(lines, ras):
    """Tracks cut to even parts and laid on the ground."""
    cut = L.densify(spatial.segments(lines), 150.0)
    placed = cut.select("line", F.least(F.floor(F.col("y") / 10), F.lit(99)).alias("r"), F.least(F.floor(F.col("x") / 10), F.lit(99)).alias("c"))
    return placed.join(ras, ["r", "c"], "left").groupBy("line").agg(F.count(F.lit(1)).alias("points"), F.count("zc").alias("measured"), F.max("zc").alias("top"))
