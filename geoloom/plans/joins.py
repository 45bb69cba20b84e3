"""Queries over the operators for registers, space, rasters, lines and graphs, with DuckDB SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from geoloom.functions import vocabulary as V
from geoloom.operators import graph, raster, registers, sequences, spatial
from geoloom.sources.views import oracle, view

QUERIES, SQL = {}, {}


def collector(queries: dict, sqls: dict):
    """A decorator that files queries over views, and their SQL."""

    def query(name: str, views: tuple[str, ...], sql: str | None):
        def put(f):
            def run(spark, sf_dir):
                return f(*[view(spark, sf_dir, v) for v in views])

            run.__doc__ = f.__doc__
            queries[name] = run
            if sql is not None:
                sqls[name] = oracle(sql, *views)
            return f

        return put

    return query


query = collector(QUERIES, SQL)


@query("s2_current_versions", ("versions",), """select seq, object_id, kind, ended from (select *, row_number() over (partition by object_id order by seq) as k
  from versions where coalesce(ended, '') = '') where k = 1 or object_id is null""")
def s2(versions):
    """Current versions, first seen of each id; rows without an id all stay."""
    return registers.current_versions(versions, "object_id", "ended", "seq")


@query("s3_tree_register", ("pts",), """select id, x, y from (select *, row_number() over (partition by floor(x / 5), floor(y / 5) order by id) as k from pts
  where x between 100 and 900 and y between 100 and 900) where k = 1""")
def s3(pts):
    """Points in the box, first seen of each place."""
    return registers.first_seen(pts.where("x between 100 and 900 and y between 100 and 900"), [F.floor(F.col("x") / 5), F.floor(F.col("y") / 5)], "id").select("id", "x", "y")


RANKED = "case p " + " ".join(f"when '{k}' then {V.PRIORITY.index(g)}" for k, g in V.PURPOSES.items()) + f" else {V.PRIORITY.index('other')} end"


@query("p11_usage_group", ("units",), f"""select purposes, coalesce(min(k), {V.PRIORITY.index("other")}) as rank from (select purposes, {RANKED} as k from (
  select distinct purposes, lower(trim(unnest(string_split(purposes, ',')))) as p from units) where p <> '' union all select distinct purposes, null from units) group by purposes""")
def p11(units):
    """The most street-facing group of a list of purposes."""
    return units.select("purposes").distinct().select("purposes", usage_rank("purposes").alias("rank"))


def usage_rank(column: str):
    ranks = F.create_map(*[F.lit(x) for k, g in V.PURPOSES.items() for x in (k, V.PRIORITY.index(g))])
    other = F.lit(V.PRIORITY.index("other"))
    parts = F.filter(F.transform(F.split(column, ","), lambda p: F.lower(F.trim(p))), lambda p: p != "")
    return F.coalesce(F.array_min(F.transform(parts, lambda p: F.coalesce(F.try_element_at(ranks, p), other))), other)


@query("a7_usage_by_building", ("units",), f"""select pand, min(k) as rank, count(*) as units from (
  select pand, least(coalesce(k1, 9), coalesce(k2, 9), case when k1 is null and k2 is null then {V.PRIORITY.index("other")} else 9 end) as k from (
  select pand, case when p1 <> '' then {RANKED.replace("case p", "case p1")} end as k1, case when p2 <> '' then {RANKED.replace("case p", "case p2")} end as k2 from (
  select pand, lower(trim(split_part(purposes, ',', 1))) as p1, lower(trim(split_part(purposes, ',', 2))) as p2 from units))) group by pand""")
def a7(units):
    """Per building the highest-priority group over its units."""
    return units.groupBy("pand").agg(F.min(usage_rank("purposes")).alias("rank"), F.count(F.lit(1)).alias("units"))


@query("p13_look_hash", ("buildings",), """select id, cast((aggregate % 4294967296) % 7 as bigint) as look from (
  select id, list_reduce(list_prepend(2166136261::hugeint, list_transform(string_split(id, ''), lambda c: ascii(c)::hugeint)), lambda h, b: (xor(h, b) * 16777619) % 4294967296) as aggregate from buildings)""")
def p13(buildings):
    """FNV-1a of the id's bytes, mod 7."""
    data = F.transform(F.split(F.regexp_replace(F.hex(F.encode("id", "UTF-8")), "(..)", "$1,"), ","), lambda h: F.conv(h, 16, 10).cast("long"))
    folded = F.aggregate(F.slice(data, F.lit(1), F.octet_length("id")), F.lit(2166136261).cast("long"), lambda h, b: (h.bitwiseXOR(b) * 16777619) % 4294967296)
    return buildings.select("id", (folded % 7).alias("look"))


@query("p25_ring_area", ("poly",), "select id, 2 * rad * rad - 2 * hole * hole as area from poly")
def p25(poly):
    """Shoelace area of the rings; a hole's counts against."""
    def area(r):
        edges = spatial.diamond(F.lit(0.0), F.lit(0.0), F.col(r))
        return F.aggregate(edges, F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2

    return poly.select("id", (area("rad") - area("hole")).alias("area"))


PIP = """edges as (select id, lev, cls, cx, cy, rad, unnest([
    {'x1': cx + s, 'y1': cy, 'x2': cx, 'y2': cy + s}, {'x1': cx, 'y1': cy + s, 'x2': cx - s, 'y2': cy}, {'x1': cx - s, 'y1': cy, 'x2': cx, 'y2': cy - s},
    {'x1': cx, 'y1': cy - s, 'x2': cx + s, 'y2': cy}]) as e from (select *, unnest(case when hole > 0 then [rad, hole] else [rad] end) as s from poly)),
  pip as (select p.id as point, g.id as polygon, any_value(lev) as lev, any_value(cls) as cls from pts p join edges g on p.x between cx - rad and cx + rad and p.y between cy - rad and cy + rad
    where (e.y1 > p.y) <> (e.y2 > p.y) and p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1 group by p.id, g.id having count(*) % 2 = 1)"""


@query("j4_point_in_polygon", ("pts", "poly"), f"with {PIP} select point, polygon from pip")
def j4(pts, poly):
    """Even-odd, over a grid of cells."""
    return spatial.points_in_polygons(pts, poly).select("point", "polygon")


@query("j5_first_polygon", ("pts", "poly"), f"with {PIP} select point, min(polygon) as polygon, arg_min(cls, polygon) as cls from pip group by point")
def j5(pts, poly):
    """Of the polygons that hold a point the first; found once for all points of a place."""
    first = spatial.places_in_polygons(spatial.places(pts), poly).groupBy("x", "y").agg(F.min(F.struct("polygon", "cls")).alias("m"))
    return spatial.at_places(pts.select(F.col("id").alias("point"), "x", "y"), first).select("point", "m.polygon", "m.cls")


@query("j16_deck_level", ("pts", "poly"), f"with {PIP} select p.id, greatest(max(lev) / 100, p.y / 10) + 0.05 as z, count(lev) as decks from pts p left join pip on pip.point = p.id group by p.id, p.y")
def j16(pts, poly):
    """The highest deck over a point, no lower than the ground; null off decks. Decks are found once for all points of a place."""
    decks = spatial.places_in_polygons(spatial.places(pts), poly).groupBy("x", "y").agg(F.max("lev").alias("top"), F.count("lev").alias("decks"))
    z = F.greatest(F.col("top") / 100, F.col("y") / 10) + F.lit(0.05)
    return spatial.at_places(pts.select("id", "x", "y"), decks, "left").select("id", z.alias("z"), F.coalesce("decks", F.lit(0)).alias("decks"))


PAIRS = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"


@query("j6_within_distance", ("pts",), f"select a.id as id_a, b.id as id_b, {PAIRS} as gap from pts a join pts b on a.id < b.id and b.x between a.x - 4.001 and a.x + 4.001 and {PAIRS} <= 4")
def j6(pts):
    """Pairs of points at most 4 m apart."""
    return spatial.within_distance(pts, pts, 4.0).where("id_a < id_b")


@query("j7_nearest_in_range", ("pts",), f"""select distinct least(id_a, id_b) as a, greatest(id_a, id_b) as b, gap from (select a.id as id_a, b.id as id_b, {PAIRS} as gap,
  row_number() over (partition by a.id order by {PAIRS}, b.id) as k from pts a join pts b on a.id <> b.id and b.x between a.x - 18.001 and a.x + 18.001 and {PAIRS} <= 18) where k = 1 and gap between 2 and 18""")
def j7(pts):
    """Each point's nearest other, if 2 to 18 m away; each pair once."""
    found = spatial.nearest(pts, pts, 18.0).where("gap between 2 and 18")
    return found.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "gap").distinct()


@query("j21_closest_pair", ("pts",), f"select min({PAIRS}) as gap from pts a join pts b on a.id < b.id and (a.kind = 'error' or b.kind = 'error') and b.x between a.x - 5.001 and a.x + 5.001 and {PAIRS} <= 5")
def j21(pts):
    """The closest pair within 5 m of which one is flagged."""
    flagged = pts.where("kind = 'error'")
    return spatial.within_distance(flagged, pts, 5.0).where("id_a <> id_b").agg(F.min("gap").alias("gap"))


@query("j22_snap", ("pts", "poly"), """select p.id as point, arg_min(g.id, {'d': sqrt((p.x - g.cx) * (p.x - g.cx) + (p.y - g.cy) * (p.y - g.cy)), 'i': g.id}) as anchor from pts p
  join poly g on g.cx between p.x - 3.001 and p.x + 3.001 and sqrt((p.x - g.cx) * (p.x - g.cx) + (p.y - g.cy) * (p.y - g.cy)) <= 3 group by p.id""")
def j22(pts, poly):
    """The nearest anchor within 3 m; the smaller id at ties."""
    anchors = poly.select("id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    met = spatial.within_distance(pts, anchors, 3.0).groupBy("id_a").agg(F.min(F.struct("gap", "id_b")).alias("m"))
    return met.select(F.col("id_a").alias("point"), F.col("m.id_b").alias("anchor"))


@query("j9_cell_gather", ("pts", "ras"), """select id, zc from pts left join ras on r = least(greatest(cast(floor(y / 10) as bigint), 0), 99) and c = least(greatest(cast(floor(x / 10) as bigint), 0), 99)""")
def j9(pts, ras):
    """The raster's value under each point, clipped to its edge; null in a hole."""
    placed = pts.select("id", F.least(F.greatest(F.floor(F.col("y") / 10), F.lit(0)), F.lit(99)).alias("r"), F.least(F.greatest(F.floor(F.col("x") / 10), F.lit(0)), F.lit(99)).alias("c"))
    return placed.join(ras, ["r", "c"], "left").select("id", "zc")


@query("j10_bilinear", ("pts", "ras"), """select p.id, ((a.zc * (1 - fx) + b.zc * fx) * (1 - fy) + (d.zc * (1 - fx) + e.zc * fx) * fy) as z from (
  select id, floor(x / 10) as c, floor(y / 10) as r, x / 10 - floor(x / 10) as fx, y / 10 - floor(y / 10) as fy from pts) p
  join ras a on a.r = p.r and a.c = p.c join ras b on b.r = p.r and b.c = least(p.c + 1, 99) join ras d on d.r = least(p.r + 1, 99) and d.c = p.c join ras e on e.r = least(p.r + 1, 99) and e.c = least(p.c + 1, 99)""")
def j10(pts, ras):
    """Between the four cells around a point, if all are present; one exchange by point instead of four joins."""
    x, y = F.col("x") / 10, F.col("y") / 10
    corners = F.array(*[F.struct(F.lit(n).alias("n"), F.least(F.floor(y) + dr, F.lit(99)).alias("r"), F.least(F.floor(x) + dc, F.lit(99)).alias("c")) for n, (dr, dc) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)])])
    found = pts.select("id", (x - F.floor(x)).alias("fx"), (y - F.floor(y)).alias("fy"), F.inline(corners)).join(ras, ["r", "c"])
    at = lambda n: F.max(F.when(F.col("n") == n, F.col("zc")))
    wide = found.groupBy("id", "fx", "fy").agg(*[at(n).alias(f"z{n}") for n in range(4)])
    z = (F.col("z0") * (1 - F.col("fx")) + F.col("z1") * F.col("fx")) * (1 - F.col("fy")) + (F.col("z2") * (1 - F.col("fx")) + F.col("z3") * F.col("fx")) * F.col("fy")
    return wide.select("id", z.alias("z")).where("z is not null")


@query("j25_shared_edges", ("ras",), """select least(a, b) as v1, greatest(a, b) as v2, count(*) as users from (select e.a as a, e.b as b from (
  select unnest([{'a': k, 'b': k + 1}, {'a': k + 1, 'b': k + 101}, {'a': k + 101, 'b': k + 100}, {'a': k + 100, 'b': k}]) as e from (select r * 100 + c as k from ras where c < 99 and r < 99))) group by 1, 2""")
def j25(ras):
    """How many faces share each edge; one user is an open edge."""
    k = F.col("r") * 100 + F.col("c")
    corners = [k, k + 1, k + 101, k + 100]
    halves = F.array(*[F.struct(F.least(corners[n], corners[(n + 1) % 4]).alias("v1"), F.greatest(corners[n], corners[(n + 1) % 4]).alias("v2")) for n in range(4)])
    return ras.where("c < 99 and r < 99").select(F.inline(halves)).groupBy("v1", "v2").agg(F.count(F.lit(1)).alias("users"))


@query("a5_robust_level", ("pts",), """with ordered as (select kind, v, row_number() over (partition by kind order by v) as k, count(*) over (partition by kind) as n from pts),
  anchors as (select kind, v as anchor from ordered where n >= 25 and k = greatest(cast(floor(0.01 * n) as bigint), 4) + 1)
  select o.kind, median(o.v) as level from ordered o join anchors a on o.kind = a.kind where o.v between anchor - 0.1 and anchor + 0.15 group by o.kind""")
def a5(pts):
    """Median of the returns near the first percentile, by kind; none under 25 returns. The anchor is an exact order statistic by counts of values, not a sorted partition."""
    values = pts.groupBy("kind", "v").agg(F.count(F.lit(1)).alias("m"))
    sizes = pts.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).where("n >= 25")
    upto = F.sum("m").over(Window.partitionBy("kind").orderBy("v"))
    anchors = values.join(sizes, "kind").withColumn("upto", upto).where(F.col("upto") > F.greatest(F.floor(F.lit(0.01) * F.col("n")), F.lit(4))).groupBy("kind").agg(F.min("v").alias("anchor"))
    return pts.join(anchors, "kind").where("v between anchor - 0.1D and anchor + 0.15D").groupBy("kind").agg(F.median("v").alias("level"))


@query("a8_bank_percentile", ("poly",), "select cls, quantile_cont(lev, 0.25) - 0.4 as level from poly group by cls")
def a8(poly):
    """The lower quartile less a margin."""
    return poly.groupBy("cls").agg((F.percentile("lev", 0.25) - F.lit(0.4)).alias("level"))


@query("a11_error_percentiles", ("pts",), """select kind, quantile_cont(e, 0.5) as p50, quantile_cont(e, 0.95) as p95, quantile_cont(e, 0.99) as p99, avg(case when e > 25 then 1.0 else 0.0 end) as share from (
  select kind, abs(v - 50) as e from pts) group by kind""")
def a11(pts):
    """Percentiles of the absolute error, and the share above a tolerance."""
    rows = pts.select("kind", F.abs(F.col("v") - 50).alias("e")).groupBy("kind").agg(F.percentile("e", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("p"), F.avg(F.when(F.col("e") > 25, 1.0).otherwise(0.0)).alias("share"))
    return rows.select("kind", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), F.col("p")[2].alias("p99"), "share")


@query("a16_main_direction", ("lines",), """with seg as (select cast(floor(abs(x - px)) as bigint) % 90 as bin, cast(floor(abs(y - py)) as bigint) as w from (
  select x, y, lag(x) over (partition by line order by vertex) as px, lag(y) over (partition by line order by vertex) as py from lines) where px is not null),
  hist as (select bin, sum(w) as w from seg group by bin)
  select a.bin, cast(sum(b.w) as bigint) as smoothed from hist a join hist b on least((a.bin - b.bin + 90) % 90, (b.bin - a.bin + 90) % 90) <= 4 group by a.bin""")
def a16(lines):
    """Weights by direction, smoothed over nine bins around the circle."""
    parts = spatial.segments(lines).where("px is not null").select((F.floor(F.abs(F.col("x") - F.col("px"))) % 90).alias("bin"), F.floor(F.abs(F.col("y") - F.col("py"))).alias("w"))
    bins = parts.groupBy("bin").agg(F.sum("w").alias("w"))
    heard = bins.select(F.explode(F.sequence(F.lit(-4), F.lit(4))).alias("d"), "bin", "w").groupBy(F.pmod(F.col("bin") + F.col("d"), F.lit(90)).alias("bin")).agg(F.sum("w").alias("smoothed"))
    return heard.join(bins.select("bin"), "bin", "left_semi")


@query("a16_direction", ("lines",), """with seg as (select line, x - lag(x) over w as dx, y - lag(y) over w as dy from lines window w as (partition by line order by vertex)),
  turned as (select line, sqrt(dx * dx + dy * dy) as len, dx * dx - dy * dy as c2, 2 * dx * dy as s2, dx * dx + dy * dy as l2 from seg where dx * dx + dy * dy > 1e-12)
  select line, round(degrees(atan2(sum(len * (2 * c2 * s2) / (l2 * l2)), sum(len * (c2 * c2 - s2 * s2) / (l2 * l2)))) / 4, 4) as degrees from turned group by line
  having sqrt(pow(sum(len * (2 * c2 * s2) / (l2 * l2)), 2) + pow(sum(len * (c2 * c2 - s2 * s2) / (l2 * l2)), 2)) > 1e-6""")
def a16_direction(lines):
    """The direction a line runs in, modulo a right angle: the mean, by length, on a circle gone round four times."""
    seg = spatial.segments(lines).where("len > 1e-6").select("line", "len", F.radians(4 * F.degrees(F.atan2(F.col("y") - F.col("py"), F.col("x") - F.col("px")))).alias("t"))
    sums = seg.groupBy("line").agg(F.sum(F.col("len") * F.sin("t")).alias("s"), F.sum(F.col("len") * F.cos("t")).alias("k")).where("sqrt(s * s + k * k) > 1e-6")
    return sums.select("line", F.round(F.degrees(F.atan2("s", "k")) / 4, 4).alias("degrees"))


@query("f1_current", ("versions",), "select seq, object_id, kind from versions where ended is null or length(ended) = 0")
def f1(versions):
    """Rows whose registration hasn't ended: null or empty."""
    return versions.where(F.coalesce("ended", F.lit("")) == "").select("seq", "object_id", "kind")


@query("a19_length_by_kind", ("lines",), """select kind, round(sum(sqrt((x - px) * (x - px) + (y - py) * (y - py))), 3) as metres from (
  select *, lag(x) over (partition by line order by vertex) as px, lag(y) over (partition by line order by vertex) as py from lines) where px is not null group by kind""")
def a19(lines):
    """Length of the segments by kind."""
    return spatial.segments(lines).where("px is not null").groupBy("kind").agg(F.round(F.sum("len"), 3).alias("metres"))


@query("w5_box_smooth", ("ras",), """with flat as (select cast(floor(avg(zc)) as bigint) as level from ras), grid as (select r, c, coalesce(zc, level) as z, zc is null as missing from
  (select unnest(range(0, 100)) as r) x cross join (select unnest(range(0, 100)) as c) y left join ras using (r, c) cross join flat)
  select a.r, a.c, sum(b.z) / 9.0e0 as z from grid a cross join (select unnest([-1, 0, 1]) as dr) p cross join (select unnest([-1, 0, 1]) as dc) q
  join grid b on b.r = least(greatest(a.r + dr, 0), 99) and b.c = least(greatest(a.c + dc, 0), 99) where a.missing group by a.r, a.c""")
def w5(ras):
    """The 3 x 3 mean, edges repeated, of the cells that had no value and took the mean level."""
    places = ras.sparkSession.range(10_000).select(F.floor(F.col("id") / 100).alias("r"), (F.col("id") % 100).alias("c"))
    level = ras.agg(F.floor(F.avg("zc")).alias("level"))
    grid = places.join(ras, ["r", "c"], "left").join(F.broadcast(level)).select("r", "c", F.coalesce("zc", "level").alias("z"))  # one row goes out
    return raster.smoothed(grid, 100, 100).join(ras.select("r", "c"), ["r", "c"], "left_anti")


@query("w7_disk_max", ("ras",), "select a.r, a.c, max(b.zc) as top from ras a join ras b on (b.r - a.r) * (b.r - a.r) + (b.c - a.c) * (b.c - a.c) <= 9 group by a.r, a.c")
def w7(ras):
    """The highest cell within three cells."""
    return raster.focal(ras, 3, [F.max("zc").alias("top")], lambda dr, dc: dr * dr + dc * dc <= 9).select("r", "c", "top")


@query("w8_local_peaks", ("ras",), "select r, c, zc from ras a where not exists (select 1 from ras b where b.r between a.r - 2 and a.r + 2 and b.c between a.c - 2 and a.c + 2 and b.zc > a.zc)")
def w8(ras):
    """Cells that are the highest of their 5 x 5 window."""
    return raster.local_peaks(ras, 2)


@query("w10_roughness", ("ras",), """select a.r, a.c, sqrt(cast(count(*) * sum(b.zc::hugeint * b.zc) - sum(b.zc)::hugeint * sum(b.zc) as double)) / count(*) / 100 as std
  from ras a join ras b on b.r between a.r - 2 and a.r + 2 and b.c between a.c - 2 and a.c + 2 group by a.r, a.c""")
def w10(ras):
    """The standard deviation of the present cells of the 5 x 5 window, from whole sums."""
    seen = raster.focal(ras, 2, [F.sum("zc").alias("s"), F.sum(F.col("zc") * F.col("zc")).alias("q"), F.count(F.lit(1)).alias("n")])
    return seen.select("r", "c", (F.sqrt((F.col("n") * F.col("q") - F.col("s") * F.col("s")).cast("double")) / F.col("n") / 100).alias("std"))


@query("w12_dilate", ("ras",), """select distinct r + dr as r, c + dc as c from (select r, c from ras where zc > 9000000), (select unnest(range(-2, 3)) as dr), (select unnest(range(-2, 3)) as dc)
  where abs(dr) + abs(dc) <= 2 and r + dr between 0 and 99 and c + dc between 0 and 99""")
def w12(ras):
    """The cells of a mask and those within two steps of it."""
    grown = raster.spread(ras.where("zc > 9000000"), raster.offsets(2, lambda dr, dc: abs(dr) + abs(dc) <= 2))
    return grown.where("r between 0 and 99 and c between 0 and 99").select("r", "c").distinct()


@query("w6_fill_holes", ("ras",), None)
def w6(ras):
    """The raster without holes."""
    return raster.fill_holes(ras, 100, 100)


@query("c1_components", ("network",), """with edges as (select a as s, b as t from network union all select b, a from network),
  reached(node, label) using key (node) as (select distinct s, s from edges union
    select e.t, min(l.label) from reached l join edges e on e.s = l.node join recurring.reached now on now.node = e.t group by e.t, now.label having min(l.label) < now.label)
  select node, label from reached""")
def c1(network):
    """The least node that each node reaches."""
    return graph.connected_components(network)


@query("w16_prefix_offsets", ("lines",), "select line, n, cast(sum(n) over (order by line rows between unbounded preceding and current row) - n as bigint) as start_at from (select line, count(*) as n from lines group by line) t")
def w16(lines):
    """Where each line's vertices begin if all lines follow one another."""
    sizes = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    return sequences.prefix_sums(sizes, F.floor(F.col("line") / 4096), [F.col("line")], "n", "start_at")


@query("p31_face_key", ("poly",), """select id, azimuth, shift, cast(dense_rank() over (order by cls, azimuth, shift) as bigint) as face from (
  select id, cls, cast(floor(lev / 2 + 0.5) as bigint) % 90 as azimuth, cast(floor((cx + cy) / 0.5e0 + 0.5) as bigint) as shift from poly)""")
def p31(poly):
    """Faces numbered by class, direction and distance."""
    keyed = poly.select("id", "cls", (F.floor(F.col("lev") / 2 + 0.5) % 90).alias("azimuth"), F.floor((F.col("cx") + F.col("cy")) / 0.5 + 0.5).alias("shift"))
    keys = keyed.select("cls", "azimuth", "shift").distinct().withColumn("one", F.lit(1).cast("long"))
    numbered = sequences.prefix_sums(keys, F.col("cls") * 200 + F.col("azimuth") + 100, [F.col("shift")], "one", "before")
    return keyed.join(numbered, ["cls", "azimuth", "shift"]).select("id", "azimuth", "shift", (F.col("before") + 1).alias("face"))
