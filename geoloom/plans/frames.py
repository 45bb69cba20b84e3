"""DataFrame forms of queries whose SQL the other modules give to DuckDB: what matches was written twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions import vocabulary as V
from geoloom.operators import spatial
from geoloom.sources.views import VIEWS, read, view

QUERIES, SQL = {}, {}


def frame(name: str, *inputs: str):
    """Files a query over views and tables; its SQL is that of the same name elsewhere."""

    def put(f):
        def run(spark, sf_dir):
            return f(*[view(spark, sf_dir, i) if i in VIEWS else read(spark, sf_dir, i) for i in inputs])

        run.__doc__ = f.__doc__ or f"The query {name}."
        QUERIES[name] = run
        return f

    return put


col, lit = F.col, F.lit


def area() -> Column:
    """Of a polygon without its hole."""
    return 2 * col("rad") * col("rad") - 2 * col("hole") * col("hole")


def cell(c: str, size: float) -> Column:
    return F.floor(col(c) / size)


def first_of(text: Column, rules: list[tuple[str, str]], otherwise: Column) -> Column:
    """The result of the first needle that the text holds."""
    held = F.filter(F.array(*[F.struct(lit(a).alias("needle"), lit(b).alias("result")) for a, b in rules]), lambda r: F.contains(text, r["needle"]))
    return F.coalesce(F.get(held, lit(0))["result"], otherwise)


def checks(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def check(df: DataFrame, name: str, passed: Column, severity: str | None = "error") -> DataFrame:
    """One row: whether all of df passes."""
    made = df.agg(passed.alias("passed")).select(lit(name).alias("name"), "passed")
    return made if severity is None else made.withColumn("severity", lit(severity))


def every(test: Column, empty: bool = False) -> Column:
    """No row fails; `empty` if there is none, or none that says."""
    return F.coalesce(F.every(test), lit(empty))


# filters


@frame("f2_points_in_box", "pts")
def f2(pts):
    return pts.where(col("x").between(250, 750) & col("y").between(100, 600.5)).select("id", "x", "y", "kind")


@frame("f3_box_contains", "poly")
def f3(poly):
    inside = lambda c: (col(c) - col("rad") >= -1e-6) & (col(c) + col("rad") <= 1000 + 1e-6)
    return poly.where(inside("cx") & inside("cy")).select("id")


@frame("f5_plausible_height", "buildings")
def f5(buildings):
    kind = F.when(col("height_m") < 2.5, "low").when(col("height_m") > 45, "high").when(col("height_m").isNotNull(), "kept")
    n = lambda k: F.count_if(col("kind") == k)
    return buildings.select(kind.alias("kind")).agg(F.count(lit(1)).alias("all_buildings"), n("low").alias("too_low"), n("high").alias("too_high"), n("kept").alias("kept"))


@frame("f6_extent_can_reach", "poly")
def f6(poly):
    meets = lambda c: (col(c) + col("rad") >= 200) & (col(c) - col("rad") <= 400)
    return poly.where(col("lev").isNull() | (meets("cx") & meets("cy"))).select("id")


@frame("f8_nodata_share", "ras")
def f8(ras):
    share = 1 - col("present") / 10000.0
    return ras.agg(F.count(lit(1)).alias("present")).select("present", share.alias("missing_share"), (share > 0.5).alias("too_many"))


@frame("f12_area_floor", "poly")
def f12(poly):
    return poly.select("id", area().alias("area"), (col("rad") ** 2 / (2 * col("rad") ** 2) >= 0.2).alias("wet_enough")).where("area >= 40")


@frame("f18_markup_answers", "pages")
def f18(pages):
    """Answers that begin, after white space, as documents of map services do."""
    head = F.regexp_extract("html", r"(?s)^[ \t\n\x0B\f\r]*(.{0,64})", 1)
    return pages.select("page_id", F.when(col("html").isNotNull(), reduce(Column.__or__, [head.startswith(m) for m in V.MARKUP_STARTS])).alias("is_markup"))


# projections


@frame("p1_local_shift", "pts")
def p1(pts):
    return pts.select("id", *[(col(c) - 500).alias(f"local_{c}") for c in "xy"])


@frame("p7_road_class", "lineitem")
def p7(lineitem):
    """The surface by the first word of the function, bricks by the material."""
    functions = ["Rijbaan lokale weg", "voetpad op trap", " fietspad", "parkeervlak", "OV-baan", "inrit"]
    f = F.coalesce(F.get(F.array(*map(lit, functions)), col("l_linenumber") - 1), lit(""))
    m = F.coalesce(F.get(F.array(*map(lit, ["asfalt", "Gebakken klinker", "tegels"])), (col("l_suppkey") % 4).cast("int")), lit(""))
    kinds = lineitem.groupBy(f.alias("f"), m.alias("m")).agg(F.count(lit(1)).alias("parts"))
    surface = first_of(F.lower(F.trim("f")), V.ROAD_FUNCTIONS, lit("road"))
    brick = F.exists(F.array(*map(lit, V.BRICK_MATERIALS)), lambda b: F.contains(F.lower(F.trim("m")), b))
    return kinds.withColumn("surface", surface).select("f", "m", F.when(col("surface").isin("road", "parking") & brick, "road_brick").otherwise(col("surface")).alias("class"), "parts")


@frame("p9_type_coalesce", "versions")
def p9(versions):
    """The registered type, else the further one; signs of nothing are none."""
    known = lambda x, none: F.when(~F.coalesce(x, lit("")).isin("", none), x)
    first = F.element_at(F.array(lit("niet-bgt"), lit(""), col("kind")), (col("seq") % 3 + 1).cast("int"))
    return versions.select("seq", F.coalesce(known(F.trim(first), "niet-bgt"), known(F.when(col("seq") % 5 == 0, "none").otherwise(col("kind")), "none")).alias("type"))


@frame("p12_facade_era", "buildings")
def p12(buildings):
    """By the year, else by how many of the heights it reaches."""
    by_year = F.size(F.filter(F.array(*map(lit, V.ERAS)), lambda y: y < col("build_year")))
    by_height = F.least(F.size(F.filter(F.array(*map(lit, V.ERA_HEIGHTS)), lambda h: h <= col("height_m"))), lit(len(V.ERAS) - 1))
    return buildings.select("id", F.when(col("build_year") <= V.ERAS[-1], by_year).otherwise(by_height).alias("era"))


@frame("p14_archetype", "buildings")
def p14(buildings):
    """The first kind of a list whose rule holds."""
    height, year, floors, ground, use = (col(c) for c in ("height_m", "build_year", "floors", "footprint_m2", "function"))
    tower = ~col("storeys_known") & (height >= 15)
    rules = [
        ("monumental", tower & (F.coalesce(year, lit(0)) < 1940)), ("monumental", (use == 4) & (height >= 12) & (year < 1900)), ("industrial", (use == 3) | ((ground >= 2000) & (floors <= 3))),
        ("retail", use == 1), ("office", use == 2), ("house", (use == 0) & (ground < 250) & (floors <= 4)), ("apartment", use == 0), ("apartment", tower | (height >= 25) | (floors >= 8)),
    ]
    return buildings.select("id", F.coalesce(*[F.when(rule, kind) for kind, rule in rules], lit("house")).alias("archetype"))


@frame("p15_storeys", "buildings")
def p15(buildings):
    """The registered storeys if they are of plausible height, else by the height, halves to the even number."""
    each = F.try_divide("height_m", "floors")
    return buildings.select("id", F.when(col("storeys_known") & (col("floors") > 0) & each.between(2.2, 5), col("floors")).otherwise(F.greatest(lit(1), F.rint(col("height_m") / 3).cast("long"))).alias("storeys"))


@frame("p16_tree_sizes", "pts")
def p16(pts):
    clipped = lambda x, low, high: F.least(F.greatest(x, lit(low)), lit(high))
    sized = pts.select("id", clipped(col("v") / 3, 2.0, 35.0).alias("h"))
    return sized.withColumns({"crown": clipped(0.26 * col("h"), 0.8, 7.0), "trunk": clipped(0.38 * col("h"), 0.6, 6.0)})


@frame("p21_tile_width", "buildings")
def p21(buildings):
    widths = F.create_map(*map(lit, (1, 7.0, 2, 7.0, 3, 9.0)))
    return buildings.select("id", F.coalesce(F.try_element_at(widths, col("function").cast("int")), lit(4.0)).alias("tile_m"))


@frame("p36_titles", "pages")
def p36(pages):
    after = F.split("html", "<title>", 2)
    return pages.select("page_id", F.when(col("html").rlike("<title>[^<]*</title>"), F.regexp_extract(F.concat(lit("<title>"), after[1]), "<title>([^<]*)</title>", 1)).when(col("html").isNotNull(), "").alias("title"))


@frame("p37_short_errors", "documents")
def p37(documents):
    texts = F.create_map(lit(1), lit("x NameResolutionError y"), lit(2), lit("pool: Read timed out."), lit(3), lit("SSLError(1)"))
    rows = documents.select("doc_id", F.coalesce(F.try_element_at(texts, (col("doc_id") % 12).cast("int")), col("text"), lit("")).alias("t"))
    return rows.select("doc_id", first_of(col("t"), V.ERRORS, F.when(F.length("t") < 160, col("t")).otherwise(F.concat(F.substring("t", 1, 157), lit("...")))).alias("message"))


# joins


@frame("j1_usage_join", "buildings", "units")
def j1(buildings, units):
    """Units are counted before the join."""
    counted = units.groupBy("pand").agg(F.count(lit(1)).alias("n"))
    return buildings.join(counted, F.substring_index("id", ".", -1) == col("pand"), "left").select("id", F.coalesce("n", lit(0)).alias("units"))


@frame("j18_semi_anti", "lineitem", "orders")
def j18(lineitem, orders):
    returned = lineitem.where("l_returnflag = 'R'").select(col("l_orderkey").alias("o_orderkey"))
    big = lineitem.where("l_discount > 0.09").select(col("l_orderkey").alias("o_orderkey")).distinct().withColumn("big", lit(True))
    return orders.join(returned, "o_orderkey", "left_anti").join(big, "o_orderkey", "left").select("o_orderkey", F.coalesce("big", lit(False)).alias("big_discount"))


@frame("j27_dimension_lookup", "customer", "nation", "region")
def j27(customer, nation, region):
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(F.broadcast(places), customer.c_nationkey == places.n_nationkey).select("c_custkey", "n_name", "r_name")  # as many rows as nations


@frame("j17_mask_class", "pts", "ras")
def j17(pts, ras):
    placed = pts.select("id", F.floor(col("y") / 10 + 0.5).alias("r"), F.floor(col("x") / 10 + 0.5).alias("c"))
    return placed.join(ras.where("zc > 5000000").select("r", "c", lit(True).alias("hit")), ["r", "c"], "left").select("id", F.coalesce("hit", lit(False)).alias("inside"))


# aggregates


@frame("a1_block_mean", "ras")
def a1(ras):
    blocks = ras.groupBy(cell("r", 4).alias("br"), cell("c", 4).alias("bc"))
    return blocks.agg((F.sum("zc") / (F.count("zc") * lit(100.0))).alias("mean_z"), F.count(lit(1)).alias("hits"))


@frame("a2_fetch_stats", "versions")
def a2(versions):
    return versions.groupBy("kind").agg(F.count(lit(1)).alias("raw"), F.count_if(col("ended") == "").alias("running"), F.count_if(col("ended") != "").alias("superseded"))


@frame("a4_archetype_spread", "buildings")
def a4(buildings):
    return buildings.groupBy("function").agg(F.count(lit(1)).alias("n"), F.sum("footprint_m2").alias("area"), F.min("height_m").alias("low"), F.max("height_m").alias("high"))


@frame("a13_deck_quartile", "pts")
def a13(pts):
    """The lower quartile of the values in the band, between ranks, if there are ten; else a fixed height."""
    banded = pts.select("kind", F.when(col("v").between(50.1, 56), col("v")).alias("v"))
    return banded.groupBy("kind").agg(F.when(F.count("v") >= 10, F.percentile("v", 0.25)).otherwise(1.5).alias("deck"))


@frame("a15_bit_flags", "events")
def a15(events):
    bits = F.create_map(*map(lit, ("view", 1, "click", 2, "error", 4, "purchase", 8)))
    return events.groupBy("user_id").agg(F.bit_or(F.coalesce(F.try_element_at(bits, col("event_type")), lit(16))).alias("flags"), F.min("event_id").alias("first_event"))


@frame("a20_class_shares", "poly")
def a20(poly):
    counts = poly.groupBy("cls").agg(F.count(lit(1)).alias("n"))
    whole = F.broadcast(counts.agg(F.sum("n").alias("all")))  # one row
    return counts.join(whole).select("cls", "n", (col("n") / col("all")).alias("share"))


@frame("a21_edge_multiplicity", "tris")
def a21(tris):
    return edges(tris).groupBy("users").agg(F.count(lit(1)).alias("edges"))


def edges(tris: DataFrame) -> DataFrame:
    """Each edge once, with how many triangles use it."""
    pairs = [(F.least(a, b), F.greatest(a, b)) for a, b in (("v1", "v2"), ("v2", "v3"), ("v3", "v1"))]
    return tris.select(F.inline(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in pairs]))).groupBy("a", "b").agg(F.count(lit(1)).alias("users"))


@frame("a22_plan_density", "pts")
def a22(pts):
    return pts.groupBy(cell("x", 50).alias("gx"), cell("y", 50).alias("gy")).agg(F.count_distinct("x", "y").alias("places")).where("places > 3")


@frame("a24_junction_degree", "network")
def a24(network):
    return network.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(lit(1)).alias("degree"))


@frame("a25_pooling", "ras")
def a25(ras):
    return ras.groupBy(cell("r", 8).alias("pr"), cell("c", 8).alias("pc")).agg(F.max("zc").alias("top"), F.min("zc").alias("low"))


@frame("a26_zero_filled_counts", "nation", "supplier")
def a26(nation, supplier):
    rich = supplier.where("s_acctbal > 5000").groupBy("s_nationkey").agg(F.count(lit(1)).alias("n"))
    return nation.join(rich, nation.n_nationkey == rich.s_nationkey, "left").groupBy("n_name").agg(F.coalesce(F.sum("n"), lit(0)).alias("suppliers"))


@frame("a30_sorted_distinct", "poly")
def a30(poly):
    return poly.groupBy("cls", cell("cx", 100).alias("column_no")).count().drop("count")


# windows


@frame("w1_running_length", "lines")
def w1(lines):
    """Length along a line up to each vertex, 0 at the first."""
    return spatial.segments(lines).select("line", "vertex", F.round("along", 3).alias("along"))


@frame("w2_previous_next", "lines")
def w2(lines):
    w = Window.partitionBy("line").orderBy("vertex")
    return lines.select("line", "vertex", F.first("x").over(w.rowsBetween(-1, 0)).alias("before"), F.last("x").over(w.rowsBetween(0, 1)).alias("after"))


@frame("w3_ring_neighbours", "lines")
def w3(lines):
    ring, w = Window.partitionBy("line"), Window.partitionBy("line").orderBy("vertex")
    around = lambda step, end: F.coalesce(step("vertex").over(w), end("vertex").over(ring))
    return lines.select("line", "vertex", around(F.lag, F.max).alias("before"), around(F.lead, F.min).alias("after"))


@frame("w4_worst_of_group", "pts")
def w4(pts):
    """A grouped minimum, without a sort."""
    return pts.groupBy("kind").agg(F.min(F.struct((-col("v")).alias("low"), "id", "v")).alias("m")).select("kind", "m.id", "m.v")


@frame("w9_painters_order", "poly")
def w9(poly):
    top = poly.groupBy(cell("cx", 20).alias("gx"), cell("cy", 20).alias("gy")).agg(F.max(F.struct("cls", "id")).alias("m"))
    return top.select("gx", "gy", "m.id", "m.cls")


@frame("w17_runs", "ras")
def w17(ras):
    """A run begins where the cell before isn't there."""
    w = Window.partitionBy("r").orderBy("c")
    begun = ras.withColumn("new", F.when(F.lag("c").over(w) == col("c") - 1, 0).otherwise(1))
    return begun.withColumn("run", F.sum("new").over(w)).groupBy("r", "run").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(lit(1)).alias("cells")).drop("run")


@frame("w19_bed_level", "poly")
def w19(poly):
    return poly.withColumn("bed", col("lev") - col("rad")).groupBy(cell("cx", 20).alias("gx"), cell("cy", 20).alias("gy")).agg(F.min("bed").alias("bed"))


# orders and sets


@frame("o1_tallest_first", "pts")
def o1(pts):
    w = Window.partitionBy(cell("x", 50), cell("y", 50)).orderBy(F.desc("v"), "x", "y", "id")
    return pts.select("id", F.row_number().over(w).cast("long").alias("place"))


@frame("o5_newest", "orders")
def o5(orders):
    return orders.select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(24)


@frame("o7_composite_key", "poly")
def o7(poly):
    return poly.select("cls", "id", F.row_number().over(Window.partitionBy("cls").orderBy(area(), F.desc("lev"), "id")).cast("long").alias("place"))


@frame("o8_page_budget", "orders")
def o8(orders):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return orders.withColumn("k", F.row_number().over(w)).where("k < 6").select("o_custkey", "o_orderkey")


@frame("u2_union_distinct", "network")
def u2(network):
    return network.select(F.explode(F.array("a", "b")).alias("node")).distinct()


@frame("u3_difference", "customer", "orders")
def u3(customer, orders):
    urgent = orders.where("o_orderpriority = '1-URGENT'").select(col("o_custkey").alias("c_custkey"))
    return customer.join(urgent, "c_custkey", "left_anti").select("c_custkey")


@frame("u5_key_overlap", "lineitem")
def u5(lineitem):
    """One pass: the flags that each pair of keys has."""
    flags = lineitem.where(col("l_returnflag").isin("R", "A")).groupBy("l_suppkey", "l_partkey").agg(F.count_distinct("l_returnflag").alias("n"))
    return flags.where("n = 2").groupBy(col("l_suppkey").alias("s")).agg(F.count(lit(1)).alias("shared"))


@frame("u6_row_sets", "orders", "customer")
def u6(orders, customer):
    poor = F.max(col("c_acctbal") < 0)
    kept = customer.groupBy(col("c_custkey").alias("k")).agg(poor.alias("poor")).where(~F.coalesce("poor", lit(False)))
    return kept.join(orders.select(col("o_custkey").alias("k")), "k", "left_semi").select("k")


# checks


@frame("v1_box_checks", "poly")
def v1(poly):
    return checks(
        check(poly, "bbox_width", F.every(2 * col("rad") >= 4), "warning"),
        check(poly, "bbox_in_domain", F.every(col("cx").between(-7000, 300000))),
    )


@frame("v2_terrain_checks", "ras")
def v2(ras):
    return checks(
        check(ras, "terrain_no_holes", F.count(lit(1)) == 10000, None),
        check(ras, "nap_plausible", F.every((col("zc") > -250000) & (col("zc") < 4000000000)), None),
        check(ras, "gap_fill", F.count(lit(1)) > 2500, None),
    )


@frame("v3_building_checks", "buildings")
def v3(buildings):
    return checks(
        check(buildings, "buildings_present", F.count(lit(1)) > 0, None),
        check(buildings, "heights_positive", F.every(col("height_m") > 0), None),
        check(buildings, "under_ceiling", F.every(col("height_m") <= 200), None),
    )


@frame("v4_buildings_meet_terrain", "buildings", "ras")
def v4(buildings, ras):
    """The ground sends its level to the cells around it; no base stands higher over the lowest of them than 0.75 m."""
    near = ras.select("zc", F.explode(F.sequence(col("r") - 1, col("r") + 1)).alias("r"), "c").select("zc", "r", F.explode(F.sequence(col("c") - 1, col("c") + 1)).alias("c"))
    low = near.groupBy("r", "c").agg((F.min("zc") / 100000.0).alias("low"))
    met = buildings.select((col("height_m") / 50).alias("base"), (col("floors") * 3).alias("r"), F.floor(col("footprint_m2") / 100).alias("c")).join(low, ["r", "c"])
    made = met.agg(F.count(lit(1)).alias("checked"), every(col("base") <= col("low") + 0.75).alias("passed"))
    return made.select(lit("buildings_meet_terrain").alias("name"), "passed", lit("error").alias("severity"), "checked")


@frame("v5_tree_checks", "pts")
def v5(pts):
    spots = pts.groupBy(F.floor("x"), F.floor("y")).count()
    return checks(
        check(pts, "trees_present", F.count(lit(1)) > 0),
        check(pts, "trees_inside", every(col("x").between(0, 1000) & col("y").between(0, 1000))),
        check(pts, "tree_heights", every(col("v") / 3 <= 45)),
        check(pts.where("id % 4 = 0"), "found_tree_heights", every(col("v") / 3 <= 32, True)),
        check(spots, "no_two_share_a_spot", every(col("count") == 1, True)),
    )


@frame("v6_water_checks", "poly")
def v6(poly):
    of_class = poly.groupBy("cls").agg((F.max("lev") - F.min("lev")).alias("spread"), F.min(col("lev") - col("rad")).alias("bed"), (F.percentile("lev", 0.25) - lit(0.4)).alias("bank"))
    return checks(
        check(poly, "water_present", F.count(lit(1)) > 0),
        check(poly, "water_levels", every((col("lev") / 100).between(-10, 60))),
        check(of_class, "one_level_per_water", every(col("spread") < 0.01, True)),
        check(of_class, "bed_below_bank", every(col("bed") < col("bank"))),
        check(poly, "land_cover_coverage", F.coalesce(F.sum(area()) > 250000, lit(False)), "warning"),
    )


@frame("v8_furniture_inside", "pts")
def v8(pts):
    return pts.groupBy("kind").agg(F.count(lit(1)).alias("n"), F.every(col("x").between(0, 1000) & col("y").between(0, 1000)).alias("passed"))


@frame("v9_barrier_checks", "tris", "lines")
def v9(tris, lines):
    flat = (col("x2") - col("x1")) * (col("y3") - col("y1")) - (col("x3") - col("x1")) * (col("y2") - col("y1"))
    return checks(
        check(edges(tris), "manifold", every(col("users") <= 2, True)),
        check(tris, "not_degenerate", every(F.abs(flat / 2) > 1e-9, True)),
        check(lines, "height_plausible", every(col("x") / 125 <= 8, True)),
        check(lines, "sits_on_ground", F.coalesce(F.count_if(col("y") > 999) / F.count(lit(1)) <= 0.30, lit(True))),
    )


@frame("v10_vehicle_checks", "pts", "poly")
def v10(pts, poly):
    return checks(
        check(pts.where(col("kind").isin("click", "view")), "vehicles_inside", every(col("x").between(0, 1000) & col("y").between(0, 1000), True), None),
        check(pts.where("kind = 'click'"), "cars_finite", every(F.abs("v") < 1e30, True), None),
        check(poly, "boats_at_water_level", F.count_if(col("lev").isNull() | (F.abs("lev") > 100000)) == 0, None),
    )


@frame("v11_rail_checks", "pts")
def v11(pts):
    over = col("v") - F.when(col("kind") == "view", 2.4).otherwise(0.0)
    return pts.groupBy("kind").agg(F.every(over >= -0.05).alias("passed"), F.count_if(col("v") > 6).alias("elevated"))


@frame("v12_structure_checks", "pts")
def v12(pts):
    return checks(
        check(pts, "structures_measured", F.coalesce(F.count_if(col("id") % 5 != 0) >= 0.5 * F.count(lit(1)), lit(False)) & (F.count(lit(1)) > 0), "warning"),
        check(pts.where("kind = 'click'"), "decks_above", F.coalesce(F.try_divide(F.count_if(col("v") >= col("y") / 100), F.count(lit(1))) > 0.98, lit(True))),
        check(pts.where("kind = 'error'"), "tunnels_below", every(col("v") < col("y"), True)),
        check(pts.where("kind = 'purchase'"), "portals", F.count(lit(1)) != 1),
    )


@frame("v15_quay_checks", "poly")
def v15(poly):
    deck = F.abs("lev") / 1000
    return poly.groupBy("cls").agg(F.every(col("rad") >= 3).alias("quay_below"), every(deck.between(0.1, 6)).alias("deck_height"))


@frame("v16_closed_sheet", "tris")
def v16(tris):
    twice = (col("x2") - col("x1")) * (col("y3") - col("y1")) - (col("x3") - col("x1")) * (col("y2") - col("y1"))
    whole = tris.agg(F.count(lit(1)).alias("triangles"), (F.sum(twice) / 2).alias("area"))
    seams = edges(tris).agg(F.count_if(col("users") == 1).alias("outline"), F.count_if(col("users") > 2).alias("broken"))
    return whole.join(F.broadcast(seams))  # one row each


# outputs


@frame("k4_land_cover", "poly")
def k4(poly):
    top = poly.groupBy(cell("cy", 20).alias("gy"), cell("cx", 20).alias("gx")).agg(F.max("cls").alias("class"))
    return top.select((49 - col("gy")).alias("north_up_row"), "gx", "class")


@frame("k7_columns_of_kinds", "lines")
def k7(lines):
    return lines.groupBy("kind", "line").agg(F.count("vertex").alias("vertices"), F.min("vertex").alias("first_vertex"), F.max("vertex").alias("last_vertex"))


@frame("k3_water_rings", "poly")
def k3(poly):
    """A polygon's rings, the outer one first."""
    ring = lambda name, no, size: F.struct(lit(name).alias("ring"), lit(no).alias("hole_no"), size.alias("size"))
    rings = F.filter(F.array(ring("outer", 0, col("rad")), ring("hole", 1, col("hole"))), lambda r: (r["hole_no"] == 0) | (r["size"] > 0))
    return poly.select("id", "lev", F.inline(rings)).withColumn("vertices", lit(4))


@frame("u1_tagged_union", "pts", "poly", "lines")
def u1(pts, poly, lines):
    tagged = lambda df, kind, id, x, y: df.select(lit(kind).alias("kind"), col(id).alias("id"), col(x).alias("x"), col(y).alias("y"))
    posts = lines.groupBy("line").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return tagged(pts.where("kind = 'click'"), "car", "id", "x", "y").unionByName(tagged(poly.where("cls % 3 = 0"), "boat", "id", "cx", "cy")).unionByName(tagged(posts, "post", "line", "x", "y"))
