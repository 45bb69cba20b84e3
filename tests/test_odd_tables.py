"""Queries against their SQL on small tables that the test data doesn't hold."""

import re

import duckdb
import pytest
from test_queries import rows

from geoloom.operators import lines, spatial
from geoloom.plans import catalog


@pytest.fixture
def agrees(spark, tmp_path):
    """Writes tables given as SQL and compares a query's rows with its SQL's; gives the rows."""

    def check(name, **tables):
        con = duckdb.connect()
        for t, sql in tables.items():
            con.execute(f"create table {t} as {sql}")
            con.execute(f"copy {t} to '{tmp_path}/{t}.parquet'")
        df = catalog.QUERIES[name](spark, str(tmp_path))
        columns = sorted(df.columns)
        got = rows(df.select(*columns).collect(), columns)
        assert repr(got) == repr(rows(con.execute(f"select {', '.join(columns)} from ({catalog.SQL[name]})").fetchall(), columns))
        return got

    return check


#: Vertices whose numbers differ by 100,000 are at one place: segments without length alone, in the middle, and at the end; a line of one vertex, and one that turns back on itself.
STILL = """select v::bigint as o_orderkey, l::bigint as o_custkey, '2-HIGH' as o_orderpriority from (values
  (7, 1), (100007, 1), (5, 2), (12, 2), (100012, 2), (100020, 2), (3, 3), (8, 3), (100008, 3), (6, 4), (30, 5), (40, 5), (100030, 5)) t(v, l)"""
GROUND = "select v::bigint as l_orderkey, w::bigint as l_partkey, 100.0e0 + v + w as l_extendedprice from range(0, 100) a(v), range(0, 90) b(w)"


def test_normals_beside_segments_without_length(agrees):
    found = agrees("p28_offset_normals", orders=STILL)
    assert len(found) == 11 and sum(repr(r[1]) == "nan" for r in found) == 6


def test_barriers_beside_segments_without_length(agrees):
    assert len(agrees("x6_barriers", orders=STILL, lineitem=GROUND)) == 11


#: Repeated vertices, of one kind and of two, and vertices without a line or a number.
REPEATED = """select v::bigint as o_orderkey, l::bigint as o_custkey, k as o_orderpriority from (values
  (7, 1, '2-HIGH'), (9, 1, '2-HIGH'), (9, 1, '1-URGENT'), (12, 1, '5-LOW'), (3, 2, '2-HIGH'), (3, 2, '2-HIGH'), (6, 2, '2-HIGH'), (5, null, '2-HIGH'), (8, null, '2-HIGH'), (null, 2, '2-HIGH'), (4, 3, null), (2, 3, '2-HIGH')) t(v, l, k)"""


def test_barriers_of_repeated_vertices(agrees):
    found = agrees("x6_barriers", orders=REPEATED, lineitem=GROUND)
    assert len(found) == 13


#: Many points and polygons at few places, and points on the corners and edges of polygons.
CROWD = "select i::bigint as event_id, 'click' as event_type, (i % 97) * 1.0e0 as value, (i % 5)::bigint as user_id from (select j + 100000 * k as i from range(0, 400) a(j), range(0, 3) b(k))"
WATERS = "select i::bigint as c_custkey, (i % 25)::int as c_nationkey, (i % 31) * 10.0e0 as c_acctbal from (select j + 100000 * k as i from range(0, 300) a(j), range(0, 2) b(k))"


@pytest.mark.parametrize("name", ["j4_point_in_polygon", "j5_first_polygon", "j16_deck_level", "x2_waters"])
def test_points_that_share_places(agrees, name):
    assert agrees(name, events=CROWD, customer=WATERS)


@pytest.mark.parametrize("name", ["j4_point_in_polygon", "j5_first_polygon", "j16_deck_level", "x2_waters"])
def test_polygons_meet_places_not_points(spark, tmp_path, name):
    """Copies of a point are joined with polygons once."""
    con = duckdb.connect()
    for t, sql in (("events", CROWD), ("customer", WATERS)):
        con.execute(f"copy ({sql}) to '{tmp_path}/{t}.parquet'")
    plan = catalog.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and re.search(r"Aggregate \[(x#\d+, y#\d+|_groupingexpression#\d+, _groupingexpression#\d+)", plan)


def test_points_of_a_place_go_along_with_it(spark, tmp_path, agrees, monkeypatch):
    monkeypatch.setattr(spatial, "BLOCK", 2)  # three points of a place make two blocks
    assert agrees("j4_point_in_polygon", events=CROWD, customer=WATERS)
    plan = catalog.QUERIES["j4_point_in_polygon"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(points" in plan and plan.count("Join ") == 1


@pytest.mark.parametrize("name", ["j4_point_in_polygon", "j16_deck_level"])
def test_listed_polygons_are_not_broadcast(spark, tmp_path, name):
    """However small the table is, its listing by cells isn't sent to the driver."""
    con = duckdb.connect()
    for t, sql in (("events", CROWD), ("customer", WATERS)):
        con.execute(f"copy ({sql}) to '{tmp_path}/{t}.parquet'")
    plan = catalog.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [gx#" in plan and "BroadcastHashJoin [gx#" not in plan


#: Lines that come in copies with short segments, one without length.
TRACKS = "select i * 41975 + 41975::bigint * 10000000 * k as o_orderkey, (i // 4 + 1000 * k)::bigint as o_custkey, '2-HIGH' as o_orderpriority from range(0, 2000) a(i), range(0, 3) b(k)"
NEAR = "select j + 100000 * k as event_id, 'click' as event_type, 1.0e0 as value, 1::bigint as user_id from range(0, 3000) a(j), range(0, 2) b(k)"


#: One segment of 707 m.
LONG = "select v::bigint as o_orderkey, 1::bigint as o_custkey, '2-HIGH' as o_orderpriority from (values (0), (50000)) t(v)"


def test_long_segments_are_met(agrees):
    found = agrees("j8_nearest_line", events=NEAR.replace("range(0, 3000)", "range(0, 20000)"), orders=LONG)
    assert len(found) > 400 and {r[2] for r in found} == {50000.0}


@pytest.mark.parametrize("hits, bound", [(16, 250_000), (0.01, 250_000), (1e9, 0), (0.01, 0)])
def test_segments_of_any_length_in_rounds(agrees, monkeypatch, hits, bound):
    """Long, short and one without length; in one round and in several, with places sent out and merged."""
    monkeypatch.setattr(lines, "HITS", hits)
    monkeypatch.setattr(lines, "BOUND", bound)
    crossing = "select (v * 7919 + 10000 * (v % 3))::bigint as o_orderkey, (v // 3)::bigint as o_custkey, '2-HIGH' as o_orderpriority from range(0, 60) t(v)"
    assert len(agrees("j8_nearest_line", events=NEAR, orders=f"{crossing} union all {TRACKS} union all {STILL.replace('l::bigint', '(l + 900000)::bigint')}")) > 1000


@pytest.mark.parametrize("name, tables", [
    ("j8_nearest_line", {"events": NEAR, "orders": TRACKS}),
    ("j7_nearest_in_range", {"events": CROWD.replace("range(0, 400)", "range(0, 9000)").replace("range(0, 3)", "range(0, 1 + j % 2)")}),
    ("j23_longest_border", {"customer": WATERS}),
    ("f14_piers_in_water", {"customer": WATERS.replace("range(0, 300)", "range(0, 3000)")}),
    ("x13_layers", {"customer": WATERS}),
])
def test_copies_at_one_place(agrees, name, tables):
    assert agrees(name, **tables)


@pytest.mark.parametrize("name, by, tables", [
    ("j8_nearest_line", "px", {"events": NEAR, "orders": TRACKS}),
    ("j23_longest_border", "x0", {"customer": WATERS}),
    ("f14_piers_in_water", "x0", {"customer": WATERS}),
    ("x13_layers", "x0", {"customer": WATERS}),
])
def test_equal_shapes_meet_once(spark, tmp_path, name, by, tables):
    con = duckdb.connect()
    for t, sql in tables.items():
        con.execute(f"copy ({sql}) to '{tmp_path}/{t}.parquet'")
    plan = catalog.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"Aggregate \[{by}#\d+, ", plan)


#: Boxes that crowd a corner of the area, and some inside out; places repeat with the numbers divisible by 100,000.
CROWDED = "select (i * 100000 + (i * 37) % 60)::bigint as c_custkey, (i % 29 - 6)::int as c_nationkey, 0.0e0 as c_acctbal from range(0, 1500) t(i)"


@pytest.mark.parametrize("name", ["j23_longest_border", "x13_layers"])
def test_crowded_and_inverted_boxes(agrees, name):
    assert agrees(name, customer=CROWDED)


@pytest.mark.parametrize("name", ["j23_longest_border", "x13_layers"])
def test_boxes_that_cannot_be_chosen_are_not_listed(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"copy ({CROWDED}) to '{tmp_path}/customer.parquet'")
    plan = catalog.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"isnull\(last#\d+L?\) OR \(neighbour#\d+L? <= last#\d+L?\)", plan)


def test_points_that_share_their_place_look_no_further(spark, monkeypatch):
    seen, real = [], spatial.near_cells
    monkeypatch.setattr(spatial, "near_cells", lambda df, *a: (seen.append(df.count()), real(df, *a))[1])
    points = spark.createDataFrame([(n, 0.0, 0.0) for n in range(50)] + [(50, 1.0, 0.0), (51, 30.0, 0.0), (52, 33.0, 4.0)], "id long, x double, y double")
    found = {r.id_a: (r.id_b, r.gap) for r in spatial.nearest(points, points, 8.0).collect()}
    assert found == {0: (1, 0.0), **{n: (0, 0.0) for n in range(1, 50)}, 50: (0, 1.0), 51: (52, 5.0), 52: (51, 5.0)}
    assert seen == [3, 2, 2, 2] or seen == [3, 2, 2, 2, 2]
