"""Each query of the reference's operators against its SQL, on the smallest tables."""

import duckdb
import pytest

from geoloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    return float(f"{value:.9g}") if isinstance(value, (int, float)) and not isinstance(value, bool) else value if value is None or isinstance(value, bool) else str(value)


def rows(found, columns):
    return sorted((tuple(plain(v) for v in r) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_its_sql(spark, oracle, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = oracle.execute(f"select {', '.join(columns)} from ({catalog.SQL[name]})").fetchall()
    assert rows(df.select(*columns).collect(), columns) == rows(want, columns)


def test_every_statement_has_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"w6_fill_holes", "a6_pooled_level", "g1_greedy_spacing", "g2_conflict_free", "g3_triangle_pairs", "g5_prune_spurs", "p2_grid_envelope", "p27_simplify", "p29_polygon_clip", "x1_terrain", "x4_detected_trees", "g4_refine_until_fit", "x11_road_cuts"}
