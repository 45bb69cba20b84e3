"""Services, tiles, kept tables, sinks and streams on small cases."""

import gzip
import http.server
import json
import threading
import urllib.error

import pytest
from pyspark.sql import functions as F

from geoloom.sources import pages, sinks
from geoloom.streaming import registers as streams


class Service(http.server.BaseHTTPRequestHandler):
    tries: dict[str, int] = {}

    def do_GET(self):
        self.tries[self.path] = self.tries.get(self.path, 0) + 1
        feature = lambda n: {"id": n, "properties": {"k": str(n), "deep": {"a": 1}, "none": None}, "geometry": {"type": "Point", "coordinates": [n, 2]}}
        here, status, body = f"http://127.0.0.1:{self.server.server_port}", 200, None
        if self.path == "/a":
            body = {"features": [feature(1), feature(2)], "links": [{"rel": "next", "href": here + "/b"}]}
        elif self.path == "/b":
            body = {"features": [{"id": None, "properties": None, "geometry": None}], "links": [{"rel": "next", "href": here + "/a"}]}
        elif self.path.startswith("/offset/"):
            start = int(self.path.rsplit("/", 1)[1])
            body = {"features": [feature(n) for n in range(start, min(start + 2, 5))]}
        elif self.path == "/busy" and self.tries[self.path] < 3:
            status = 503
        elif self.path == "/markup":
            body = "<html>sorry</html>"
        elif self.path == "/gone":
            status = 404
        data = (body if isinstance(body, str) else json.dumps(body)).encode()
        self.send_response(status)
        self.end_headers()
        self.wfile.write(gzip.compress(data) if self.path == "/b" else data)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def service():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_pages_follow_links_until_one_repeats(spark, service):
    rows = pages.in_arrival_order(pages.features(spark, [service + "/a"])).orderBy("seq").collect()
    assert [(r.page, r.place, r.id, r.kind) for r in rows] == [(0, 0, "1", "Point"), (0, 1, "2", "Point"), (1, 0, None, None)]
    assert rows[0].properties == {"k": "1", "deep": '{"a": 1}', "none": None} and json.loads(rows[0].coordinates) == [1, 2]


def test_offset_pages_end_at_a_short_one(spark, service):
    rows = pages.features(spark, [service + "/offset/{start}"], offset=2).collect()
    assert sorted(int(r.id) for r in rows) == [0, 1, 2, 3, 4]


def test_page_budget_warns(service):
    with pytest.warns(UserWarning, match="over 1"):
        assert len(list(pages.pages(service + "/a", 1))) == 1


def test_retries_and_final_errors(service):
    waits = []
    assert pages.get(service + "/busy", sleep=waits.append) == b"null" and waits == [2.0, 4.0]
    with pytest.raises(urllib.error.HTTPError):
        pages.get(service + "/gone", sleep=waits.append)
    with pytest.raises(pages.NotData):
        pages.get(service + "/markup")
    assert len(waits) == 2
    assert pages.reachable(service + "/gone") and not pages.reachable("http://127.0.0.1:9/")


def test_fallback_tells_all_reasons(spark):
    def fails():
        raise OSError("closed")

    good = pages.first_that_works([("one", fails), ("two", lambda: spark.range(0)), ("three", lambda: spark.range(2))])
    assert {r.source for r in good.collect()} == {"three"}
    with pytest.raises(RuntimeError, match="one: closed; two: no rows"):
        pages.first_that_works([("one", fails), ("two", lambda: spark.range(0))])


def test_tiles_and_rasters_round_trip(spark, tmp_path):
    cells = spark.range(600).select((F.col("id") % 20).alias("r"), F.floor(F.col("id") / 20).alias("c"), F.col("id").alias("zc"))
    sinks.write_raster(cells, str(tmp_path / "ras"), tile=10)
    back = spark.read.parquet(str(tmp_path / "ras"))
    assert back.count() == 600 and back.select("tile_r", "tile_c").distinct().count() == 6
    joined = pages.mosaic([(cells.where("c < 15"), 0, 0), (cells.where("c >= 15").withColumn("c", F.col("c") - 15), 0, 15)])
    assert joined.exceptAll(cells.select("r", "c", "zc")).isEmpty() and joined.count() == 600


def test_tiles_in_box_and_pruned_reads(spark, tmp_path):
    index = spark.createDataFrame([("a", 0.0, 0.0, 9.0, 9.0), ("b", 20.0, 0.0, 29.0, 9.0), ("c", None, None, None, None)], "tile string, xmin double, ymin double, xmax double, ymax double")
    index.withColumn("v", F.lit(1)).write.partitionBy("tile").parquet(str(tmp_path / "t"))
    got = pages.read_tiles(spark, str(tmp_path / "t"), index, (5.0, 5.0, 9.5, 9.5)).collect()
    assert sorted(r.tile for r in got) == ["a", "c"]


def test_kept_reads_once(spark, tmp_path):
    calls = []

    def read():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert pages.kept(spark, str(tmp_path), "roads", (0, 0, 1, 1), read).count() == 3
    assert len(calls) == 1


def test_settings():
    assert pages.merged({"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"y": 3}, "b": None}, {"a": {"z": None}}) == {"a": {"x": 1, "y": 3, "z": None}, "b": 1}
    assert pages.checked_box({"bbox": {"xmin": 0, "ymin": 0, "xmax": 2, "ymax": 3}}) == (0, 0, 2, 3)
    for bad in ({}, {"bbox": {"xmin": 1, "ymin": 0, "xmax": 1, "ymax": 3}}):
        with pytest.raises(ValueError):
            pages.checked_box(bad)


def test_lists_and_reports(spark, tmp_path):
    v = sinks.vehicle_list(spark.createDataFrame([(510.0, 480.0, 0.0, "car"), (500.0, 500.0, 3.141592653589793, None)], "x double, y double, heading double, kind string"), 500.0, 500.0)
    assert [(r.heading_deg, r.local.x, r.local.z) for r in v.collect()] == [(90.0, 10.0, 20.0), (270.0, 0.0, 0.0)]
    sinks.write_json(v, str(tmp_path / "v"))
    assert spark.read.json(str(tmp_path / "v")).count() == 2
    assert sinks.world_file(0, 100, 50, 100, 10, 20).split("\n")[:6] == ["5.0000000000", "0.0000000000", "0.0000000000", "-5.0000000000", "2.5000000000", "97.5000000000"]
    assert sinks.report_ok(sinks.report(spark, [("a", True, "error", ""), ("b", False, "warning", "")]))
    assert not sinks.report_ok(sinks.report(spark, [("a", None, "error", "")]))


def test_run_history_leaves_out_broken_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"name": "r", "total_seconds": 9.5, "completed": True, "stages": [{"step": 1, "name": "terrain", "seconds": 4.5, "failed": False}]}))
    (tmp_path / "b.json").write_text("{ not json")
    assert [(r.run, r.step, r.seconds) for r in pages.run_history(spark, str(tmp_path)).collect()] == [("r", 1, 4.5)]


def test_stream_equals_the_table(spark, tmp_path):
    rows = spark.createDataFrame([(n, f"2024-01-01 0{n % 4}:10:00", "ab"[n % 2], None if n % 5 == 0 else str(n % 3), "" if n % 4 else "x") for n in range(20)], "n long, t string, kind string, id string, ended string").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = streams.follow(spark, str(tmp_path / "in"), "n long, t timestamp, kind string, id string, ended string")
    for name, df, mode in [("counts", streams.counts_by_window(stream, "t", "kind", "1 hour"), "complete"), ("current", streams.current(stream, "id", "ended", "t"), "append")]:
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    want = streams.counts_by_window(rows, "t", "kind", "1 hour")
    assert spark.table("counts").exceptAll(want).isEmpty() and spark.table("counts").count() == want.count()
    got = spark.table("current").collect()
    assert sorted(r.id for r in got if r.id) == ["0", "1", "2"] and len([r for r in got if r.id is None]) == len([n for n in range(20) if n % 5 == 0 and n % 4])
