"""Reading services: paged features, offset pages, tiles under an index, and tables behind a fallback.

A service is read by tasks, one partition a box or tile, never by the driver.
`spark.dataSource.register(PagedFeatures)` makes the format "paged_features".
"""

from __future__ import annotations

import gzip
import json
import time
import urllib.error
import urllib.request
import warnings
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Answers worth another try.
AGAIN = {429, 500, 502, 503, 504}


class NotData(ValueError):
    """The service answered with markup where data was due."""


def get(url: str, tries: int = 4, wait: float = 2.0, timeout: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The body of a URL, unpacked if it is gzip. Lost connections, 429 and 5xx are tried again after 2, 4 and 8 s; other errors are final."""
    for k in range(tries):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as answer:
                body = answer.read()
            body = gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body
            if body.lstrip()[:1] == b"<":
                raise NotData(f"{url} answered with markup: {body[:160]!r}")
            return body
        except urllib.error.HTTPError as e:
            if e.code not in AGAIN or k == tries - 1:
                raise
        except (urllib.error.URLError, ConnectionError, TimeoutError):
            if k == tries - 1:
                raise
        sleep(wait * 2**k)
    raise AssertionError("unreachable")


def reachable(url: str, timeout: float = 5.0) -> bool:
    """Whether a service replies at all; an error status is a reply."""
    try:
        urllib.request.urlopen(url, timeout=timeout).close()
    except urllib.error.HTTPError:
        return True
    except (OSError, ValueError):
        return False
    return True


def pages(url: str, most: int, fetch: Callable[[str], bytes] = get) -> Iterator[dict]:
    """Pages from a first URL on, by their rel=next link. Stops at a URL seen before; warns if there are more than `most`."""
    seen: set[str] = set()
    while url and url not in seen:
        if len(seen) == most:
            warnings.warn(f"over {most} pages; the rest is not read", stacklevel=2)
            return
        seen.add(url)
        page = json.loads(fetch(url))
        yield page
        url = next((x["href"] for x in page.get("links", []) if x.get("rel") == "next"), None)


def offset_pages(template: str, size: int, fetch: Callable[[str], bytes] = get) -> Iterator[dict]:
    """Pages of a URL with {start} and {size}, until one is short or malformed."""
    start = 0
    while True:
        try:
            page = json.loads(fetch(template.format(start=start, size=size)))
            features = page["features"]
        except (ValueError, KeyError, TypeError):
            return
        yield page
        if len(features) < size:
            return
        start += size


class Start(InputPartition):
    def __init__(self, number: int, url: str):
        self.number, self.url = number, url


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = json.loads(options["urls"])
        self.most = int(options.get("maxPages", 200))
        self.size = int(options.get("offsetSize", 0))

    def partitions(self) -> list[InputPartition]:
        return [Start(n, u) for n, u in enumerate(self.urls)]

    def read(self, partition: Start) -> Iterator[tuple]:
        found = offset_pages(partition.url, self.size) if self.size else pages(partition.url, self.most)
        for number, page in enumerate(found):
            for k, f in enumerate(page.get("features") or []):
                shape = f.get("geometry") or {}
                given = {k: None if v is None else v if isinstance(v, str) else json.dumps(v) for k, v in (f.get("properties") or {}).items()}
                yield partition.number, number, k, None if f.get("id") is None else str(f["id"]), given, shape.get("type"), json.dumps(shape.get("coordinates"))


class PagedFeatures(DataSource):
    """Features of paged services. Options: urls (a JSON list, a partition each), maxPages, offsetSize (for URLs with {start} and {size}).

    (start, page, place) is the order of arrival. A missing geometry gives a null kind and the coordinates "null".
    """

    @classmethod
    def name(cls) -> str:
        return "paged_features"

    def schema(self) -> str:
        return "start int, page int, place int, id string, properties map<string,string>, kind string, coordinates string"

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def features(spark: SparkSession, urls: list[str], most: int = 200, offset: int = 0) -> DataFrame:
    spark.dataSource.register(PagedFeatures)
    return spark.read.format("paged_features").options(urls=json.dumps(urls), maxPages=str(most), offsetSize=str(offset)).load()


def in_arrival_order(rows: DataFrame) -> DataFrame:
    """Adds seq, which orders rows as their pages came; 2**20 pages a start and rows a page."""
    return rows.withColumn("seq", (F.shiftleft(F.col("start").cast("long"), 42) + F.shiftleft(F.col("page").cast("long"), 21) + F.col("place")))


def first_that_works(sources: list[tuple[str, Callable[[], DataFrame]]], probe: Callable[[str], bool] | None = None) -> DataFrame:
    """The first source that gives rows, with its name as the column source. The last is not probed; if all fail the error gives the reasons."""
    why = []
    for n, (name, read) in enumerate(sources):
        try:
            if probe is not None and n < len(sources) - 1 and not probe(name):
                raise ConnectionError("no answer")
            found = read()
            if found.isEmpty():
                raise ValueError("no rows")
            return found.withColumn("source", F.lit(name))
        except Exception as e:  # noqa: BLE001 - whatever a source raises, the next one is tried and all reasons are told
            why.append(f"{name}: {e}")
    raise RuntimeError("no source works: " + "; ".join(why))


def tiles_in_box(index: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """(tile) of an index (tile, xmin, ymin, xmax, ymax) that can reach a box; a tile without an extent can."""
    apart = F.coalesce((F.col("xmax") < x0) | (F.col("xmin") > x1) | (F.col("ymax") < y0) | (F.col("ymin") > y1), F.lit(False))
    return index.where(~apart).select("tile").distinct()


def read_tiles(spark: SparkSession, path: str, index: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows of a table partitioned by tile. The join prunes its partitions as it runs; the extent filter reaches the scan."""
    table = spark.read.parquet(path)
    if {"xmin", "xmax", "ymin", "ymax"} <= set(table.columns):
        table = table.where(f"xmin is null or not (xmax < {box[0]} or xmin > {box[2]} or ymax < {box[1]} or ymin > {box[3]})")
    return table.join(tiles_in_box(index, *box), "tile", "left_semi")


def mosaic(tiles: list[tuple[DataFrame, int, int]]) -> DataFrame:
    """One raster of tiles (cells, first row, first column) that abut."""
    placed = [t.select((F.col("r") + r).alias("r"), (F.col("c") + c).alias("c"), "zc") for t, r, c in tiles]
    out = placed[0]
    for t in placed[1:]:
        out = out.unionByName(t)
    return out


def kept(spark: SparkSession, folder: str, collection: str, box: tuple[float, float, float, float], read: Callable[[], DataFrame]) -> DataFrame:
    """The rows of a read, kept as a table by collection and box to a decimetre. A table without its success mark is written again."""
    path = f"{folder.rstrip('/')}/{collection}-" + "_".join(f"{v:.1f}" for v in box)
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        read().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def merged(*layers: dict) -> dict:
    """Settings laid over one another, deep; later layers win, and None leaves what is there."""
    out: dict = {}
    for layer in layers:
        for k, v in layer.items():
            if isinstance(v, dict):
                out[k] = merged(out[k] if isinstance(out.get(k), dict) else {}, v)
            elif v is not None or k not in out:
                out[k] = v
    return out


def checked_box(settings: dict) -> tuple[float, float, float, float]:
    """The box of settings; an error if a side is missing or not positive."""
    box = settings.get("bbox") or {}
    missing = [k for k in ("xmin", "ymin", "xmax", "ymax") if k not in box]
    if missing:
        raise ValueError(f"bbox lacks {', '.join(missing)}")
    x0, y0, x1, y1 = (float(box[k]) for k in ("xmin", "ymin", "xmax", "ymax"))
    if x0 >= x1 or y0 >= y1:
        raise ValueError("bbox has no area")
    return x0, y0, x1, y1


def run_history(spark: SparkSession, path: str) -> DataFrame:
    """Timings that earlier runs left as JSON, one row a stage; malformed files are left out."""
    schema = "name string, total_seconds double, completed boolean, stages array<struct<step:int,name:string,seconds:double,failed:boolean>>"
    runs = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    return runs.select(F.col("name").alias("run"), "total_seconds", "completed", F.inline("stages"))
