"""Shared helpers of the corpus operators."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of just this name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """A name that no column of the frame has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the Python workers, once a context, so that no path of theirs needs to hold it."""
    sc = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    name = f"{package.name}_modules.zip"
    if name not in sc._python_includes:
        with zipfile.ZipFile(path := f"{tempfile.mkdtemp()}/{name}", "w") as z:  # the driver serves it to the executors
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(path)


def per_row(docs: DataFrame, text: str, new: dict[str, str], start: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """Adds the columns `new` (name and type) to every row, from its text, in Arrow batches.

    start() is called once a task and gives what makes the new columns of a batch of
    texts. Columns already named as the new ones are replaced. The rows travel as
    one struct, so that any column names do.
    """
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in new}]
    schema = docs.select(*map(column, kept)).schema
    for name, kind in new.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = start()
        for batch in batches:
            *columns, texts = batch.column("row").flatten()
            yield pa.RecordBatch.from_arrays([*columns, *made(texts)], [*kept, *new])

    return docs.select(F.struct(*map(column, kept), column(text).alias("text")).alias("row")).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this context in the folder that the cluster shares.

    That is the session's spark.checkpoint.dir. Where it is unset, a local master
    (tests in one process) takes a temporary folder; a cluster couldn't read it, so
    there it is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="geoloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that was written between stages."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows in a part of a checkpoint, at least, and parts for each core, where a frame says how many rows it has at most.
PART_ROWS, PARTS = 50_000, 4


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cuts the lineage by a checkpoint in the shared folder.

    What led there isn't needed again, so the driver collects its garbage: Spark
    deletes the shuffles and checkpoints of frames that no variable holds.

    rows: how many rows there are, about or at most. A small frame then goes to few files, however
    many partitions a shuffle gave it; on a local file system each file starts two processes.
    Not for frames that are costly to make, as their tasks become as few.
    """
    if rows is not None:
        df = df.coalesce(max(PARTS * df.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS)))
    shared_folder(df.sparkSession)
    done = df.checkpoint(eager=True)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return done


#: Rows of one group that may meet in one task, at least; and hot groups that are told to all tasks, at most.
GROUP, HOT_GROUPS = 1000, 100_000


def met(rows: DataFrame, groups: DataFrame, by: str, total: int, spread: str) -> DataFrame:
    """rows joined with their group's row on `by`; the groups' column `size` holds how many rows they have, in all at most `total`.

    Groups above a size are dealt by a hash of `spread` over several tasks, each with a copy of
    the group's row. The size is `total` / HOT_GROUPS or more, so that there are at most
    HOT_GROUPS of them: a proven bound of what is broadcast.
    """
    most = max(GROUP, -(-total // HOT_GROUPS))
    hot = F.broadcast(groups.where(F.col("size") > most).select(by, F.ceil(F.col("size") / most).cast("int").alias("parts")))
    dealt = rows.join(hot, by, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64(spread, F.lit(11)), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    copies = groups.join(hot, by, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts", "size")
    return dealt.join(copies, [by, "part"]).drop("part")


#: ASCII other than digits and letters becomes a space, A-Z becomes a-z; every
#: byte from 0x80 on stays, so that UTF-8 words beyond ASCII stay whole.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The text's words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []
