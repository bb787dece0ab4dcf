"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space, the separators of `[^\x20\x09-\x0D]+`.
SPACES = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only where the session names none and runs on one machine, as in tests, a temporary folder is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Delete the files of a table that `stored` wrote, when whatever was computed from it is stored itself."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand Python workers at most so many rows at a time, so that the texts of a batch fit beside the executor's heap.

    Spark bounds a batch's bytes by itself (spark.sql.execution.arrow.maxBytesPerBatch).
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def relieved(job):
    """An Arrow job whose worker gives the memory that it no longer uses back to the system when a task ends."""

    @functools.wraps(job)
    def of(batches):
        try:
            yield from job(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
                ctypes.CDLL(None).malloc_trim(0)

    return of


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column, separators: str = SPACES) -> Column:
    """The words between separators, in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that an edge (a, b) names; root is the least node it reaches.

    Alternating large and small stars, each written to the shared folder, until the edges stand
    still. No node's neighbours are ever gathered: each step is a minimum per node and a join.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    nodes = now.select(F.explode(F.array("u", "v")).alias("node")).distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    last = state(now)
    while last[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        now = stored(small, "edges")
        if (new := state(now)) == last:
            break
        last = new
    root = now.groupBy("u").agg(F.min("v").alias("root"))
    return nodes.join(root, nodes.node == root.u, "left").select("node", F.coalesce("root", "node").alias("root"))
