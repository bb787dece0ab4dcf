"""Components, levels and reachability over edge tables, by iterated joins."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of this machine only where the session names none and runs here."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextlib.contextmanager
def leaving_no_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind, which would stay until the driver's memory is collected; nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again, so plans of loops stay short and what it was made from takes no disk any more."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loop-{uuid.uuid4().hex}"
    with leaving_no_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) of nodes(node): the least node that undirected edges(a, b) reach.

    Each round takes the least label among neighbours, then the label's own label, so the number of rounds
    grows with the logarithm of the longest path.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    now = cut(nodes.select("node", F.col("node").alias("label")).distinct())
    while True:
        near = both.join(now, both.b == now.node).groupBy("a").agg(F.min("label").alias("near"))
        low = now.join(near, now.node == near.a, "left").select("node", F.least("label", "near").alias("low"), F.col("label").alias("old"))
        hop = now.select(F.col("node").alias("at"), F.col("label").alias("far"))
        new = cut(low.join(hop, low.low == hop["at"], "left").select("node", F.least("low", "far").alias("label"), "old"))
        if not new.where("label <> old").limit(1).count():
            return new.select("node", "label")
        now = new.select("node", "label")


def ascents(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """(node, top, depth) of nodes(node) and parents(child, parent), one parent a child at most: the upper end of each node's way up, itself if it has
    no parent, and how far it is. top is null on or behind a cycle.

    Each round lengthens every way by its upper end's way, so a way of n takes log n rounds. Nodes whose way has ended are set aside.
    """
    start = nodes.select("node").distinct().join(parents.select(F.col("child").alias("node"), F.col("parent").alias("up")), "node", "left")
    now = cut(start.select("node", F.coalesce("up", "node").alias("up"), F.col("up").isNotNull().cast("int").alias("depth"), F.col("up").isNull().alias("ended")))
    ended = now.where("ended").select("node", "up", "depth")
    for _ in range(now.count().bit_length() + 1):  # longer ways close a cycle
        top = now.select(F.col("node").alias("at"), F.col("up").alias("further"), F.col("depth").alias("more"), F.col("ended").alias("last"))
        open_ = now.where("not ended")
        if open_.isEmpty():
            break
        new = cut(open_.join(top, F.col("up") == F.col("at"), "left").select("node", F.coalesce("further", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("last", F.lit(True)).alias("ended")))
        ended = ended.union(new.where("ended").select("node", "up", "depth"))
        now = new.union(now.where("ended")) if not new.where("not ended").isEmpty() else new
    lost = now.where("not ended").select("node", F.lit(None).cast(now.schema["up"].dataType), F.lit(None).cast("int"))
    return ended.union(lost).select("node", F.col("up").alias("top"), "depth")


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, depth): the longest way from a node without parents along edges(parent, child); null on or behind a cycle.

    A node with one parent left has depth max(base, parent's + add); such steps compose, so chains of them are doubled and take log n rounds. A node
    with several parents gathers, in base, those whose depth is known, until one or none is left. Rounds grow with how often ways with several open
    parents follow each other, not with their length.
    """
    left = cut(edges.select("parent", "child").distinct())
    many = left.groupBy("child").agg(F.count("*").alias("m"))
    several = many.where("m > 1").select("child")
    if several.isEmpty():
        return ascents(nodes.select("node").union(left.select("parent")), left).join(nodes.select("node").distinct(), "node", "left_semi").select("node", F.when(F.col("top").isNotNull(), F.col("depth")).alias("depth"))
    every = nodes.select("node").union(left.select("parent")).distinct()
    done = cut(every.join(left.select(F.col("child").alias("node")), "node", "left_anti").select("node", F.lit(0).alias("depth")))
    open_ = cut(left.join(several, "child", "left_semi"))
    base = open_.select(F.col("child").alias("node")).distinct().select("node", F.lit(0).alias("base"))
    way = cut(left.join(several, "child", "left_anti").select(F.col("child").alias("node"), F.col("parent").alias("up"), F.lit(0).alias("base"), F.lit(1).alias("add")))
    while True:
        for _ in range(way.count().bit_length() + 1):
            on = way.select(F.col("node").alias("at"), F.col("up").alias("further"), F.col("base").alias("b"), F.col("add").alias("a"))
            met = way.join(on, F.col("up") == F.col("at"), "left")
            if met.where("further is not null").isEmpty():
                break
            way = cut(met.select("node", F.coalesce("further", "up").alias("up"), F.greatest("base", F.coalesce(F.col("b") + F.col("add"), F.lit(0))).alias("base"), (F.col("add") + F.coalesce("a", F.lit(0))).alias("add")))
        known = done.select(F.col("node").alias("up"), F.col("depth").alias("d"))
        hit = cut(way.join(known, "up").select("node", F.greatest("base", F.col("d") + F.col("add")).alias("depth")))
        way = way.join(hit.select("node"), "node", "left_anti")
        done = cut(done.union(hit))
        told = cut(open_.join(done.select(F.col("node").alias("parent"), "depth"), "parent"))
        if told.isEmpty() and hit.isEmpty():
            return nodes.select("node").distinct().join(done, "node", "left")
        best = told.groupBy(F.col("child").alias("node")).agg(F.max(F.col("depth") + 1).alias("b"))
        base = cut(base.join(best, "node", "left").select("node", F.greatest("base", F.coalesce("b", F.lit(0))).alias("base")))
        open_ = cut(open_.join(told.select("parent", "child"), ["parent", "child"], "left_anti"))
        rest = base.join(open_.groupBy(F.col("child").alias("node")).agg(F.count("*").alias("m"), F.min("parent").alias("up")), "node", "left")
        rest = cut(rest)
        done = cut(done.union(rest.where("m is null").select("node", F.col("base").alias("depth"))))
        way = cut(way.union(rest.where("m = 1").select("node", "up", "base", F.lit(1).alias("add"))))
        base = rest.where("m > 1").select("node", "base")
        open_ = open_.join(base.select(F.col("node").alias("child")), "child", "left_semi")


def reachable(starts: DataFrame, edges: DataFrame, limit: int | None = None) -> DataFrame:
    """(origin, node, hops): what starts(origin, node) reach along edges(src, dst), themselves included.

    Rounds join by shuffled keys: one that broadcasts would send its rows through the driver, again in each round.
    """
    edges = edges.hint("merge")
    seen = cut(starts.select("origin", "node", F.lit(0).alias("hops")).distinct())
    front, hops = seen, 0
    while limit is None or hops < limit:
        hops += 1
        step = front.join(edges, front.node == edges.src).select("origin", F.col("dst").alias("node"), F.lit(hops).alias("hops")).distinct()
        front = cut(step.join(seen.select("origin", "node").hint("merge"), ["origin", "node"], "left_anti"))
        if not front.limit(1).count():
            break
        seen = cut(seen.union(front))
    return seen


def roots(nodes: DataFrame) -> DataFrame:
    """(node, root) of nodes(node, parent) by pointer jumping; null where a parent is missing or a cycle closes."""
    known = nodes.select(F.col("node").alias("known"))
    now = nodes.join(known, nodes.parent == known.known, "left").select("node", F.when(F.col("parent").isNull(), F.col("node")).otherwise(F.col("known")).alias("up"), (F.col("parent").isNotNull() & F.col("known").isNull()).alias("lost"))
    now = cut(now)
    size = max(1, now.count())
    for _ in range(size.bit_length() + 1):
        top = now.select(F.col("node").alias("n2"), F.col("up").alias("up2"), F.col("lost").alias("lost2"))
        new = cut(now.join(top, now.up == top.n2, "left").select("node", F.coalesce("up2", "up").alias("up"), (F.col("lost") | F.coalesce("lost2", F.lit(False))).alias("lost"), F.col("up").alias("before")))
        moved = new.where("not (up <=> before)").limit(1).count()
        now = new.select("node", "up", "lost")
        if not moved:
            break
    tops = nodes.where("parent is null").select(F.col("node").alias("top"))
    return now.join(tops, now.up == tops.top, "left").select("node", F.when(~F.col("lost"), F.col("top")).alias("root"))
