"""Helpers shared by the operators: tables, stored intermediates, gapless ranks, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rank buckets of `gapless`: one task ranks about 1/buckets of a group.
BUCKETS = 1024
#: `components` ends after a few rounds; this many would mean a fault.
MAX_ROUNDS = 60


def importable(df: DataFrame) -> None:
    """Let Python workers import this package from where the driver has it, installed or not."""
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. A local session without one gets a temp folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerstrata-"))
    return context.getCheckpointDir()


def passing(spark: SparkSession, path: str) -> None:
    """Have an existing folder removed when the driver's JVM ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system now."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Folders written by `stored`, by open `scratch` blocks.
_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block that ends with its result written: what `stored` wrote inside it is removed then, also after a failure."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            remove(spark, path)


def stored(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: work is not repeated, and lost executors lose nothing.

    The files go at the end of the innermost `scratch` block, or else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    passing(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def gapless(df: DataFrame, groups: list[str], order: list[str], name: str, buckets: int = BUCKETS) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    Rows are dealt into hash buckets of their order columns. A bucket's first number comes from the counts of the
    buckets before it, so that no task holds a whole group. Equal rows get different numbers, in any order.
    """
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*groups, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    numbered = keyed.withColumn("_at", F.row_number().over(inside).cast("long") - 1)
    joined = numbered.join(bases, [*groups, "_bucket"])
    return joined.withColumn(name, F.col("_base") + F.col("_at")).drop("_bucket", "_at", "_base")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (hi, lo), hi > lo: nodes move to the least of their neighbours."""
    if large:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        return moved.where("hi > lo").distinct()
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    moved = joined.select(F.explode(F.array(
        F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct("hi", F.col("m").alias("lo"))
    )).alias("e")).select("e.*")
    return moved.where("hi > lo").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (u, v): rows (node, component), component being the least node.

    Large and small stars by turns; each is two hash joins, so that a node of very many edges is an ordinary skewed
    join. Every round is stored, which cuts the lineage. Nodes without an edge have no row. Nulls are no nodes.
    """
    pairs = edges.where("u is not null and v is not null and u <> v")
    now = stored(pairs.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct())

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        return tuple(row)

    seen = mark(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        now = stored(_star(_star(now, large=True), large=False))
        found = mark(now)
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
