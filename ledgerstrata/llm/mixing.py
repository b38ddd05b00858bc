"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, stored

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix in hundredths of all words; a source's target in times its size at most.
SHARE, MOST = 150, 2
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = SHARE, most: int = MOST) -> DataFrame:
    """Add `target` to one row per source (source, source_size, ...).

    Water filling in closed form: sources in the order of cap / weight; the first k stop at their cap where the level
    of the rest, (total - caps before) / (weights left), first fits under the next cap. The table has one row for each
    source, never for each document, so that its one-partition windows are small.
    """
    ranked = sizes.withColumn("_at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("_at") - 1, F.lit(len(weights))) + 1)
    caps = ranked.withColumns({"_w": weight.cast("long"), "_cap": F.col("source_size") * most})
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = caps.withColumns({
        "_total": F.sum("source_size").over(everything) * share,
        "_left": F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)),
        "_used": F.coalesce(F.sum("_cap").over(before), F.lit(0)),
    }).withColumn("_level", (F.col("_total") - 100 * F.col("_used")).cast("double") / (100 * F.col("_left")))
    # A source stops at its cap as long as the level at its place would lift it over that.
    free = level.withColumn("_free", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")))
    found = free.withColumn("_final", F.first("_free", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return found.withColumn("target", F.least(
        F.col("_cap").cast("double"), F.coalesce(F.col("_final") * F.col("_w"), F.col("_cap").cast("double"))
    )).select("source", "source_size", "target")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from a hash of the key, the same in every run and engine: 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(2**52))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """How many words of each document the mix takes.

    A source's repetition rate is target / size. A document is taken floor(rate) times, and once more if its draw, a
    hash of seed and doc_id, is under the fraction. Returns doc_id, source, size (words; null text: 0), source_size,
    target, copies and taken (size times copies). A null source is a source; a source of no words has target 0 and its
    documents no copies. Repeated rows are drawn alike. An empty table gives no rows.

    Words are counted once, stored as narrow rows and summed with map-side aggregation. The join goes over the short
    table of sources: Spark broadcasts it while small, else it is a sort join whose hot sources AQE splits.
    """
    sized = stored(docs.select(
        "doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")
    ))
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    sources = sources.select(F.col("source").alias("_source"), "source_size", "target")
    joined = sized.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    counted = joined.withColumn("_rate", rate).withColumn("copies", (
        F.floor("_rate") + (draw(F.col("doc_id"), seed) < F.col("_rate") - F.floor("_rate")).cast("int")
    ).cast("long"))
    return counted.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def repeat(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The documents as often as the mix takes them, with all columns. Rows of one doc_id and source share their draws."""
    taken = mix(docs, weights, seed).groupBy(F.col("doc_id").alias("_llm_id"), F.col("source").alias("_llm_source")).agg(
        F.max("copies").cast("int").alias("_llm_copies"))
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_llm_id"]) & docs["source"].eqNullSafe(taken["_llm_source"]))
    every = joined.where("_llm_copies > 0").withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), F.col("_llm_copies"))))
    return every.select(*[every[f"`{c}`"] for c in docs.columns])
