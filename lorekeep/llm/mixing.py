"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule w(t) over training time t in [0, 1].
The weights fix how many words of each source the whole mix takes (its target);
the schedule says when.  The integral of a schedule is the source's cumulative
demand; inverting it at a document's place in its source's cumulative supply gives
the training position, and documents are range-sorted by position.

All of it is DataFrame expressions.  A source's running total is taken in two
steps (4,096 hash buckets per source, then inside a bucket), so that a source with
a third of all rows is spread over as many tasks as any other.

Defined results: null text has size 0; a null source is a source of its own, last in
order; rows with equal doc_id and source are told apart by size and text, and each has a place of its own;
empty tables give no rows; other columns are ignored.  Of rows that agree in doc_id, source and text, the mix
holds one of them (by a hash of all columns) as often as all of them are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
#: Slopes of the linear schedules 1 + slope * (2 t - 1), repeating over the sources: early, level, late.
SLOPES = (-0.5, 0.0, 0.5)
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: str = "text"):
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, slopes=SLOPES) -> DataFrame:
    """From (source, source_size), one row a source: add weight, slope and target.

    A level L is sought with sum(min(cap * size, L * weight)) = share * all sizes: sources
    in order of cap * size / weight fill up one after the other; after the last full
    one the rest is split by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    s = sizes.withColumn("_i", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", pick([float(w) for w in weights], F.col("_i"))).withColumn("slope", pick([float(x) for x in slopes], F.col("_i")))
    s = s.withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    filling = Window.orderBy(F.col("_cap") / F.col("weight"), "_i")
    upto = filling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (
        s.withColumn("_all", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("_full", F.sum("_cap").over(upto) - F.col("_cap"))
        .withColumn("_left", F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight"))
    )
    # The level if all before this source are full and this one isn't; the first source that stays below its cap sets it (later ones give less).
    s = s.withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_left"))
    s = s.withColumn("_at", F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level")))
    s = s.withColumn("_found", F.max("_at").over(every))
    s = s.withColumn("target", F.when(F.col("_found").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_found") * F.col("weight"))))
    return s.select("source", "source_size", "weight", "slope", "target")


def plan(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, slopes=SLOPES) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken, offset, slope, position, text_key.

    offset: words of the source before the document, in the order of md5(doc_id).
    position: the training time, in [0, 1], of the document's first words that are taken
    (null if none are).  The last pass over a source may take only a document's first words.
    """
    d = docs.select(F.col("doc_id"), F.col("source"), words().alias("size"), text_key().alias("text_key"))
    d = d.withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))).withColumn("_bucket", F.substring("_key", 1, 3))
    d = d.withColumn("_src", F.struct(F.col("source").isNull().alias("none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name")))
    buckets = d.groupBy("_src", "_bucket").agg(F.first("source").alias("source"), F.sum("size").alias("_sum"))
    goal = targets(buckets.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, cap, slopes)
    before = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = buckets.withColumn("_before", F.sum("_sum").over(before) - F.col("_sum"))
    buckets = buckets.join(goal, buckets["source"].eqNullSafe(goal["source"])).select("_src", "_bucket", "_before", "source_size", "target", "slope")
    inside = Window.partitionBy("_src", "_bucket").orderBy("_key", "doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_in", F.sum("size").over(inside) - F.col("size")).join(buckets, ["_src", "_bucket"])
    d = d.withColumn("offset", F.col("_before") + F.col("_in"))
    whole = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    d = d.withColumn("_passes", passes).withColumn("_rest", whole - F.col("_passes") * F.col("source_size"))
    d = d.withColumn("taken", F.col("_passes") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("_rest") - F.col("offset"), F.col("size"))))
    d = d.withColumn("position", F.when(F.col("taken") > 0, arrival(F.col("offset") / F.col("target"), F.col("slope"))))
    return d.select("doc_id", "source", "size", "source_size", "target", "taken", "offset", "slope", "position", "text_key")


def arrival(share, slope):
    """t at which the integral t + slope * (t * t - t) of the schedule 1 + slope * (2 t - 1) is ``share``."""
    b = 1 - slope
    root = (F.sqrt(b * b + 4 * slope * share) - b) / (2 * slope)
    return F.when(slope == 0, share).otherwise(root)


def in_training_order(p: DataFrame) -> DataFrame:
    """Range-sort a plan by position; documents that aren't taken come last."""
    return p.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row for each copy, range-sorted by position.

    A document appears once for each whole time it is taken and once more if the
    last pass takes at least half of its words: rows are whole documents, and each
    source's sum is within half a document of its target.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keys = ["_id", "_source", "_text"]
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), text_key().alias("_text"), F.struct(*columns).alias("_row"), F.xxhash64(*columns).alias("_hash"))
    # Rows of one key are one text: one of them stands for all, and every place that any of them has is taken by it.
    rows = rows.groupBy(*keys).agg(F.min_by("_row", "_hash").alias("_row"))
    p = plan(docs, **settings).withColumn("_copies", F.round(F.col("taken") / F.col("size")).cast("int")).where("taken > 0 and _copies > 0")
    p = p.select(F.col("doc_id").alias("_pid"), F.col("source").alias("_psource"), F.col("text_key").alias("_ptext"), "_copies", "offset", "slope", "target", "source_size")
    out = p.join(rows, p["_pid"].eqNullSafe(rows["_id"]) & p["_psource"].eqNullSafe(rows["_source"]) & (p["_ptext"] == rows["_text"]))
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    share = F.least(F.lit(1.0), (F.col("offset") + F.col("_copy") * F.col("source_size")) / F.col("target"))
    out = out.select("_id", "_text", "_copy", arrival(share, F.col("slope")).alias("_at"), "_row")
    return out.orderBy("_at", "_id", "_text", "_copy").select("_row.*")
