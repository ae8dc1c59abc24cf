"""Nearest vectors in blocks, against every pair scored by itself."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lorekeep.functions.vectors import cosine
from lorekeep.operators import nearest as N
from lorekeep.plans import retrieval as P

VECTORS = "chunk_id string, embedding array<float>"
QUERIES = "query_id long, embedding array<float>"


def plain(vectors, queries, k):
    """Every pair by the cosine expression, as SQL orders them: NaN first, null ids last."""
    scored = vectors.crossJoin(queries.select("query_id", F.col("embedding").alias("_q"))).select("query_id", "chunk_id", cosine(F.col("embedding"), F.col("_q")).alias("score")).where("score is not null")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("chunk_id")))
    return scored.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def listed(d):
    return sorted(((r.query_id, r.chunk_id, "NaN" if math.isnan(r.score) else r.score) for r in d.collect()), key=str)


def odd_vectors(spark):
    rng = random.Random(5)
    vec = lambda: [rng.gauss(0, 1) for _ in range(8)]
    some = [vec() for _ in range(40)]
    rows = [*some, *[some[3]] * 30, *[[2 * x for x in some[4]]] * 20, *[[3 * x for x in some[4]]] * 20]
    rows += [[0.0] * 8, [], None, [1.0, None, *[0.0] * 6], [1.0, 2.0], [float("nan")] + [1.0] * 7, [float("inf")] * 8, [1e-38] * 8, [3e38] * 8]
    rows += [[float("nan"), float(x)] + [1.0] * 6 for x in range(15)]
    ids = [f"c{i:03d}" for i in range(len(rows))]
    rng.shuffle(ids)
    vectors = spark.createDataFrame([*zip(ids, rows, strict=True), (None, some[3]), (None, some[7])], VECTORS)
    asked = [*some[:6], [0.0] * 8, [], None, [2.0, 1.0], [float("nan")] * 8, [1e-38] * 8, [1.0, 0.0, None, *[1.0] * 5], [-x for x in some[3]]]
    return vectors, spark.createDataFrame(list(enumerate(asked)), QUERIES)


def test_odd_vectors(spark, monkeypatch):
    vectors, queries = odd_vectors(spark)
    want = {k: listed(plain(vectors, queries, k)) for k in (1, 10, 200)}
    for numbers, across, tile in ((1 << 21, 4096, 1 << 21), (240, 3, 16)):
        monkeypatch.setattr(N, "BLOCK_NUMBERS", numbers)
        monkeypatch.setattr(N, "BLOCK_QUERIES", across)
        monkeypatch.setattr(N, "TILE", tile)
        for k in want:
            assert listed(P.vector_chunks_each(vectors, queries, k)) == want[k]
    assert P.vector_chunks_each(vectors, queries.where("query_id < 0")).collect() == []
    assert P.vector_chunks_each(vectors.where("chunk_id < ''"), queries).collect() == []


def test_ids_that_are_null_come_last(spark):
    vectors = spark.createDataFrame([(None, [1.0, 0.0]), ("b", [2.0, 0.0]), ("a", [1.0, 0.0])], VECTORS)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], QUERIES)
    assert [r.chunk_id for r in P.vector_chunks_each(vectors, queries, 2).orderBy("chunk_id").collect()] == ["a", "b"]


def test_pairs_are_not_rows(spark, sf):
    from lorekeep import catalog

    plan = catalog.QUERIES["vector_topk_each"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_index(spark):
    rng = random.Random(6)
    some = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(400)]
    vectors = spark.createDataFrame([(f"c{i:03d}", v) for i, v in enumerate([*some, *[some[0]] * 20])], VECTORS).repartition(8)
    index, centres = P.vector_index(vectors, lists=12)
    assert len(index.inputFiles()) == index.select("list").distinct().count() and index.count() == 420
    queries = spark.createDataFrame(list(enumerate([*some[:5], [0.0] * 8, None])), QUERIES)
    q = queries.select("query_id", F.col("embedding").alias("_q"))
    nearest = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("_c"), "list"))
    for probes in (1, 3, 12):
        probed = q.crossJoin(centres).withColumn("_c", cosine(F.col("_q"), F.col("centre"))).where("_c is not null").withColumn("_n", nearest).where(F.col("_n") <= probes)
        pairs = index.join(probed, "list").select("query_id", "chunk_id", cosine(F.col("embedding"), F.col("_q")).alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id"))
        want = pairs.withColumn("_rank", rank).where("_rank <= 10").drop("_rank")
        got = P.search_index(index, centres, queries, probes=probes)
        assert listed(got) == listed(want)
