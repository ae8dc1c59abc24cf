"""Connected components of a link table by alternating large-star and small-star steps.

Every step is two aggregations and two joins over all links; the links of a round are
written to the shared folder.  A hub's rows are pre-aggregated before each shuffle, and
nothing is collected but a count and a checksum a round.  The rounds needed grow with the logarithm of the
longest path; more than ``ROUNDS`` are taken for an error and raise.

``few_components`` saves the rounds where the links are few: up to a checked number they are joined in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.shared import at_most, drop_written, materialize

ROUNDS = 60
#: Links that one task may join: two numbers each.
FEW = 1_000_000


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = ROUNDS) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable."""
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = materialize(now, "links")
    before = _state(now)
    for _ in range(rounds):
        if not before[0]:
            break
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        after = materialize(small, "links")
        state = _state(after)
        drop_written(now.sparkSession, now)
        now = after
        if state == before:
            break
        before = state
    else:
        if before[0]:
            raise RuntimeError(f"components didn't settle in {rounds} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def few_components(links: DataFrame, a: str = "a", b: str = "b", few: int = FEW) -> DataFrame:
    """The same for long nodes: in one task up to ``few`` links, which are counted, beyond that by ``components``."""
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b").distinct()
    if not at_most(links, few):
        return components(links)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for d in batches:
            for x, y in zip(d["a"].tolist(), d["b"].tolist(), strict=True):
                x, y = sorted((top(x), top(y)))
                root[y] = x
        yield pd.DataFrame({"node": list(root), "component": [top(x) for x in root]}, dtype="int64")

    return links.coalesce(1).mapInPandas(join, "node long, component long")
