"""Connected components of a link table: joined within tasks, then by star contraction, each round in shared storage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import shared_dir

HELD = 1 << 19


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, and survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, root`` of the links (two columns) that one task has: the least node that its own links lead to.

    Many links become one row per node. A task that sees more than ``HELD`` nodes gives out what it has and goes on.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parent), pa.int64()),
                                           pa.array([find(x) for x in parent], pa.int64())], ["node", "root"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > HELD:
            yield out()
            parent.clear()
    yield out()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link to another one; root: the least node reachable. Nodes are longs.

    Every task first joins what its own links join. A node that several tasks have seen then links the roots that they
    gave it, which is a far smaller table: only those roots go through star contraction. Minima are aggregates, so a node
    with very many links is combined before the shuffle. Nothing but an answer per round comes to the driver.
    """
    schema = "node long, root long"
    seen = stored(links.select(a, b).filter(F.col(a) != F.col(b)).mapInArrow(forest, schema), "forests")
    least = stored(seen.groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("other")), "least")
    split = least.filter("root != other")
    if split.isEmpty():
        return least.select("node", "root")
    met = seen.withColumnRenamed("root", "u").join(split.select("node", "root"), "node").filter("u != root")
    met = stored(met.select("u", F.col("root").alias("v")).distinct(), "links")
    # Read again from few files: most of these links meet in a task now.
    roots = stars(stored(met.mapInArrow(forest, schema).filter("node != root").toDF("u", "v"), "links"))
    roots = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return least.join(roots, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def stars(edges: DataFrame) -> DataFrame:
    """``node, root`` of links ``u, v`` with u > v, by alternating star contraction.

    Each round gives every node's neighbours to the least of them (large star on greater neighbours, then small star on
    lesser ones); the number of rounds is logarithmic in the longest path.
    """
    while True:
        # Done when each node has one link, and that to a node which has none of its own.
        ends = edges.select("u", "v", F.lit(0).alias("met")).union(edges.select("v", F.lit(None).cast("long"), F.lit(1)))
        ends = ends.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("met").alias("met"))
        if ends.filter("low != high OR low IS NOT NULL AND met = 1").isEmpty():
            edges = edges.distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct().toDF("node", "root"))
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # Large star: greater neighbours of u are linked to the least of u and its neighbours.
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: lesser neighbours of u, and u itself, are linked to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stored(small.filter("u != v").distinct(), "links")
