"""Connected components of an edge table: union-find inside partitions, then large and small stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatloom.llm.common import cut, drop, keep, step, tidy

#: Edges that one task contracts at a time.
EDGES = 200_000


def forest(edges: list[tuple[int, int]]) -> dict[int, int]:
    """Union-find with path halving: each node's root, the smallest node of its tree."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as stars: every node to the root of its tree."""
    edges: list[tuple[int, int]] = []
    most = EDGES
    for batch in batches:
        edges += zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True)
        if len(edges) > most:
            edges = [(x, r) for x, r in forest(edges).items() if x != r]
            most = max(EDGES, 2 * len(edges))  # so that all contractions together cost no more than twice the edges
    roots = [(x, r) for x, r in forest(edges).items() if x != r]
    for i in range(0, len(roots), 10_000):
        part = roots[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], ["u", "v"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): each node of edges (u, v), a materialised table, with the smallest node it reaches.

    Partitions of about EDGES edges are contracted by union-find first. If there are several, rounds of large-star
    and small-star (each node hands its neighbours to its smallest neighbour) follow until no edge changes;
    minima are pre-aggregated before they are shuffled, and a node with very many neighbours is only ever the
    many-row side of a join that adaptive execution may split.
    """
    spark = edges.sparkSession
    with step(spark):
        parts = -(-edges.count() // EDGES)
        stars = cut(edges.where("u <> v").coalesce(max(1, parts)).mapInArrow(tidy(_contract), "u long, v long"))
        before = None
        for _ in range(most_rounds if parts > 1 else 0):
            both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            down = large.where("u > v")
            least = down.groupBy("u").agg(F.min("v").alias("m"))
            small = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            old, stars = stars, cut(small.union(least.select("u", F.col("m").alias("v"))).distinct().coalesce(parts))
            drop(old)
            now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == before:
                break
            before = now
        else:
            if parts > 1:
                raise RuntimeError("components did not settle")
        return keep(cut(stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v")).distinct().coalesce(max(1, parts))))
