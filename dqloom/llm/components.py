"""Connected components: union-find inside tasks, then star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import cut, drop, ship

#: Links that one union-find holds before it gives out its forest; bounds memory, loses no link.
HELD_LINKS = 500_000


def local_forest(links: DataFrame) -> DataFrame:
    """Links (a, b) of each task replaced by links of its nodes to the smallest node they reach."""
    ship(links.sparkSession)

    def forest(parent: dict[int, int]) -> pa.RecordBatch:
        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        pairs = [(x, r) for x in parent if (r := root(x)) != x]
        return pa.RecordBatch.from_pydict({
            "a": pa.array([p[0] for p in pairs], pa.int64()),
            "b": pa.array([p[1] for p in pairs], pa.int64()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > HELD_LINKS:
                yield forest(parent)
                parent.clear()
        if parent:
            yield forest(parent)

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Node and smallest node it reaches, for every node that has a link (long columns a, b).

    Each round lets the larger neighbours of a node point to its smallest neighbour, then the smaller
    ones (alternating stars), until nothing changes. A node's neighbours are never gathered: minima are
    aggregated and joined back, so a node with any number of links is split like any join key.
    """
    edges = cut(local_forest(links.where("a <> b")), "forest")
    state = _state(edges)
    while state[0]:
        large = _star(edges, larger=True)
        small = cut(_star(large, larger=False).distinct(), "stars")
        now = _state(small)
        drop(edges)
        edges = small
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _state(edges: DataFrame) -> tuple:
    """What stays equal if and only if a round changed nothing (up to the hash)."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (node, smaller node) after one star operation on edges of the same form."""
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = down.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        joined = both.where("v > u").join(least, "u")
        return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b")
