"""Connected components of a link table, as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.operators.persist import materialize

MAX_ROUNDS = 60


def _contracted(edges: DataFrame) -> DataFrame:
    """Each partition's links as stars around the least node of its own components."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(up, up)
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) >= PARTITION_NODES:
                yield _stars(parent, root)
                parent.clear()
        yield _stars(parent, root)

    return edges.mapInArrow(contract, "a long, b long")


#: Nodes that a task holds at a time.
PARTITION_NODES = 500_000


def _stars(parent: dict[int, int], root) -> pa.RecordBatch:
    pairs = [(x, root(x)) for x in list(parent)]
    pairs = [p for p in pairs if p[0] != p[1]]
    columns = list(zip(*pairs, strict=True)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _toward_least(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of u (larger ones, or smaller ones and u itself) are linked to u's least neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = both.filter("b > a") if large else both.union(both.select("a", F.col("a").alias("b")))
    out = near.join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).filter("u <> v")
    # the smaller end comes second
    return out.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b: longs); the component is its smallest node.

    ``known``: what an earlier call returned for some of the links.  Tasks
    first contract the links they hold to stars; then large-star and
    small-star steps alternate until every node hangs on its least one.  Steps
    are group-by-least and join, so no component meets in one task; each
    round's links are written, which cuts the lineage.
    """
    edges = links.filter("a <> b").select("a", "b")
    if known is not None:
        edges = edges.union(known.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b"))
    edges = materialize(_contracted(edges).distinct(), "links")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count("*"), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        # every node has one larger-to-smaller link, and no least node hangs on another
        if tuple(now) == mark or now[0] == now[1] and edges.select("b").join(edges.select("a"), F.col("a") == F.col("b"), "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )
        mark = tuple(now)
        stepped = _toward_least(_toward_least(edges, large=True).distinct(), large=False)
        edges = materialize(_contracted(stepped).distinct(), "links")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
