"""Connected components by alternating stars, on Spark joins alone."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import bring_back, save

#: Links that a task contracts at once.
CHUNK = 250_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def contract(edges: DataFrame) -> DataFrame:
    """The same components with fewer links: stars within chunks of each partition.

    Which links meet in a chunk only decides how much is saved.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def stars(links: list[tuple[int, int]]) -> pa.RecordBatch:
        root: dict[int, int] = {}

        def find(node: int) -> int:
            top = node
            while (up := root.setdefault(top, top)) != top:
                top = up
            while root[node] != top:
                root[node], node = top, root[node]
            return top

        for u, v in links:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
        pairs = [(n, find(n)) for n in root]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=schema)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []
        for batch in batches:
            links += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            if len(links) >= CHUNK:
                yield stars(links)
                links = []
        yield stars(links)

    return edges.select("u", "v").mapInArrow(local, "u bigint, v bigint")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (u, v); root is the component's least node.

    Rounds of large stars and small stars: each node links its larger neighbours, then
    its smaller ones, to the least of them, until every component is a star; before
    that, tasks contract the links they hold. A node of many neighbours is aggregated
    by a partial minimum and its links are dealt by salts, never gathered. A round
    writes its links to the shared folder. No links give an empty result.
    """
    edges = save(links.where("u <> v").select("u", "v"), "links")
    state = None
    while True:
        edges = save(contract(edges), "links")  # u > v from here on
        now = _state(edges)
        if now == state or not now[0]:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = save(
            both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
            .select(F.col("u").alias("v"), F.least("u", "m").alias("m"), "n"), "least-neighbours")
        # the larger neighbours of v are the u of its edges
        large = save(
            bring_back(edges, least, "v", "n", F.col("u"), "inner")
            .select("u", F.col("m").alias("v")).distinct(), "links")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = save(
            small.where("u <> v").unionByName(lowest.withColumnRenamed("m", "v")).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
