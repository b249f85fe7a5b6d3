"""Connected components of a graph of links, without gathering it anywhere.

Each task first reduces its own links to a forest by union-find, in bounded memory; then rounds of large and small stars, as joins and
minima, until every node hangs on the smallest node of its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import settle

NODES = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up: dict[int, int] = {}

    def root(x: int) -> int:
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r:
            up[x] = r
            x = p
        return r

    def flush() -> pa.RecordBatch:
        hung = [(x, root(x)) for x in up]
        hung = [(x, r) for x, r in hung if x != r]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in hung], pa.int64()), pa.array([r for _, r in hung], pa.int64())], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        if len(up) > NODES:
            yield flush()
            up.clear()
    if up:
        yield flush()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node with a link; ``links``: two columns of ids without nulls, in any direction."""
    a, b = links.columns
    edges = settle(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b").mapInArrow(_forest, "u long, v long"), "forest")
    while True:
        down = edges.groupBy("u").agg(F.count("*").alias("n"))
        if down.filter("n > 1").isEmpty() and edges.join(down.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = settle(small.select("e.u", "e.v").filter("u <> v").distinct(), "stars")
