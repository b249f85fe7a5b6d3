"""Resharding by minimum-cost flow (operator 8).

From the bytes of the old shards and the capacities of the new ones, a flow network over shards (not rows) gives how many
bytes go from which old shard to which new one, at the least cost; staying costs nothing, so the fewest bytes move. Each old
shard then is a line of rows, large ones first, that the transfers cut into stretches; cuts fall among the small rows at the
end, so new sizes differ from their capacities by a few small rows. Only stretches that move, and the files they come from, are
rewritten.

Lines and places within a shard are running sums over blocks: rows of one size class and one hash of the id, about
``block_rows`` of them; the offsets of blocks come from their sums. No step gathers a shard, hot or not, and only one sum for
each old shard reaches the driver.

Defined results: null text: no bytes, checksum 0. A null ``old_shard`` or one out of range is a new row: it counts as moved wherever it
goes. Null or repeated ids: rows of their own, in any order among equal ones. Empty table: no rows. Other columns are kept
by ``reshard`` unless they have the name of a result column, which is replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.llm.common import settle


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> list[tuple[int, int, int]]:
    """Transfers (from, to, amount) that send all supply within capacity at the least total ``cost(i, j)`` per unit:
    successive shortest paths with potentials on the graph source, suppliers, takers, sink."""
    n, m = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards are too small")
    source, sink, size = n + m, n + m + 1, n + m + 2
    edges: list[list[list]] = [[] for _ in range(size)]  # to, room, cost, place of the reverse edge

    def add(u, v, room, c):
        edges[u].append([v, room, c, len(edges[v])])
        edges[v].append([u, 0, -c, len(edges[u]) - 1])

    for i in range(n):
        add(source, i, supply[i], 0)
        for j in range(m):
            add(i, n + j, supply[i], cost(i, j))
    for j in range(m):
        add(n + j, sink, capacity[j], 0)
    height, left = [0] * size, sum(supply)  # costs are not negative
    while left:
        far, via, heap = [float("inf")] * size, [None] * size, [(0, source)]
        far[source] = 0
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for k, (v, room, c, _) in enumerate(edges[u]):
                if room and (to := d + c + height[u] - height[v]) < far[v]:
                    far[v], via[v] = to, (u, k)
                    heapq.heappush(heap, (to, v))
        height = [h + (d if d < float("inf") else 0) for h, d in zip(height, far)]
        push, v = left, sink
        while v != source:
            u, k = via[v]
            push, v = min(push, edges[u][k][1]), u
        v = sink
        while v != source:
            u, k = via[v]
            edges[u][k][1] -= push
            edges[v][edges[u][k][3]][1] += push
            v = u
        left -= push
    return [(i, v - n, supply[i] - room) for i in range(n) for v, room, _, _ in edges[i] if n <= v < n + m and supply[i] > room]


def _running(df: DataFrame, by: list[str], order: list[str], col: str, out: str) -> DataFrame:
    """Sum of ``col`` over the rows before."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(col).over(before), F.lit(0)))


def plan_transfers(old_bytes: dict[int, int], shards: int, capacity: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(old shard, new shard, bytes); old shard -1 holds rows without one. Capacities default to equal ones."""
    old, total = sorted(old_bytes), sum(old_bytes.values())
    capacity = capacity or [total // shards + (j < total % shards) for j in range(shards)]
    return [(old[i], j, amount) for i, j, amount in min_cost_flow([old_bytes[k] for k in old], capacity, lambda i, j: int(old[i] != j))]


def reshard_plan(docs: DataFrame, shards: int, capacity: list[int] | None = None, overhead: int = 8, block_rows: int = 2000) -> DataFrame:
    """A row per document: ``doc_id, size, text_crc32, old_shard, shard, slot``. ``docs`` needs ``doc_id, text, old_shard``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    known = F.when(F.col("old_shard").between(0, shards - 1), F.col("old_shard").cast("int")).otherwise(-1)
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       known.alias("old_shard"))
    rows = settle(rows.withColumn("cls", F.floor(-F.log2("size")).cast("int")), "sizes")
    totals = {r["old_shard"]: (r["b"], r["n"]) for r in rows.groupBy("old_shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    blocks = max(1, sum(n for _, n in totals.values()) // block_rows)
    at = ["old_shard", "cls", "block"]
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.monotonically_increasing_id()), F.lit(blocks)))
    inside = Window.partitionBy(*at).orderBy("doc_id", "size", "text_crc32")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = settle(rows.withColumns({"rn": F.row_number().over(inside), "upto": F.coalesce(F.sum("size").over(before), F.lit(0))}), "lines")
    starts = _running(rows.groupBy(*at).agg(F.sum("size").alias("b")), ["old_shard"], ["cls", "block"], "b", "begin").drop("b")

    cuts, reach = [], dict.fromkeys(totals, 0)
    transfers = plan_transfers({k: b for k, (b, _) in totals.items()}, shards, capacity)
    for old, new, amount in sorted(transfers, key=lambda t: (t[0], t[0] != t[1], t[1])):  # what stays comes first on the line
        cuts.append((old, new, reach[old], reach[old] + amount))
        reach[old] += amount
    schema = T.StructType([T.StructField("old_shard", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])
    cuts = F.broadcast(spark.createDataFrame(cuts, schema))  # as many as pairs of shards at most
    middle = F.col("begin") + F.col("upto") + F.floor(F.col("size") / 2)
    placed = rows.join(starts, at).withColumn("middle", middle).join(cuts, "old_shard").filter("low <= middle AND middle < high")
    placed = settle(placed.select("doc_id", "size", "text_crc32", *at, "rn", "shard"), "placed")
    parts = placed.groupBy("shard", *at).agg(F.count("*").alias("n"), F.min("rn").alias("first"))
    parts = _running(parts, ["shard"], at, "n", "head")
    return placed.join(parts, ["shard", *at]).select(
        "doc_id", "size", "text_crc32", F.when(F.col("old_shard") >= 0, F.col("old_shard")).alias("old_shard"), "shard",
        (F.col("head") + F.col("rn") - F.col("first")).cast("long").alias("slot"))


def reshard(docs: DataFrame, out: str, shards: int, capacity: list[int] | None = None) -> None:
    """Write the affected rows below ``out``, a folder for each new shard and old shard (-1: none) it takes from: rows that stay are
    rewritten only where rows leave their shard. ``doc_id`` has to be a key here."""
    plan = reshard_plan(docs, shards, capacity).select("doc_id", F.col("old_shard").alias("_from"), "shard", "slot")
    plan = plan.withColumn("_from", F.coalesce("_from", F.lit(-1)))
    leaves = plan.groupBy("_from").agg(F.max((F.col("_from") != F.col("shard")).cast("int")).alias("_leaves"))
    moved = plan.join(leaves, "_from").filter("_leaves = 1").select("doc_id", "_from", "shard", "slot")
    keep = docs.drop(*(c for c in docs.columns if c.lower() in ("shard", "slot", "_from", "old_shard")))
    keep.join(moved, "doc_id").repartition("shard", "_from").write.partitionBy("shard", "_from").parquet(out)
