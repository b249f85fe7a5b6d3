"""Merkle dataset manifest as a postorder append log (operator 13).

The rows of a part, in their order, are the leaves of a binary tree: every two consecutive nodes of a level make one of the next, a last single one
makes one alone, until one is left, the part's subroot. The subroots, in the order of their parts, make the root by the same rule.

A log takes the nodes in the order in which they complete, as a builder appends them that reads the leaves once. The place of a node follows
from the sizes of the subtrees before it: when s leaves are in, 2s - popcount(s) nodes are, so node j of height h, over the leaves from
s = j * 2^h on, lies at 2s - popcount(s) + 2^(h+1) - 2; nodes over fewer leaves complete when the log is closed, lowest first.
``position`` says it for any node, without the log.

A builder owns an aligned block of 2^BITS leaves, whose nodes are a stretch of the log; the tops of blocks are leaves of builders one storey up, and
so on, so that no task holds more than a block whatever a part's share of all rows. Proofs address siblings in a block's stretch by their
positions and go from the highest storey down: a block hands the path above it to its children.

Defined results: null columns: '-' in the leaf's input. Null parts: a part of their own, the first. Null or repeated ids: rows of their own; rows of one id are
in order of their leaves. Repeated rows: a leaf each. Empty table: no rows. Very long texts: hashed whole, by the scan. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import join_equal, ranked, settle

#: Leaves of a builder, as a power of two.
BITS = 10
LEFT, RIGHT, ALONE = "L", "R", "A"


def leaf_hash(*columns: Column) -> Column:
    """SHA-256 in hex of the columns: each ``-`` if null, else its UTF-8 bytes' number, a colon and its text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(part, columns)), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def position(height: int, node: int, leaves: int) -> int:
    """Place in the log of a node of a tree over so many leaves."""
    first = node << height
    if first + (1 << height) <= leaves:
        return 2 * first - first.bit_count() + (2 << height) - 2
    ragged = sum(1 for h in range(1, height) if leaves & ((1 << h) - 1))
    return 2 * leaves - leaves.bit_count() + ragged


def build_log(leaves: list[str], height: int) -> list[str]:
    """Nodes up to ``height`` over an aligned block's leaves, in the order of the log: each by its place."""
    n, level = len(leaves), leaves
    log = [""] * sum(-(-n >> h) for h in range(height + 1))
    for h in range(height + 1):
        for j, node in enumerate(level):
            log[position(h, j, n)] = node
        level = [digest(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return log


def siblings(log: list[str], leaf: int, leaves: int, height: int) -> list[str]:
    """What a leaf of the block needs on its way to the block's top, from below: the sibling's side and hash, or that it has none."""
    out = []
    for h in range(height):
        j = leaf >> h
        other = j ^ 1
        if other << h >= leaves:
            out.append(ALONE)
        else:
            out.append((LEFT if other < j else RIGHT) + log[position(h, other, leaves)])
    return out


def fold(node: str, path: list[str]) -> str:
    """The root that a leaf and its path lead to."""
    for step in path:
        side, other = step[0], step[1:]
        node = digest(other, node) if side == LEFT else digest(node, other)
    return node


def _height(total: int, bits: int) -> int:
    """Levels that a block rises: all of a builder's, or to the top of a tree that is no more than this block."""
    return (total - 1).bit_length() if total <= 1 << bits else bits


@dataclass
class Tree:
    """Storeys of blocks, lowest first: ``part, block, total, payload, log``; ``total``: nodes that the part has on the floor of the storey."""

    storeys: list[DataFrame]
    bits: int

    def tops(self) -> DataFrame:
        """``part, hash`` of the roots of all parts."""
        own = [s.filter(F.col("total") <= (1 << self.bits)).select("part", F.element_at("log", -1).alias("hash")) for s in self.storeys]
        out = own[0]
        for t in own[1:]:
            out = out.unionByName(t)
        return out

    def log(self) -> DataFrame:
        """``part, position, height, node, hash``: the whole append log."""
        bits, out = self.bits, None

        def rows(storey: int):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for r in range(batch.num_rows):
                        row = batch.slice(r, 1)
                        block, leaves, log = (row.column(i)[0].as_py() for i in (1, 2, 3))
                        n = min(1 << bits, -(-leaves >> bits * storey) - (block << bits))
                        top = _height(-(-leaves >> bits * storey), bits)
                        at = [(h, j) for h in range(1 if storey else 0, top + 1) for j in range(-(-n >> h))]
                        nodes = [(h + bits * storey, (block << bits - h) + j, log[position(h, j, n)]) for h, j in at]
                        cols = list(zip(*nodes)) or [(), (), ()]
                        place = [position(h, j, leaves) for h, j, _ in nodes]
                        yield pa.RecordBatch.from_arrays([row.column(0).take(pa.array([0] * len(nodes), pa.int32())), pa.array(place, pa.int64()), pa.array(cols[0], pa.int32()),
                                                          pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["part", "position", "height", "node", "hash"])
            return run

        sizes = self.storeys[0].groupBy("part").agg(F.max("total").alias("leaves"))
        for k, s in enumerate(self.storeys):
            kind = s.schema["part"].dataType.simpleString()
            one = join_equal(s.select("part", "block", "log"), sizes, ["part"]).select("part", "block", "leaves", "log")
            one = one.mapInArrow(rows(k), f"part {kind}, position long, height int, node long, hash string")
            out = one if out is None else out.unionByName(one)
        return out


def _build_block(bits: int, payload: str | None):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        log = build_log(table["hash"].to_pylist(), _height(table["total"][0].as_py(), bits))
        first = table.slice(0, 1)
        cols = {"part": first["part"], "block": first["block"], "total": first["total"], "log": pa.array([log], pa.list_(pa.string()))}
        if payload:
            load = table[payload].combine_chunks()
            cols["payload"] = pa.ListArray.from_arrays(pa.array([0, len(load)], pa.int32()), load)
        return pa.table(cols)

    return run


def build(leaves: DataFrame, payload: str | None = None, bits: int = BITS) -> Tree:
    """Trees over ``part, rank, total, hash``; ``rank`` counts the leaves of a part from 0, ``total`` is their number. ``payload`` names a
    column that lies with the blocks."""
    nodes, storeys = leaves, []
    while True:
        kind = nodes.schema["part"].dataType.simpleString()
        schema = f"part {kind}, block long, total long, log array<string>"
        keep = payload if not storeys else None
        if keep:
            schema += f", payload array<{nodes.schema[keep].dataType.simpleString()}>"
        dealt = nodes.select("part", "rank", "total", "hash", *([keep] if keep else []), F.shiftright("rank", bits).alias("block"))
        storeys.append(settle(dealt.groupBy("part", "block").applyInArrow(_build_block(bits, keep), schema), "storey"))
        above = storeys[-1].filter(F.col("total") > (1 << bits))
        if above.isEmpty():
            return Tree(storeys, bits)
        nodes = above.select("part", F.col("block").alias("rank"), F.ceil(F.col("total") / (1 << bits)).cast("long").alias("total"), F.element_at("log", -1).alias("hash"))


def _hand_down(bits: int):
    """Path of every child of a block: its siblings inside, then the block's own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                block, total, log, above = (row.column(i)[0].as_py() for i in (1, 2, 3, 4))
                n, height = min(1 << bits, total - (block << bits)), _height(total, bits)
                paths = [siblings(log, i, n, height) + above for i in range(n)]
                same = pa.array([0] * n, pa.int32())
                yield pa.RecordBatch.from_arrays([row.column(0).take(same), pa.array([(block << bits) + i for i in range(n)], pa.int64()), pa.array(paths, pa.list_(pa.string()))], ["part", "node", "path"])

    return run


def _with_paths(tree: Tree, storey: int, above: DataFrame | None, tops: DataFrame | None) -> DataFrame:
    """Blocks of a storey with the ``path`` from their tops up: handed down by the storey above, or that of the part's root."""
    s, alone = tree.storeys[storey], F.col("total") <= (1 << tree.bits)
    highest = s.filter(alone)
    out = join_equal(highest, tops, ["part"]) if tops is not None else highest.withColumn("path", F.array().cast("array<string>"))
    if above is not None:
        out = out.unionByName(join_equal(s.filter(~alone), above.withColumnRenamed("node", "block"), ["part", "block"]))
    return out


def paths(tree: Tree, tops: DataFrame | None = None, floor: int = 0) -> DataFrame:
    """``part, node, path`` of the nodes on the floor of a storey (0: leaves). ``tops``: ``part, path`` above the parts' roots."""
    above = None
    for k in range(len(tree.storeys) - 1, floor - 1, -1):
        blocks = _with_paths(tree, k, above, tops).select("part", "block", "total", "log", "path")
        kind = blocks.schema["part"].dataType.simpleString()
        above = blocks.mapInArrow(_hand_down(tree.bits), f"part {kind}, node long, path array<string>")
        if k > floor:
            above = settle(above, "paths")
    return above


@dataclass
class Manifest:
    """``tree``: the parts' trees, with ``id`` and ``forged`` of each leaf as payload; ``crown``: the tree over their subroots; ``subroots``: ``part, subroot, rank``."""

    tree: Tree
    crown: Tree
    subroots: DataFrame


def build_manifest(rows: DataFrame, bits: int = BITS) -> Manifest:
    """``rows``: ``part, id, leaf, forged`` (a leaf to be checked in its place; null: the leaf itself). Leaves of a part are in order of id and leaf."""
    load = F.struct("id", "forged").alias("payload")
    placed = ranked(rows.select("part", "id", "leaf", "forged"), ["part"], [F.col("id").asc_nulls_first(), F.col("leaf")])
    tree = build(placed.select("part", "rank", "total", F.col("leaf").alias("hash"), load), "payload", bits)
    tops = ranked(tree.tops(), [], [F.col("part").asc_nulls_first()])
    subroots = settle(tops.select("part", F.col("hash").alias("subroot"), "rank", "total"), "subroots")
    crown = build(subroots.select(F.lit(0).alias("part"), "rank", "total", F.col("subroot").alias("hash")), None, bits)
    return Manifest(tree, crown, subroots.drop("total"))


def _check(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block, total, log, above, load, root = (batch.column(i)[r].as_py() for i in (1, 2, 3, 4, 5, 7))
                n, height = min(1 << bits, total - (block << bits)), _height(total, bits)
                leaf, proof, folded = [], [], []
                for i in range(n):
                    path = siblings(log, i, n, height) + above
                    leaf.append(log[position(0, i, n)])
                    proof.append(digest(*(x[1:] for x in path)))
                    folded.append(fold(load[i]["forged"] or leaf[-1], path))
                same = pa.array([r] * n, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([x["id"] for x in load], pa.int64()), pa.array(leaf), batch.column(6).take(same), batch.column(7).take(same), pa.array(proof),
                                                  pa.array(folded), pa.array([f == root for f in folded])], ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return run


def check(manifest: Manifest) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row: its proof is taken from the logs, and the leaf to be checked is
    folded up with it."""
    tree, crown = manifest.tree, manifest.crown
    over = paths(crown).join(crown.tops().withColumnRenamed("hash", "root"), "part").select(F.col("node").alias("rank"), "path", "root")
    tops = settle(manifest.subroots.join(over, "rank").select("part", "subroot", "root", "path"), "tops")
    ends = tops.select("part", "path")
    above = paths(tree, ends, 1) if len(tree.storeys) > 1 else None
    blocks = join_equal(_with_paths(tree, 0, above, ends), tops.drop("path"), ["part"])
    return blocks.select("part", "block", "total", "log", "path", "payload", "subroot", "root").mapInArrow(
        _check(tree.bits), "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
