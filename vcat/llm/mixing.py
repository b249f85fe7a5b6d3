"""Mixing sources to target weights by pivotal dependent rounding (operator 11).

Every source gets a target in words, by weight and at most ``most`` times what it holds. A document is taken a whole number of times, the integral part
of target / size of its source, and once more with the fraction as its probability. These fractions are rounded dependently: two documents meet, and a random
one of two transfers of mass (words times probability) is made, the largest that leaves one of them at 0 or 1; the odds keep all expectations, and
the mass of a source stays what it is. Longer documents meet first, so that what stays open becomes short.

The rounding is a reduction tree: a source's documents are dealt to blocks of about ``block`` by a hash, each block leaves at most one document open, and
these are the documents of the next storey, until a source has one left, which is rounded by its own odds. So a source's words differ from its target by less
than one document, and no task holds more than a block, whatever the source's share. All draws come from hashes of ids and texts: reruns agree.

Targets share out by weight; what a full source can't take goes to the others by weight, until none is above its limit. Only two sums for each turn reach the driver.

Defined results: null or empty text: size 0, never taken. Null source: a source of its own, the last. Null or repeated ids: rows of their own; repeated rows may be
taken differently, which of them is the same to say. A very long text: one document, counted whole. Empty table: no rows. Other columns are ignored; ``copies`` keeps them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import join_equal, ranked, settle

#: Weights of the sources in their order, repeating; words of the mix, as a share of all words; the most that a document is taken.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
BLOCK = 4096


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, weight, target`` of ``source, source_size``."""
    placed = ranked(sources.select("source", "source_size"), [], [F.col("source").asc_nulls_last()])
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int"))
    placed = settle(placed.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("limit")), "sources")
    wanted = share * (placed.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, None
    while True:  # words for a unit of weight, higher with every source that is full
        full = F.col("limit") <= level * F.col("weight")
        held, count, open_ = placed.agg(F.sum(F.when(full, F.col("limit"))), F.count(F.when(full, 1)), F.sum(F.when(~full, F.col("weight")))).first()
        if count == before or not open_:
            break
        level, before = (wanted - (held or 0.0)) / open_, count
    return placed.select("source", "source_size", "weight", F.least("limit", F.col("weight") * level).alias("target"))


def round_pairs(size: list[int], chance: list[float], draw) -> tuple[list[float], int | None]:
    """The fractions after all have met in the order given, and the place of the one that is still open."""
    x, held = list(chance), None
    for i in range(len(size)):
        if not 0.0 < x[i] < 1.0:
            continue
        if held is None:
            held = i
            continue
        s, t, a, b = size[held], size[i], x[held], x[i]
        up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)  # words to the held one, words from it
        if draw() * (up + down) < down:
            held_done, own_done = (1 - a) * s <= b * t, b * t <= (1 - a) * s
            x[held] = 1.0 if held_done else a + up / s
            x[i] = 0.0 if own_done else b - up / t
        else:
            held_done, own_done = a * s <= (1 - b) * t, (1 - b) * t <= a * s
            x[held] = 0.0 if held_done else a - down / s
            x[i] = 1.0 if own_done else b + down / t
        if held_done:
            held = None if own_done else i
        x[i] = min(max(x[i], 0.0), 1.0)
        if held is not None and not 0.0 < x[held] < 1.0:
            held = None
    return x, held


def _round_block(turn: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("key", "ascending"), ("chance", "ascending")])
        seed = int(np.bitwise_xor.reduce(table["key"].to_numpy().view(np.uint64)))
        draw = iter(np.random.default_rng([seed, turn, table.num_rows]).random(table.num_rows + 1).tolist()).__next__
        x, held = round_pairs(table["size"].to_pylist(), table["chance"].to_pylist(), draw)
        if held is not None and table["blocks"][0].as_py() == 1:
            x[held], held = float(draw() < x[held]), None
        done = np.ones(len(x), bool)
        if held is not None:
            done[held] = False
        names = table.column_names
        return table.set_column(names.index("chance"), "chance", pa.array(x)).append_column("done", pa.array(done)).drop_columns(["block", "blocks"])

    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """A row per document: ``doc_id, source, text_hash, size, source_size, target, times`` (how often it is taken)."""
    rows = settle(docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("size")), "sizes")
    wanted = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    plan = wanted.select("source", "source_size", "target", F.floor(rate).cast("long").alias("whole"), (rate - F.floor(rate)).alias("chance"))
    counts = rows.filter("size > 0").groupBy("source").agg(F.count("*").alias("n"))
    plan = settle(join_equal(plan, counts, ["source"], "left").withColumn("blocks", F.ceil(F.coalesce("n", F.lit(1)) / block).cast("long")).drop("n"), "plan")
    every = join_equal(rows, plan, ["source"])
    is_open = (F.col("size") > 0) & (F.col("chance") > 0)
    cols = ["doc_id", "source", "text_hash", "size", "source_size", "target", "whole"]
    out = every.filter(~is_open).select(*cols, F.lit(0.0).alias("chance"))
    key = F.xxhash64("doc_id", "text_hash", "source")
    rest, turn = every.filter(is_open).select(*cols, "chance", key.alias("key"), F.pmod(key, F.col("blocks")).alias("block"), "blocks"), 0
    kinds = ", ".join(f"`{c}` {rest.schema[c].dataType.simpleString()}" for c in [*cols, "chance", "key"])
    while True:
        placed = settle(rest.groupBy("source", "block").applyInArrow(_round_block(turn), kinds + ", done boolean"), "rounded")
        out = out.unionByName(placed.filter("done").select(*cols, "chance"))
        left = placed.filter("NOT done")
        if left.isEmpty():
            break
        turn += 1
        per = settle(left.groupBy("source").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks")), "left")
        rest = join_equal(left.drop("done"), per, ["source"]).select(*cols, "chance", "key", F.pmod(F.xxhash64("key", F.lit(turn)), F.col("blocks")).alias("block"), "blocks")
    taken = F.when(F.col("size") > 0, F.col("whole") + F.round("chance").cast("long")).otherwise(0)
    return out.select(*cols[:-1], taken.alias("times"))


def copies(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken. ``doc_id`` has to be a key here."""
    again = mixed.filter("times > 0").select(F.col("doc_id").alias("_taken_id"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_copy")).drop("_copy")
    return docs.join(again, docs["doc_id"] == again["_taken_id"]).drop("_taken_id")
