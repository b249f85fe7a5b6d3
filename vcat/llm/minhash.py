"""Near-duplicate documents by SuperMinHash (operator 3).

Every shingle of a text draws a pseudo-random permutation of the ``m`` places of the signature, step by step: in step j it offers
j + r, r in [0, 1), to the place the permutation gives it. A place keeps the least offer. As the offers grow with j, a text is done as soon
as all its places hold less than the next step would offer; ranks within one permutation are correlated, which is what lowers the variance.

1. Texts with equal shingle sets are one class, held by its smallest id.
2. Signatures are cut into bands; classes that share a band are candidates. All members of a bucket are first compared with its
   most central one (that with the largest buckets), which costs as many pairs as members, and linked groups are found.
3. Then members of one bucket that are still in different groups are compared, a large bucket in blocks of bounded size. Pairs inside
   a group could not change it, so no link between different texts is lost and no large group of copies is expanded into its pairs.
4. A pair is dropped if its signatures agree in too few places to have the similarity sought (six standard deviations below), or if
   counts of its shingles by cell show that the sets can't share enough; every other one is verified on the full shingle sets of whole texts.

With 96 places in 24 bands of 4, a pair at similarity 0.8 shares no band with a chance of 3e-6.

Defined results: null or empty text, or one without words: no shingles, linked with nothing. Fewer words than ``k``: one shingle, the whole sequence.
Null id: component null, kept, linked with nothing. Rows of one repeated id count as one document. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import settle
from vcat.llm.components import connected_components
from vcat.llm.textbytes import U, chunks, data, mix, shingle_sets

PLACES, BANDS = 96, 24
#: Cells that a set's shingles are counted in; members of a bucket that are compared at once.
CELLS, BLOCK = 256, 512
_NONE = U(0xFFFFFFFFFFFFFFFF)
_LOW = U(0xFFFFFFFF)


def super_minhash(rows: np.ndarray, shingles: np.ndarray, n: int, m: int = PLACES) -> np.ndarray:
    """Signatures (n, m) of sets given as (row, shingle), rows ascending; a component is step << 32 | r. All ones: an empty set."""
    sig = np.full(n * m, _NONE)
    base = rows * m
    size = np.bincount(rows, minlength=n)
    active, elements = rows, shingles
    perm = None
    for j in range(m):
        x = mix(elements, 101 + j)
        pick = j + (((x >> U(32)) * U(m - j)) >> U(32)).astype(np.int64)
        if perm is None:
            place = pick
        else:
            line = np.arange(len(perm))
            place = perm[line, pick].astype(np.int64)
            perm[line, pick] = perm[:, j]
        np.minimum.at(sig, base + place, (U(j) << U(32)) | (x & _LOW))
        far = sig.reshape(n, m).max(axis=1) >> U(32)
        going = (far > U(j)) & (size > 0)  # what step j + 1 offers could still be less somewhere
        if not going.any():
            break
        keep = going[active]
        if perm is None:
            active, elements, base, pick = active[keep], elements[keep], base[keep], pick[keep]
            perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(active), 1))
            perm[np.arange(len(active)), pick] = 0
        elif keep.mean() < 0.7:
            active, elements, base, perm = active[keep], elements[keep], base[keep], perm[keep]
    return sig.reshape(n, m)


def _sign(k: int, m: int, bands: int):
    width = m // bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).fill_null("")
            for i, j in chunks(texts):
                n = j - i
                rows, s = shingle_sets(*data(texts.slice(i, n)), k)
                size = np.bincount(rows, minlength=n)
                full = np.flatnonzero(size)
                sums = np.zeros((2, n), U)
                if len(full):
                    starts = np.concatenate(([0], np.cumsum(size[full])[:-1]))
                    sums[0, full] = np.add.reduceat(mix(s, 1), starts)
                    sums[1, full] = np.bitwise_xor.reduceat(mix(s, 2), starts)
                sig = super_minhash(rows, s, n, m)
                keys = np.zeros((n, bands), U)
                for b in range(bands):
                    h = np.full(n, U(b))
                    for p in range(b * width, (b + 1) * width):
                        h = mix(h * U(0x2545F4914F6CDD1D) ^ sig[:, p])
                    keys[:, b] = h
                short = (sig & U(255)).astype(np.uint8)
                cells = np.bincount(rows * CELLS + (s >> U(56)).astype(np.int64), minlength=n * CELLS).reshape(n, CELLS)
                cells = np.minimum(cells, 255).astype(np.uint8)
                full_bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, n), pa.array(size.astype(np.int64)), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), full_bands,
                     pa.array([x.tobytes() for x in short], pa.binary()), pa.array([x.tobytes() for x in cells], pa.binary())],
                    ["doc_id", "n_shingles", "f1", "f2", "bands", "sig", "cells"])

    return run


def signatures(docs: DataFrame, k: int, m: int = PLACES, bands: int = BANDS) -> DataFrame:
    """``doc_id, n_shingles, f1, f2`` (fingerprint of the set)``, bands, sig`` (low bytes of the signature)``, cells`` (shingles by cell)."""
    schema = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sig binary, cells binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sign(k, m, bands), schema)


def _likely(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
                near = pa.array((x == y).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])

    return run


def _across(least: int, percent: int):
    """Pairs of one block that could be links: of different groups, first met in this band, close by signature and by cells."""
    def run(block: pa.Table) -> pa.Table:
        n = block.num_rows
        ids, group, size, part = (block[c].to_numpy() for c in ("rep", "group", "n_shingles", "part"))
        lo, hi = block["lo"][0].as_py(), block["hi"][0].as_py()
        bands = block["bands"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        sig, cells = (np.frombuffer(b"".join(block[c].to_pylist()), np.uint8).reshape(n, -1) for c in ("sig", "cells"))
        earlier = bands[:, :int(np.flatnonzero(bands[0] == block["band"][0].as_py())[0])]
        right = np.flatnonzero(part == hi)
        found_a, found_b = [], []
        for i in np.flatnonzero(part == lo).tolist():
            at = right[(group[right] != group[i]) & (100 * np.minimum(size[right], size[i]) >= percent * np.maximum(size[right], size[i]))]
            if lo == hi:
                at = at[at > i]
            at = at[(sig[at] == sig[i]).sum(axis=1) >= least]
            at = at[~(earlier[at] == earlier[i]).any(axis=1)]
            shared = np.minimum(cells[at], cells[i]).sum(axis=1, dtype=np.int64)
            full = (cells[at].max(axis=1, initial=0) == 255) | (cells[i].max() == 255)
            at = at[full | (100 * shared >= percent * (size[at] + size[i] - shared))]
            found_a.append(np.minimum(ids[at], ids[i]))
            found_b.append(np.maximum(ids[at], ids[i]))
        return pa.table({"a": np.concatenate([*found_a, ids[:0]]), "b": np.concatenate([*found_b, ids[:0]])})

    return run


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).fill_null("") for c in (2, 3))
            good = np.zeros(batch.num_rows, bool)
            for i, j in chunks(left):
                n = j - i
                rows, s = shingle_sets(*data(left.slice(i, n)), k)
                size = np.bincount(rows, minlength=n)
                at = np.concatenate(([0], np.cumsum(size)))
                for p, q in chunks(right.slice(i, n)):
                    own, t = shingle_sets(*data(right.slice(i + p, q - p)), k)
                    sizes = np.bincount(own, minlength=q - p)
                    to = np.concatenate(([0], np.cumsum(sizes)))
                    for r in range(q - p):
                        x, y = s[at[p + r]:at[p + r + 1]], t[to[r]:to[r + 1]]
                        if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                            continue
                        both = np.concatenate((x, y))
                        both.sort(kind="stable")
                        shared = int((both[1:] == both[:-1]).sum())
                        good[i + p + r] = 100 * shared >= percent * (len(both) - shared)
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, m: int = PLACES, bands: int = BANDS) -> DataFrame:
    """A row per document: ``doc_id, n_shingles, component_id, kept``. Links join sets with 100 * intersection >= percent * union."""
    signed = settle(signatures(docs, k, m, bands), "signed")
    classes = settle(signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "f1", "f2").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("cells").alias("cells")), "classes")
    s = percent / 100
    least = max(0, int(m * s - 6 * (m * s * (1 - s)) ** 0.5))

    members = classes.select("rep", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = settle(members.join(shared, "band"), "members")
    central = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    first = members.join(central, "rep").groupBy("band").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("first"))
    sigs = classes.select("rep", "sig")
    ids = settle(members.select("rep").distinct(), "ids")  # of a known size: while they are few, the planner moves them and not the texts
    texts = settle(docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(ids, "rep", "left_semi"), "texts")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are links."""
        left, right = (t.toDF(side, x) for t, side, x in ((sigs, "a", "sa"), (sigs, "b", "sb")))
        likely = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_likely(least), "a long, b long")
        likely = settle(likely, "likely")
        left, right = texts.toDF("a", "ta"), texts.toDF("b", "tb")
        both = likely.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
        return settle(both.mapInArrow(_verify(k, percent), "a long, b long").distinct(), "links")

    star = members.join(first, "band").filter("rep <> first").select(F.least("first", "rep").alias("a"), F.greatest("first", "rep").alias("b"))
    stars = settle(star.distinct(), "stars")
    links = linked(stars)
    groups = settle(connected_components(links), "groups")
    placed = members.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", F.coalesce("component", "rep").alias("group"))
    split = placed.groupBy("band").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    split = split.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    placed = placed.join(split, "band").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    placed = placed.join(classes.select("rep", "n_shingles", "bands", "sig", "cells"), "rep")
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumns({"lo": F.least("part", "other").cast("int"), "hi": F.greatest("part", "other").cast("int")}).drop("parts", "other")
    across = dealt.groupBy("band", "lo", "hi").applyInArrow(_across(least, percent), "a long, b long")
    rest = across.join(stars, ["a", "b"], "left_anti")
    groups = connected_components(links.unionByName(linked(rest)))

    held = classes.select("n_shingles", "f1", "f2", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n_shingles", "f1", "f2", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "f1", "f2").join(held, ["n_shingles", "f1", "f2"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
