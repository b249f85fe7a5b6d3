"""Near-duplicate vectors by counting collisions of one-dimensional projections (operator 2).

Unit vectors are projected on ``m`` Gaussian directions. Two vectors at distance d differ by N(0, d^2) on each; they collide on one if
they differ by ``reach`` or less, that is, if one lies in the window centred on the other. The chance p of a collision is known
for the least similar pair sought, and the count a pair has to pass is the largest that such a pair reaches with the recall asked for.

A window on one projection still holds a fifth of all vectors. So projections are taken four at a time: a vector is indexed by its
cell on each of the four, cells two windows' reach wide, and asks the two cells its window meets on each; the sorted join on cells
compares the windows themselves as its condition. A pair missed by one group of four is found by another; all projections
then count. Pairs that pass are verified by cosine in double precision on the vectors as they are.

Equal vectors are one class, held by the smallest id, so copies are not expanded. Hot cells are split by adaptive skew joins.

Labels may be of any type that can be written as text; NaN equals NaN, and 0.0 equals -0.0. Vectors are scaled by powers of two, which changes no cosine,
so that lengths beyond the range of a double's square are compared too.

Defined results: null label, null vector, null or non-finite components, zero norm, no components: linked with nothing, but kept. Vectors of
other lengths than the label's partner don't link. Null id: component null, kept, no links. Repeated rows with equal ids: one vector.
Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.llm.common import settle
from vcat.llm.components import connected_components
from vcat.llm.textbytes import U, mix

LEADING = 4
#: Projections are kept as whole multiples of 1 / STEP.
STEP = 4096


def calibrated_count(m: int, p: float, recall: float) -> int:
    """The largest count that a pair colliding with chance ``p`` on each of ``m`` projections reaches with chance ``recall``."""
    tail = 0.0
    for c in range(m, -1, -1):
        tail += comb(m, c) * p**c * (1 - p) ** (m - c)
        if tail >= recall:
            return c
    return 0


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that their largest components are from 1/2 to 1."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=-1, keepdims=True))[1])


def _project(m: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, labels, vectors = batch.column(0), batch.column(1), batch.column(2)
            keep, bits, proj = [], [], []
            starts = np.asarray(vectors.offsets)
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components: NaN
            usable = (np.asarray(labels.is_valid()) & np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid()))
            for i in np.flatnonzero(usable):
                v = flat[starts[i]:starts[i + 1]]
                if not np.isfinite(v).all() or not v.any():
                    continue
                unit = _scaled(v)
                unit /= np.linalg.norm(unit)
                if len(v) not in directions:
                    directions[len(v)] = np.random.default_rng([seed, len(v)]).standard_normal((len(v), m))
                keep.append(i)
                bits.append(v.tobytes())
                proj.append(np.rint(unit @ directions[len(v)] * STEP).astype("<i2").tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(at), labels.take(at), pa.array(bits, pa.binary()), pa.array(proj, pa.binary())], ["vec_id", "label", "bits", "proj"])

    return run


def _cells(m: int, reach: int, groups: int, probes: bool):
    shifts = np.array([[i >> j & 1 for j in range(LEADING)] for i in range(2**LEADING)]) if probes else np.zeros((1, LEADING), int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                n = part.num_rows
                p = np.frombuffer(b"".join(part.column(3).to_pylist()), "<i2").reshape(n, m).astype(np.int64)
                label = np.asarray(part.column(1)).astype(U)
                size = np.array([len(x) for x in part.column(2).to_pylist()], U)
                for g in range(groups):
                    lead = p[:, g * LEADING:(g + 1) * LEADING]
                    low = (lead - reach if probes else lead) // (2 * reach)
                    cell = low[:, None, :] + shifts[None]
                    key = mix(label * U(groups) + U(g), 11)[:, None] ^ mix(size, 12)[:, None] + np.zeros(len(shifts), U)
                    for j in range(LEADING):
                        key = mix(key ^ cell[:, :, j].astype(U), 13 + j)
                    again = pa.array(np.repeat(np.arange(n), len(shifts)))
                    fixed = [pa.array(np.repeat(lead[:, j], len(shifts)).astype(np.int32)) for j in range(LEADING)]
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.full(n * len(shifts), g, np.int32)), part.column(0).take(again),
                                                      part.column(3).take(again), *fixed], ["key", "g", "id", "proj", *(f"p{j}" for j in range(LEADING))])

    return run


def _count(m: int, reach: int, least: int):
    """Pairs that collide often enough, in the first of the groups that found them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i2").reshape(n, m).astype(np.int32) for c in (3, 4))
            hit = np.abs(x - y) <= reach
            g = np.asarray(batch.column(0))
            found = hit[:, :m // LEADING * LEADING].reshape(n, -1, LEADING).all(axis=2)
            good = pa.array((hit.sum(axis=1) >= least) & (found.argmax(axis=1) == g))
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(good), batch.column(2).filter(good)], ["a", "b"])

    return run


def _cosine(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            left, right = (batch.column(c).to_pylist() for c in (2, 3))
            by_size: dict[int, list[int]] = {}
            for i, (x, y) in enumerate(zip(left, right)):
                if len(x) == len(y):
                    by_size.setdefault(len(x), []).append(i)
            for size, at in by_size.items():
                x, y = (_scaled(np.frombuffer(b"".join(s[i] for i in at)).reshape(len(at), size // 8)) for s in (left, right))
                dot = np.einsum("ij,ij->i", x, y)
                good[at] = dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))) >= least
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return run


def _label_text(vectors: DataFrame) -> Column:
    c = F.col("label")
    if isinstance(vectors.schema["label"].dataType, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # turns -0.0 to 0.0
    return c.cast("string")


def near_vectors(vectors: DataFrame, least: float = 0.98, m: int = 32, groups: int = 6, width: float = 2.0, recall: float = 0.9999, seed: int = 5) -> DataFrame:
    """A row per vector of ``vec_id, label, embedding``: ``vec_id, n_links, component_id, kept``. ``width``: the windows' reach in
    standard deviations of the least similar pair."""
    if groups * LEADING > m:
        raise ValueError("each group takes four of the projections")
    far = sqrt(2 - 2 * least)
    reach = max(1, round(width * far * STEP))
    count = calibrated_count(m, erf(width / sqrt(2)), recall)
    given = vectors.select(F.col("vec_id").cast("long"), _label_text(vectors).alias("label"), F.col("embedding").cast("array<double>"))
    known = settle(given.mapInArrow(_project(m, seed), "vec_id long, label string, bits binary, proj binary"), "projected")
    classes = settle(known.groupBy("label", "bits").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("copies"), F.first("proj").alias("proj")), "classes")

    reps = classes.select("rep", F.xxhash64("label").alias("label"), "bits", "proj")  # equal labels are asked for again below
    schema = "key long, g int, id long, proj binary, " + ", ".join(f"p{j} int" for j in range(LEADING))
    index, asked = (reps.mapInArrow(_cells(m, reach, groups, probes), schema) for probes in (False, True))
    x, y = asked.alias("x"), index.alias("y")
    window = [F.abs(F.col(f"x.p{j}") - F.col(f"y.p{j}")) <= reach for j in range(LEADING)]
    near = x.join(y, [F.col("x.key") == F.col("y.key"), F.col("x.g") == F.col("y.g"), F.col("x.id") < F.col("y.id"), *window])
    pairs = near.select("x.g", "x.id", "y.id", "x.proj", "y.proj").toDF("g", "a", "b", "pa", "pb").mapInArrow(_count(m, reach, count), "a long, b long")
    pairs = settle(pairs.distinct(), "pairs")
    left, right = (classes.select("rep", "bits", "label").toDF(side, f"v{side}", f"l{side}") for side in ("a", "b"))
    links = settle(pairs.join(right, "b").join(left, "a").filter("la = lb").select("a", "b", "va", "vb").mapInArrow(_cosine(least), "a long, b long").distinct(), "links")

    groups_of = connected_components(links)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(classes.select(F.col("rep").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    held = classes.select("label", "bits", "rep", "copies").join(others.withColumnRenamed("a", "rep"), "rep", "left").join(groups_of.withColumnRenamed("node", "rep"), "rep", "left")
    held = held.select("label", "bits", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    found = known.select("vec_id", "label", "bits").join(held, ["label", "bits"]).groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = given.select("vec_id").join(found, "vec_id", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))
