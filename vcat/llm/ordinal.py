"""Quality classifier by ordinal regression (operator 4).

Ratings are grades 0, 1, 2, ...; a text has one latent score, the sum of the weights of its hashed features, and grade <= k has the probability
1 / (1 + exp(score - threshold_k)). All thresholds share the weights and are kept in order. The expected grade ranks texts; the tail
probability P(grade >= k) selects them.

Features are the distinct words (A to Z lower-cased) and buckets of a few shape figures (share of capitals, marks, digits, repeated words; lengths
of words, lines, text), hashed into ``2^bits`` places; only places seen in ``least_docs`` rated texts get a weight, so that words of one text teach nothing.

The fit takes at most ``most_rated`` rated documents, those with the smallest hash of their id; it is one task over that bounded sample. Scoring
runs over all texts; the weights it broadcasts have at most ``2^bits`` entries.

Defined results: null or empty text: scored by its shape alone. Several ratings of one id: the lowest. Ratings without a document, null ids or
grades: not used. No rating at all: weights are zero and every tail probability is 1. Repeated rows: each scored. Columns of ``classify``'s results replace
columns of the same name; others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.llm.textbytes import NOT_WORD, U, WHITE, chunks, data, word_hashes

BITS = 20
#: Places at the end, for buckets of shape figures.
SHAPES = 512
MOST_RATED = 12_000
LEAST_DOCS = 8
_KINDS = np.zeros(256, np.int8)  # 1 capital, 2 mark, 3 digit
_KINDS[65:91] = 1
_KINDS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
_KINDS[48:58] = 3


def features(raw: np.ndarray, ends: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the distinct features of each text."""
    n = len(ends) - 1
    rows, h = word_hashes(raw, ends, NOT_WORD)
    count = np.bincount(rows, minlength=n)
    at = np.concatenate(([0], np.cumsum(count)))
    again = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    for r in np.flatnonzero(count):
        h[at[r]:at[r + 1]].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    owner, words = rows[new], h[new]
    distinct = np.bincount(owner, minlength=n)
    # longest run of one word, as it is sorted
    begin = np.flatnonzero(new)
    runs = np.diff(np.concatenate((begin, [len(h)])))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, runs)
    length = np.diff(ends)
    per = lambda x: np.divide(x, np.maximum(length - _in(WHITE[raw], ends), 1))
    kinds = _KINDS[raw]
    lines = np.maximum(_in(raw == 10, ends) + 1, 1)
    same = np.zeros(n, np.int64)  # words that repeat the one before
    np.add.at(same, rows[1:][again], 1)
    words_of = np.maximum(count, 1)
    shape = [*(per(_in(kinds == k, ends)) for k in (1, 2, 3)), top / words_of, 1 - distinct / words_of, same / words_of, 0.01 * length / words_of,
             0.002 * count / lines, 1e-4 * count]
    parts, owners = [words % U((1 << bits) - SHAPES)], [owner]
    for k, x in enumerate(shape):  # a place for each power of two that the figure reaches
        level = np.clip(np.floor(np.log2(np.maximum(x, 1e-9)) + 10), 0, 16).astype(np.int64)
        steps = np.concatenate([np.arange(v + 1) for v in level]) if n else level
        parts.append(steps.astype(U) + U((1 << bits) - SHAPES + 32 * k))
        owners.append(np.repeat(np.arange(n), level + 1))
    place, owner = np.concatenate(parts).astype(np.int64), np.concatenate(owners)
    both = np.unique(owner << bits | place)
    return both >> bits, both & ((1 << bits) - 1)


def _in(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int32 if len(mask) < 1 << 31 else np.int64)
    np.cumsum(mask, out=sums[1:])
    return (sums[ends[1:]] - sums[ends[:-1]]).astype(np.int64)


def _probabilities(score: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """P(grade <= k) for each threshold."""
    return 1 / (1 + np.exp(np.clip(score[:, None] - cuts[None], -40, 40)))


def _loss(p: np.ndarray, width: int, rows: np.ndarray, places: np.ndarray, grades: np.ndarray, scale: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Negative log likelihood plus penalty, and its slope. ``p``: weights, the first threshold, logarithms of the steps to the others."""
    n, line = len(grades), np.arange(len(grades))
    w, free = p[:width], p[width:]
    cuts = np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))
    c = _probabilities(np.bincount(rows, weights=(w * scale)[places], minlength=n), cuts)
    c = np.concatenate((np.zeros((n, 1)), c, np.ones((n, 1))), axis=1)
    slope = c * (1 - c)
    hi, lo = slope[line, grades + 1], slope[line, grades]
    mass = np.maximum(c[line, grades + 1] - c[line, grades], 1e-12)
    by_cut = np.zeros((n, len(cuts) + 2))
    by_cut[line, grades + 1] -= hi / mass
    by_cut[line, grades] += lo / mass
    later = np.cumsum(by_cut[:, 1:-1].sum(axis=0)[::-1])[::-1]
    by_weight = np.bincount(places, weights=((hi - lo) / mass)[rows], minlength=width) * scale + penalty * w
    return -np.log(mass).sum() + penalty / 2 * (w @ w), np.concatenate((by_weight, later[:1], later[1:] * np.exp(free[1:])))


def fit(rows: np.ndarray, places: np.ndarray, grades: np.ndarray, scale: np.ndarray, penalty: float = 0.5, rounds: int = 80, memory: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Weights by place, thresholds. ``places`` count from 0 without gaps; ``scale``: how much a place may say. Limited-memory quasi-Newton steps on the whole sample."""
    n, top, width = len(grades), int(grades.max()), int(places.max()) + 1
    share = np.clip([(grades <= k).mean() for k in range(top)], 1 / (2 * n), 1 - 1 / (2 * n))
    start = np.log(share / (1 - share))
    p = np.concatenate((np.zeros(width), [start[0]], np.log(np.maximum(np.diff(start), 1e-3))))
    loss, g = _loss(p, width, rows, places, grades, scale, penalty)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        d, alphas = g.copy(), []
        for s, y, r in reversed(past):
            alphas.append(r * (s @ d))
            d -= alphas[-1] * y
        d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(g).sum() ** 0.5)
        for (s, y, r), alpha in zip(past, reversed(alphas)):
            d += (alpha - r * (y @ d)) * s
        step = 1.0
        while step > 1e-6:
            q = p - step * d
            after, h = _loss(q, width, rows, places, grades, scale, penalty)
            if np.isfinite(after) and after <= loss - 1e-4 * step * (g @ d):
                break
            step /= 2
        else:
            break
        if (h - g) @ (q - p) > 1e-10:
            past = [*past[1 - memory:], (q - p, h - g, 1 / ((h - g) @ (q - p)))]
        done = loss - after < 1e-5 * loss
        p, loss, g = q, after, h
        if done:
            break
    free = p[width:]
    return p[:width] * scale, np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def _featurize(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for i, j in chunks(texts):
                rows, places = features(*data(texts.slice(i, j - i)), bits)
                at = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.ListArray.from_arrays(pa.array(at), pa.array(places.astype(np.int32)))],
                                                 ["doc_id", "grade", "places"])

    return run


def rarity(docs: np.ndarray, n: int, shape: np.ndarray) -> np.ndarray:
    """Places of words count by how rare they are, so that the common words of long texts don't add up; those of shape count whole."""
    return np.where(shape, 1.0, np.log(n / docs) / np.log(n))


def _train(least_docs: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        t = pa.Table.from_batches(kept).combine_chunks().sort_by("doc_id")
        lists, grades = t["places"].combine_chunks(), t["grade"].to_numpy()
        places = lists.flatten().to_numpy()
        rows = np.repeat(np.arange(len(t)), np.asarray(lists.value_lengths()))
        seen, at, docs = np.unique(places, return_inverse=True, return_counts=True)
        good = docs[at] >= least_docs
        seen, at, docs = np.unique(places[good], return_inverse=True, return_counts=True)
        if not len(seen) or not grades.max():
            return
        weights, cuts = fit(rows[good], at, grades, rarity(docs, len(t), seen >= (1 << bits) - SHAPES))
        yield pa.RecordBatch.from_arrays([pa.array([seen.astype(np.int32)]), pa.array([weights]), pa.array([cuts])], ["places", "weights", "cuts"])

    return run


def train(docs: DataFrame, ratings: DataFrame, bits: int = BITS, most_rated: int = MOST_RATED, least_docs: int = LEAST_DOCS) -> dict:
    """Model of ``ratings`` (doc_id, grade) on the texts of ``docs``."""
    rated = ratings.select(F.col("doc_id").cast("long"), F.col("grade").cast("int")).dropna().groupBy("doc_id").agg(F.min("grade").alias("grade"))
    sample = F.broadcast(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rated))  # the bound of the sample
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(sample, "doc_id").select("doc_id", "text", "grade")
    found = texts.mapInArrow(_featurize(bits), "doc_id long, grade int, places array<int>").repartition(1)
    got = found.mapInArrow(_train(least_docs, bits), "places array<int>, weights array<double>, cuts array<double>").collect()
    if not got:
        return {"bits": bits, "places": np.zeros(0, np.int64), "weights": np.zeros(0), "cuts": np.array([-40.0])}
    return {"bits": bits, "places": np.array(got[0]["places"], np.int64), "weights": np.array(got[0]["weights"]), "cuts": np.array(got[0]["cuts"])}


def _score(model, at_least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        bits, cuts = m["bits"], m["cuts"]
        weights = np.zeros(1 << bits)
        weights[m["places"]] = m["weights"]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).fill_null("")
            for i, j in chunks(texts):
                rows, places = features(*data(texts.slice(i, j - i)), bits)
                below = _probabilities(np.bincount(rows, weights=weights[places], minlength=j - i), cuts)
                mass = np.diff(np.concatenate((np.zeros((j - i, 1)), below, np.ones((j - i, 1))), axis=1), axis=1)
                k = min(at_least, len(cuts))
                own = [pa.array((1 - below).sum(axis=1)), pa.array(1 - below[:, k - 1]), pa.array(mass.argmax(axis=1).astype(np.int32))]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, *own], [*part.schema.names, "expected_grade", "tail", "grade"])

    return run


def classify(docs: DataFrame, model: dict, at_least: int = 2) -> DataFrame:
    """``docs`` with ``expected_grade``, ``tail`` = P(grade >= at_least) and the most likely ``grade``."""
    docs = docs.drop(*(c for c in docs.columns if c.lower() in ("expected_grade", "tail", "grade")))
    schema = T.StructType([*docs.schema.fields, T.StructField("expected_grade", T.DoubleType()), T.StructField("tail", T.DoubleType()), T.StructField("grade", T.IntegerType())])
    return docs.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), at_least), schema)


def rating() -> Column:
    """Grade of a row of labels: 0 toxic, 1 poor, 2 clean."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
