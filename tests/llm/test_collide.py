import decimal
import math
import random

import numpy as np

from vcat.llm import collide

SCHEMA = "vec_id long, label int, embedding array<float>, n_links int"


def plain(rows, least):
    good = {}
    for i, label, v, _ in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(np.array(v, np.float32), float))
    up, n = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in good:
        for b in good:
            (la, x), (lb, y) = good[a], good[b]
            if a < b and la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                n[a] += 1
                n[b] += 1
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (n[i], root(i)) for i in n}


def test_links_match_brute_force(docs):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(12):
        base = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 30))):
            v = base + rng.standard_normal(64) * rng.choice([0, 0.05, 0.1, 0.14, 0.2])
            rows.append((len(rows), int(c % 3), [float(x) for x in v * rng.choice([1, 2])], 0))
    odd = [(None, [1.0] * 64), (1, None), (1, [0.0] * 64), (1, []), (1, [math.nan] * 64), (1, [math.inf] + [1.0] * 63), (1, [None] + [1.0] * 63), (1, [1.0] * 8), (1, [1.0] * 8)]
    rows += [(len(rows) + i, label, v, 0) for i, (label, v) in enumerate(odd)]
    out = collide.near_vectors(docs(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == plain(rows, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_repeats_null_ids_and_empty_table(docs):
    v = [1.0, 2.0]
    out = collide.near_vectors(docs([(1, 0, v, 0), (1, 0, v, 0), (2, 0, v, 0), (None, 0, v, 0)], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in out) == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (0, 0, None, True)], key=str)
    assert collide.near_vectors(docs([], SCHEMA)).count() == 0


def test_labels_of_any_type_and_lengths_of_any_size(docs):
    v, w = [1.0, 2.0, -3.0], [1.0, 2.0, -2.9]
    for kind, (one, other) in {"double": (0.2, 0.7), "string": ("b,1", "b"), "decimal(38,0)": (10**30, 10**30 + 1), "boolean": (True, False), "long": (2**60, 2**60 + 1)}.items():
        if kind.startswith("decimal"):
            one, other = decimal.Decimal(one), decimal.Decimal(other)
        rows = [(1, one, v), (2, other, v), (3, one, w), (4, None, v)]
        out = collide.near_vectors(docs(rows, f"vec_id long, label {kind}, embedding array<double>")).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in out} == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (0, 4)}, kind
    rows = [(1, 0.0, [x * 1e200 for x in v]), (2, -0.0, [x * 1e-200 for x in w]), (3, 0.0, [x * 5e-324 for x in v]), (4, 0.0, [-x * 1e300 for x in v]), (5, math.nan, v), (6, math.nan, w)]
    out = collide.near_vectors(docs(rows, "vec_id long, label double, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


def test_calibrated_count_keeps_the_recall():
    rng = random.Random(1)
    p = math.erf(2 / math.sqrt(2))
    c = collide.calibrated_count(32, p, 0.999)
    hits = [sum(rng.random() < p for _ in range(32)) >= c for _ in range(4000)]
    assert sum(hits) / len(hits) > 0.995
