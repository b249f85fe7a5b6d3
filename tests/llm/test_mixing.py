import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vcat.llm import mixing


def plain_targets(size, weights=(3, 1, 2), share=1.5, most=2.0):
    """Shares out by weight, sets full sources to their limit and shares the excess among the others, until none is above."""
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total = share * sum(size.values())
    target = {s: total * w[s] / sum(w.values()) for s in order}
    full = set()
    while True:
        above = [s for s in order if s not in full and target[s] > most * size[s]]
        if not above:
            return target
        excess = sum(target[s] - most * size[s] for s in above)
        for s in above:
            target[s] = most * size[s]
        full |= set(above)
        left = sum(w[s] for s in order if s not in full)
        for s in order:
            if s not in full:
                target[s] += excess * w[s] / left


@pytest.mark.parametrize("block", [8, 4096])
def test_mix_meets_its_targets(docs, block):
    rng = random.Random(block)
    rows = [(i if i % 50 else None, None if i % 37 == 0 else "w " * rng.choice([0, 1, 3, 10, 60]) + " \t\x0b", "hot" if i % 3 == 0 else rng.choice([None, "", "é", "b", "tiny"] if i % 9 else ["c"]))
            for i in range(900)] + [(7, "a b c", "b")] * 3
    df = docs(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, block=block).collect()
    assert len(got) == len(rows)
    size, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        n = len((text or "").split())
        size[source] += n
        longest[source] = max(longest[source], n)
    want = plain_targets(size)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.times <= 2 and (r.size or not r.times)
        taken[r.source] += r.times * r.size
    for s in size:
        assert abs(taken[s] - want[s]) <= longest[s]
    again = mixing.mix(df.repartition(7), block=block).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_expectations_are_kept():
    rng, n = random.Random(5), 20_000
    size, chance = [9, 5, 5, 2, 1], [0.3, 0.5, 0.25, 0.9, 0.4]
    mean = [0.0] * 5
    for _ in range(n):
        x, held = mixing.round_pairs(size, chance, rng.random)
        assert sum(0 < v < 1 for v in x) <= 1 and abs(sum(a * s for a, s in zip(x, size)) - 8.65) < 1e-9
        if held is not None:
            x[held] = float(rng.random() < x[held])
        mean = [m + v / n for m, v in zip(mean, x)]
    assert max(abs(m - c) for m, c in zip(mean, chance)) < 0.015


def test_copies_and_no_rows(docs):
    df = docs([(i, "a b", "s", str(i)) for i in range(40)], "doc_id long, text string, source string, times string")
    out = mixing.copies(df, mixing.mix(df))
    assert out.columns == df.columns and out.count() == 60
    assert mixing.mix(docs([], "doc_id long, text string, source string")).count() == 0
    assert mixing.mix(docs([(1, None, "s")], "doc_id long, text string, source string")).collect()[0].times == 0
    long = docs([(1, "ab " * 300_000, "s")], "doc_id long, text string, source string").select(mixing.words(F.col("text"))).first()[0]
    assert long == 300_000
