import math
import random
import re

import numpy as np
import pyarrow as pa


from vcat.llm import ordinal
from vcat.llm.textbytes import NOT_WORD, data, word_hashes


def test_slope_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    rows, places, grades = np.repeat(np.arange(30), 4), rng.integers(0, 8, 120), rng.integers(0, 3, 30)
    scale, p = rng.random(8), rng.standard_normal(10)
    loss, g = ordinal._loss(p, 8, rows, places, grades, scale, 0.5)
    for i in range(10):
        q = p.copy()
        q[i] += 1e-6
        assert abs((ordinal._loss(q, 8, rows, places, grades, scale, 0.5)[0] - loss) / 1e-6 - g[i]) < 1e-3


def test_features_are_distinct_and_per_text():
    rows, places = ordinal.features(*data(pa.array(["a A b", "", "b"])))
    words = [set(places[(rows == r) & (places < (1 << ordinal.BITS) - ordinal.SHAPES)]) for r in range(3)]
    assert [len(w) for w in words] == [2, 0, 1] and words[2] < words[0]


def _texts(n, seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(300)]
    bad, dull = ["vile", "rotten", "awful"], ["meh", "hmm"]
    rows = []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2])
        w = [rng.choice(pool) for _ in range(rng.randint(5, 200))]
        for _ in range(2):
            if grade < 2:
                w.insert(rng.randrange(len(w)), rng.choice(bad if grade == 0 else dull))
        rows.append((i, " ".join(w), grade))
    return rows


def test_held_out_accuracy_and_order(docs):
    rows = _texts(900, 3)
    d = docs(rows, "doc_id long, text string, grade int")
    model = ordinal.train(d, docs([(r[0], r[2]) for r in rows if r[0] < 600], "doc_id long, grade int"))
    assert (np.diff(model["cuts"]) > 0).all()
    out = {r.doc_id: r for r in ordinal.classify(d, model).collect()}
    test = [(g, out[i]) for i, _, g in rows if i >= 600]
    assert sum((r.tail >= 0.5) == (g == 2) for g, r in test) / len(test) > 0.9
    means = [np.mean([r.expected_grade for g, r in test if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]


def _plain_places(text):
    raw = (text or "").encode()
    words = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw)]
    n, solid = max(len(words), 1), max(len(re.findall(rb"[^ \t-\r]", raw)), 1)
    share = lambda kind: len(re.findall(kind, raw)) / solid
    shape = [share(rb"[A-Z]"), share(rb"[!-/:-@\[-`{-~]"), share(rb"[0-9]"), max(map(words.count, set(words)), default=0) / n, 1 - len(set(words)) / n,
             sum(a == b for a, b in zip(words, words[1:])) / n, 0.01 * len(raw) / n, 0.002 * len(words) / (raw.count(b"\n") + 1), 1e-4 * len(words)]
    size = 1 << ordinal.BITS
    places = {int(word_hashes(*data(pa.array([w.decode()])), NOT_WORD)[1][0]) % (size - ordinal.SHAPES) for w in set(words)}
    for k, x in enumerate(shape):
        reached = min(max(math.floor(math.log2(max(x, 1e-9)) + 10), 0), 16)
        places |= {size - ordinal.SHAPES + 32 * k + i for i in range(reached + 1)}
    return places


def test_scores_match_a_plain_version(docs):
    rng = random.Random(8)
    rows = _texts(400, 4)
    model = ordinal.train(docs(rows, "doc_id long, text string, grade int"), docs([(i, g) for i, _, g in rows], "doc_id long, grade int"))
    weights = dict(zip(model["places"].tolist(), model["weights"].tolist()))
    pool = ["vile", "Rotten", "meh", "HMM", "w1", "w2", "W3", "w299", "é1", "straße", "1,5", "--", "a_b", "\n", "\n\n", "\t", "x" * 300]
    texts = [None, "", " ", "\n", "vile", "meh " * 2000, "w1 " * 40_000] + ["".join(rng.choice(pool) + rng.choice([" ", "  ", ""]) for _ in range(rng.randint(1, 120))) for _ in range(200)]
    out = {r.doc_id: r for r in ordinal.classify(docs(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        score = sum(weights.get(p, 0.0) for p in _plain_places(text))
        below = [0.0, *(1 / (1 + math.exp(score - c)) for c in model["cuts"]), 1.0]
        mass = np.diff(below)
        assert abs(out[i].expected_grade - sum(k * m for k, m in enumerate(mass))) < 1e-9 and abs(out[i].tail - mass[2]) < 1e-9
        assert out[i].grade == mass.argmax() or np.ptp(np.sort(mass)[-2:]) < 1e-9


def test_nulls_conflicts_and_empty_tables(docs):
    d = docs([(1, None, "x"), (None, "", "y"), (2, "a b", "z"), (2, "a b", "z")], "doc_id long, text string, tail string")
    for ratings in ([], [(1, None), (None, 2), (99, 1)], [(1, 2)]):
        out = ordinal.classify(d, ordinal.train(d, docs(ratings, "doc_id long, grade int"))).collect()
        assert len(out) == 4 and all(0 <= r.tail <= 1 for r in out)
    assert ordinal.classify(d.limit(0), ordinal.train(d.limit(0), docs([(1, 0)], "doc_id long, grade int"))).count() == 0


def test_given_tables(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rated = labels.withColumn("grade", ordinal.rating())
    model = ordinal.train(d.select("doc_id", "text"), rated.filter("doc_id % 4 <> 0"))
    out = ordinal.classify(d, model).join(rated.filter("doc_id % 4 = 0").select("doc_id", "quality", "toxic"), "doc_id").collect()
    clean = [r.tail >= 0.5 for r in out if r.quality == 1 and r.toxic == 0]
    assert sum(clean) / len(clean) > 0.95
