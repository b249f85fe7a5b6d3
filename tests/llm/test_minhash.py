import random

import numpy as np
import pyarrow as pa

from vcat.llm import minhash
from vcat.llm.components import connected_components
from vcat.llm.textbytes import NOT_WORD, WINDOW, chunks, data, shingle_sets, word_hashes

WHITE = " \t\n\v\f\r"


def words(t):
    out, w = [], ""
    for c in "".join(x.lower() if "A" <= x <= "Z" else x for x in t or "") + " ":
        if c in WHITE:
            out += [w] if w else []
            w = ""
        else:
            w += c
    return out


def shingles(t, k):
    w = words(t)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def plain(rows, k, percent):
    sets = {d: shingles(t, k) for d, t in rows if d is not None}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_words_of_windows_match_a_plain_split():
    rng = random.Random(1)
    texts = ["", "a", " A b ", "é x\tB\x1cz", "x" * (WINDOW + 10), ("w%d " % 7) * (WINDOW // 3), "Ab ab"] + ["".join(rng.choice("aB \n.é") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    rows, h = word_hashes(*data(pa.array(texts)))
    seen = {}
    for i, t in enumerate(texts):
        mine, own = h[rows == i].tolist(), words(t)
        assert len(mine) == len(own)
        for w, x in zip(own, mine):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    assert len(word_hashes(*data(pa.array(["a.b,c"])), NOT_WORD)[1]) == 3
    assert [j - i for i, j in chunks(pa.array([], pa.string()))] == []


def test_signature_agreement_estimates_similarity():
    rng = random.Random(2)
    pool = [f"w{i}" for i in range(4000)]
    errors = []
    for _ in range(40):
        base = rng.sample(pool, 300)
        other = base[:200] + rng.sample(pool, 100)
        rows, s = shingle_sets(*data(pa.array([" ".join(base), " ".join(other)])), 1)
        sig = minhash.super_minhash(rows, s, 2, 96)
        assert (sig >> np.uint64(32)).max() < 96
        true = len(set(base) & set(other)) / len(set(base) | set(other))
        errors.append((sig[0] == sig[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_early_stopping_changes_nothing_for_small_sets():
    rows, s = shingle_sets(*data(pa.array(["one", "", "a b c d"])), 1)
    sig = minhash.super_minhash(rows, s, 3, 16)
    assert (sig[1] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert sorted((sig[0] >> np.uint64(32)).tolist()) == list(range(16))  # one element: a permutation of all ranks


def test_groups_match_brute_force(docs):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(14):
        base = [rng.choice(pool) for _ in range(rng.choice([1, 3, 20, 60]))]
        for _ in range(rng.randint(1, 25)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 9))):
                w[rng.randrange(len(w))] = rng.choice(pool)
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \n", "solo", "SOLO", "é x"])]
    for k in (2, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs(rows), k, 80).collect()}
        assert got == plain(rows, k, 80)


def test_nulls_repeats_and_empty_table(docs):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (3, "a b c d"), (None, None)]
    out = sorted((-1 if r.doc_id is None else r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs(rows), 2).collect())
    assert out == [(-1, None, True), (-1, None, True), (3, 3, True), (5, 3, False), (5, 3, False)]
    assert minhash.near_duplicates(docs([]), 2).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(100, 160)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys([*range(100, 160), 200], 100), 300: 300, 301: 300, 302: 300}
    assert connected_components(df.limit(0)).count() == 0
