import hashlib
import random

import pytest
from pyspark.sql import functions as F

from vcat.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def run_up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def proof_of(levels, i):
    out = []
    for level in levels[:-1]:
        other = i ^ 1
        out += [level[other]] if other < len(level) else []
        i //= 2
    return out


def test_position_is_completion_order():
    for n in range(1, 40):
        log, open_ = [], []  # a builder that reads leaves one by one; open_: heights and nodes that wait
        made = [0] * 8
        for _ in range(n):
            node = (0, made[0])
            made[0] += 1
            log.append(node)
            open_.append(node)
            while len(open_) > 1 and open_[-1][0] == open_[-2][0]:
                hgt = open_.pop()[0] + 1
                open_[-1] = (hgt, made[hgt])
                made[hgt] += 1
                log.append(open_[-1])
        for hgt in range(1, (n - 1).bit_length() + 1):
            if n % (1 << hgt):
                log.append((hgt, n >> hgt))
        assert [manifest.position(a, j, n) for a, j in log] == list(range(len(log)))


@pytest.mark.parametrize("bits", [2, 10])
def test_against_plain_trees(docs, bits):
    rng = random.Random(bits)
    rows = [(rng.choice(["de", "en", "en", "en", None, "é"]), rng.choice([None, *range(40)]), h(str(rng.randrange(60))), rng.choice([None, None, "wrong"])) for _ in range(90)]
    rows.append(rows[0])
    df = docs(rows, "part string, id long, leaf string, forged string")
    built = manifest.build_manifest(df, bits)
    got = sorted((str(r.id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in manifest.check(built).collect())
    parts = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        parts.setdefault(r[0], []).append(r)
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = [run_up([r[2] for r in parts[p]]) for p in order]
    crown = run_up([t[-1][0] for t in trees])
    want = []
    for k, p in enumerate(order):
        for i, r in enumerate(parts[p]):
            proof = proof_of(trees[k], i) + proof_of(crown, k)
            again = [x[2] for x in parts[p]]
            again[i] = r[3] or r[2]
            tops = [t[-1][0] for t in trees]
            tops[k] = run_up(again)[-1][0]
            root = run_up(tops)[-1][0]
            want.append((str(r[1]), r[2], trees[k][-1][0], crown[-1][0], h(*proof), root, root == crown[-1][0]))
    assert [x[1:5] for x in got] == [x[1:5] for x in sorted(want)]
    assert sorted(x[5:] for x in got) == sorted(x[5:] for x in want)
    if bits == 2:  # the whole log: every node of every tree in its place
        log = built.tree.log().filter("part = 'en'").orderBy("position").collect()
        tree = trees[order.index("en")]
        assert [r.position for r in log] == list(range(sum(map(len, tree))))
        assert all(tree[r.height][r.node] == r.hash and manifest.position(r.height, r.node, len(tree[0])) == r.position for r in log)


def test_leaves_of_nulls_long_texts_and_no_rows(docs, spark):
    long = "é" * 500_000
    df = docs([(1, long), (None, None), (2, "")]).select("doc_id", manifest.leaf_hash(F.col("doc_id"), F.col("text")).alias("h"))
    got = {r.doc_id: r.h for r in df.collect()}
    assert got == {1: h("1:1", "1000000:", long), None: h("--"), 2: h("1:2", "0:")}
    none = docs([], "part string, id long, leaf string, forged string, root string")
    assert manifest.check(manifest.build_manifest(none)).count() == 0
