"""Merkle roll-up against a plain Python loop, with one parent holding most of the rows."""

import hashlib
import random

from pyspark.sql import functions as F

from vcat.functions.merkle import merkle_by_source, merkle_rollup


def expected(rows):
    out = {}
    for k, h in rows:
        out.setdefault(k, []).append(h or "")
    return {k: hashlib.md5("".join(sorted(v)).encode()).hexdigest() if any(v) else "" for k, v in out.items()}


def rows_with_hot_parent():
    rng = random.Random(7)
    md5 = lambda x: hashlib.md5(str(x).encode()).hexdigest()
    rows = [(0, md5(i)) for i in range(40_000)]  # far more than one Arrow batch
    rows += [(0, md5("copy"))] * 25_000  # equal hashes of one parent
    rows += [(rng.randrange(1, 3000), md5(i)) for i in range(20_000)]
    rows += [(5000, None), (5001, ""), (5001, None), (5002, "")]
    rng.shuffle(rows)
    return rows


def test_rollup_equals_brute_force(spark):
    rows = rows_with_hot_parent()
    df = spark.createDataFrame([(k, h, i) for i, (k, h) in enumerate(rows)], "k bigint, h string, id bigint").repartition(6)
    for tiebreak in (None, ["id"]):
        got = {r["k"]: r["hash"] for r in merkle_rollup(df, ["k"], "h", tiebreak=tiebreak).collect()}
        assert got == expected(rows)


def test_hot_parent_is_spread_over_partitions(spark):
    df = spark.createDataFrame([(0, f"{i:032d}", i) for i in range(50_000)], "k bigint, h string, id bigint")
    placed = df.repartitionByRange(4, "k", "h", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(placed) == 4


def test_several_hashes_and_composite_keys(spark):
    rows = [("a", 1, "x", ""), ("a", 1, "w", "q"), ("a", 2, "", ""), (None, 1, "z", "z")]
    df = spark.createDataFrame(rows, "p string, n int, a string, b string")
    got = {(r.p, r.n): tuple(r.hashes) for r in merkle_by_source(
        df, ["p", "n"], {"src_a": F.col("a"), "src_b": F.col("b"), "all": F.concat("a", "b")}).filter("p IS NOT NULL").collect()}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert got == {("a", 1): (md5("wx"), md5("q"), md5("wqx")), ("a", 2): ("", "", "")}
