"""Matching of file names by suffix, against a plain version."""

import random

import pytest

from vcat.operators.metadata import match_by_suffix


def plain(files, urls):
    turn = str.maketrans("/-", "__")
    fits = lambda f, u: f == u or f.endswith("_" + u)
    return sorted((f, u) for f in files for u in urls if f is not None and u is not None and fits(f.translate(turn), u.translate(turn)))


def matched(spark, files, urls):
    out = match_by_suffix(spark.createDataFrame([(f,) for f in files], "file string"), spark.createDataFrame([(u,) for u in urls], "url string"))
    return sorted((r.file, r.url) for r in out.select("file", "url").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_nested_urls_over_many_ranges(spark, seed):
    rnd = random.Random(seed)
    name = lambda most: "".join(rnd.choice(["a", "b", "bb", "", "é", "x.svs"]) + rnd.choice("/-_") for _ in range(rnd.randint(0, most))) + rnd.choice(["a", "b", "x.svs"])
    files, urls = [name(5) for _ in range(400)], [name(3) for _ in range(80)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert matched(spark, files, urls) == plain(files, urls)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_empty_names_repeats_and_empty_tables(spark):
    files = [None, "", "a/", "a/b", "a/b", "c-a_b", "b", "xb", "a//b"]
    urls = [None, "", "b", "b", "a-b", "/b", "a/b/"]
    assert matched(spark, files, urls) == plain(files, urls)
    assert matched(spark, files, []) == [] == matched(spark, [], urls)


def test_names_of_many_parts(spark):
    """A name of 2 000 parts beside urls of as many and of three."""
    long = "/".join(["p"] * 2_000)
    assert matched(spark, [f"q/{long}", "q/p"], [long, "p/p/p"]) == sorted([(f"q/{long}", long), (f"q/{long}", "p/p/p")])
