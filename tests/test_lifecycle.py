"""Invariants of the version lifecycle."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from vcat.operators import lifecycle as L
from vcat.operators import redact as R
from vcat.plans import fixtures as fx
from vcat.plans import q_lifecycle as Q
from vcat.sources.publish import settle

KEY = Q.KEY


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_build_then_rollback_returns_the_previous_state(spark):
    level = Q.stored(spark, SF)
    after = L.apply_version(level, L.classify(level, Q.offered(spark, SF, 2), KEY), KEY, "instance", 2)
    cols = ["sop", "uuid", "init_version", "rev_version", "final_version"]
    back, _ = L.rollback({"instance": after}, {}, ["instance"], 2)
    assert as_set(back["instance"].select(cols)) == as_set(level.select(cols))


def test_same_sources_change_nothing(spark):
    level = Q.stored(spark, SF)
    status = L.classify(level, Q.offered(spark, SF, 1), KEY)
    assert [r.status for r in status.select("status").distinct().collect()] == ["unchanged"]
    after = L.apply_version(level, status, KEY, "instance", 2)
    assert as_set(after.select("uuid", "final_version")) == as_set(level.select("uuid", "final_version"))


def test_one_live_row_per_object_and_version(spark):
    level = Q.stored(spark, SF)
    after = L.apply_version(level, L.classify(level, Q.offered(spark, SF, 2), KEY), KEY, "instance", 2)
    for v in (1, 2):
        from vcat.functions.exprs import alive_at

        assert after.filter(alive_at(v)).groupBy(*KEY).count().filter("count > 1").count() == 0


def test_redacting_nothing_changes_no_hash(spark):
    lv, ed = fx.levels(spark, SF), fx.edges(spark, SF)
    none = fx.redactions(spark, SF).filter("false")
    ser = lv["series"]
    out = R.redact_level(ser, ed["series_instance"], lv["instance"], none, 2, ("series", "instance"), ("se", "i"), "m")
    assert as_set(out.select("uuid", "hashes.all", "redacted")) == as_set(ser.select("uuid", "hashes.all", "redacted"))


def test_classes_add_up(spark):
    n = {r.status: r["count"] for r in Q.v1(spark, SF).groupBy("status").count().collect()}
    assert sum(n.values()) == fx.items(spark, SF).filter("p1 OR p2").count()
    assert set(n) == {"new", "retired", "revised", "unchanged"}


def test_skipped_source_keeps_an_object(spark):
    h = "struct<src_a:string,src_b:string>"
    b = "struct<src_a:boolean,src_b:boolean>"
    prev = spark.createDataFrame([("x", "u1", 1, ("h", ""), (True, False)), ("y", "u2", 1, ("h", "g"), (True, True))],
                                 f"k string, uuid string, init_version int, hashes {h}, sources {b}")
    src = spark.createDataFrame([("z", ("h", ""), (True, False))], f"k string, hashes {h}, sources {b}")
    skip = spark.createDataFrame([("x", (True, False)), ("y", (True, False)), ("z", (True, False))], f"k string, skipped {b}")
    got = {r.k: r.status for r in L.classify(prev, src, ["k"], skip, ["k"]).collect()}
    # x can not be asked for, y lost its other source, z is offered by the skipped source only
    assert got == {"x": "unchanged", "y": "revised"}


def test_empty_and_md5_of_nothing_are_equal(spark):
    df = spark.createDataFrame([("", "d41d8cd98f00b204e9800998ecf8427e"), (None, ""), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(L.same_hash(F.col("a"), F.col("b"))).collect()] == [True, True, False]


def _build(*args):
    return L.build_version(*args, settle=settle)


def _empty(spark, path):
    out = {}
    for i, (name, _) in enumerate(path):
        keys = ", ".join(f"{k} string" for _, k in path[:i + 1])
        hashes = "src_a: string, src_b: string" + ("" if i == len(path) - 1 else ", all: string")
        more = ", size int, excluded boolean" if i == len(path) - 1 else ""
        out[name] = spark.createDataFrame([], f"{keys}, uuid string, hashes struct<{hashes}>, sources struct<src_a: boolean, src_b: boolean>, "
                                              f"init_version int, rev_version int, final_version int{more}")
    return out


def test_build_noop_skip_and_rollback(spark):
    path = [("collection", "c"), ("series", "s"), ("instance", "i")]
    schema = "c string, s string, i string, hashes struct<src_a: string, src_b: string>, sources struct<src_a: boolean, src_b: boolean>, size int"
    row = lambda c, s, i, a="", b="", size=1: (c, s, i, (a, b), (a != "", b != ""), size)
    one = spark.createDataFrame([row("c1", "s1", "i1", "h1"), row("c1", "s1", "i2", "h2"), row("c1", "s2", "i3", "", "g3"), row("c2", "s3", "i4", "h4")], schema)
    keep = lambda rows: {n: spark.createDataFrame(rows[n].collect(), rows[n].schema) for n, _ in path}
    first = keep(_build(_empty(spark, path), one, path, 1)[0])
    assert {n: first[n].count() for n, _ in path} == {"collection": 2, "series": 3, "instance": 4}
    skip = spark.createDataFrame([("s1", (True, False))], "s string, skipped struct<src_a: boolean, src_b: boolean>")
    for args in ((), (skip, ["s"])):
        again = _build(first, one, path, 2, *args)[0]
        assert all(sorted(map(str, again[n].collect())) == sorted(map(str, first[n].select(*again[n].columns).collect())) for n, _ in path)

    two = spark.createDataFrame([row("c1", "s1", "i1", "new", size=9), row("c1", "s2", "i3", "", "g3"), row("c3", "s5", "i5", "h5")], schema)
    rows, edges = _build(first, two, path, 2)
    second = keep(rows)
    live = {r.i: (r.hashes.src_a, r.size, r.excluded) for r in second["instance"].filter("final_version = 0").collect()}
    assert live == {"i1": ("new", 9, False), "i3": ("", 1, False), "i5": ("h5", 1, False)}
    assert {r.s: r.final_version for r in second["series"].filter("rev_version = 1").collect()} == {"s1": 1, "s2": 0, "s3": 1}
    assert sorted(r.c for r in second["collection"].filter("final_version = 0").collect()) == ["c1", "c3"]
    assert edges["version_collection"].count() == 2 and edges["series_instance"].count() == 2
    # with its source skipped, what can't be asked stays
    held = _build(first, two, path, 2, skip, ["s"])[0]["instance"].filter("final_version = 0 AND s = 's1'").collect()
    assert sorted((r.i, r.hashes.src_a) for r in held) == [("i1", "h1"), ("i2", "h2")]
    back, _ = L.rollback(second, {f"{a}_{b}": edges[f"{a}_{b}"] for a, b in (("collection", "series"), ("series", "instance"))}, ["collection", "series", "instance"], 2)
    for n, _ in path:
        assert sorted(map(str, back[n].collect())) == sorted(map(str, first[n].select(*back[n].columns).collect()))


def test_noop_compares_version_rows_of_builds(spark, monkeypatch):
    built = []

    def build(levels, offered, path, version, settle=None, **_):
        built.append(version)
        return {"version": spark.sql(f"SELECT {version} AS version, named_struct('all', '{'x' if len(built) < 3 else 'y'}') AS hashes")}, {}

    monkeypatch.setattr(Q.L, "build_version", build)
    assert {r.pair: r.noop for r in Q.v14(spark, SF).collect()} == {"same": True, "other": False}
    assert built == [1, 2, 2]


_PATH3 = [("collection", "c"), ("series", "s"), ("instance", "i")]
_HASHES, _HAS = "hashes struct<src_a: string, src_b: string>", "sources struct<src_a: boolean, src_b: boolean>"


def _full_levels(spark):
    """No rows yet, with all attributes that a catalogue has."""
    span = "init_version int, rev_version int, final_version int"
    whole = f"hashes struct<src_a: string, src_b: string, all: string>, {_HAS}, {span}"
    stamps = "min_timestamp string, max_timestamp string"
    return {"collection": spark.createDataFrame([], f"c string, uuid string, {whole}, {stamps}, collection_id string"),
            "series": spark.createDataFrame([], f"c string, s string, uuid string, {whole}, {stamps}, series_instances bigint, source_doi string, excluded boolean"),
            "instance": spark.createDataFrame([], f"c string, s string, i string, uuid string, {_HASHES}, {_HAS}, {span}, timestamp string, size int")}


def _offer(spark, *rows):
    """rows: c, s, i, hash at the first source, timestamp."""
    return spark.createDataFrame([(c, s, i, (h, ""), (True, False), t, 1) for c, s, i, h, t in rows], f"c string, s string, i string, {_HASHES}, {_HAS}, timestamp string, size int")


def _told(spark, **names):
    return {"collection": spark.createDataFrame(list(names.items()), "c string, collection_id string"),
            "series": spark.createDataFrame([("c1", "s1", "doi1"), ("c1", "s9", "doi9"), ("c2", "s2", "doi2")], "c string, s string, source_doi string")}


def test_build_carries_attributes_and_renames(spark):
    one = _offer(spark, ("c1", "s1", "i1", "h1", "t1"), ("c2", "s2", "i2", "h2", "t1"))
    args = {"names": {"collection": "collection_id"}, "settle": settle}
    first, _ = L.build_version(_full_levels(spark), one, _PATH3, 1, attributes=_told(spark, c1="One", c2="Two"), **args)
    two = _offer(spark, ("c1", "s1", "i1", "h1", "t9"), ("c1", "s1", "i3", "h3", "t2"), ("c1", "s9", "i9", "h9", "t3"), ("c2", "s2", "i2", "h2", "t1"))
    rows, edges = L.build_version(first, two, _PATH3, 2, attributes=_told(spark, c1="One", c2="second"), **args)
    series = {(r.s, r.rev_version): (r.series_instances, r.min_timestamp, r.max_timestamp, r.source_doi, r.excluded, r.final_version) for r in rows["series"].collect()}
    assert series == {("s1", 1): (1, "t1", "t1", "doi1", False, 1), ("s1", 2): (2, "t1", "t2", "doi1", False, 0), ("s9", 2): (1, "t3", "t3", "doi9", False, 0),
                      ("s2", 1): (1, "t1", "t1", "doi2", False, 0)}
    colls = {(r.c, r.rev_version): (r.collection_id, r.init_version, r.final_version, r.max_timestamp, r.hashes.all) for r in rows["collection"].collect()}
    # the renamed one: a revised row with the same hash, first version and children
    assert colls["c2", 2] == ("second", 1, 0, "t1", colls["c2", 1][4]) and colls["c2", 1][:3] == ("Two", 1, 1)
    assert colls["c1", 2][:4] == ("One", 1, 0, "t3")
    version = rows["version"].first()
    assert (version.min_timestamp, version.max_timestamp) == ("t1", "t3")
    renamed = {r.uuid for r in rows["collection"].filter("c = 'c2' AND rev_version = 2").collect()}
    child = {r.uuid for r in rows["series"].filter("s = 's2'").collect()}
    assert {(r.collection_uuid, r.series_uuid) for r in edges["collection_series"].collect()} >= {(a, b) for a in renamed for b in child}


def _announce(rows):
    return {n: rows[n].filter("final_version = 0").select(*[k for _, k in _PATH3[:d + 1]], "hashes", "sources") for d, (n, _) in enumerate(_PATH3[:-1])}


def test_pruned_build_and_announced_hashes(spark):
    one = _offer(spark, *((c, f"{c}.{s}", f"{c}.{s}.{i}", f"h{c}{s}{i}", "t1") for c in ("c1", "c2", "c3") for s in range(2) for i in range(2)))
    first, _ = L.build_version(_full_levels(spark), one, _PATH3, 1)
    two = one.filter("i <> 'c2.1.0'").withColumn("hashes", F.when(F.col("i") == "c1.0.0", F.struct(F.lit("new").alias("src_a"), F.lit("").alias("src_b"))).otherwise(F.col("hashes")))
    whole, whole_edges = L.build_version(first, two, _PATH3, 2)
    announced = _announce(whole)
    front = L.changed_parents(first, announced, _PATH3, settle)
    assert sorted(r.s for r in front.collect()) == ["c1.0", "c2.1"]
    # below unchanged parents the offer is not looked at: wrong rows there make no difference
    beside = two.withColumn("hashes", F.when(F.col("c") == "c3", F.struct(F.lit("x").alias("src_a"), F.lit("").alias("src_b"))).otherwise(F.col("hashes")))
    pruned, edges = L.build_version(first, beside, _PATH3, 2, announced=announced)
    for n, _ in _PATH3:
        assert as_set(pruned[n].select(F.to_json(F.struct(*sorted(pruned[n].columns))))) == as_set(whole[n].select(F.to_json(F.struct(*sorted(pruned[n].columns)))))
    for n, e in whole_edges.items():
        assert as_set(e) == as_set(edges[n].select(*e.columns))
    lie = announced["series"].withColumn("hashes", F.when(F.col("s") == "c1.0", F.struct(F.lit("no").alias("src_a"), F.lit("").alias("src_b"), F.lit("no").alias("all"))).otherwise(F.col("hashes")))
    with pytest.raises(L.BuildError, match="series: 1 rows"):
        L.build_version(first, two, _PATH3, 2, announced={**announced, "series": lie})
