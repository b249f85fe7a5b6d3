"""Ids and hashes are shuffled as narrow columns, and what was shuffled or read several times is so once."""

import hashlib

from pyspark.sql import functions as F

from tests.conftest import SF
from vcat.functions.exprs import pack_hash, pack_hashes, unpack_hash, unpack_hashes
from vcat.functions.merkle import merkle_rollup
from vcat.operators import flatten as FL
from vcat.operators import lifecycle as L
from vcat.operators import manifests as M
from vcat.operators import redact as R
from vcat.plans import fixtures as fx
from vcat.plans import load
from vcat.plans import q_flatten as QF
from vcat.plans.registry import QUERIES

load()
MD5 = [hashlib.md5(str(i).encode()).hexdigest() for i in range(4)]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hashes_come_back(spark):
    texts = [*MD5, MD5[0].upper(), MD5[0] + "\n", "", None, "x", "0" * 32, "sixteen-bytes-ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, h string")
    rows = df.select("n", "h", pack_hash("h").alias("k")).select("n", "h", "k", unpack_hash("k").alias("y")).orderBy("n").collect()
    assert [r.y for r in rows] == texts and len(rows[0].k) == 16
    assert len({bytes(r.k) for r in rows if r.k is not None}) == len(texts) - 1
    pairs = spark.createDataFrame([(0, ("a", MD5[0])), (1, (None, "")), (2, None)], "n int, hashes struct<src_a: string, all: string>")
    flat = pairs.select("n", *pack_hashes(pairs, "hashes", "h"))
    assert sorted(flat.select("n", unpack_hashes(flat.columns, "h").alias("hashes")).collect()) == sorted(pairs.collect())


def test_rollup_is_in_the_order_of_the_texts(spark):
    texts = [*MD5, "zz", "Z", "", None, "0" * 31, MD5[1]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, h string").withColumn("k", F.lit(1))
    out = merkle_rollup(df, ["k"], "h", tiebreak=["i"])
    assert out.first().hash == hashlib.md5("".join(sorted(t or "" for t in texts)).encode()).hexdigest()
    assert "unhex" in _plan(out)


def test_a_level_is_read_once_for_its_closed_and_its_born_rows(spark):
    ids = [f"0a000000-0000-0000-0000-00000000000{i}" for i in range(5)]
    level = spark.createDataFrame([("a", ids[0], 5), ("b", ids[1], 6), ("c", ids[2], 7), ("a", ids[0], 8), ("n", None, 9)], "k string, uuid string, size int").selectExpr(
        "k", "uuid", "1 AS init_version", "1 AS rev_version", "0 AS final_version", "size", "named_struct('src_a', md5(k), 'src_b', '') AS hashes")
    status = spark.createDataFrame([("a", "revised", ids[0], 1), ("b", "retired", ids[1], 1), ("d", "new", None, None), ("c", "unchanged", ids[2], 1)],
                                   "k string, status string, old_uuid string, old_init int").selectExpr("*", "named_struct('src_a', 'h', 'src_b', '') AS hashes")
    offer = spark.createDataFrame([("a", 50), ("a", 51), ("d", 60)], "k string, size int")
    out = L.apply_version(level, status, ["k"], "x", 2, offer)
    rows = sorted((r.k, r.rev_version, r.final_version, r["size"], r.hashes.src_a) for r in out.collect())
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert rows == sorted([("a", 1, 1, 5, md5("a")), ("a", 1, 1, 8, md5("a")), *[("a", 2, 0, n, "h") for n in (50, 50, 51, 51)], ("b", 1, 1, 6, md5("b")),
                           ("c", 1, 0, 7, md5("c")), ("d", 2, 0, 60, "h"), ("n", 1, 0, 9, md5("n"))])
    assert _plan(out).count("rev_version#") and _plan(out).count(" AS rev_version#") <= 4
    big = QUERIES["v5_v6_apply_version"](spark, SF)
    assert not any(f.endswith("/customer.parquet") for f in big.inputFiles())


def test_a_status_is_told_from_narrow_hashes(spark):
    from vcat.plans import q_lifecycle as QL

    assert _plan(L.classify(QL.stored(spark, SF), QL.offered(spark, SF, 2), QL.KEY)).count("unhex") >= 4


def test_flattened_rows_are_narrow_until_widened(spark):
    lv, ed = fx.levels(spark, SF), fx.edges(spark, SF)
    few = FL.all_flattened(lv, ed, narrow=True)
    assert dict(few.dtypes)["i_uuid"] == dict(few.dtypes)["st_hashes:all"] == "binary"
    assert FL.widened(few).schema == QF.flat(spark, SF).schema and "versioned_source_url" in QF.flat(spark, SF).columns
    assert FL.widened(FL.widened(few)).columns == QF.flat(spark, SF).columns


def test_images_meet_narrow_rows(spark):
    plan = _plan(QUERIES["n11_dicom_all"](spark, SF))
    assert "gs://" in plan and "gs://" not in plan[plan.index("Join Inner, (sop_instance_uid"):].replace("gs://in/", "")


def test_mutable_metadata_is_made_distinct_where_it_is(spark):
    df = QF.public(spark, SF, narrow=True)
    plan = FL.mutable_metadata(df, fx.license_lookup(spark))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(st_uuid" not in plan


def test_bundles_come_from_one_reading(spark):
    cols = "StudyInstanceUID string, study_uuid string, study_revised_version int, SeriesInstanceUID string, series_uuid string, series_revised_version int, instance_uuid string, collection_id string"
    aux = spark.createDataFrame([("st", "u", 2, "se", s, r, i, "c") for s, r in (("b", 2), ("a", 1)) for i in ("y", "x", "x")], cols)
    out = M.bundle_manifest(aux, 2, "p/")
    assert sorted(map(tuple, out.collect())) == [(1, "p/b", "[p/x,p/y]", "p/b"), (2, "p/u", "[p/a,p/b]", "p/u")]
    assert _plan(out).count("Aggregate [") == 1


def test_hierarchy_is_joined_once_for_urls_and_analysis_results(spark):
    for name in ("a11_ordered_url_list", "n15_analysis_metadata"):
        assert not any(f.endswith("/orders.parquet") for f in QUERIES[name](spark, SF).inputFiles())


def test_patched_hashes_are_narrow_in_the_joins(spark):
    keys = [k for _, k, _ in R.PATCHED]
    table = spark.createDataFrame([(1, "i1", *keys, *MD5), (2, None, *keys, "old", None, "", MD5[0])],
                                  ", ".join(["version int", "i_uuid string", *[f"{k} string" for k in keys], *[f"{h} string" for _, _, h in R.PATCHED]]))
    patch = spark.createDataFrame([(1, *keys, "z", MD5[3], "", None), (1, *keys, MD5[2], MD5[1], "", None)],
                                  ", ".join(["version int", *[f"{k} string" for k in keys], *[f"{h} string" for _, _, h in R.PATCHED]]))
    out = R.patch_hashes(table, patch)
    most = max(MD5[3], MD5[1])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "i1", *keys, "z", most, "", MD5[3]), (2, None, *keys, "old", None, "", MD5[0])], key=str)
    assert "unhex" in _plan(out)


def test_a_whole_snapshot_is_not_shuffled_again(spark):
    assert "Aggregate" not in _plan(QUERIES["t1_ingest_manifests"](spark, SF))
