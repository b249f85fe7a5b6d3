"""What grows with the input is not written or shuffled more than the result needs."""

import json

from pyspark.sql import functions as F

from tests.conftest import SF
from vcat.functions.exprs import pack_id, unpack_id
from vcat.operators import flatten as FL
from vcat.operators import lifecycle as L
from vcat.operators import manifests as M
from vcat.operators import validate as V
from vcat.plans import documents as D
from vcat.plans import fixtures as fx
from vcat.plans import q_lifecycle as QL
from vcat.plans import q_redact as QR
from vcat.plans.q_flatten import flat


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_catalogue_is_read_from_the_base_tables(spark):
    tables = [fx.items(spark, SF), flat(spark, SF), QL.stored(spark, SF), *fx.levels(spark, SF).values(), *fx.edges(spark, SF).values()]
    assert all(f.startswith(f"file://{SF}/") for df in tables for f in df.inputFiles())


def test_flattened_columns_that_nobody_reads_are_not_joined(spark):
    plan = _plan(flat(spark, SF).select("source_doi"))
    assert "ingestion_url" not in plan and "hashes" not in plan


def test_withdrawn_levels_are_not_written(spark):
    out = QR.withdrawn(spark, SF)
    assert any(f.endswith("/lineitem.parquet") for f in out["instance"].inputFiles())
    assert any(f.endswith("/customer.parquet") for f in out["study"].inputFiles())


def test_nested_groups_are_built_after_the_aggregate(spark):
    for df in (D.reports(spark, SF), D.segmentation_docs(spark, SF)):
        at, below = _plan(df).split("Aggregate [", 1)[1].split("\n", 1)
        assert "collect_list" in at and "CodeMeaning" not in below


def test_old_ids_are_not_shuffled_for_a_status(spark):
    plan = _plan(L.classify(QL.stored(spark, SF), QL.offered(spark, SF, 2), QL.KEY).select(*QL.KEY, "status"))
    assert "_old_uuid" not in plan


def test_new_objects_do_not_meet_on_a_null_id(spark):
    level = spark.createDataFrame([("a", "u1", 1, 1, 0, 5), ("b", "u2", 1, 1, 0, 6), ("c", "u3", 1, 1, 0, 7)],
                                  "k string, uuid string, init_version int, rev_version int, final_version int, size int")
    status = spark.createDataFrame([("a", "revised", "u1", 1), ("b", "retired", "u2", 1), ("d", "new", None, None), ("e", "new", None, None)],
                                   "k string, status string, old_uuid string, old_init int")
    out = L.apply_version(level, status, ["k"], "x", 2)
    rows = sorted((r.k, r.init_version, r.rev_version, r.final_version, r["size"]) for r in out.collect())
    assert rows == [("a", 1, 1, 1, 5), ("a", 1, 2, 0, 5), ("b", 1, 1, 1, 6), ("c", 1, 1, 0, 7), ("d", 2, 2, 0, None), ("e", 2, 2, 0, None)]
    born = L.apply_version(level, status.filter(F.col("status") == "new"), ["k"], "x", 2)
    assert "isnotnull(old_uuid" in _plan(born)


def test_ids_are_shuffled_as_narrow_keys(spark):
    ids = ["0a1b2c3d-0000-1111-2222-333344445555", "0A1B2C3D-0000-1111-2222-333344445555", "0a1b2c3d000011112222333344445555", "u1", "", "é", None,
           "0a1b2c3d-0000-1111-2222-333344445555\n", "sixteen-bytes-ab", "zz1b2c3d-0000-1111-2222-333344445555", "\x00" * 17]
    keys = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, x string").select("n", "x", pack_id("x").alias("k"))
    rows = keys.select("n", "x", "k", unpack_id("k").alias("y")).orderBy("n").collect()
    assert [r.y for r in rows] == [r.x for r in rows] == ids
    assert len({bytes(r.k) for r in rows if r.k is not None}) == len(ids) - 1 and len(rows[0].k) == 16
    plan = flat(spark, SF).select("i_uuid", "se_uuid")._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan[plan.index("Join Inner"):]
    assert "unhex" in _plan(V.unique_ids(fx.levels(spark, SF)["series"]))


def test_urls_are_built_after_the_shuffle(spark):
    rows = [("s1", "i1", "g", "a"), ("s1", "i1", "g", "a"), ("s0", "i1", "g", "a"), ("s2", "i1", None, "a"), (None, "i1", "g", "b"), ("s1", None, "g", "a"),
            ("b/s1", "i2", "a", "c"), ("s1", "i2", "a/b", "c")]
    df = spark.createDataFrame(rows, "se_uuid string, i_uuid string, pub_gcs_bucket string, pub_aws_bucket string")
    out = M.url_lists(df, ["i_uuid"], {"url": lambda u: u, "old": lambda u: F.replace(u, F.lit("gs://g"), F.lit("gs://h"))})
    got = {r.i_uuid: (r.url, r.old) for r in out.collect()}
    assert got["i1"][0] == "[gs://g/s0/i1.dcm, s3://a/s0/i1.dcm, gs://g/s1/i1.dcm, s3://a/s1/i1.dcm]"
    assert got["i1"][1] == got["i1"][0].replace("gs://g", "gs://h") and got[None][0] == "[]" and got["i2"][0].count("gs://a/b/s1/i2.dcm") == 2
    assert "s3://" not in _plan(out).split("Aggregate [", 1)[1].split("\n", 1)[1]


def test_mutable_metadata_of_unknown_objects(spark):
    rows = [("st", "se", "i", "g", "a"), ("st", "se", "i", "g", "a"), ("st", None, "i", "g", "a"), ("st", None, "i", "h", "a"), (None, "se", "i", "g", None)]
    df = spark.createDataFrame(rows, "st_uuid string, se_uuid string, i_uuid string, pub_gcs_bucket string, pub_aws_bucket string").selectExpr(
        "*", "'Public' AS access", "'u' AS source_url", "'d' AS source_doi", "'d.v1' AS versioned_source_doi")
    lic = spark.createDataFrame([("d", "l", "s", "u")], "source_doi string, license_long_name string, license_short_name string, license_url string")
    out = FL.mutable_metadata(df, lic)
    got = sorted((r.crdc_study_uuid or "", r.crdc_series_uuid or "", r.gcs_url or "", r.aws_url or "") for r in out.collect())
    assert got == [("", "se", "gs://g/se/i.dcm", ""), ("st", "", "", ""), ("st", "se", "gs://g/se/i.dcm", "s3://a/se/i.dcm")]
    assert "Aggregate" in _plan(out) and "gs://" not in _plan(out).split("Aggregate [", 1)[1].split("\n", 1)[1]


def test_a_series_is_one_set_before_the_shuffle(spark):
    df = spark.createDataFrame([("se", "s", "b", "i2"), ("se", "s", "a", "i1"), ("se", "s", "b", "i2"), ("se", "s", None, "i3")],
                               "se_uuid string, series_instance_uid string, sop_instance_uid string, i_uuid string")
    out = M.series_objects(df, "plain", "p/")
    assert [r.object for r in out.collect()] == [
        '{"description":"DICOM series","self_uri":"drs://p/se","SeriesInstanceUID":"s","contents":["drs://p/i3","drs://p/i1","drs://p/i2"]}']
    assert "collect_set" in _plan(out) and _plan(out).count("Aggregate") == 1


IDS = ("0a000000-0000-0000-0000-000000000001", "0a000000-0000-0000-0000-000000000002", "no uuid", None)


def test_staging_map_meets_within_an_instance(spark):
    rows = [(i, s, a, b) for i in IDS for s, a, b in ((IDS[0], "src_a", "x"), (IDS[0], "src_a", "x"), (IDS[0], "src_b", "y"), ("s", None, "x"), (None, "src_a", "x"), ("t", "src_a", None))]
    df = spark.createDataFrame(rows, "i_uuid string, se_uuid string, i_source string, pub_gcs_bucket string")
    u = lambda b, s, i: b and f"gs://{b}/{s}/{i}.dcm"
    want = {(r[0], u(r[2] and f"v2_{r[2]}", r[1], r[0]), u(q[3], q[1], q[0])) for r in rows for q in rows if None not in r[:2] and r[:2] == q[:2]}
    got = M.staging_map(df, 2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert "Join" not in _plan(got) and _plan(got).count("Aggregate") == 1


def test_sources_and_dois_come_from_one_small_table(spark):
    cols = "collection_id string, source_doi string, source_url string, versioned_source_doi string, i_source string, i_rev_version int, version int, i_excluded boolean, i_redacted boolean, i_uuid string"
    base = [("c", "d", "u", f"d.v{v}", s, v, v, False, False) for s in ("src_a", "src_b") for v in (1, 2)] + [(None, None, None, None, "src_b", 1, 1, True, False)]
    df = spark.createDataFrame([(*r, str(n)) for r in base for n in range(5)], cols)
    few = FL.described(df)
    assert few.count() == len(base)
    access = spark.createDataFrame([("d", "Cr", "Public")], "source_doi string, type string, access string")
    none = lambda c: spark.createDataFrame([], f"source_doi string, {c} string")
    for f in (lambda x: FL.all_sources(x, access, none("metadata_sunset"), none("analysis_result_id")), FL.newest_versioned_doi):
        assert sorted(map(str, f(df).collect())) == sorted(map(str, f(few).collect()))


def test_rollback_hashes_parents_and_sorts_no_edges(spark):
    out = L.rollback(fx.levels(spark, SF), fx.edges(spark, SF), ["collection", "patient", "study", "series", "instance"], 2)[1]
    plan = out["series_instance"]._jdf.queryExecution().toString()
    assert "strategy=shuffle_hash" in plan and "unhex" in plan
    e = spark.createDataFrame([(p, c, n) for n, p in enumerate(IDS) for c in IDS], "series_uuid string, instance_uuid string, n int")
    gone = spark.createDataFrame([(IDS[0],), (IDS[0],), ("no uuid",), (None,)], "uuid string")
    got = L._without_parents(e, gone, "series_uuid", "instance_uuid")
    assert got.columns == e.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, e.filter(F.col("n").isin(1, 3)).collect()))


def test_objects_of_a_series_are_shuffled_as_narrow_keys(spark):
    df = spark.createDataFrame([("s", "x", "p", i) for i in reversed(IDS)] + [("s", "x", "a", IDS[1])], "se_uuid string, series_instance_uid string, sop_instance_uid string, i_uuid string")
    out = M.series_objects(df, "ids", "")
    assert "unhex" in _plan(out).split("collect_set", 1)[1]
    row = out.first()
    assert row.se_uuid == "s" and json.loads(row.object)["instance_uuids"] == [IDS[1], None, IDS[0], IDS[1], "no uuid"]


def test_deletions_are_compared_on_narrow_keys(spark):
    from vcat.operators import redact as R

    rows = spark.createDataFrame([(v, i, "wide") for v in (1, 2) for i in IDS], "version int, i_uuid string, k string")
    gone = spark.createDataFrame([(IDS[0], 1, 1), ("no uuid", 2, 0), (None, 1, 0)], "i_uuid string, i_rev_version int, i_final_version int")
    got = R.check_deleted(rows, rows.filter("i_uuid <> '%s'" % IDS[1]), gone, 2)
    assert "unhex" in _plan(got)
    want = [(1, IDS[0], "right"), (2, "no uuid", "right"), *[(v, IDS[1], "left") for v in (1, 2)], *[(v, None, "left") for v in (1, 2)]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_withdrawn_instances_are_picked_before_the_joins(spark):
    plan = _plan(QR.redactions(spark, SF))
    assert "c_custkey" not in plan.split("Join LeftSemi", 1)[1]


def test_orders_are_listed_in_more_partitions_where_they_are_many(spark, monkeypatch):
    monkeypatch.setattr(D, "PART_ROWS", 500)
    df = D.per_order(spark, SF)
    assert df.rdd.getNumPartitions() == -(-fx.table(spark, SF, "lineitem").count() // 500) > 4
    assert "concat_ws(.," not in _plan(df).split("collect_list", 1)[1].split("\n", 1)[1]
    assert {r.sop for r in df.select(F.inline("_rs")).collect()} == {r.sop for r in fx.items(spark, SF).collect()}


def test_groups_are_not_shuffled_for_a_bounded_lookup(spark, monkeypatch):
    from vcat.operators import nested as N

    plan = lambda: _plan(N.measurement_groups(D.reports(spark, SF), D.seg_lookup(spark, SF)))
    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(N, "LOOKUP_ROWS", 1)
    assert "strategy=broadcast" not in plan()


def test_deliveries_are_shuffled_once_and_stored_small(spark):
    from vcat.plans.registry import QUERIES
    from vcat.streaming import intake

    rows = [("a", 1, "x", None), ("a", 1, "x", 5), ("a", 1, None, 9), ("a", 0, "z", 9), ("b", None, None, None), (None, 2, "u", 1), (None, 2, "v", 0)]
    df = spark.createDataFrame(rows, "sop_instance_uid string, delivered int, hash string, size int").select("hash", "sop_instance_uid", "size", "delivered")
    out = intake._newest(df, "delivered")
    assert out.columns == ["sop_instance_uid", "hash", "size", "delivered"] and "max_by" not in _plan(out)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", "x", 5, 1), ("b", None, None, None), (None, "v", 0, 2)], key=str)
    files = QUERIES["t1_ingest_manifests"](spark, SF).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_cases_and_sources_come_from_one_reading(spark):
    from vcat.plans.registry import QUERIES

    for name in ("a8_cases_per_doi", "a8_cases_per_collection"):
        assert not any(f.endswith("/lineitem.parquet") for f in QUERIES[name](spark, SF).inputFiles())


def test_hierarchy_is_joined_once_for_the_sources_and_the_current_rows(spark):
    from vcat.plans.registry import QUERIES

    assert not any(f.endswith("/orders.parquet") for f in QUERIES["j10_release_times"](spark, SF).inputFiles())
    flags = [(v, x, r) for v in (1, 2, None) for x in (True, False, None) for r in (True, False, None)]
    df = spark.createDataFrame([("c", "d", "u", "s", *f, str(n)) for n, f in enumerate(flags)],
                               "collection_id string, source_doi string, source_url string, i_source string, version int, i_excluded boolean, i_redacted boolean, i_uuid string")
    out = FL.narrow(df, 2, "i_uuid", "source_url")
    assert out.count() == len(flags) and out.drop("i_uuid").columns == df.drop("i_uuid").select(*out.drop("i_uuid").columns).columns
    some = "version = 2 AND NOT i_excluded AND NOT i_redacted"
    assert out.filter("i_uuid IS NOT NULL").collect() == out.filter(some).collect() and out.filter(some).first().i_uuid == df.filter(some).first().i_uuid


def test_collection_metadata_joins_the_hierarchy_once(spark):
    from vcat.plans.registry import QUERIES

    assert not any(f.endswith("/orders.parquet") for f in QUERIES["n14_collection_metadata"](spark, SF).inputFiles())
