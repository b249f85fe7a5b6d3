"""Sources, sinks, clinical files and the stream."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.functions.textclean import expand_range, links_to_modal, links_to_text, reform_case
from vcat.operators import harmonise as H
from vcat.operators.manifests import DOWNLOAD_HEADER, with_header, write_manifests
from vcat.sources import publish as P
from vcat.sources import readers as R
from vcat.streaming.intake import compact, current_instances, ingest_manifests


def test_clinical_file_with_two_header_rows(spark, tmp_path):
    f = tmp_path / "c.csv"
    f.write_text("Case,Visit,,note\nid,1st day,two-b,x\nk1,a,b,z\nk2,c,d,z\nk3,e,f,z\n")
    df = H.read_clinical(spark, {"path": str(f), "headrows": [0, 1], "skip_cols": [3], "skip_rows": [3], "max_row": 4})
    assert df.columns == ["case_id", "visit_1st_day", "visit_two_b"]
    assert sorted(tuple(r) for r in df.collect()) == [("k1", "a", "b"), ("k3", "e", "f")]


def test_clinical_file_transposed(spark, tmp_path):
    f = tmp_path / "t.csv"
    f.write_text("id,p1,p2\nage,4,5\n")
    df = H.read_clinical(spark, {"path": str(f), "pivot": True})
    assert df.columns == ["id", "age"]
    assert sorted(tuple(r) for r in df.collect()) == [("p1", "4"), ("p2", "5")]


def test_csv_with_skipped_lines_over_several_blocks(spark, tmp_path):
    f = tmp_path / "s.csv"
    f.write_text("junk\nmore junk\nk,v\n" + "".join(f"{i},x{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = R.load_csv(spark, str(f), "k bigint, v string", skip=3)
        assert sorted(r.k for r in df.collect()) == list(range(5000))
        lines = R.line_numbers(spark.read.text(str(f))).collect()
        assert {r.value: r._row for r in lines}["4999,x4999"] == 5002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_relational_types():
    s = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DecimalType(10, 2)), T.StructField("c", T.ArrayType(T.StringType())),
                      T.StructField("d", T.StructType([]))])
    assert [R.sql_type(f.dataType) for f in s.fields] == ["BIGINT", "NUMERIC", "TEXT[]", "JSONB"]


def test_links(spark):
    html = '<p><a class="c" href="http://x.org/1">one</a> <A HREF=\'http://y.gov/2\'>two\nlines</A></p>'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(links_to_text("h")).first()[0] == "<p>one (http://x.org/1) two\nlines (http://y.gov/2)</p>"
    modal = df.select(links_to_modal("h")).first()[0]
    assert 'url="http://x.org/1"' in modal and "<A HREF='http://y.gov/2'>two\nlines</A>" in modal


def test_case_rules_and_ranges(spark):
    df = spark.createDataFrame([("12345",), ("7",)], "c string")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(reform_case("c", F.lit("X"), "acrin format")).collect()] == ["X-12345", "X-007"]
    names = spark.createDataFrame([("dose2-4",), ("plain",), ("odd5-3",)], "n string")
    assert sorted(r.n for r in expand_range(names, "n").collect()) == ["dose2", "dose3", "dose4", "plain"]


def test_manifest_files_are_ordered(spark, tmp_path):
    lines = spark.createDataFrame([("d", f"cp {i:04d}") for i in range(500)], "doi string, line string")
    from pyspark.sql import functions as F

    out = str(tmp_path / "m")
    write_manifests(with_header(lines, ["doi"], DOWNLOAD_HEADER, F.lit("f.txt")), out, ["doi"])
    text = [line for part in sorted((tmp_path / "m" / "doi=d").glob("*.txt")) for line in part.read_text().splitlines()]
    assert text[0].startswith("# To download") and "f.txt" in text[1]
    assert text[2:] == sorted(text[2:]) and len(text) == 502


def test_stream_is_repeatable(spark, tmp_path):
    head = "collection_id\tsubmitter_case_id\tstudy_instance_uid\tseries_instance_uid\tsop_instance_uid\tingestion_url\thash\tsize\n"
    (tmp_path / "in").mkdir()
    put = lambda name, ids: (tmp_path / "in" / name).write_text(head + "".join(f"c\tp\ts\te\t{i}\tu{i}\th{i}\t{i}\n" for i in ids))
    run = lambda: ingest_manifests(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp"), max_files=1).awaitTermination()
    put("a.tsv", [1, 2, 2]), put("b.tsv", [2, 3])
    run()
    put("c.tsv", [3, 4])
    run()
    run()
    rows = current_instances(spark, str(tmp_path / "t")).collect()
    assert sorted(r.sop_instance_uid for r in rows) == ["1", "2", "3", "4"]


HEAD = "collection_id\tsubmitter_case_id\tstudy_instance_uid\tseries_instance_uid\tsop_instance_uid\tingestion_url\thash\tsize\n"


def _deliver(spark, tmp_path, name, rows, every):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text(HEAD + "".join(f"c\tp\ts\te\t{i}\tu{i}\t{h}\t1\n" for i, h in rows))
    ingest_manifests(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp"), compact_every=every).awaitTermination()


def _now(spark, tmp_path):
    return {r.sop_instance_uid: r.hash for r in current_instances(spark, str(tmp_path / "t")).collect()}


def test_reads_take_the_snapshot_and_the_deltas_since(spark, tmp_path):
    table = tmp_path / "t"
    for n, rows in enumerate([[(1, "a"), (2, "a")], [(2, "b"), (3, "b")], [(3, "c"), (4, "c")]]):
        _deliver(spark, tmp_path, f"{n}.tsv", rows, 2)
    assert sorted(p.name for p in (table / "snapshots").iterdir()) == ["upto=1"]
    want = {"1": "a", "2": "b", "3": "c", "4": "c"}
    assert _now(spark, tmp_path) == want
    # What the snapshot holds is not read from its deltas any more.
    other = spark.read.parquet(str(table / "deltas" / "batch=2")).withColumn("sop_instance_uid", F.lit("9"))
    other.write.mode("overwrite").parquet(str(table / "deltas" / "batch=0"))
    assert _now(spark, tmp_path) == want
    compact(spark, str(table), 2)
    assert _now(spark, tmp_path) == want
    before = {p.name: p.stat().st_mtime_ns for p in (table / "snapshots" / "upto=2").iterdir()}
    compact(spark, str(table), 2)  # in the log: not written again
    assert {p.name: p.stat().st_mtime_ns for p in (table / "snapshots" / "upto=2").iterdir()} == before


def test_a_snapshot_without_its_row_in_the_log_does_not_count(spark, tmp_path):
    table = tmp_path / "t"
    _deliver(spark, tmp_path, "0.tsv", [(1, "a"), (2, "a")], 0)
    spark.range(3).write.parquet(str(table / "snapshots" / "upto=0"))  # a compaction that ended before the switch
    assert _now(spark, tmp_path) == {"1": "a", "2": "a"}
    compact(spark, str(table), 0)
    _deliver(spark, tmp_path, "1.tsv", [(2, "b")], 0)
    assert _now(spark, tmp_path) == {"1": "a", "2": "b"}


def test_long_files_are_hashed_in_blocks(spark, tmp_path):
    import hashlib

    d = tmp_path / "files"
    d.mkdir()
    want = {}
    for name, data in (("empty", b""), ("short.gz", b"not packed"), ("long one%41.gz", bytes(range(256)) * 300), ("long.b", b"x" * 70001)):
        (d / name).write_bytes(data)
        want[name] = (hashlib.md5(data).hexdigest(), len(data))
    with (d / "sparse").open("wb") as f:
        f.truncate(3 << 30)  # more than a cell can hold
    zeros = hashlib.md5()
    for _ in range(3 << 8):
        zeros.update(bytes(4 << 20))
    want["sparse"] = (zeros.hexdigest(), 3 << 30)
    done = spark.createDataFrame([(f"file:{d}/long.b",)], "ingestion_url string")
    got = {r.ingestion_url.rsplit("/", 1)[1]: (r.hash, r["size"]) for r in R.file_manifest(spark, str(d), done=done, whole=1000).collect()}
    assert got == {k: v for k, v in want.items() if k not in ("long.b", "empty")}


def test_scratch_follows_the_cluster_setting():
    class Session:  # the setting can only be made when a session starts
        class conf:
            get = staticmethod(lambda key, default: {"spark.checkpoint.dir": "hdfs://shared/cp/"}.get(key, default))

        class sparkContext:  # noqa: N801
            applicationId = "app-1"

    assert P.scratch_dir(Session).startswith("hdfs://shared/cp/app-1/vcat-")


def test_clustered_reads_skip_files_and_lose_no_row(spark):
    db = P.scratch_db(spark, "zones")
    rows = spark.range(4000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        P.clustered_write(rows, f"{db}.t", ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wanted = lambda low, high: rows.filter((F.col("k") >= low) & (F.col("k") <= high)).count()
    part = P.read_range(spark, f"{db}.t", "k", 100, 200)
    assert part.count() == wanted(100, 200) and len(part.inputFiles()) < len(spark.table(f"{db}.t").inputFiles())
    assert P.read_range(spark, f"{db}.t", "k", 9000).count() == 0
    assert P.read_range(spark, f"{db}.t", "k").count() == rows.filter("k IS NOT NULL").count()
    P.clustered_write(rows.selectExpr("k + 10000 AS k", "id"), f"{db}.t", ["k"], "append")
    assert P.read_range(spark, f"{db}.t", "k", 3990, 10010).count() == wanted(3990, 4000) + wanted(0, 10)
    assert spark.table(f"{db}.t_zones").count() == len(spark.table(f"{db}.t").inputFiles())
    rows.filter("id < 10").write.mode("append").saveAsTable(f"{db}.t")  # by another writer, who tells no zones
    assert P.read_range(spark, f"{db}.t", "k", 0, 5).count() == 2 * wanted(0, 5)
