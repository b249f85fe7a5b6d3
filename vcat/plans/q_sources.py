"""Source, sink and streaming queries. What they read back was written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.operators.validate import hash_mismatch
from vcat.plans import fixtures as fx
from vcat.plans.fixtures import items, table
from vcat.plans.oracle import content, with_
from vcat.plans.registry import query
from vcat.sources import publish as P
from vcat.sources import readers as R
from vcat.streaming.intake import current_instances, ingest_manifests


def manifest_rows(spark, sf):
    return items(spark, sf).select(
        F.lit("coll").alias("collection_id"), F.concat(F.lit("p"), F.col("l_orderkey") % 25).alias("submitter_case_id"),
        F.concat(F.lit("st."), "l_suppkey").alias("study_instance_uid"), F.concat(F.lit("se."), "l_orderkey").alias("series_instance_uid"),
        F.col("sop").alias("sop_instance_uid"), F.concat(F.lit("in/"), "sop").alias("ingestion_url"),
        fx.content_hash("1").alias("hash"), "size")


_MAN = f"""SELECT 'coll' AS collection_id, 'p' || (l_orderkey % 25) AS submitter_case_id, 'st.' || l_suppkey AS study_instance_uid, 'se.' || l_orderkey AS series_instance_uid,
  sop AS sop_instance_uid, 'in/' || sop AS ingestion_url, {content('1')} AS hash, {{size}} AS size FROM items"""


@query("s1_read_manifest", with_("items") + _MAN.format(size="CAST(size AS VARCHAR)"))
def s1(spark, sf):
    path = P.scratch_dir(spark) + "/m.tsv"
    out = manifest_rows(spark, sf).withColumn("size", F.concat(F.lit(" "), "size")).withColumnsRenamed({
        "submitter_case_id": "Patient ID", "study_instance_uid": "Study Instance UID", "series_instance_uid": "Series Instance UID",
        "sop_instance_uid": "SOP Instance UID", "ingestion_url": "Filename", "hash": "md5_hash"})
    P.export_tsv(out, path)
    return R.read_manifest(spark, path)


def _tree_of_files(spark, sf):
    """Sixteen folders with a file of urls each: the files grow, not their number."""
    path = P.scratch_dir(spark) + "/files"
    table(spark, sf, "pages").select((F.col("page_id") % 16).alias("bucket"), F.col("url").alias("value")).repartition(
        "bucket").sortWithinPartitions("bucket", "value").write.partitionBy("bucket").text(path)
    return path


_FILES = "files AS (SELECT CAST(page_id % 16 AS VARCHAR) AS bucket, md5(string_agg(url || chr(10), '' ORDER BY url)) AS hash, CAST(sum(strlen(url) + 1) AS BIGINT) AS size FROM pages GROUP BY 1)"


@query("s2_file_manifest", f"WITH {_FILES} SELECT bucket, hash, size FROM files WHERE bucket <> '1'")
def s2(spark, sf):
    path = _tree_of_files(spark, sf)
    done = R.file_manifest(spark, path, include="bucket=1/").select("ingestion_url")
    out = R.file_manifest(spark, path, exclude_suffixes=("_SUCCESS", ".crc"), include="bucket=", done=done)
    return out.select(F.regexp_extract("ingestion_url", "bucket=([0-9]+)", 1).alias("bucket"), "hash", "size")


@query("s3_lookup_json", "SELECT DISTINCT c_mktsegment AS source_doi, 'Public' AS access FROM customer")
def s3(spark, sf):
    path = P.scratch_dir(spark) + "/l.json"
    doc = F.concat(F.lit("{source_doi: '"), "c_mktsegment", F.lit("', \"access\": \"Public\"}"))
    few = table(spark, sf, "customer").select(doc.alias("d")).distinct()  # one entry per segment: a short lookup
    few.agg(F.concat(F.lit("/* lookup */ ["), F.array_join(F.collect_list("d"), ",\n"), F.lit("]")).alias("value")).write.text(path)
    return R.read_lookup_json(spark, path, "source_doi string, access string")


@query("s4_ndjson", "SELECT c_custkey, c_name FROM customer")
def s4(spark, sf):
    path = P.scratch_dir(spark) + "/n"
    table(spark, sf, "customer").select("c_custkey", "c_name").write.json(path)
    return R.load_ndjson(spark, path, "c_custkey bigint, c_name string")


@query("s5_csv", "SELECT c_custkey, c_name, 'declared' AS kind FROM customer UNION ALL SELECT c_custkey, c_name, 'auto' FROM customer")
def s5(spark, sf):
    path = P.scratch_dir(spark) + "/c"
    table(spark, sf, "customer").select("c_custkey", "c_name").write.csv(path, header=True)
    a = R.load_csv(spark, path, "c_custkey bigint, c_name string", skip=1).withColumn("kind", F.lit("declared"))
    return a.unionByName(R.load_csv(spark, path).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name").withColumn("kind", F.lit("auto")))


@query("s7_level_table", """SELECT n_name AS submitter_case_id, v AS rev_version, md5('patient|' || n_nationkey || '|' || v) AS src_a, true AS has_a FROM nation, (VALUES (1), (2)) t(v)""")
def s7(spark, sf):
    flat = R.unpack_level_table(fx.levels(spark, sf)["patient"]).withColumn("rev_version", F.col("rev_version").cast("bigint"))
    path = P.scratch_dir(spark) + "/p"
    flat.write.parquet(path)
    out = R.read_level_table(spark.read.parquet(path))
    return out.select("submitter_case_id", "rev_version", "hashes.src_a", F.col("sources.src_a").alias("has_a"))


@query("s8_jdbc_types", """SELECT n_name, '["' || n_name || '"]' AS tags FROM nation""")
def s8(spark, sf):
    df = table(spark, sf, "nation").select("n_name", F.array(F.struct(F.col("n_name").alias("x"))).alias("tags"))
    ready = R.jdbc_ready(df)
    return ready.select("n_name", F.concat(F.lit('["'), F.get_json_object("tags", "$[0].x"), F.lit('"]')).alias("tags"))


@query("s9_materialize", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def s9(spark, sf):
    db = P.scratch_db(spark, "s9")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    P.materialize(n, f"{db}.t")
    P.materialize(n, f"{db}.t")
    return P.materialize(table(spark, sf, "nation").filter("n_regionkey = 1").select("n_nationkey", "n_name"), f"{db}.t", "append")


def _dataset(spark, sf, name):
    db = P.scratch_db(spark, name)
    for t in ("region", "nation", "customer"):
        table(spark, sf, t).write.saveAsTable(f"{db}.{t}")
    spark.sql(f"CREATE VIEW {db}.nation_view AS SELECT n_name, r_name FROM {db}.nation JOIN {db}.region ON n_regionkey = r_regionkey")
    return db


@query("s10_export_dataset", "SELECT 'customer' AS t, CAST(count(*) AS BIGINT) AS n FROM customer UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def s10(spark, sf):
    db, out = _dataset(spark, sf, "s10"), P.scratch_dir(spark)
    parts = [spark.read.parquet(f"{out}/{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("t"), "n") for n in P.export_dataset(spark, db, out)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("s11_export_tsv", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def s11(spark, sf):
    path = P.scratch_dir(spark) + "/t"
    P.export_tsv(table(spark, sf, "customer").select("c_custkey", "c_name"), path)
    return spark.read.csv(path, sep="\t", header=True)


@query("s12_publish_dataset", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def s12(spark, sf):
    src, dst = _dataset(spark, sf, "s12"), P.scratch_db(spark, "s12_pub")
    P.publish_dataset(spark, src, dst, skips=("customer",))
    assert not spark.catalog.tableExists(f"{dst}.customer") and src not in P.view_text(spark, dst, "nation_view")
    return spark.table(f"{dst}.nation_view")


@query("s13_publish_current", "SELECT r_regionkey, r_name FROM region")
def s13(spark, sf):
    db = P.scratch_db(spark, "s13")
    spark.sql(f"CREATE DATABASE {db}_v7 LOCATION '{P.scratch_dir(spark)}'")
    table(spark, sf, "region").write.saveAsTable(f"{db}_v7.region")
    P.publish_current(spark, db, 7, name=db)
    return spark.table(f"{db}.region")


@query("s14_build_derived", "SELECT n_regionkey, CAST(count(*) AS BIGINT) AS n FROM nation GROUP BY 1")
def s14(spark, sf):
    db = P.scratch_db(spark, "s14")
    note = T.StructType([T.StructField("n", T.LongType(), True, {"comment": "number of nations"})])
    P.build_derived(spark, db, [
        ("base", lambda s: table(s, sf, "nation"), None),
        ("counts", lambda s: s.table(f"{db}.base").groupBy("n_regionkey").agg(F.count("*").alias("n")), note)])
    return spark.table(f"{db}.counts_view")


@query("s15_annotate_schema", "SELECT n_nationkey, n_name, n_name AS inner_name FROM nation")
def s15(spark, sf):
    df = table(spark, sf, "nation").select("n_nationkey", "n_name", F.array(F.struct(F.col("n_name").alias("x"))).alias("rec"))
    inner = T.StructType([T.StructField("x", T.StringType(), True, {"comment": "inner"})])
    out = P.annotate_schema(df, T.StructType([T.StructField("n_name", T.StringType(), True, {"comment": "outer"}), T.StructField("rec", T.ArrayType(inner))]))
    assert out.schema["n_name"].metadata["comment"] == "outer" and out.schema["rec"].dataType.elementType["x"].metadata["comment"] == "inner"
    return out.select("n_nationkey", "n_name", F.get("rec", F.lit(0))["x"].alias("inner_name"))


@query("s16_clustered_write", "SELECT o_custkey, o_orderkey FROM orders")
def s16(spark, sf):
    db = P.scratch_db(spark, "s16")
    P.clustered_write(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), f"{db}.o", ["o_custkey", "o_orderkey"])
    return spark.table(f"{db}.o")


@query("s16_range_read", "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey BETWEEN (SELECT max(o_custkey) // 4 FROM orders) AND (SELECT max(o_custkey) // 2 FROM orders)")
def s16_range(spark, sf):
    """The second quarter of the keys, from the files that hold it."""
    db = P.scratch_db(spark, "s16r")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    top = orders.agg(F.max("o_custkey")).first()[0]
    P.clustered_write(orders, f"{db}.o", ["o_custkey", "o_orderkey"])
    return P.read_range(spark, f"{db}.o", "o_custkey", top // 4, top // 2)


#: Most rows of a compressed file, which is read by one task.
DELIVERY_ROWS = 1_000_000


@query("t1_ingest_manifests", with_("items") + _MAN.format(size="size"))
def t1(spark, sf):
    """Three overlapping manifest deliveries, the last one after the first run of the stream."""
    base = P.scratch_dir(spark)
    k = F.col("series_instance_uid").substr(4, 20).cast("bigint")
    rows = manifest_rows(spark, sf)
    put = lambda cond: rows.filter(cond).write.mode("append").option("maxRecordsPerFile", DELIVERY_ROWS).csv(
        f"{base}/in", sep="\t", header=True, compression="gzip")
    run = lambda: ingest_manifests(spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", compact_every=2).awaitTermination()
    put(k % 3 != 0)
    put(k % 3 != 1)
    run()
    put(k % 2 == 0)
    put(k % 2 == 1)
    run()
    return current_instances(spark, f"{base}/table")


@query("t1_ingest_updates", with_("items") + "SELECT sop AS sop_instance_uid, CASE WHEN l_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS hash FROM items")
def t1_updates(spark, sf):
    """A later delivery brings new content for half of the instances: read from the snapshot of the first and the second's delta."""
    base = P.scratch_dir(spark)
    rows = manifest_rows(spark, sf)
    put = lambda df, h: df.withColumn("hash", F.lit(h)).write.mode("append").option("maxRecordsPerFile", DELIVERY_ROWS).csv(
        f"{base}/in", sep="\t", header=True, compression="gzip")
    run = lambda every: ingest_manifests(spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", compact_every=every).awaitTermination()
    put(rows, "old")
    run(1)
    put(rows.filter(F.col("series_instance_uid").substr(4, 20).cast("bigint") % 2 == 0), "new")
    run(16)
    return current_instances(spark, f"{base}/table").select("sop_instance_uid", "hash")


@query("q11_hash_check", f"WITH {_FILES} SELECT bucket AS url, md5(hash) AS md5, hash AS found_md5 FROM files WHERE CAST(bucket AS INTEGER) % 2 = 0")
def q11(spark, sf):
    """Every second bucket's manifest hash is wrong; files are checked against their content."""
    files = R.file_manifest(spark, _tree_of_files(spark, sf), exclude_suffixes=("_SUCCESS", ".crc")).select(
        F.regexp_extract("ingestion_url", "bucket=([0-9]+)", 1).alias("url"), F.col("hash").alias("md5"))
    manifest = files.withColumn("md5", F.when(F.col("url").cast("int") % 2 == 0, F.md5("md5")).otherwise(F.col("md5")))
    return hash_mismatch(manifest, files)
