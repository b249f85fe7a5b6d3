"""Clinical-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.operators import harmonise as H
from vcat.operators.validate import check_metadata_tables
from vcat.plans.fixtures import table
from vcat.plans.registry import query
from vcat.sources.publish import scratch_db, scratch_dir


def batches(spark, sf):
    """Two batches: customers, and suppliers with another id name and one column less."""
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"),
                                            (F.col("c_custkey") % 4).cast("double").alias("grade"), ((F.col("c_custkey") % 5) / 2).alias("score"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sid"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 3).cast("double").alias("grade"),
                                            ((F.col("s_suppkey") % 5) / 2).alias("score"))
    return a, b


def stacked(spark, sf):
    return H.stack_batches(*batches(spark, sf), ids=["id", "sid"])


_B = """b AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS seg, c_custkey % 4 AS grade, c_custkey % 5 AS half, 0 AS source_batch FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_suppkey % 3, s_suppkey % 5, 1 FROM supplier)"""


@query("c3_stack_batches", f"WITH {_B} SELECT id, name, seg, CAST(grade AS BIGINT) AS grade, source_batch FROM b")
def c3(spark, sf):
    return stacked(spark, sf).drop("score").withColumn("grade", F.col("grade").cast("bigint"))


@query("u7_union_by_name", "SELECT r_regionkey AS k, r_name AS a, CAST(NULL AS VARCHAR) AS b FROM region UNION ALL SELECT n_nationkey, NULL, n_name FROM nation")
def u7(spark, sf):
    a = table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("a"))
    return a.unionByName(table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("b")), allowMissingColumns=True)


@query("c2_normal_names", "SELECT l_orderkey AS a_b, l_partkey AS c_1st_col, l_suppkey AS x_y_ FROM lineitem")
def c2(spark, sf):
    return H.normalise_names(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").toDF("A/b", "1st col", "x-y (%)"))


@query("c4_recast", f"WITH {_B} SELECT id, CAST(grade AS BIGINT) AS grade, CAST(half AS BIGINT) AS half FROM b")
def c4(spark, sf):
    out = H.recast(stacked(spark, sf), "id")
    kept = F.when(F.lit(dict(out.dtypes)["score"] == "double"), (F.col("score") * 2).cast("bigint"))
    return out.select("id", F.lit(None).cast("bigint").alias("grade") if dict(out.dtypes)["grade"] != "bigint" else F.col("grade"), kept.alias("half"))


_PROF = """SELECT 'seg' AS "column", CAST(count(DISTINCT coalesce(seg, 'null')) AS BIGINT) AS n_values, CAST(NULL AS BIGINT) AS rng_min, CAST(NULL AS BIGINT) AS rng_max,
  string_agg(DISTINCT seg, ',' ORDER BY seg) || ',null' AS "values" FROM b
UNION ALL SELECT 'name', CAST(count(DISTINCT name) AS BIGINT), NULL, NULL, NULL FROM b
UNION ALL SELECT 'id', CAST(count(DISTINCT id) AS BIGINT), min(id), max(id), NULL FROM b
UNION ALL SELECT 'grade', CAST(count(DISTINCT grade) AS BIGINT), min(grade), max(grade), string_agg(DISTINCT grade || '.0', ',' ORDER BY grade || '.0') FROM b
UNION ALL SELECT 'source_batch', CAST(count(DISTINCT source_batch) AS BIGINT), min(source_batch), max(source_batch), '0,1' FROM b"""


@query("c5_profile", f"WITH {_B} {_PROF}")
def c5(spark, sf):
    p = H.profile(stacked(spark, sf).drop("score"))
    return p.select("column", "n_values", F.col("rng_min").cast("bigint").alias("rng_min"), F.col("rng_max").cast("bigint").alias("rng_max"),
                    F.array_join("values", ",").alias("values"))


@query("c6_column_metadata", f"""WITH {_B} SELECT 'coll' AS collection_id, "column", CASE "column" WHEN 'id' THEN 'Patient' ELSE "column" END AS column_label, "column" = 'id' AS case_col,
  "values", CASE WHEN "values" IS NOT NULL THEN 'derived from inspection of values' END AS values_source FROM ({_PROF})""")
def c6(spark, sf):
    m = H.column_metadata(stacked(spark, sf).drop("score"), "coll", "coll_clinical", "id", labels={"id": "Patient"})
    return m.select("collection_id", "column", "column_label", "case_col", F.array_join(F.transform("values", lambda x: x["option_code"]), ",").alias("values"), "values_source")


@query("c7_table_metadata", """SELECT n_name AS table_name, n_name || '.json' AS post_process_src, CASE WHEN n_nationkey % 5 = 0 THEN 'v3' ELSE 'v1' END AS version_table_added,
  CASE WHEN n_nationkey % 5 = 0 THEN 'now' ELSE 't1' END AS table_added_datetime, CASE WHEN n_nationkey % 5 = 0 THEN md5(n_name) ELSE 'a' END AS post_process_src_added_md5,
  CASE WHEN n_nationkey % 5 = 0 THEN 'v3' WHEN n_nationkey % 2 = 0 THEN 'v2' ELSE 'v1' END AS version_table_prior,
  CASE WHEN n_nationkey % 5 = 0 THEN md5(n_name) WHEN n_nationkey % 2 = 0 THEN 'old' ELSE 'p' END AS post_process_src_prior_md5,
  CASE WHEN n_nationkey % 5 = 0 OR n_nationkey % 2 = 0 THEN 'v3' ELSE 'v2' END AS version_table_updated,
  CASE WHEN n_nationkey % 5 = 0 OR n_nationkey % 2 = 0 THEN 'now' ELSE 't2' END AS table_updated_datetime, md5(n_name) AS post_process_src_updated_md5 FROM nation""")
def c7(spark, sf):
    n, k = table(spark, sf, "nation"), F.col("n_nationkey")
    src = F.concat(F.lit("./clin/"), "n_name", F.lit(".json"))
    hist = n.filter(k % 5 != 0).select(
        F.col("n_name").alias("table_name"), src.alias("post_process_src"), F.lit("v1").alias("version_table_added"), F.lit("t1").alias("table_added_datetime"),
        F.lit("a").alias("post_process_src_added_md5"), F.lit("v1").alias("version_table_prior"), F.lit("p").alias("post_process_src_prior_md5"),
        F.lit("v2").alias("version_table_updated"), F.lit("t2").alias("table_updated_datetime"),
        F.when(k % 2 == 0, "old").otherwise(F.md5("n_name")).alias("post_process_src_updated_md5"))
    now = n.select(F.col("n_name").alias("table_name"), F.concat("n_name", F.lit(".json")).alias("post_process_src"), F.md5("n_name").alias("md5"))
    return H.table_metadata(now, hist, "v3", "now")


@query("c8_case_id", "SELECT c_mktsegment || '-' || CASE WHEN c_custkey < 100 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END AS dicom_patient_id, c_custkey FROM customer")
def c8(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return H.with_case_id(c, "c_custkey", F.col("c_mktsegment"), "acrin format").drop("c_mktsegment")


@query("c9_attach_dictionary", f"""WITH {_B} SELECT "column", CASE "column" WHEN 'grade' THEN 'Grade of it' ELSE "column" END AS column_label,
  CASE "column" WHEN 'grade' THEN '0=low,1=high' WHEN 'seg' THEN "values" WHEN 'source_batch' THEN '0,1' END AS "values",
  CASE WHEN "column" = 'grade' THEN 'provided dictionary' WHEN "values" IS NOT NULL THEN 'derived from inspection of values' END AS values_source FROM ({_PROF})""")
def c9(spark, sf):
    from vcat.functions.textclean import parse_options

    m = H.column_metadata(stacked(spark, sf).drop("score"), "coll", "coll_clinical", "id")
    d = spark.createDataFrame([("grade", "Grade of it", "0=low, 1=high")], "column string, label string, text string").select(
        "column", "label", parse_options("text", "assign").alias("opts"))
    out = H.attach_dictionary(m, d)
    show = F.transform("values", lambda x: F.concat_ws("=", x["option_code"], x["option_description"]))
    return out.select("column", "column_label", F.array_join(show, ",").alias("values"), "values_source")


@query("c10_split_by_collection", """SELECT DISTINCT s_nationkey AS n, CAST(o_custkey AS VARCHAR) AS dicom_patient_id, 0 AS source_batch, c_name FROM customer JOIN orders ON o_custkey = c_custkey
JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey""")
def c10(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    known = li.join(table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("s_nationkey").alias("collection_id"), F.col("o_custkey").cast("string").alias("PatientID"))
    out = H.split_by_collection(table(spark, sf, "customer").select("c_custkey", "c_name"), known, "c_custkey")
    return out.select(F.col("collection_id").alias("n"), "dicom_patient_id", "source_batch", "c_name")


@query("j22_comma_join", "SELECT c_name, n_name FROM customer, nation WHERE c_nationkey = n_nationkey AND n_regionkey = 2")
def j22(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation").filter("n_regionkey = 2")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_name", "n_name")


@query("c1_read_clinical", "SELECT 'k' || c_custkey AS case_id, c_name AS visit_name, c_mktsegment AS seg FROM customer WHERE c_mktsegment = 'BUILDING'")
def c1(spark, sf):
    path = scratch_dir(spark) + "/c1"
    table(spark, sf, "customer").select(
        F.concat(F.lit("k"), "c_custkey").alias("Case id"), F.col("c_name").alias("Visit-name"), F.col("c_mktsegment").alias("Seg"), F.lit("z").alias("x")
    ).write.csv(path, header=True)
    return H.read_clinical(spark, {"path": path, "headrows": [0], "skip_cols": [3], "filter_rows": "Seg", "collection": "BUILDING"})


@query("c11_load_clinical", "SELECT c_custkey AS id, c_name AS name FROM customer")
def c11(spark, sf):
    path = scratch_dir(spark) + "/c11"
    table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.json(path)
    return H.load_clinical(spark, {"t": (path, "id bigint, name string")})["t"]


@query("q13_metadata_agreement", """SELECT 'clin_a' AS table_name, 'seg' AS item, 'column_left' AS problem UNION ALL SELECT 'clin_b', NULL, 'table_left' UNION ALL SELECT 'clin_b', 'dicom_patient_id', 'column_left'
UNION ALL SELECT 'clin_a', CAST(c_custkey AS VARCHAR), 'patient_unknown' FROM customer WHERE c_custkey % 50 = 0""")
def q13(spark, sf):
    db = scratch_db(spark, "q13")
    c = table(spark, sf, "customer")
    c.select(F.col("c_custkey").cast("string").alias("dicom_patient_id"), F.col("c_mktsegment").alias("seg")).write.saveAsTable(f"{db}.clin_a")
    c.filter("c_custkey % 50 = 1").select(F.col("c_custkey").cast("string").alias("dicom_patient_id")).write.saveAsTable(f"{db}.clin_b")
    tm = spark.createDataFrame([("clin_a",)], "table_name string")
    cm = spark.createDataFrame([("clin_a", "dicom_patient_id")], "table_name string, column string")
    known = c.filter("c_custkey % 50 <> 0").select(F.col("c_custkey").cast("string").alias("PatientID"))
    return check_metadata_tables(spark, db, tm, cm, known)
