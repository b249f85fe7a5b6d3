"""Manifest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.operators import manifests as M
from vcat.plans import fixtures as fx
from vcat.plans.fixtures import table
from vcat.plans.oracle import with_
from vcat.plans.q_flatten import TS, _NEWEST, _aux_sql, _shown, aux, current, public, public_columns
from vcat.plans.registry import query


@query("x1_download_manifest", with_("current_rows") + """SELECT DISTINCT source_doi, 'cp s3://' || pub_aws_bucket || '/' || se_uuid || '/*  .' AS line FROM current_rows""")
def x1(spark, sf):
    return M.download_manifest(current(spark, sf), "aws", ["source_doi"])


@query("x1_download_manifest_text", with_("current_rows", extra="""lines AS (SELECT DISTINCT source_doi, collection_id,
  'cp s3://' || pub_gcs_bucket || '/' || se_uuid || '/*  .' AS line FROM current_rows), groups AS (SELECT DISTINCT source_doi, collection_id FROM lines)""")
       + """SELECT source_doi, collection_id, 2 AS part, line FROM lines
UNION ALL SELECT source_doi, collection_id, 0, '# To download the files in this manifest, install a download client for the archive,' FROM groups
UNION ALL SELECT source_doi, collection_id, 1, '# save this manifest as ' || collection_id || '.txt, then run the client on ' || collection_id || '.txt.' FROM groups""")
def x1t(spark, sf):
    by = ["source_doi", "collection_id"]
    lines = M.download_manifest(current(spark, sf), "gcs", by)
    return M.with_header(lines, by, M.DOWNLOAD_HEADER, F.concat("collection_id", F.lit(".txt")))


@query("x2_object_id_manifest", with_("current_rows") + "SELECT DISTINCT source_doi, 'dg.0/' || i_uuid AS line FROM current_rows")
def x2(spark, sf):
    return M.object_id_manifest(current(spark, sf), "dg.0/", ["source_doi"])


_URL = "'gs://' || pub_gcs_bucket || '/' || se_uuid || '/' || i_uuid || '.dcm, s3://' || pub_aws_bucket || '/' || se_uuid || '/' || i_uuid || '.dcm'"


def _reg(src, where, extra_cols, acl):
    return f"""SELECT 'dg.0/' || i_uuid AS "GUID", i_hash AS md5, i_size AS size, '{acl}' AS acl, '[' || string_agg(u, ', ' ORDER BY split_part(u, '/', 4)) || ']' AS url,
  {TS.format(c='i_init')} AS content_created_timestamp, {TS.format(c='i_rev')} AS content_updated_timestamp, 'DICOM instance' AS description,
  'version: ' || i_rev AS version, sop_instance_uid AS name {extra_cols}
FROM (SELECT DISTINCT i_uuid, i_hash, i_size, i_init, i_rev, sop_instance_uid, {_URL} AS u FROM {src} WHERE {where})
GROUP BY i_uuid, i_hash, i_size, i_init, i_rev, sop_instance_uid"""


@query("x3_registration_manifest", with_("current_rows") + _reg("current_rows", "i_rev = 2", ", '[''/open'']' AS authz", "[''*'']"))
def x3(spark, sf):
    return _shown(M.registration_manifest(current(spark, sf), fx.versions_table(spark), 2, "dg.0/"))


@query("a11_ordered_url_list", with_("public_rows") + f"""SELECT i_uuid, '[' || string_agg(u, ', ' ORDER BY split_part(u, '/', 4)) || ']' AS url
FROM (SELECT DISTINCT i_uuid, {_URL} AS u FROM public_rows) GROUP BY 1""")
def a11(spark, sf):
    return M.url_lists(public_columns(spark, sf, "i_uuid", "se_uuid"), ["i_uuid"], {"url": lambda u: u})


@query("x4_reindex_manifest", with_("public_rows") + _reg("public_rows", "version = 2 AND pub_gcs_bucket = 'open-data' AND i_rev < 2",
       ", '[' || string_agg(replace(u, 'open-data', 'old-data'), ', ' ORDER BY split_part(u, '/', 4)) || ']' AS previous_url", "*"))
def x4(spark, sf):
    return _shown(M.reindex_manifest(public(spark, sf), fx.versions_table(spark), 2, "open-data", "old-data", 2, "dg.0/"))


_AUX = with_("current_rows", "licenses", extra=_NEWEST + ",\naux AS (" + _aux_sql("pub_gcs_bucket") + ")")


@query("x5_bundle_manifest", _AUX + """SELECT 2 AS sortby, 'dg.0/' || study_uuid AS bundle_names, '[' || string_agg(DISTINCT 'dg.0/' || series_uuid, ',' ORDER BY 'dg.0/' || series_uuid) || ']' AS ids,
  'dg.0/' || study_uuid AS guid FROM aux WHERE study_revised_version = 2 GROUP BY study_uuid
UNION ALL SELECT 1, 'dg.0/' || series_uuid, '[' || string_agg(DISTINCT 'dg.0/' || instance_uuid, ',' ORDER BY 'dg.0/' || instance_uuid) || ']', 'dg.0/' || series_uuid
FROM aux WHERE series_revised_version = 2 GROUP BY series_uuid""")
def x5(spark, sf):
    return M.bundle_manifest(aux(spark, sf), 2, "dg.0/")


@query("a10_bundle_lists", """SELECT o_custkey, '[' || string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) || ']' AS ids FROM orders GROUP BY 1""")
def a10(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()
    return df.groupBy("o_custkey").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("o_orderpriority")), ","), F.lit("]")).alias("ids"))


@query("u1_union_all", """SELECT 2 AS sortby, 'st.' || o_custkey AS id, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 2
UNION ALL SELECT 1, 'se.' || l_orderkey, CAST(count(*) AS BIGINT) FROM lineitem GROUP BY 2""")
def u1(spark, sf):
    st = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    se = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return st.select(F.lit(2).alias("sortby"), F.concat(F.lit("st."), "o_custkey").alias("id"), "n").unionByName(
        se.select(F.lit(1).alias("sortby"), F.concat(F.lit("se."), "l_orderkey").alias("id"), "n"))


@query("x6_new_ids", with_("public_rows") + "SELECT DISTINCT i_uuid FROM public_rows WHERE i_rev = 2")
def x6(spark, sf):
    return M.new_ids(public(spark, sf), 2)


@query("o1_ordered_manifest", with_("inst") + "SELECT i_uuid AS id FROM inst WHERE i_rev = 2 ORDER BY 1")
def o1(spark, sf):
    df = fx.levels(spark, sf)["instance"].filter("rev_version = 2").select(F.col("uuid").alias("id"))
    return df.orderBy("id")


@query("o2_ordered_sample", with_("inst") + "SELECT i_uuid AS id FROM inst ORDER BY 1 LIMIT 1000")
def o2(spark, sf):
    return fx.levels(spark, sf)["instance"].select(F.col("uuid").alias("id")).orderBy("id").limit(1000)


def _obj(layout):
    kids = {"ids": "'\"' || i_uuid || '\"'", "plain": "'\"drs://dg.0/' || i_uuid || '\"'",
            "bundle": "'{\"name\":\"' || sop_instance_uid || '\",\"drs_uri\":\"drs://dg.0/' || i_uuid || '\"}'"}[layout]
    k = f"string_agg({kids}, ',' ORDER BY sop_instance_uid, i_uuid)"
    q = lambda s: "'" + s + "'"
    if layout == "ids":
        doc = (q('{"description":"DICOM series","series_uuid":"') + " || se_uuid || " + q('","SeriesInstanceUID":"') + " || series_instance_uid || "
               + q('","instance_uuids":[') + f" || {k} || " + q('],"archive_drs_uri":"drs://dg.0/some_TBD_uuid"}'))
    elif layout == "plain":
        doc = (q('{"description":"DICOM series","self_uri":"drs://dg.0/') + " || se_uuid || " + q('","SeriesInstanceUID":"') + " || series_instance_uid || "
               + q('","contents":[') + f" || {k} || " + q("]}"))
    else:
        doc = (q('{"encoding_version":"1.0","description":"DICOM series compound object","object_type":"DICOM series","id":"') + " || se_uuid || "
               + q('","name":"') + " || series_instance_uid || " + q('","self_uri":"drs://dg.0/') + " || se_uuid || "
               + q('","access_methods":[{"method":"children","mime_type":"application/dicom","description":"List of DRS URIs of instances in this series","contents":[')
               + f" || {k} || " + q(']},{"method":"folder_object","mime_type":"application/json","description":"DRS URI that resolves to a gs or s3 folder corresponding to this series","contents":[{"name":"')
               + " || series_instance_uid || " + q('/","drs_uri":"drs://dg.0/some_TBD_uuid"}]}]}'))
    return f"SELECT '{layout}' AS layout, se_uuid, md5({doc}) AS object_md5 FROM d GROUP BY se_uuid, series_instance_uid"


@query("x7_series_objects", with_("flat", extra="d AS (SELECT DISTINCT se_uuid, series_instance_uid, sop_instance_uid, i_uuid FROM flat)")
       + " UNION ALL ".join(_obj(x) for x in ("bundle", "ids", "plain")))
def x7(spark, sf):
    from vcat.plans.q_flatten import flat

    df = flat(spark, sf)
    out = None
    for layout in ("bundle", "ids", "plain"):
        part = M.series_objects(df, layout, "dg.0/").select(F.lit(layout).alias("layout"), "se_uuid", F.md5("object").alias("object_md5"))
        out = part if out is None else out.unionByName(part)
    return out


@query("x8_doi_history", with_("public_rows") + """SELECT DISTINCT * FROM (SELECT se_rev AS version, collection_id, source_doi, source_url FROM public_rows WHERE i_source = 'src_b'
  UNION ALL SELECT se_final + 1, collection_id, source_doi, source_url FROM public_rows WHERE i_source = 'src_b' AND se_final <> 0)""")
def x8(spark, sf):
    return M.doi_history(public(spark, sf))


@query("u2_union_distinct", with_("ser") + "SELECT DISTINCT * FROM (SELECT doi, se_rev AS version FROM ser UNION ALL SELECT doi, se_final + 1 FROM ser WHERE se_final <> 0)")
def u2(spark, sf):
    df = fx.levels(spark, sf)["series"].select(F.col("source_doi").alias("doi"), "rev_version", "final_version")
    return df.select("doi", F.col("rev_version").alias("version")).union(
        df.filter("final_version <> 0").select("doi", F.col("final_version") + 1)).distinct()


@query("a16_size_rollup", with_("public_rows") + """SELECT pub_gcs_bucket AS bucket, se_uuid, CAST(sum(i_size) AS BIGINT) AS size FROM public_rows
WHERE version = 2 AND se_rev = 2 GROUP BY 1, 2""")
def a16(spark, sf):
    df = public(spark, sf).filter("version = 2 AND se_rev_version = 2")
    return df.groupBy(F.col("pub_gcs_bucket").alias("bucket"), "se_uuid").agg(F.sum("i_size").alias("size"))


@query("j23_staging_map", with_("public_rows") + """SELECT DISTINCT i_uuid, 'gs://v2_' || i_source || '/' || se_uuid || '/' || i_uuid || '.dcm' AS dev_url,
  'gs://' || pub_gcs_bucket || '/' || se_uuid || '/' || i_uuid || '.dcm' AS pub_url FROM public_rows WHERE version = 2 AND se_rev = 2""")
def j23(spark, sf):
    return M.staging_map(public(spark, sf).filter("version = 2 AND se_rev_version = 2"), 2)
