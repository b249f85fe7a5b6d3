"""Metadata, lookup and file-matching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.operators import metadata as MD
from vcat.plans import fixtures as fx
from vcat.plans.fixtures import table
from vcat.plans.oracle import with_
from vcat.plans.q_flatten import TS, _NEWEST, _aux_sql, _shown, aux, current, current_cases, current_columns, flat, image_rows
from vcat.plans.registry import query


def records(spark, sf):
    """Catalogue records: one per region, with one source per residue of the DOI number modulo 8."""
    k = F.col("r_regionkey")
    src = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.named_struct(
        F.lit("title"), F.concat(F.lit("t"), i), F.lit("concept_doi"), F.when(i == 0, F.concat(F.lit("10.5281/d."), k)),
        F.lit("source_doi"), F.concat(F.lit("10.5281/d."), k + i * 5), F.lit("source_url"), F.concat(F.lit("https://doi.org/10.5281/d."), k + i * 5),
        F.lit("license"), F.named_struct(F.lit("url"), F.concat(F.lit("u"), i), F.lit("long_name"), F.concat(F.lit("long "), i), F.lit("short_name"), F.concat(F.lit("s"), i)),
        F.lit("citation"), F.concat(F.lit("cite "), i)))
    return table(spark, sf, "region").select(
        F.col("r_name").alias("collection_name"), F.lower("r_name").alias("collection_id"), F.array(F.lit("ca"), F.lit("cb")).alias("cancer_types"),
        F.array(F.concat(F.lit("loc"), k)).alias("tumor_locations"), F.lit("Human").alias("species"),
        F.when(k % 2 == 0, F.array(F.lit("x"), F.lit("y"))).alias("supporting_data"), F.concat(F.lit("prog"), k % 2).alias("program"),
        F.lit("Complete").alias("status"), F.lit("2024-01-01").alias("updated"), src.alias("sources"))


def results(spark):
    """Analysis results: DOI numbers ending in 8."""
    k = F.col("k")
    lic = F.struct(F.lit("au").alias("url"), F.lit("along").alias("long_name"), F.lit("as").alias("short_name"))
    return fx._dois(spark).filter(k % 10 == 8).select(
        F.concat(F.lit("Res-"), k).alias("analysis_result_id"), F.concat(F.lit("Result "), k).alias("analysis_result_name"),
        F.concat(F.lit("Title "), k).alias("title"), F.upper("source_doi").alias("source_doi_upper"), "source_doi",
        F.concat(F.lit("https://doi.org/"), "source_doi").alias("source_url"), F.array(F.lit("ca")).alias("cancer_types"),
        F.array(F.lit("l1"), F.lit("l2")).alias("tumor_locations"), F.array(F.lit("ASIA"), F.lit("EUROPE")).alias("collections"),
        F.lit("2024-02-02").alias("updated"), lic.alias("license"), F.concat(F.lit("cite "), k).alias("citation"))


_DM = "dm AS (SELECT sop AS dsop, CASE WHEN l_linestatus = 'O' THEN 'CT' ELSE 'MR' END AS modality FROM items)"


@query("a8_cases_per_collection", with_("current_rows") + """SELECT collection_id, CAST(count(DISTINCT submitter_case_id) AS BIGINT) AS cases FROM current_rows GROUP BY 1""")
def a8(spark, sf):
    return MD.cases_per(current_cases(spark, sf), ["collection_id"])


@query("a8_cases_per_doi", with_("current_rows") + "SELECT source_doi, CAST(count(DISTINCT submitter_case_id) AS BIGINT) AS cases FROM current_rows GROUP BY 1")
def a8d(spark, sf):
    return MD.cases_per(current_cases(spark, sf), ["source_doi"])


@query("a9_modalities", with_("current_rows", extra=_DM) + """SELECT source_doi, string_agg(DISTINCT modality, ', ' ORDER BY modality) AS modalities
FROM current_rows JOIN dm ON dsop = sop_instance_uid GROUP BY 1""")
def a9(spark, sf):
    return MD.modalities_per(current(spark, sf), image_rows(spark, sf), ["source_doi"])


@query("a18_latest_for_modality", with_("current_rows", "licenses", extra=_NEWEST + ",\naux AS (" + _aux_sql("pub_gcs_bucket") + "),\n" + _DM)
       + f"""SELECT collection_name, collection_id, max(instance_revised_version) AS version, {TS.format(c='max(instance_revised_version)')} AS max_timestamp
FROM aux JOIN dm ON dsop = "SOPInstanceUID" WHERE modality = 'CT' GROUP BY 1, 2""")
def a18(spark, sf):
    return _shown(MD.latest_for_modality(aux(spark, sf), image_rows(spark, sf), "CT", fx.versions_table(spark)))


_OCM = """ocm AS (SELECT s_suppkey, 'col-' || s_suppkey AS cid, p_type AS tag, p_brand AS brand, p_partkey FROM (SELECT DISTINCT l_suppkey AS s_suppkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey)"""


def tagged(spark, sf):
    """Per collection (a supplier): comma lists of the types and brands sold, two sources."""
    sold = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct().join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lists = MD.list_of(sold, ["l_suppkey"], "p_type", "CancerTypes", " , ").join(MD.list_of(sold, ["l_suppkey"], "p_brand", "TumorLocations"), "l_suppkey")
    k = F.col("l_suppkey")
    src = F.array(*[F.struct(F.concat(F.lit("10.5281/d."), (k + i * 8) % 40).alias("source_doi"), F.lit(m).alias("ImageTypes")) for i, m in ((0, "CT, MR"), (1, "SM"))])
    return lists.select(F.concat(F.lit("col-"), k).alias("collection_id"), "CancerTypes", "TumorLocations", src.alias("sources"))


_TAGS = with_(extra=_OCM + """, d AS (SELECT ocm.*, 'Result ' || r AS name, '10.5281/d.' || r AS doi, i FROM ocm, (VALUES (8), (18), (28), (38)) t(r), (VALUES (0), (1)) u(i)
  WHERE (s_suppkey + i * 8) % 40 = r)""")


@query("a21_tag_rollup", _TAGS + """SELECT name AS analysis_result_name, doi AS source_doi, string_agg(DISTINCT tag, ', ' ORDER BY tag) AS cancer_types, string_agg(DISTINCT brand, ', ' ORDER BY brand) AS tumor_locations,
  CASE WHEN bool_or(i = 0) AND bool_or(i = 1) THEN 'CT, MR, SM' WHEN bool_or(i = 0) THEN 'CT, MR' ELSE 'SM' END AS modalities, string_agg(DISTINCT cid, ', ' ORDER BY cid) AS collections,
  CAST(count(DISTINCT cid) AS BIGINT) AS n_collections, replace(lower(name), ' ', '_') AS analysis_result_id FROM d GROUP BY 1, 2""")
def a21(spark, sf):
    return MD.tag_rollup(tagged(spark, sf), results(spark))


@query("j28_tag_join", with_(extra=_OCM) + """SELECT DISTINCT cid AS collection_id, tag, '10.5281/d.' || (s_suppkey % 40) AS source_doi FROM ocm WHERE s_suppkey % 40 % 10 = 8""")
def j28(spark, sf):
    rows = tagged(spark, sf).select("collection_id", F.explode(F.transform(F.split("CancerTypes", ","), lambda x: F.trim(x))).alias("tag"),
                                    F.get("sources", F.lit(0))["source_doi"].alias("source_doi"))
    return rows.join(results(spark).select("source_doi"), "source_doi").distinct()


@query("a22_latest_release", """SELECT user_id % 50 AS grp, CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 3 = 0 THEN '37.0' WHEN event_id % 3 = 1 THEN '9.10' ELSE '9.9' END AS latest
FROM events""")
def a22(spark, sf):
    k = F.col("event_id") % 3
    h = lambda *v: F.array(*[F.struct(F.lit(x).alias("data_release")) for x in v])
    hist = F.when(k == 0, h("9.0", "37.0", "10.1")).when(k == 1, h("9.9", "9.10")).otherwise(h("9.9", "9.1"))
    return table(spark, sf, "events").select((F.col("user_id") % 50).alias("grp"), F.col("event_id").cast("string").alias("id"), MD.latest_release(hist).alias("latest"))


_REC = """rec AS (SELECT r_name, r_regionkey AS k, i, '10.5281/d.' || (r_regionkey + CASE WHEN i = 0 THEN 0 ELSE i * 5 END) AS doi FROM region, (VALUES (0), (1), (2)) t(i))"""
_RES = "res AS (SELECT k, '10.5281/d.' || k AS doi FROM (VALUES (8), (18), (28), (38)) t(k))"


@query("s6_catalog_licenses", with_(extra=f"{_REC}, {_RES}") + """SELECT doi AS source_doi, r_name AS source_name, 'original_data' AS source_type, 'u' || i AS license_url, 'long ' || i AS license_long_name, 's' || i AS license_short_name FROM rec
UNION ALL SELECT doi, 'Res-' || k, 'analysis_result', 'au', 'along', 'as' FROM res""")
def s6(spark, sf):
    return MD.catalog_records_to_tables(records(spark, sf), results(spark))["licenses"]


@query("s6_catalog_collections", """SELECT r_name AS collection_name, lower(r_name) AS collection_id, 'ca, cb' AS cancer_types, 'loc' || r_regionkey AS tumor_locations, 'Human' AS species,
  CASE WHEN r_regionkey % 2 = 0 THEN 'x, y' ELSE '' END AS supporting_data, 'prog' || (r_regionkey % 2) AS program_id, 'Complete' AS status, '2024-01-01' AS updated FROM region""")
def s6c(spark, sf):
    return MD.catalog_records_to_tables(records(spark, sf), results(spark))["collections"]


_MODS = """m AS (SELECT collection_id AS c, source_url AS u, string_agg(DISTINCT modality, ', ' ORDER BY modality) AS mods FROM current_rows JOIN dm ON dsop = sop_instance_uid GROUP BY 1, 2),
cases AS (SELECT collection_id AS c, CAST(count(DISTINCT submitter_case_id) AS BIGINT) AS n FROM current_rows GROUP BY 1),
srcs AS (SELECT r_name AS c, 0 AS kind, i AS pos, lower(r_name) AS sid, 't' || i AS title, 'original_data' AS st, doi FROM rec
  UNION ALL SELECT u.c, 1, 0, 'res_' || res.k, 'Title ' || res.k, 'analysis_result', res.doi FROM (SELECT DISTINCT collection_id AS c, source_doi FROM current_rows) u JOIN res ON res.doi = u.source_doi),
shown AS (SELECT srcs.c, string_agg(sid || '/' || title || '/' || st || '/' || doi || '/' || coalesce(mods, ''), ';' ORDER BY kind, pos, doi) AS sources
  FROM srcs LEFT JOIN m ON m.c = srcs.c AND m.u = lower('https://doi.org/' || doi) GROUP BY 1)"""


@query("n14_collection_metadata", with_("current_rows", extra=",\n".join([_DM, _REC, _RES, _MODS])) + """SELECT r_name AS collection_name, sources, coalesce(n, 0) AS subjects, 'about ' || lower(r_name) AS description,
  'prog' || (r_regionkey % 2) AS "Program" FROM region LEFT JOIN shown ON shown.c = r_name LEFT JOIN cases ON cases.c = r_name""")
def n14(spark, sf):
    desc = table(spark, sf, "region").select(F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))).alias("collection_id"),
                                             F.concat(F.lit("about "), F.lower("r_name")).alias("description"))
    rows = current_columns(spark, sf, "submitter_case_id", "sop_instance_uid")
    out = MD.collection_metadata(records(spark, sf), results(spark), rows, image_rows(spark, sf), desc)
    show = F.array_join(F.transform("sources", lambda s: F.concat_ws("/", s["source_id"], s["source_title"], s["source_type"], s["source_doi"], s["modalities"])), ";")
    return out.select("collection_name", show.alias("sources"), "subjects", "description", "Program")


@query("n15_analysis_metadata", with_("current_rows", extra=f"{_DM}, {_RES}, x AS (SELECT source_doi AS d, string_agg(DISTINCT modality, ', ' ORDER BY modality) AS mods, CAST(count(DISTINCT submitter_case_id) AS BIGINT) AS n FROM current_rows JOIN dm ON dsop = sop_instance_uid GROUP BY 1)")
       + """SELECT 'Res-' || k AS analysis_result_id, 'Title ' || k AS analysis_result_title, upper(doi) AS source_doi, 'ca' AS cancer_types, 'l1, l2' AS tumor_locations, 'ASIA, EUROPE' AS collections, coalesce(n, 0) AS subjects,
  coalesce(mods, '') AS modalities, CASE WHEN k = 8 THEN 'eight' ELSE '' END AS description FROM res LEFT JOIN x ON d = doi""")
def n15(spark, sf):
    up = results(spark).drop("source_doi").withColumnRenamed("source_doi_upper", "source_doi")
    desc = results(spark).filter("analysis_result_id = 'Res-8'").select(F.col("analysis_result_id").alias("id"), F.lit("eight").alias("description"))
    rows = current_columns(spark, sf, "submitter_case_id", "sop_instance_uid")
    out = MD.analysis_metadata(up, rows, image_rows(spark, sf), desc)
    return out.select("analysis_result_id", "analysis_result_title", "source_doi", "cancer_types", "tumor_locations", "collections", "subjects", "modalities", "description")


@query("j29_last_update", "SELECT r_name AS collection_id, '2022-03-04 05:06:07' AS updated FROM region")
def j29(spark, sf):
    return _shown(MD.last_update(fx.levels(spark, sf)["collection"], fx.versions_table(spark)))


@query("j30_fill_descriptions", """SELECT lower(replace(r_name, ' ', '_')) AS collection_id, 'd' || r_regionkey || CASE WHEN r_regionkey % 2 = 0 THEN '<p>Please see the <a href="u' || r_regionkey || '" target="_blank">' || r_name || ': T' || r_regionkey ||
  '</a>) wiki page to learn more about the histopathology images and to obtain any supporting metadata for this collection.</p>' ELSE '' END AS description FROM region WHERE r_regionkey <> 3""")
def j30(spark, sf):
    r, k = table(spark, sf, "region"), F.col("r_regionkey")
    name = F.col("r_name")
    return MD.fill_descriptions(
        r.select(name.alias("collection_id"), F.concat(F.lit("d"), k).alias("description")),
        r.select(name.alias("collection_name"), F.when(k == 3, "Limited").otherwise("Public").alias("access"), F.lit(0).alias("metadata_sunset")),
        r.filter(k % 2 == 0).select(name.alias("collection_id"), F.concat(F.lit("u"), k).alias("source_url")),
        r.select(name.alias("collection_name"), F.concat(F.lit("T"), k).alias("title")))


@query("j31_licensed_public", with_("flat") + "SELECT DISTINCT collection_id AS collection_name FROM flat WHERE i_source = 'src_a' AND k <> 0 AND k <> 1 AND k <> 2")
def j31(spark, sf):
    return MD.licensed_public(flat(spark, sf), fx.access_lookup(spark), fx.sunset_lookup(spark), 2, "src_a")


def downloads(spark, sf):
    k = F.col("p_partkey")
    kind = F.when(k % 4 == 0, F.array(F.lit("Clinical Data"), F.lit("x"))).when(k % 4 == 1, F.array(F.lit("Pathology Images"))).when(
        k % 4 == 2, F.array(F.lit("OTHER"))).otherwise(F.array(F.lit("Radiology Images")))
    return table(spark, sf, "part").select(
        k.alias("id"), F.concat(F.lit("slug"), k).alias("slug"), kind.alias("download_type"),
        F.when(k % 3 == 0, "must sign").otherwise("").alias("download_requirements"),
        F.when(k % 5 == 0, F.array(F.lit("DICOM"))).when(k % 5 == 1, F.array(F.lit("CSV"))).otherwise(F.array(F.lit("XLSX"), F.lit("DICOM"))).alias("file_type"))


@query("p17_likely_clinical", "SELECT p_partkey AS id FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0 AND p_partkey % 5 <> 0")
def p17(spark, sf):
    return MD.likely_clinical(downloads(spark, sf)).select("id")


@query("p18_download_filter", """SELECT p_partkey AS id, 'r' AS kind FROM part WHERE p_partkey % 4 = 3 AND p_partkey % 5 <> 0
UNION ALL SELECT p_partkey, 'p' FROM part WHERE p_partkey % 4 = 1""")
def p18(spark, sf):
    d = downloads(spark, sf)
    one = d.withColumn("download_type", F.get("download_type", F.lit(0)))  # text instead of a list
    return MD.filter_downloads(d, ["Radiology Images"], not_only="DICOM").select("id", F.lit("r").alias("kind")).unionByName(
        MD.filter_downloads(one, ["Pathology Images"]).select("id", F.lit("p").alias("kind")))


@query("j25_parent_of", """SELECT p_partkey AS id, CASE WHEN o.s IS NULL THEN '' ELSE CAST(o.s AS VARCHAR) END AS parent_id, coalesce('sup' || o.s, '') AS parent_slug
FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1) o ON l_partkey = p_partkey""")
def j25(spark, sf):
    # the parts each supplier sells
    c = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.collect_set("l_partkey").alias("collection_downloads")).select(
        F.col("l_suppkey").alias("id"), F.concat(F.lit("sup"), "l_suppkey").alias("slug"), "collection_downloads")
    return MD.parent_of(downloads(spark, sf).select("id"), c)


@query("j24_source_status", """SELECT c_name AS collection_name, md5(c_name) AS md5_hash, CASE WHEN c_custkey % 3 = 0 THEN 'p' || c_custkey ELSE '' END AS "patientID" FROM customer""")
def j24(spark, sf):
    c = table(spark, sf, "customer")
    return MD.source_status(c.select(F.col("c_name").alias("collection_name"), F.md5("c_name").alias("hash")),
                            c.filter("c_custkey % 3 = 0").select(F.md5("c_name").alias("source_file_hash"), F.concat(F.lit("p"), "c_custkey").alias("patientID")))


@query("j26_match_by_suffix", """SELECT 'pkg/v1/' || o_orderkey || '/img-' || (o_orderkey % 7) || '.svs' AS file, o_orderkey || '_img_' || (o_orderkey % 7) || '.svs' AS url FROM orders WHERE o_orderkey % 5 <> 0""")
def j26(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    files = o.select(F.concat(F.lit("pkg/v1/"), k, F.lit("/img-"), k % 7, F.lit(".svs")).alias("file"))
    urls = o.filter(k % 5 != 0).select(F.concat(k, F.lit("_img_"), k % 7, F.lit(".svs")).alias("url"))
    return MD.match_by_suffix(files, urls)


@query("j33_path_hashes", """SELECT './a-b/' || o_orderkey || '.svs' AS path, md5(CAST(o_orderkey AS VARCHAR)) AS hash FROM orders WHERE o_orderkey % 6 <> 0
UNION ALL SELECT './a-b/' || o_orderkey || '.svs', NULL FROM orders WHERE o_orderkey % 6 = 0""")
def j33(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    hit, miss = MD.path_hashes(o.select(F.concat(F.lit("./a-b/"), k, F.lit(".svs")).alias("path")),
                               o.filter(k % 6 != 0).select(F.concat(F.lit("a_b/"), k, F.lit(".svs")).alias("path"), F.md5(k.cast("string")).alias("hash")))
    return hit.unionByName(miss, allowMissingColumns=True)


@query("j32_unlisted", "SELECT c_name AS name FROM customer WHERE c_custkey % 4 <> 0")
def j32(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), "c_custkey")
    return MD.unlisted(c.select("name"), c.filter("c_custkey % 4 = 0"))


@query("p12_exclude", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (1, 2) AND l_partkey NOT IN (3, 4) AND l_linenumber <> 7
  AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def p12(spark, sf):
    bad = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return MD.exclude(table(spark, sf, "lineitem"), l_suppkey=[1, 2], l_partkey=[3, 4], l_linenumber=[7], l_orderkey=bad).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("p13_like_any", "SELECT page_id FROM pages WHERE url LIKE '%example.com/fr%' OR url LIKE '%/en/%' OR starts_with(url, 'http://m.')")
def p13(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").filter(u.like("%example.com/fr%") | u.like("%/en/%") | u.startswith("http://m.")).select("page_id")


@query("p14_membership", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def p14(spark, sf):
    c = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    o = table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return o.join(c, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("o_orderkey")
