"""Withdrawal queries and version lifespans."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.functions.exprs import alive_at, touched_by
from vcat.operators import redact as R
from vcat.operators.flatten import all_flattened, all_joined
from vcat.operators.validate import missing_count
from vcat.plans import fixtures as fx
from vcat.plans.fixtures import table
from vcat.plans.oracle import merkle, uuid, with_
from vcat.plans.q_flatten import flat, stored_sources
from vcat.plans.registry import query
from vcat.sources.publish import scratch_dir

_RED = """red_rows AS (SELECT DISTINCT i_uuid, se_uuid, st_uuid, p_uuid, c_uuid, i_rev, i_final, se_rev, se_final, up_rev, up_final,
  pub_gcs_bucket, pub_aws_bucket, series_instance_uid, sop_instance_uid FROM joined WHERE red)"""
_COLS = ["i_uuid", "se_uuid", "st_uuid", "p_uuid", "c_uuid", *[f"{p}_{x}_version" for p in ("c", "p", "st", "se", "i") for x in ("rev", "final")],
         "pub_gcs_bucket", "pub_aws_bucket", "series_instance_uid", "sop_instance_uid"]


def redactions(spark, sf):
    """The withdrawn instances are picked before the hierarchy is flattened, so that only their rows go through its joins."""
    red = fx.items(spark, sf).filter("red").select(F.col("sop").alias("sop_instance_uid"))
    lv = fx.levels(spark, sf)
    f = all_flattened({**lv, "instance": lv["instance"].join(red, "sop_instance_uid", "left_semi")}, fx.edges(spark, sf))
    return all_joined(f, stored_sources(spark, sf)).select(*_COLS).distinct()


def light(spark, sf):
    """The redaction set from the keys alone: what the level-wise steps need, without the full flatten."""
    return fx.redactions(spark, sf)


@query("p15_alive_at", with_("inst") + "SELECT i_uuid, i_rev <= 1 AND (1 <= i_final OR i_final = 0) AS at_1, i_rev <= 2 AND (2 <= i_final OR i_final = 0) AS at_2 FROM inst")
def p15(spark, sf):
    lv = fx.levels(spark, sf)["instance"]
    return lv.select(F.col("uuid").alias("i_uuid"), alive_at(1).alias("at_1"), alive_at(2).alias("at_2"))


@query("p16_touched_by", with_("inst") + "SELECT i_uuid, i_final <= 1 OR (i_rev <= 1 AND 1 <= i_final) AS by_1 FROM inst")
def p16(spark, sf):
    return fx.levels(spark, sf)["instance"].select(F.col("uuid").alias("i_uuid"), touched_by(1).alias("by_1"))


@query("m1_mark", with_("inst") + "SELECT i_uuid AS uuid, red AS redacted, CASE WHEN red THEN 'm1' END AS mitigation FROM inst")
def m1(spark, sf):
    out = R.mark(fx.levels(spark, sf)["instance"], light(spark, sf), 2, "m1")
    return out.select("uuid", "redacted", "mitigation")


def withdrawn(spark, sf):
    """All levels after the withdrawal."""
    return R.withdraw(fx.levels(spark, sf), fx.edges(spark, sf), light(spark, sf), 2, "m1")


# a series and its instances are linked where both are alive in one of the two versions
_SM = f"""hit AS (SELECT o_orderkey AS k, se_rev AS r, bool_and(red) AS red, {merkle("CASE WHEN red THEN '' ELSE hash END")} AS h FROM (
    SELECT DISTINCT o_orderkey, se_rev, sop, i_rev, hash, red FROM ser JOIN inst ON l_orderkey = o_orderkey
    WHERE (se_rev <= 1 AND (1 <= se_final OR se_final = 0) AND i_rev <= 1 AND (1 <= i_final OR i_final = 0)) OR (se_rev <= 2 AND (2 <= se_final OR se_final = 0) AND i_rev <= 2 AND (2 <= i_final OR i_final = 0)))
  GROUP BY 1, 2 HAVING bool_or(red)),
sm AS (SELECT o_orderkey, o_custkey, se_rev, se_final, se_uuid, coalesce(hit.red, false) AS red, hit.k IS NOT NULL AS hit,
  CASE WHEN hit.k IS NULL THEN md5('series|' || o_orderkey || '|' || se_rev) WHEN o_orderkey % 2 = 0 THEN hit.h ELSE '' END AS src_a,
  CASE WHEN hit.k IS NULL THEN md5(md5('series|' || o_orderkey || '|' || se_rev)) WHEN o_orderkey % 2 = 1 THEN hit.h ELSE '' END AS src_b,
  CASE WHEN hit.k IS NULL THEN md5(md5(md5('series|' || o_orderkey || '|' || se_rev))) ELSE hit.h END AS all_hash
  FROM ser LEFT JOIN hit ON hit.k = o_orderkey AND r = se_rev)"""


@query("m2_series_rollup", with_("inst", "ser", extra=_SM) + "SELECT se_uuid AS uuid, red AS redacted, src_a, src_b, all_hash, CASE WHEN hit THEN 'm1' END AS mitigation FROM sm")
def m2(spark, sf):
    out = R.withdraw(fx.levels(spark, sf), fx.edges(spark, sf), light(spark, sf), 2, "m1", "series")["series"]
    return out.select("uuid", "redacted", "hashes.src_a", "hashes.src_b", F.col("hashes.all").alias("all_hash"), "mitigation")


def _slot(s):
    return merkle(f"CASE WHEN red THEN '' ELSE {s} END")


def _level_sql(out, level, kids, parent, base, key, names):
    """Rows of a level at each version: rolled up where a child was hit, as stored elsewhere."""
    own = f"md5('{level}|' || " + (f"{key} || '|' || v)" if level != "version" else "v)")
    return f"""{out}_hit AS (SELECT {parent} AS k, v AS kv, bool_and(red) AS red, {_slot('src_a')} AS src_a, {_slot('src_b')} AS src_b, {_slot('all_hash')} AS all_hash FROM {kids} GROUP BY 1, 2 HAVING bool_or(hit)),
{out} AS (SELECT {names}, v, k IS NOT NULL AS hit, coalesce(red, false) AS red, CASE WHEN k IS NULL THEN {own} ELSE src_a END AS src_a,
  CASE WHEN k IS NULL THEN md5({own}) ELSE src_b END AS src_b, CASE WHEN k IS NULL THEN md5(md5({own})) ELSE all_hash END AS all_hash
  FROM {base} LEFT JOIN {out}_hit ON k = {key} AND kv = v)"""


_ST = ("links AS (SELECT v, sm.* FROM sm, (VALUES (1), (2)) t(v) WHERE se_rev <= v AND (v <= se_final OR se_final = 0)),\n"
       + _level_sql("strows", "study", "links", "o_custkey", "customer CROSS JOIN (VALUES (1), (2)) t(v)", "c_custkey", "c_custkey, c_nationkey"))
_UP = ",\n".join([_ST, _level_sql("prows", "patient", "strows", "c_nationkey", "nation CROSS JOIN (VALUES (1), (2)) t(v)", "n_nationkey", "n_nationkey, n_regionkey"),
                  _level_sql("crows", "collection", "prows", "n_regionkey", "region CROSS JOIN (VALUES (1), (2)) t(v)", "r_regionkey", "r_regionkey, 0 AS whole"),
                  _level_sql("vrows", "version", "crows", "whole", "(VALUES (0, 1), (0, 2)) t(w, v)", "w", "w")])
_SHOWN = "red AS redacted, src_a, src_b, all_hash"


@query("m3_study_rollup", with_("inst", "ser", extra=_SM + ",\n" + _ST) + f"SELECT {uuid('study', 'c_custkey', 'v')} AS uuid, {_SHOWN} FROM strows")
def m3(spark, sf):
    return withdrawn(spark, sf)["study"].select("uuid", "redacted", "hashes.src_a", "hashes.src_b", F.col("hashes.all").alias("all_hash"))


@query("m3_upper_rollups", with_("inst", "ser", extra=_SM + ",\n" + _UP) + f"""SELECT 'patient' AS level, {uuid('patient', 'n_nationkey', 'v')} AS id, {_SHOWN} FROM prows
UNION ALL SELECT 'collection', {uuid('collection', 'r_regionkey', 'v')}, {_SHOWN} FROM crows UNION ALL SELECT 'version', CAST(v AS VARCHAR), false, src_a, src_b, all_hash FROM vrows""")
def m3_upper(spark, sf):
    out = withdrawn(spark, sf)
    parts = []
    for name in ("patient", "collection", "version"):
        key, red = ("version", F.lit(False)) if name == "version" else ("uuid", F.col("redacted"))
        parts.append(out[name].select(F.lit(name).alias("level"), F.col(key).cast("string").alias("id"), red.alias("redacted"), "hashes.src_a", "hashes.src_b", F.col("hashes.all").alias("all_hash")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("m4_stack_rollup", with_("items") + f"""SELECT 'se.' || l_orderkey AS series_instance_uid, bool_and(red) AS redacted, {merkle("CASE WHEN red THEN '' ELSE h END")} AS hash
FROM (SELECT *, md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, size)) AS h FROM items) GROUP BY 1""")
def m4(spark, sf):
    st = fx.source_stack(spark, sf)
    red = fx.items(spark, sf).select(F.col("sop").alias("sop_instance_uid"), "red")
    kids = st["instance"].join(red, "sop_instance_uid").withColumn("redacted", F.col("red"))
    return R.redact_stack(st["series"], kids, "series_instance_uid", "sop_instance_uid").select("series_instance_uid", "redacted", "hash")


_P = """SELECT DISTINCT version, CASE WHEN c.all_hash = '' THEN '' ELSE collection_id END AS collection_id, c.all_hash AS collection_hash, up_rev AS c_rev_version, up_final AS c_final_version,
  CASE WHEN p.all_hash = '' THEN '' ELSE submitter_case_id END AS submitter_case_id, p.all_hash AS patient_hash, up_rev AS p_rev_version, up_final AS p_final_version,
  CASE WHEN st.all_hash = '' THEN '' ELSE study_instance_uid END AS study_instance_uid, st.all_hash AS study_hash, up_rev AS st_rev_version, up_final AS st_final_version,
  CASE WHEN sm.all_hash = '' THEN '' ELSE series_instance_uid END AS series_instance_uid, sm.all_hash AS series_hash, flat.se_rev AS se_rev_version, flat.se_final AS se_final_version
FROM flat JOIN sm ON sm.o_orderkey = flat.o_orderkey AND sm.se_rev = flat.se_rev JOIN strows st ON st.c_custkey = flat.c_custkey AND st.v = version
JOIN prows p ON p.n_nationkey = flat.n_nationkey AND p.v = version JOIN crows c ON c.r_regionkey = flat.r_regionkey AND c.v = version WHERE flat.red"""


def _patch(spark, sf):
    """From the results of the withdrawal: the flattened rows of withdrawn instances alone."""
    out = withdrawn(spark, sf)
    gone = out["instance"].filter("redacted")
    f = all_flattened({**out, "instance": gone}, fx.edges(spark, sf))
    return fx.stored(spark, sf, "hash_patch", lambda: R.hash_patch(f, gone.select(F.col("uuid").alias("i_uuid"))))


@query("m5_hash_patch", with_("flat", extra=_SM + ",\n" + _UP) + _P)
def m5(spark, sf):
    return _patch(spark, sf)


def _one_sql(name, key, h):
    return f"{name} AS (SELECT version, {key}, max({h}) AS new_{h} FROM patch WHERE {key} <> '' GROUP BY 1, 2)"


@query("m6_apply_patch", with_("flat", extra=_SM + ",\n" + _UP + f",\npatch AS ({_P}),\n" + ",\n".join(_one_sql(f"n{i}", k, h) for i, (_, k, h) in enumerate(R.PATCHED)))
       + "SELECT version, i_uuid, " + ", ".join(f"coalesce(new_{h}, md5({k})) AS {h}" for _, k, h in R.PATCHED)
       + " FROM flat " + " ".join(f"LEFT JOIN n{i} USING (version, {k})" for i, (_, k, _) in enumerate(R.PATCHED)))
def m6(spark, sf):
    """A published table whose hashes are all stale, patched in its files; versions that the patch says nothing of are not touched."""
    path = f"{scratch_dir(spark)}/published"
    flat(spark, sf).select("version", "i_uuid", *[k for _, k, _ in R.PATCHED], *[F.md5(k).alias(h) for _, k, h in R.PATCHED]).write.option(
        "compression", "zstd").partitionBy("version").parquet(path)
    R.patch_published(path, _patch(spark, sf))
    return spark.read.parquet(path).select("version", "i_uuid", *[h for _, _, h in R.PATCHED])


@query("j27_update_from", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'new' ELSE p_brand END AS p_brand, p_name FROM part")
def j27(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    patch = p.filter("p_partkey % 3 = 0").select("p_partkey", F.lit("new").alias("p_brand"))
    return R.apply_patch(p, patch, ["p_partkey"], ["p_brand"])


@query("j21_lifespan_versions", with_("inst") + "SELECT i_uuid, v AS version FROM inst JOIN (VALUES (1), (2)) t(v) ON i_rev <= v AND (v <= i_final OR i_final = 0) WHERE red")
def j21(spark, sf):
    return R.redaction_versions(light(spark, sf), fx.LAST)


@query("m7_delete_redacted", with_("flat") + "SELECT version, i_uuid, i_size FROM flat WHERE NOT red")
def m7(spark, sf):
    return R.delete_redacted(flat(spark, sf).select("version", "i_uuid", "i_size"), light(spark, sf), fx.LAST)


@query("j20_removed_rows", with_("inst") + "SELECT i_uuid, size FROM inst WHERE red")
def j20(spark, sf):
    i = fx.levels(spark, sf)["instance"].select(F.col("uuid").alias("i_uuid"), "size")
    return i.join(light(spark, sf).select("i_uuid").distinct(), "i_uuid", "left_semi")


@query("m8_check_deleted", with_("flat") + """SELECT version, i_uuid, 'left' AS side FROM flat WHERE NOT red AND l_orderkey % 50 = 2
UNION ALL SELECT version, i_uuid, 'right' FROM flat WHERE red AND l_orderkey % 60 = 0""")
def m8(spark, sf):
    k = F.regexp_replace("series_instance_uid", "se.", "").cast("bigint")
    rows = flat(spark, sf).select("version", "i_uuid", k.alias("k"))
    gone = light(spark, sf)
    actual = R.delete_redacted(rows, gone, fx.LAST).filter("k % 50 <> 2").unionByName(
        rows.filter("k % 60 = 0").join(gone.select("i_uuid").distinct(), "i_uuid", "left_semi").select(*rows.columns))
    return R.check_deleted(rows, actual, gone, fx.LAST)


_URL = "'gs://' || pub_gcs_bucket || '/' || se_uuid || '/' || i_uuid || '.dcm, s3://' || pub_aws_bucket || '/' || se_uuid || '/' || i_uuid || '.dcm'"


@query("m9_deindex_manifest", with_("joined", extra=_RED) + f"""SELECT 'dg.0/' || i_uuid AS "GUID", '[' || string_agg(u, ', ' ORDER BY split_part(u, '/', 4)) || ']' AS url
FROM (SELECT DISTINCT i_uuid, {_URL} AS u FROM red_rows) GROUP BY i_uuid""")
def m9(spark, sf):
    return R.deindex_manifest(redactions(spark, sf), "dg.0/")


@query("m10_removal_list", with_("joined", extra=_RED) + "SELECT DISTINCT pub_gcs_bucket AS bucket, se_uuid || '/' || i_uuid || '.dcm' AS name FROM red_rows")
def m10(spark, sf):
    return R.removal_list(redactions(spark, sf))


@query("q14_missing_count", "SELECT CAST(count(*) FILTER (p_partkey % 11 = 0 OR p_partkey % 13 = 0) AS BIGINT) AS missing, CAST(count(*) AS BIGINT) AS n_rows FROM part")
def q14(spark, sf):
    k = F.col("p_partkey")
    url = F.when(k % 11 == 0, None).when(k % 13 == 0, "").otherwise(F.col("p_name"))
    return missing_count(table(spark, sf, "part").select(url.alias("url")), "url")
