"""Version lifecycle queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vcat.functions.exprs import pack_hashes, pack_id, unpack_hashes, unpack_id, uuid_of
from vcat.operators import lifecycle as L
from vcat.operators.metadata import version_metadata
from vcat.plans import fixtures as fx
from vcat.plans.fixtures import table
from vcat.plans.oracle import content, merkle, uuid, with_
from vcat.plans.registry import query
from vcat.sources.publish import settle

KEY = ["l_orderkey", "sop"]


def _struct(source, h):
    return F.struct(F.when(source == "src_a", h).otherwise("").alias("src_a"),
                    F.when(source == "src_b", h).otherwise("").alias("src_b"))


def _has(source):
    return F.struct((source == "src_a").alias("src_a"), (source == "src_b").alias("src_b"))


def offered(spark, sf, v):
    """Instances the sources offer for release v."""
    df = fx.items(spark, sf).filter(F.col(f"p{v}"))
    s = F.col("source")
    return df.select(*KEY, _struct(s, fx.content_hash(str(v))).alias("hashes"), _has(s).alias("sources"))


def stored(spark, sf):
    """Instance level after release 1."""
    return offered(spark, sf, 1).select(
        *KEY, uuid_of("instance", F.concat_ws("|", *KEY), F.lit(1)).alias("uuid"), "hashes", "sources",
        F.lit(1).alias("init_version"), F.lit(1).alias("rev_version"), F.lit(0).alias("final_version"))


_STATUS = "CASE WHEN NOT p1 THEN 'new' WHEN NOT p2 THEN 'retired' WHEN chg THEN 'revised' ELSE 'unchanged' END"


@query("v1_classify", with_("items") + f"SELECT l_orderkey, sop, {_STATUS} AS status FROM items WHERE p1 OR p2")
def v1(spark, sf):
    return L.classify(stored(spark, sf), offered(spark, sf, 2), KEY).select(*KEY, "status")


def series_at(spark, sf, v):
    df = fx.items(spark, sf).filter(F.col(f"p{v}")).withColumn("h", fx.content_hash(str(v)))
    rolled = L.series_rollup(df, ["l_orderkey"], "h", "source", ["sop"])
    src = F.col("l_orderkey") % 2 == 0
    return rolled.select("l_orderkey", "hashes", F.struct(src.alias("src_a"), (~src).alias("src_b")).alias("sources"))


_SER_AT = "s{v} AS (SELECT l_orderkey, {m} AS hash FROM (SELECT l_orderkey, {c} AS h FROM items WHERE p{v}) GROUP BY 1)"
_S12 = ",\n".join(_SER_AT.format(v=v, m=merkle("h"), c=content(str(v))) for v in (1, 2))
_CMP = ("CASE WHEN a.hash IS NULL THEN 'new' WHEN b.hash IS NULL THEN 'retired' WHEN a.hash <> b.hash THEN 'revised' "
        "ELSE 'unchanged' END")


@query("v1_classify_series", with_("items", extra=_S12) + f"""SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, {_CMP} AS status
FROM s1 a FULL JOIN s2 b ON a.l_orderkey = b.l_orderkey""")
def v1_series(spark, sf):
    prev = series_at(spark, sf, 1).withColumn("uuid", uuid_of("series", "l_orderkey", F.lit(1))).withColumn("init_version", F.lit(1))
    return L.classify(prev, series_at(spark, sf, 2), ["l_orderkey"]).select("l_orderkey", "status")


@query("v2_revised_sources", with_("items") + """SELECT l_orderkey, sop, chg AND source = 'src_a' AS src_a, chg AND source = 'src_b' AS src_b
FROM items WHERE p1 AND p2""")
def v2(spark, sf):
    out = L.classify(stored(spark, sf), offered(spark, sf, 2), KEY).filter("status IN ('revised', 'unchanged')")
    return out.select(*KEY, "revised.src_a", "revised.src_b")


def skips(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("l_orderkey"), F.struct((k % 7 == 0).alias("src_a"), (k % 11 == 0).alias("src_b")).alias("skipped"))


@query("v3_existence", with_("items") + """SELECT l_orderkey, sop, status FROM (
  SELECT l_orderkey, sop, CASE WHEN NOT p1 AND NOT sk THEN 'new' WHEN NOT p1 THEN NULL WHEN l_orderkey % 77 = 0 THEN 'unchanged'
    WHEN NOT p2 AND NOT sk THEN 'retired' WHEN p2 AND chg AND NOT sk THEN 'revised' ELSE 'unchanged' END AS status
  FROM (SELECT *, CASE WHEN source = 'src_a' THEN l_orderkey % 7 = 0 ELSE l_orderkey % 11 = 0 END AS sk FROM items WHERE p1 OR p2))
WHERE status IS NOT NULL""")
def v3(spark, sf):
    return L.classify(stored(spark, sf), offered(spark, sf, 2), KEY, skips(spark, sf), ["l_orderkey"]).select(*KEY, "status")


_HAVE = """(SELECT o_custkey AS c, bool_or(o_orderkey % 2 = 0) AS a, bool_or(o_orderkey % 2 = 1) AS b FROM orders WHERE o_orderkey % 10 {w} GROUP BY 1)"""


@query("v4_skip_mask", f"""SELECT coalesce(p.c, s.c) AS c_custkey,
  coalesce(p.c, s.c) % 5 = 0 OR coalesce(p.c, s.c) % 13 = 0 OR (p.c IS NOT NULL AND NOT p.a AND NOT coalesce(s.a, false)) AS src_a,
  coalesce(p.c, s.c) % 13 = 0 OR (p.c IS NOT NULL AND NOT p.b AND NOT coalesce(s.b, false)) AS src_b
FROM {_HAVE.format(w='< 2')} p FULL JOIN {_HAVE.format(w='BETWEEN 1 AND 3')} s ON p.c = s.c""")
def v4(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    have = lambda w: L.sources_of(o.filter(w).select(
        F.col("o_custkey").alias("c_custkey"), F.struct((k % 2 == 0).alias("src_a"), (k % 2 == 1).alias("src_b")).alias("sources")), ["c_custkey"])
    cust = table(spark, sf, "customer").select("c_custkey")
    out = L.skip_mask(have(k % 10 < 2), have((k % 10).between(1, 3)), cust.filter("c_custkey % 5 = 0").withColumn("source", F.lit("src_a")),
                      cust.filter("c_custkey % 13 = 0"), "c_custkey")
    return out.select("c_custkey", "skipped.src_a", "skipped.src_b")


@query("v5_v6_apply_version", with_("inst") + f"""SELECT sop, {uuid('instance', "l_orderkey || '|' || sop", 'i_rev')} AS uuid,
  i_init AS init_version, i_rev AS rev_version, i_final AS final_version, CASE WHEN i_rev = 2 THEN size + 1 ELSE size END AS size,
  i_init = 1 AND excluded AS excluded, false AS redacted, CASE WHEN i_init = 1 THEN '10.5281/d.' || l_orderkey END AS source_doi, hash AS content,
  source = 'src_a' AS from_a FROM inst""")
def v5(spark, sf):
    """Attributes of the old row are kept, those of the offer (sizes) replace them."""
    own = fx.items(spark, sf)
    attributes = own.select("sop", "size", "excluded", F.lit(False).alias("redacted"), F.concat(F.lit("10.5281/d."), "l_orderkey").alias("source_doi"))
    # Both are read several times.
    first = stored(spark, sf)
    narrow = first.select(*KEY, pack_id("uuid").alias("uuid"), *pack_hashes(first, "hashes", "hashes"), "sources", "init_version", "rev_version", "final_version").join(attributes, "sop")
    level = settle(narrow.select(*[unpack_id(c).alias(c) if c == "uuid" else unpack_hashes(narrow.columns, c).alias(c) if c == "hashes" else c
                                   for c in (*first.columns, *attributes.columns[1:])]))
    status = settle(L.classify(level, offered(spark, sf, 2), KEY).filter("status <> 'unchanged'").drop("revised"))
    sizes = own.filter("p2").select(*KEY, (F.col("size") + 1).alias("size"))
    out = L.apply_version(level, status, KEY, "instance", 2, sizes)
    content_of = F.concat("hashes.src_a", "hashes.src_b").alias("content")
    return out.select("sop", "uuid", "init_version", "rev_version", "final_version", "size", "excluded", "redacted", "source_doi", content_of, F.col("sources.src_a").alias("from_a"))


@query("v5_skipped_sources", """SELECT o_orderkey, CASE WHEN NOT sa AND (n % 2 = 0 OR n % 3 = 0) OR NOT sb AND n % 3 <> 1 THEN 'revised' ELSE 'unchanged' END AS status,
  CASE WHEN NOT sa AND n % 2 = 0 THEN 'A2' WHEN NOT sa AND n % 3 = 0 THEN '' ELSE 'A1' END AS src_a, CASE WHEN NOT sb AND n % 3 = 0 THEN 'B2' WHEN NOT sb AND n % 3 = 2 THEN '' ELSE 'B1' END AS src_b,
  sa OR n % 2 = 0 OR n % 3 <> 0 AS in_a, sb OR n % 3 <> 2 AS in_b
FROM (SELECT o_orderkey, o_orderkey % 6 AS n, o_orderkey % 7 = 0 AS sa, o_orderkey % 11 = 0 AS sb FROM orders)""")
def v5_skipped(spark, sf):
    """Both sources hold every object; each offers new content, the old one or nothing, and either may be skipped."""
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 6).alias("n"))
    both = lambda a, b: F.struct(a.alias("src_a"), b.alias("src_b"))
    prev = o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("uuid"), F.lit(1).alias("init_version"), both(F.lit("A1"), F.lit("B1")).alias("hashes"),
                    both(F.lit(True), F.lit(True)).alias("sources"))
    a = F.when(F.col("n") % 2 == 0, "A2").when(F.col("n") % 3 != 0, "A1")
    b = F.when(F.col("n") % 3 == 0, "B2").when(F.col("n") % 3 == 1, "B1")
    src = o.select("o_orderkey", both(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))).alias("hashes"), both(a.isNotNull(), b.isNotNull()).alias("sources"))
    out = L.classify(prev, src, ["o_orderkey"], skips(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])
    return out.select("o_orderkey", "status", "hashes.src_a", "hashes.src_b", F.col("sources.src_a").alias("in_a"), F.col("sources.src_b").alias("in_b"))


def _ser_level(spark, sf):
    return fx.series_versions(spark, sf).withColumn("uuid", uuid_of("series", "o_orderkey", "rev_version"))


def _inst_level(spark, sf):
    return fx.instance_versions(spark, sf).withColumn("uuid", uuid_of("instance", "sop", "rev_version"))


@query("v7_v11_next_edges", with_("inst", "ser") + "SELECT se_uuid AS series_uuid, i_uuid AS instance_uuid FROM ser JOIN inst ON l_orderkey = o_orderkey WHERE se_rev = 2 AND i_final = 0")
def v11(spark, sf):
    kids = _inst_level(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    return L.next_edges(_ser_level(spark, sf), kids, ["o_orderkey"], "series", "instance", 2)


@query("v8_retire", with_("inst") + "SELECT i_uuid AS uuid, CASE WHEN l_orderkey % 50 = 0 AND i_final = 0 THEN 2 ELSE i_final END AS final_version FROM inst")
def v8(spark, sf):
    ser = _ser_level(spark, sf)
    gone = ser.filter("o_orderkey % 50 = 0 AND final_version = 0")
    out = L.retire({"series": ser, "instance": _inst_level(spark, sf)}, fx.edges(spark, sf), ["series", "instance"], gone, 3)
    return out["instance"].select("uuid", "final_version")


@query("v9_rename", "SELECT n_nationkey, n_name AS old_name, lower(n_name) AS new_name FROM nation WHERE n_nationkey % 4 = 1")
def v9(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    src = n.select(F.when(F.col("n_nationkey") % 4 == 1, F.lower("n_name")).otherwise(F.col("n_name")).alias("n_name"))
    return L.rename(n, n, src, "n_nationkey", "n_name")


@query("v9_classify_renamed", "SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 1 THEN lower(n_name) ELSE n_name END AS name, CASE WHEN n_nationkey % 4 = 1 THEN 'renamed' ELSE 'unchanged' END AS status FROM nation")
def v9b(spark, sf):
    n = table(spark, sf, "nation")
    h = F.struct(F.md5("n_name").alias("src_a"), F.lit("").alias("src_b"))
    has = F.struct(F.lit(True).alias("src_a"), F.lit(False).alias("src_b"))
    prev = n.select("n_nationkey", F.col("n_name").alias("name"), F.col("n_name").alias("uuid"), F.lit(1).alias("init_version"),
                    h.alias("hashes"), has.alias("sources"))
    src = n.select("n_nationkey", F.when(F.col("n_nationkey") % 4 == 1, F.lower("n_name")).otherwise(F.col("n_name")).alias("name"),
                   h.alias("hashes"), has.alias("sources"))
    return L.classify(prev, src, ["n_nationkey"], name="name").select("n_nationkey", "name", "status")


@query("v10_clone_version", f"SELECT 3 AS version, {uuid('collection', 'r_regionkey', '2')} AS collection_uuid FROM region")
def v10(spark, sf):
    return L.clone_version(fx.edges(spark, sf)["version_collection"], 3)


@query("v12_prune_to_revised", with_("flat") + "SELECT DISTINCT i_uuid AS uuid FROM flat WHERE se_rev = 2")
def v12(spark, sf):
    return L.prune_to_revised(_inst_level(spark, sf), fx.edges(spark, sf)["series_instance"],
                              _ser_level(spark, sf).filter("rev_version = 2"), "series", "instance").select("uuid")


@query("v13_verify_rollup", with_("items", extra=_S12) + "SELECT l_orderkey, hash AS rolled, md5(hash) AS announced FROM s1 WHERE l_orderkey % 50 = 1")
def v13(spark, sf):
    rolled = series_at(spark, sf, 1).select("l_orderkey", F.col("hashes.all").alias("hash"))
    told = rolled.withColumn("hash", F.when(F.col("l_orderkey") % 50 == 1, F.md5("hash")).otherwise(F.col("hash")))
    return L.verify_rollup(rolled, told, ["l_orderkey"])


@query("v14_noop", "SELECT * FROM (VALUES ('same', true), ('other', false)) t(pair, noop)")
def v14(spark, sf):
    """The same offer built once more, and the next one, each on the first release."""
    first, _ = L.build_version(_nothing(spark), _offered_path(spark, sf, 1), _PATH, 1, settle=settle)
    row = lambda rows: rows["version"].select(F.col("hashes.all").alias("hash"))
    a, again, later = row(first), *(row(L.build_version(first, _offered_path(spark, sf, v), _PATH, 2, settle=settle)[0]) for v in (1, 2))
    same, other = L.is_noop(a, again), L.is_noop(a, later)
    return same.select(F.lit("same").alias("pair"), "noop").unionByName(other.select(F.lit("other").alias("pair"), "noop"))


_ORDER = ["collection", "patient", "study", "series", "instance"]


@query("v15_rollback", with_("inst") + "SELECT i_uuid AS uuid, i_init AS init_version, i_rev AS rev_version, 0 AS final_version FROM inst WHERE i_rev = 1")
def v15(spark, sf):
    levels, _ = L.rollback(fx.levels(spark, sf), fx.edges(spark, sf), _ORDER, 2)
    return levels["instance"].select("uuid", "init_version", "rev_version", "final_version")


@query("v15_rollback_edges", with_("inst", "ser") + """SELECT se_uuid AS series_uuid, i_uuid AS instance_uuid FROM ser JOIN inst ON l_orderkey = o_orderkey
WHERE se_rev = 1 AND i_rev = 1""")
def v15e(spark, sf):
    return L.rollback(fx.levels(spark, sf), fx.edges(spark, sf), _ORDER, 2)[1]["series_instance"]


@query("v15_rollback_named", with_("inst") + """SELECT i_uuid AS uuid, i_rev AS rev_version,
  CASE WHEN r_name = 'ASIA' AND i_final = 1 THEN 0 ELSE i_final END AS final_version
FROM inst JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey WHERE NOT (r_name = 'ASIA' AND i_rev = 2)""")
def v15n(spark, sf):
    levels, _ = L.rollback(fx.levels(spark, sf), fx.edges(spark, sf), _ORDER, 2, only=["ASIA"])
    return levels["instance"].select("uuid", "rev_version", "final_version")


@query("w2_predecessor", with_("ser") + f"SELECT o_orderkey, {uuid('series', 'o_orderkey', '1')} AS prior_uuid, 1 AS prior_version FROM ser WHERE se_rev = 2 AND se_init = 1")
def w2(spark, sf):
    return L.predecessor(_ser_level(spark, sf), ["o_orderkey"], 2)


# --- source stack ---------------------------------------------------------------------------------


def stack(spark, sf):
    st = fx.source_stack(spark, sf)
    names = st["collection"].select("collection_id", F.col("_k").alias("_p"))
    st["patient"] = st["patient"].join(names, "_p").drop("_p", "_k")
    st["collection"] = st["collection"].drop("_k")
    return st


def manifest(spark, sf):
    """Every fourth order: first lines with new content, third lines as new instances of the series,
    seventh lines as a new series of a new study."""
    n = F.col("l_linenumber")
    df = fx.items(spark, sf).filter("l_orderkey % 4 = 0 AND l_linenumber IN (1, 2, 3, 7)")
    h = fx.content_hash("1")
    return df.select(
        F.lit("NEWCOLL").alias("collection_id"), F.lit("NEWPAT").alias("submitter_case_id"),
        F.concat(F.lit("st.new."), F.col("l_orderkey") % 10).alias("study_instance_uid"),
        F.when(n == 7, F.concat(F.lit("se.new."), "l_orderkey")).otherwise(F.concat(F.lit("se."), "l_orderkey")).alias("series_instance_uid"),
        F.when(n.isin(3, 7), F.concat("sop", F.lit(".new"))).otherwise(F.col("sop")).alias("sop_instance_uid"),
        F.when(n == 1, F.md5(h)).otherwise(h).alias("hash"), "size", F.concat(F.lit("gs://new/"), "sop").alias("ingestion_url")
    ).dropDuplicates(["sop_instance_uid"])


@query("v15_rollback_version", "SELECT 1 AS version, " + uuid("collection", "r_regionkey", "1") + " AS collection_uuid FROM region")
def v15v(spark, sf):
    """The undone version keeps no edge to a collection."""
    return L.rollback(fx.levels(spark, sf), fx.edges(spark, sf), _ORDER, 2)[1]["version_collection"]


_H = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, size))"


@query("v16_upsert_instances", with_("items") + f"""SELECT sop AS sop_instance_uid, 'se.' || l_orderkey AS series_instance_uid,
  CASE WHEN up THEN md5({_H}) ELSE {_H} END AS hash, size, CASE WHEN up THEN 'gs://new/' || sop ELSE 'gs://in/' || l_orderkey || '/' || sop || '.dcm' END AS ingestion_url,
  CASE WHEN up THEN 5 ELSE 1 END AS version FROM (SELECT *, l_orderkey % 4 = 0 AND l_linenumber = 1 AS up FROM items)
UNION ALL SELECT DISTINCT sop || '.new', CASE WHEN l_linenumber = 7 THEN 'se.new.' ELSE 'se.' END || l_orderkey, {_H}, size, 'gs://new/' || sop, 5
FROM items WHERE l_orderkey % 4 = 0 AND l_linenumber IN (3, 7)""")
def v16(spark, sf):
    out = L.upsert_stack(stack(spark, sf), manifest(spark, sf), "10.5281/NEW", 5)
    return out["instance"].select("sop_instance_uid", "series_instance_uid", "hash", "size", "ingestion_url", "version")


@query("v16_upsert_series", with_("items", extra="""t AS (SELECT DISTINCT l_orderkey FROM items WHERE l_orderkey % 4 = 0 AND l_linenumber IN (1, 2, 3)),
n AS (SELECT DISTINCT l_orderkey FROM items WHERE l_orderkey % 4 = 0 AND l_linenumber = 7)""") + """SELECT 'se.' || o_orderkey AS series_instance_uid,
  'st.' || o_custkey AS study_instance_uid, CASE WHEN l_orderkey IS NOT NULL THEN '10.5281/new' ELSE '10.5281/d.' || (o_orderkey % 40) END AS source_doi,
  CASE WHEN l_orderkey IS NOT NULL THEN 'https://doi.org/10.5281/new' ELSE 'https://doi.org/10.5281/d.' || (o_orderkey % 40) END AS source_url,
  CASE WHEN l_orderkey IS NOT NULL THEN '10.5281/new.v5' ELSE '10.5281/d.' || (o_orderkey % 40) || '.v1' END AS versioned_source_doi, false AS fresh
FROM orders LEFT JOIN t ON l_orderkey = o_orderkey
UNION ALL SELECT 'se.new.' || l_orderkey, 'st.new.' || (l_orderkey % 10), '10.5281/new', 'https://doi.org/10.5281/new', '10.5281/new.v5', true FROM n""")
def v16s(spark, sf):
    twice = manifest(spark, sf).unionByName(manifest(spark, sf))  # repeated rows make no difference
    out = L.upsert_stack(stack(spark, sf), twice, "10.5281/NEW", 5, "10.5281/NEW.v5")
    fresh = F.col("series_instance_uid").startswith("se.new.") & ~F.col("excluded") & ~F.col("redacted")
    return out["series"].select("series_instance_uid", "study_instance_uid", "source_doi", "source_url", "versioned_source_doi", fresh.alias("fresh"))


def _keys(levels) -> DataFrame:
    parts = [levels[lv].select(F.lit(lv).alias("level"), F.col(key).alias("id")) for lv, key, _ in L.STACK]
    return reduce(DataFrame.unionByName, parts)


def _left(where):
    return (f"i AS (SELECT * FROM items JOIN orders ON o_orderkey = l_orderkey WHERE {where})") + """
SELECT 'instance' AS level, sop AS id FROM i UNION ALL SELECT DISTINCT 'series', 'se.' || o_orderkey FROM i
UNION ALL SELECT DISTINCT 'study', 'st.' || o_custkey FROM i
UNION ALL SELECT DISTINCT 'patient', n_name FROM i JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT DISTINCT 'collection', r_name FROM i JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""


@query("v17_delete_instances", with_("items").rstrip() + ",\n" + _left("NOT (l_orderkey % 3 = 0 OR l_linenumber = 1)"))
def v17(spark, sf):
    gone = fx.items(spark, sf).filter("l_orderkey % 3 = 0 OR l_linenumber = 1").select(F.col("sop").alias("sop_instance_uid"))
    return _keys(L.delete_from_stack(stack(spark, sf), instances=gone))


@query("v17_delete_doi", with_("items").rstrip() + ",\n" + _left("o_orderkey % 40 <> 6"))
def v17d(spark, sf):
    return _keys(L.delete_from_stack(stack(spark, sf), doi="10.5281/d.6"))


@query("v17_delete_versioned_doi", with_("items").rstrip() + ",\n" + _left("o_orderkey % 40 <> 7"))
def v17v(spark, sf):
    return _keys(L.delete_from_stack(stack(spark, sf), versioned_doi="10.5281/d.7.v1"))


@query("v18_reroll", with_("items", extra=f"""se AS (SELECT o_orderkey, o_custkey, {merkle('h')} AS hash FROM orders LEFT JOIN (SELECT l_orderkey, {_H} AS h FROM items) ON l_orderkey = o_orderkey GROUP BY 1, 2),
st AS (SELECT c_custkey, c_nationkey, {merkle('hash')} AS hash FROM customer LEFT JOIN se ON o_custkey = c_custkey GROUP BY 1, 2),
p AS (SELECT n_name, n_regionkey, {merkle('hash')} AS hash FROM nation LEFT JOIN st ON c_nationkey = n_nationkey GROUP BY 1, 2),
c AS (SELECT r_name, {merkle('hash')} AS hash FROM region LEFT JOIN p ON n_regionkey = r_regionkey GROUP BY 1)""")
       + """SELECT 'series' AS level, 'se.' || o_orderkey AS id, hash FROM se UNION ALL SELECT 'study', 'st.' || c_custkey, hash FROM st
UNION ALL SELECT 'patient', n_name, hash FROM p UNION ALL SELECT 'collection', r_name, hash FROM c""")
def v18(spark, sf):
    out = L.reroll(stack(spark, sf))
    parts = [out[lv].select(F.lit(lv).alias("level"), F.col(key).alias("id"), "hash") for lv, key, _ in L.STACK[:4]]
    return reduce(DataFrame.unionByName, parts)


@query("v19_propagate_doi", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'b' || o_orderkey WHEN o_orderkey % 2 = 0 THEN 'a' || o_orderkey END AS source_doi FROM orders""")
def v19(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    a = o.filter("o_orderkey % 2 = 0").withColumn("source_doi", F.concat(F.lit("a"), "o_orderkey"))
    b = o.filter("o_orderkey % 3 = 0").withColumn("source_doi", F.concat(F.lit("b"), "o_orderkey"))
    return L.propagate_doi(o, a, b, "o_orderkey")


@query("v20_doi_renames", "SELECT '10.1/x' || c_custkey AS doi, c_name AS old_name, lower(c_name) AS new_name FROM customer WHERE c_custkey % 9 = 0")
def v20(spark, sf):
    c = table(spark, sf, "customer")
    old = c.select(F.concat(F.lit("10.1/X"), "c_custkey").alias("doi"), F.col("c_name").alias("name"))
    new = c.select(F.concat(F.lit("10.1/x"), "c_custkey").alias("doi"),
                   F.when(F.col("c_custkey") % 9 == 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("name"))
    return L.doi_renames(old, new)


@query("v21_maintain_ids", f"""SELECT c_name AS name, 'id' || c_custkey AS id FROM customer WHERE c_custkey % 5 BETWEEN 1 AND 3
UNION ALL SELECT lower(c_name), 'id' || c_custkey FROM customer WHERE c_custkey % 5 = 2
UNION ALL SELECT c_name, {uuid('id', 'c_name', '0')} FROM customer WHERE c_custkey % 5 = 4""")
def v21(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey") % 5
    old = c.filter(k != 4).select(F.col("c_name").alias("name"), F.concat(F.lit("id"), "c_custkey").alias("id"))
    now = c.filter(k != 0).select(F.when(k == 2, F.lower("c_name")).otherwise(F.col("c_name")).alias("name"))
    return L.maintain_ids(old, now)


@query("u5_presence", """SELECT o_custkey, bool_or(o_orderkey % 2 = 0) AS src_a, bool_or(o_orderkey % 3 = 0) AS src_b FROM orders
WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 GROUP BY 1""")
def u5(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return L.presence(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 3 = 0"), ["o_custkey"])


@query("u6_first_source", """SELECT o_custkey, o_orderkey, 'src_a' AS source FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT o_custkey, o_orderkey, 'src_b' FROM orders WHERE o_orderkey % 3 = 0
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 = 0)""")
def u6(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return L.first_source(o.filter("o_orderkey % 10 = 0"), o.filter("o_orderkey % 3 = 0"), ["o_custkey"], "o_orderkey")


@query("q12_duplicates", "SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q12(spark, sf):
    return L.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- a whole version ------------------------------------------------------------------------------


def _tree(spark, sf, v) -> dict[str, DataFrame]:
    """Key and hash of every object at release v, on all levels."""
    inst = offered(spark, sf, v)
    out = {"instance": inst.select(*KEY, F.concat("hashes.src_a", "hashes.src_b").alias("hash"))}
    se = series_at(spark, sf, v).select("l_orderkey", F.col("hashes.all").alias("hash"))
    out["series"] = se
    out["study"] = L.rollup(se, table(spark, sf, "orders"), "l_orderkey", "o_orderkey", "o_custkey")
    out["patient"] = L.rollup(out["study"], table(spark, sf, "customer"), "o_custkey", "c_custkey", "c_nationkey")
    out["collection"] = L.rollup(out["patient"], table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_regionkey")
    return out


_CUM = ""
for _v in (1, 2):
    _CUM += (f",\nt{_v} AS (SELECT o_custkey AS id, {merkle('hash')} AS hash FROM s{_v} JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)"
             f",\np{_v} AS (SELECT c_nationkey AS id, {merkle('hash')} AS hash FROM t{_v} JOIN customer ON c_custkey = id GROUP BY 1)"
             f",\nc{_v} AS (SELECT n_regionkey AS id, {merkle('hash')} AS hash FROM p{_v} JOIN nation ON n_nationkey = id GROUP BY 1)")


def _count(level, a, b, key="id"):
    return (f"SELECT '{level}' AS level, {_CMP} AS status, CAST(count(*) AS BIGINT) AS n FROM {a} a FULL JOIN {b} b "
            f"ON a.{key} = b.{key} GROUP BY 1, 2")


@query("v_build_version", with_("items", extra=_S12 + _CUM)
       + f"SELECT 'instance' AS level, {_STATUS} AS status, CAST(count(*) AS BIGINT) AS n FROM items WHERE p1 OR p2 GROUP BY 1, 2 UNION ALL "
       + " UNION ALL ".join([_count("series", "s1", "s2", "l_orderkey"), _count("study", "t1", "t2"), _count("patient", "p1", "p2"),
                             _count("collection", "c1", "c2")]))
def build(spark, sf):
    before, now = _tree(spark, sf, 1), _tree(spark, sf, 2)
    parts = []
    one = F.struct(F.lit(True).alias("src_a"), F.lit(False).alias("src_b"))
    for level in _ORDER:
        key = [c for c in now[level].columns if c != "hash"]
        as_struct = F.struct(F.col("hash").alias("src_a"), F.lit("").alias("src_b"))
        shape = lambda d: d.select(*key, as_struct.alias("hashes"), one.alias("sources"))
        prev = shape(before[level]).withColumn("uuid", uuid_of(level, F.concat_ws("|", *key), F.lit(1))).withColumn("init_version", F.lit(1))
        status = L.classify(prev, shape(now[level]), key)
        parts.append(status.groupBy("status").agg(F.count("*").alias("n")).select(F.lit(level).alias("level"), "status", "n"))
    return reduce(DataFrame.unionByName, parts)


_PATH = [("collection", "n_regionkey"), ("patient", "c_nationkey"), ("study", "o_custkey"), ("series", "l_orderkey"), ("instance", "sop")]


def _above(spark, sf):
    """Keys of all levels above an instance."""
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return o.join(c, F.col("c_custkey") == F.col("o_custkey")).join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "c_nationkey", "n_regionkey")


def _offered_path(spark, sf, v):
    """What the sources offer, with the keys of all levels above and the time of the release."""
    return offered(spark, sf, v).join(_above(spark, sf), "l_orderkey").withColumn("timestamp", F.expr(fx.ts_sql(str(v))))


def _attributes(spark, sf, v):
    """What the sources say of collections and series: every other collection changes its name in the second release, and all series their versioned DOI."""
    r = table(spark, sf, "region")
    name = F.when((F.col("r_regionkey") % 2 == 1) & F.lit(v == 2), F.lower("r_name")).otherwise(F.col("r_name"))
    doi = F.concat(F.lit("10.5281/d."), F.col("l_orderkey") % 40)
    series = _above(spark, sf).select("n_regionkey", "c_nationkey", "o_custkey", "l_orderkey", doi.alias("source_doi"), F.concat(doi, F.lit(f".v{v}")).alias("versioned_source_doi"))
    return {"collection": r.select(F.col("r_regionkey").alias("n_regionkey"), name.alias("collection_id")), "series": series}


def _nothing(spark):
    """Levels before the first release."""
    out = {}
    stamps = ", min_timestamp timestamp_ntz, max_timestamp timestamp_ntz"
    more = {"collection": stamps + ", collection_id string", "patient": stamps, "study": stamps + ", study_instances bigint",
            "series": stamps + ", series_instances bigint, source_doi string, versioned_source_doi string", "instance": ", timestamp timestamp_ntz"}
    for i, (name, _) in enumerate(_PATH):
        keys = ", ".join(f"{k} {'string' if k == 'sop' else 'bigint'}" for _, k in _PATH[:i + 1])
        hashes = "src_a: string, src_b: string" + ("" if name == "instance" else ", all: string")
        out[name] = spark.createDataFrame([], f"{keys}, uuid string, hashes struct<{hashes}>, sources struct<src_a: boolean, src_b: boolean>, "
                                              f"init_version int, rev_version int, final_version int{more[name]}")
    return out


def releases(spark, sf):
    """Rows and edges of two releases, each built from the one before."""
    args = {"settle": settle, "names": {"collection": "collection_id"}}
    first = L.build_version(_nothing(spark), _offered_path(spark, sf, 1), _PATH, 1, attributes=_attributes(spark, sf, 1), **args)
    return first, L.build_version(first[0], _offered_path(spark, sf, 2), _PATH, 2, attributes=_attributes(spark, sf, 2), **args)


def built(spark, sf):
    return releases(spark, sf)[1]


def _rows_sql(level, a, b, key="id"):
    return f"SELECT '{level}' AS level, CAST(coalesce(a.{key}, b.{key}) AS VARCHAR) AS id, a.hash AS h1, b.hash AS h2 FROM {a} a FULL JOIN {b} b ON a.{key} = b.{key}"


_BUILT = (", lv AS (SELECT 'instance' AS level, sop AS id, CASE WHEN p1 THEN " + content("1") + " END AS h1, CASE WHEN p2 THEN " + content("2") + " END AS h2 FROM items WHERE p1 OR p2 UNION ALL "
          + " UNION ALL ".join([_rows_sql("series", "s1", "s2", "l_orderkey"), _rows_sql("study", "t1", "t2"), _rows_sql("patient", "p1", "p2"), _rows_sql("collection", "c1", "c2")])
          + """), ro AS (SELECT level, id, 1 AS init_version, 1 AS rev_version, CASE WHEN h2 IS NULL OR h1 <> h2 THEN 1 ELSE 0 END AS final_version, h1 AS hash FROM lv WHERE h1 IS NOT NULL
  UNION ALL SELECT level, id, CASE WHEN h1 IS NULL THEN 2 ELSE 1 END, 2, 0, h2 FROM lv WHERE h2 IS NOT NULL AND (h1 IS NULL OR h1 <> h2))""")


def _stats_sql(v):
    """Numbers and the newest and oldest release of the instances below every object at release v."""
    up = "JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"
    per = [("instance", "sop", "NULL"), ("series", "l_orderkey", "count(*)"), ("study", "o_custkey", "count(*)"), ("patient", "c_nationkey", "NULL"), ("collection", "n_regionkey", "NULL")]
    rows = " UNION ALL ".join(f"SELECT '{lv}' AS level, CAST({k} AS VARCHAR) AS id, CAST({n} AS BIGINT) AS n, max(i_rev) AS hi, min(i_rev) AS lo FROM a{v} GROUP BY {k}" for lv, k, n in per)
    return f"a{v} AS (SELECT * FROM inst {up} WHERE i_rev <= {v} AND ({v} <= i_final OR i_final = 0)),\nst{v} AS ({rows})"


_TS = "CASE WHEN {c} = 1 THEN '2021-02-03 04:05:06' WHEN {c} = 2 THEN '2022-03-04 05:06:07' END"
_ATTRIBUTES = (",\n" + _stats_sql(1) + ",\n" + _stats_sql(2) + ",\nst AS (SELECT 1 AS v, * FROM st1 UNION ALL SELECT 2, * FROM st2)")


@query("v_build_rows", with_("inst", extra=_S12 + _CUM + _BUILT + _ATTRIBUTES) + f"""SELECT ro.*, st.n AS n_instances, {_TS.format(c='st.hi')} AS max_timestamp, {_TS.format(c='st.lo')} AS min_timestamp,
  CASE WHEN ro.level = 'collection' THEN (SELECT CASE WHEN r_regionkey % 2 = 1 AND rev_version = 2 THEN lower(r_name) ELSE r_name END FROM region WHERE CAST(r_regionkey AS VARCHAR) = ro.id) END AS collection_id,
  CASE WHEN ro.level = 'series' THEN '10.5281/d.' || (CAST(ro.id AS BIGINT) % 40) || '.v' || rev_version END AS versioned_source_doi
FROM ro JOIN st ON st.level = ro.level AND st.id = ro.id AND st.v = rev_version
UNION ALL SELECT 'version', '2', NULL, NULL, NULL, (SELECT md5(string_agg(hash, '' ORDER BY hash)) FROM c2), NULL, {_TS.format(c='max(i_rev)')}, {_TS.format(c='min(i_rev)')}, NULL, NULL FROM a2""")
def build_rows(spark, sf):
    """Every row of all levels with what it has of its children and of the sources."""
    rows, _ = built(spark, sf)
    told = lambda d, c: (F.col(c) if c in d.columns else F.lit(None)).cast("string").alias(c)

    def shown(name, d, key, whole, *spans):
        high, low = ("timestamp", "timestamp") if name == "instance" else ("max_timestamp", "min_timestamp")
        n = [c for c in d.columns if c in ("series_instances", "study_instances")]
        return d.select(F.lit(name).alias("level"), F.col(key).cast("string").alias("id"), *spans, whole.alias("hash"), (F.col(n[0]) if n else F.lit(None)).cast("long").alias("n_instances"),
                        F.date_format(high, "yyyy-MM-dd HH:mm:ss").alias("max_timestamp"), F.date_format(low, "yyyy-MM-dd HH:mm:ss").alias("min_timestamp"),
                        told(d, "collection_id"), told(d, "versioned_source_doi"))

    spans = ["init_version", "rev_version", "final_version"]
    parts = [shown(name, rows[name], key, F.col("hashes.all") if name != "instance" else F.concat("hashes.src_a", "hashes.src_b"), *spans) for name, key in _PATH]
    parts.append(shown("version", rows["version"], "version", F.col("hashes.all"), *[F.lit(None).cast("int").alias(c) for c in spans]))
    return reduce(DataFrame.unionByName, parts)


_PATHS = [("collection", "CAST(n_regionkey AS VARCHAR)", "''"), ("patient", "n_regionkey || '|' || c_nationkey", "CAST(n_regionkey AS VARCHAR)"),
          ("study", "n_regionkey || '|' || c_nationkey || '|' || o_custkey", "n_regionkey || '|' || c_nationkey"),
          ("series", "n_regionkey || '|' || c_nationkey || '|' || o_custkey || '|' || o_orderkey", "n_regionkey || '|' || c_nationkey || '|' || o_custkey"),
          ("instance", "n_regionkey || '|' || c_nationkey || '|' || o_custkey || '|' || o_orderkey || '|' || sop", "n_regionkey || '|' || c_nationkey || '|' || o_custkey || '|' || o_orderkey")]
_NODES = "up AS (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),\nnodes AS (" + " UNION ALL ".join(
    f"SELECT DISTINCT '{lv}' AS level, CAST({dict(_PATH)[lv].replace('l_orderkey', 'o_orderkey')} AS VARCHAR) AS id, {p} AS path, {q} AS parent FROM up" + (" JOIN items ON l_orderkey = o_orderkey" if lv == "instance" else "")
    for lv, p, q in _PATHS) + "),\nrows_ AS (SELECT ro.*, path, parent FROM ro JOIN nodes ON nodes.level = ro.level AND nodes.id = ro.id)"


def _node_uuid(a: str) -> str:
    return uuid("x", f"{a}.path", f"{a}.rev_version").replace("'x|'", f"{a}.level || '|'")


@query("v_build_edges", with_("items", extra=_S12 + _CUM + _BUILT + ",\n" + _NODES) + f"""SELECT p.level || '_' || c.level AS edge, {_node_uuid('p')} AS parent, {_node_uuid('c')} AS child
FROM rows_ p JOIN rows_ c ON c.parent = p.path AND c.final_version = 0 AND (p.level, c.level) IN (('collection', 'patient'), ('patient', 'study'), ('study', 'series'), ('series', 'instance'))
WHERE p.rev_version = 2
UNION ALL SELECT 'version_collection', '2', {_node_uuid('c')} FROM rows_ c WHERE level = 'collection' AND final_version = 0""")
def build_edges(spark, sf):
    _, edges = built(spark, sf)
    return reduce(DataFrame.unionByName, [e.select(F.lit(name).alias("edge"), F.col(e.columns[0]).cast("string").alias("parent"), F.col(e.columns[1]).alias("child")) for name, e in edges.items()])


@query("a19_version_metadata", with_("inst", extra=_S12 + _CUM) + " UNION ALL ".join(
    f"SELECT {v} AS version, (SELECT md5(string_agg(hash, '' ORDER BY hash)) FROM c{v}) AS version_hash, left({_TS.format(c='max(i_rev)')}, 10) AS version_timestamp FROM inst WHERE i_rev <= {v} AND ({v} <= i_final OR i_final = 0)"
    for v in (1, 2)))
def a19(spark, sf):
    """The version rows of two built releases."""
    (one, _), (two, _) = releases(spark, sf)
    cols = ["version", "hashes", "max_timestamp"]
    return version_metadata(one["version"].select(*cols).unionByName(two["version"].select(*cols))).withColumn("version_timestamp", F.col("version_timestamp").cast("string"))
