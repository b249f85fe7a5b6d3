"""Validation and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.functions.merkle import merkle_rollup
from vcat.operators import validate as V
from vcat.plans import fixtures as fx
from vcat.plans.fixtures import table
from vcat.plans.oracle import uuid, with_
from vcat.plans.q_flatten import joined
from vcat.plans.registry import query
from vcat.sources.publish import settle

_UP = " UNION ALL ".join(f"SELECT {uuid(lv, key, 'v')} AS id FROM {t}, (VALUES (1), (2)) x(v)" for lv, key, t in
                         (("collection", "r_regionkey", "region"), ("patient", "n_nationkey", "nation"), ("study", "c_custkey", "customer")))


@query("q1_unique_ids", with_("inst", "ser") + f"""SELECT CAST(count(*) AS BIGINT) AS n_ids, CAST(count(DISTINCT id) AS BIGINT) AS n_distinct FROM (
  SELECT i_uuid AS id FROM inst UNION ALL SELECT se_uuid FROM ser UNION ALL {_UP})""")
def q1(spark, sf):
    lv = fx.levels(spark, sf)
    return V.unique_ids(*[lv[x] for x in ("collection", "patient", "study", "series", "instance")])


@query("a15_count_distinct", "SELECT CAST(count(*) AS BIGINT) AS n_ids, CAST(count(DISTINCT k) AS BIGINT) AS n_distinct FROM (SELECT l_suppkey AS k FROM lineitem UNION ALL SELECT s_suppkey FROM supplier)")
def a15(spark, sf):
    return V.unique_ids(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("uuid")),
                        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("uuid")))


@query("q2_multi_parent", """SELECT DISTINCT l_partkey, l_orderkey, n_parents FROM lineitem JOIN (SELECT l_partkey, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_parents
  FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) > 1) USING (l_partkey)""")
def q2(spark, sf):
    return V.multi_parent(table(spark, sf, "lineitem"), "l_partkey", "l_orderkey")


_EXP = "exp AS (SELECT DISTINCT pub_gcs_bucket AS bucket, {n} AS name, l_orderkey AS k FROM joined WHERE se_rev <= 2 AND NOT i_excluded)"
_NAME = "se_uuid || '/' || i_uuid || '.dcm'"
_FOUND = """SELECT bucket, name, 'unfound' AS problem FROM exp WHERE k % 97 = 0
UNION ALL SELECT 'open-data', 'lost/' || l_orderkey || '.dcm', 'unexpected' FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 1000 = 5)"""


def _found(spark, sf, expected_with_key):
    made = table(spark, sf, "lineitem").filter("l_orderkey % 1000 = 5").select(
        F.lit("open-data").alias("bucket"), F.concat(F.lit("lost/"), "l_orderkey", F.lit(".dcm")).alias("name")).distinct()
    return expected_with_key.filter("k % 97 <> 0").select("bucket", "name").unionByName(made)


@query("q3_listing_diff", with_("joined", extra=_EXP.format(n=_NAME)) + _FOUND)
def q3(spark, sf):
    j = settle(joined(spark, sf).select("series_instance_uid", "se_uuid", "i_uuid", "pub_gcs_bucket", "i_excluded", "i_redacted", "se_rev_version"))
    k = F.regexp_replace("series_instance_uid", "se.", "").cast("bigint")
    listed = j.filter("NOT i_excluded").select(F.col("pub_gcs_bucket").alias("bucket"),
                                               F.concat("se_uuid", F.lit("/"), "i_uuid", F.lit(".dcm")).alias("name"), k.alias("k"))
    return V.diff_listing(V.expected_listing(j, 2), _found(spark, sf, listed))


@query("q3_listing_diff_series", with_("joined", extra=_EXP.format(n="se_uuid")) + _FOUND)
def q3s(spark, sf):
    j = settle(joined(spark, sf).select("series_instance_uid", "se_uuid", "i_uuid", "pub_gcs_bucket", "i_excluded", "i_redacted", "se_rev_version"))
    k = F.regexp_replace("series_instance_uid", "se.", "").cast("bigint")
    listed = j.filter("NOT i_excluded").select(F.col("pub_gcs_bucket").alias("bucket"), F.col("se_uuid").alias("name"), k.alias("k"))
    return V.diff_listing(V.expected_listing(j, 2, "series"), _found(spark, sf, listed))


@query("u3_set_difference", """SELECT l_suppkey AS k, 'unfound' AS problem FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 > 0))
UNION ALL SELECT s_suppkey, 'unexpected' FROM supplier WHERE s_suppkey % 3 > 0 AND s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)""")
def u3(spark, sf):
    return V.diff_listing(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k")),
                          table(spark, sf, "supplier").filter("s_suppkey % 3 > 0").select(F.col("s_suppkey").alias("k")))


def _dm(spark, sf):
    """Image metadata whose study and series disagree with the catalogue here and there."""
    k = F.col("l_orderkey")
    return fx.items(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), k == F.col("o_orderkey")).select(
        "sop", F.when(k % 31 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("study"),
        F.when(k % 37 == 0, -k).otherwise(k).alias("series"))


@query("q4_hierarchy_mismatch", with_("items") + """SELECT sop, o_custkey AS study, o_orderkey AS series, CASE WHEN o_orderkey % 31 = 0 THEN o_custkey + 1 ELSE o_custkey END AS dm_study,
  CASE WHEN o_orderkey % 37 = 0 THEN -o_orderkey ELSE o_orderkey END AS dm_series FROM items JOIN orders ON o_orderkey = l_orderkey WHERE o_orderkey % 31 = 0 OR (o_orderkey % 37 = 0 AND o_orderkey <> 0)""")
def q4(spark, sf):
    cat = fx.items(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "sop", F.col("o_custkey").alias("study"), F.col("o_orderkey").alias("series"))
    return V.hierarchy_mismatch(cat, _dm(spark, sf), "sop", ["study", "series"])


@query("q5_unmatched", with_("items") + "SELECT sop, CASE WHEN l_orderkey % 5 = 0 THEN 'left' ELSE 'right' END AS side FROM items WHERE (l_orderkey % 5 = 0) <> (l_orderkey % 7 = 0)")
def q5(spark, sf):
    i = fx.items(spark, sf)
    return V.unmatched(i.filter("l_orderkey % 5 = 0"), i.filter("l_orderkey % 7 = 0"), ["sop"])


@query("j18_full_outer_mismatch", """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'left' ELSE 'right' END AS side FROM part WHERE (p_partkey % 2 = 0) <> (p_partkey % 3 = 0)""")
def j18(spark, sf):
    p = table(spark, sf, "part")
    return V.unmatched(p.filter("p_partkey % 2 = 0"), p.filter("p_partkey % 3 = 0"), ["p_partkey"])


@query("j15_left_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j15(spark, sf):
    return table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey")


@query("j16_prune_orphans", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'))")
def j16(spark, sf):
    low = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    mid = table(spark, sf, "orders").join(low, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return table(spark, sf, "customer").join(mid, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("j17_not_done", "SELECT l_orderkey, l_partkey FROM lineitem WHERE NOT (l_orderkey % 4 = 0)")
def j17(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return li.join(li.filter("l_orderkey % 4 = 0").distinct(), ["l_orderkey", "l_partkey"], "left_anti")


def part_a(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")


def part_b(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part").filter(k % 13 != 0).select(
        k, "p_name", F.when(k % 11 != 0, F.col("p_brand")).alias("p_brand"),
        F.when(k % 7 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"))
    new = table(spark, sf, "part").filter(k % 50 == 0).select((-k - 1).alias("p_partkey"), "p_name", "p_brand", "p_size")
    return p.unionByName(new)


_PB = """pb AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS p_brand,
  CASE WHEN p_partkey % 7 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 13 <> 0
  UNION ALL SELECT -p_partkey - 1, p_name, p_brand, p_size FROM part WHERE p_partkey % 50 = 0)"""


@query("j19_outer_status", f"""WITH {_PB} SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN a.p_partkey IS NULL THEN 'added'
  WHEN b.p_partkey IS NULL THEN 'dropped' ELSE 'both' END AS status FROM part a FULL JOIN pb b ON a.p_partkey = b.p_partkey""")
def j19(spark, sf):
    return V.outer_status(part_a(spark, sf), part_b(spark, sf), ["p_partkey"])


_SIDE = ", ".join(f"CASE WHEN {{same}} THEN NULL ELSE a.{c} END AS a_{c}, CASE WHEN {{same}} THEN NULL ELSE b.{c} END AS b_{c}".format(same=s)
                  for c in ("p_name", "p_brand", "p_size") for s in (f"a.{c} IS NOT DISTINCT FROM b.{c}",))
_SIDE_C = ", ".join(f"CASE WHEN a.{c} = b.{c} THEN NULL ELSE a.{c} END AS a_{c}, CASE WHEN a.{c} = b.{c} THEN NULL ELSE b.{c} END AS b_{c}"
                    for c in ("p_name", "p_brand", "p_size"))
_J = "FROM part a FULL JOIN pb b ON a.p_partkey = b.p_partkey"


@query("q7_diff_tables", f"""WITH {_PB} SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, {_SIDE} {_J}
WHERE a.p_partkey IS DISTINCT FROM b.p_partkey OR a.p_brand IS DISTINCT FROM b.p_brand OR a.p_size IS DISTINCT FROM b.p_size""")
def q7(spark, sf):
    return V.diff_tables(part_a(spark, sf), part_b(spark, sf), "p_partkey")


@query("q7_diff_tables_compat", f"WITH {_PB} SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, {_SIDE_C} {_J} WHERE a.p_brand <> b.p_brand OR a.p_size <> b.p_size")
def q7c(spark, sf):
    return V.diff_tables(part_a(spark, sf), part_b(spark, sf), "p_partkey", compat=True)


_CELL = ("SELECT a.p_partkey, 'changed' AS status, '{c}' AS \"column\", CAST(a.{c} AS VARCHAR) AS old, CAST(b.{c} AS VARCHAR) AS \"new\" "
         "FROM part a JOIN pb b ON a.p_partkey = b.p_partkey WHERE a.{c} IS DISTINCT FROM b.{c}")


@query("q8_diff_rows", f"""WITH {_PB} {_CELL.format(c='p_brand')} UNION ALL {_CELL.format(c='p_size')}
UNION ALL SELECT coalesce(a.p_partkey, b.p_partkey), CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'dropped' ELSE 'unchanged' END, NULL, NULL, NULL {_J}
WHERE a.p_partkey IS NULL OR b.p_partkey IS NULL OR (a.p_brand IS NOT DISTINCT FROM b.p_brand AND a.p_size IS NOT DISTINCT FROM b.p_size)""")
def q8(spark, sf):
    return V.diff_rows(part_a(spark, sf), part_b(spark, sf), ["p_partkey"])


@query("a17_fingerprint", """SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS order_free, true AS sees_change FROM lineitem""")
def a17(spark, sf):
    """The value itself is Spark's own; what can be checked is that order has no part in it and a
    changed row has."""
    t = table(spark, sf, "lineitem")
    edited = t.withColumn("l_linenumber", F.when(F.col("l_orderkey") == 1, 99).otherwise(F.col("l_linenumber")))
    parts = [V.fingerprint(d).withColumn("k", F.lit(k)) for k, d in (("a", t), ("b", t.repartition("l_suppkey")), ("c", edited))]
    of = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(
        of("a", "n_rows").alias("n_rows"), (of("a", "fingerprint") == of("b", "fingerprint")).alias("order_free"),
        (of("a", "fingerprint") != of("c", "fingerprint")).alias("sees_change"))


@query("q6_dataset_equality", """SELECT 'nation' AS table_name, CAST(count(*) AS BIGINT) AS a_rows, CAST(count(*) AS BIGINT) AS b_rows, true AS "equal" FROM nation
UNION ALL SELECT 'customer', count(*), count(*), true FROM customer UNION ALL SELECT 'part', count(*), count(*) FILTER (p_partkey % 2 = 0), false FROM part""")
def q6(spark, sf):
    from vcat.sources.publish import scratch_db

    a, b = scratch_db(spark, "q6_a"), scratch_db(spark, "q6_b")
    for name in ("nation", "customer", "part"):
        t = table(spark, sf, name)
        t.write.mode("overwrite").saveAsTable(f"{a}.{name}")
        (t.filter("p_partkey % 2 = 0") if name == "part" else t).write.mode("overwrite").saveAsTable(f"{b}.{name}")
    return V.compare_datasets(spark, a, b).select("table_name", "a_rows", "b_rows", "equal")


def _tree(spark, sf, changed):
    """Study, series and instance levels, with one instance in a hundred orders changed."""
    k = F.col("l_orderkey")
    base = fx.content_hash("1")
    h = F.when((k % 100 == 3) & (F.col("l_linenumber") == 1), F.md5(base)).otherwise(base) if changed else base
    items = fx.items(spark, sf)
    if changed:
        items = items.filter("NOT (l_orderkey % 200 = 7 AND l_linenumber = 2)")
    inst = items.select(F.col("sop").alias("id"), k.alias("parent"), h.alias("hash"))
    ser = merkle_rollup(inst, ["parent"], "hash", "hash", ["id"]).withColumnRenamed("parent", "id").join(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parent")), "id")
    st = merkle_rollup(ser, ["parent"], "hash", "hash", ["id"]).select(F.col("parent").alias("id"), F.lit(None).cast("bigint").alias("parent"), "hash")
    text = lambda d: d.select(F.col("id").cast("string").alias("id"), F.col("parent").cast("string").alias("parent"), "hash")
    return [text(st), text(ser), text(inst)]


@query("q9_compare_hash_trees", with_("items", extra="""ch AS (SELECT *, l_orderkey % 100 = 3 AND l_linenumber = 1 AS c, l_orderkey % 200 = 7 AND l_linenumber = 2 AS gone FROM items),
se AS (SELECT l_orderkey, bool_or(c OR gone) AS d, bool_and(gone) AS lost FROM ch GROUP BY 1),
st AS (SELECT o_custkey, bool_or(d) AS d FROM se JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)""")
       + """SELECT 'study' AS level, CAST(o_custkey AS VARCHAR) AS id, 'differs' AS problem FROM st WHERE d
UNION ALL SELECT 'series', CAST(l_orderkey AS VARCHAR), CASE WHEN lost THEN 'only_a' ELSE 'differs' END FROM se WHERE d
UNION ALL SELECT 'instance', sop, CASE WHEN gone THEN 'only_a' ELSE 'differs' END FROM ch JOIN se USING (l_orderkey) WHERE (c OR gone) AND NOT lost""")
def q9(spark, sf):
    return V.compare_hash_trees(_tree(spark, sf, False), _tree(spark, sf, True), ["study", "series", "instance"])


@query("q15_store_listing", with_("items") + """SELECT DISTINCT n_name AS collection, 'study' AS depth, 'st.' || o_custkey AS id, 'unfound' AS problem FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_custkey % 10 = 3
UNION ALL SELECT DISTINCT n_name, 'series', 'se.' || o_orderkey, 'unfound' FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_custkey % 10 = 3 OR o_orderkey % 97 = 0
UNION ALL SELECT n_name, 'instance', sop, 'unfound' FROM items JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_custkey % 10 = 3 OR o_orderkey % 97 = 0""")
def q15(spark, sf):
    up = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(
        table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("o_orderkey", "o_custkey", F.col("n_name").alias("collection"))
    st, se = F.concat(F.lit("st."), "o_custkey"), F.concat(F.lit("se."), "o_orderkey")
    inst = fx.items(spark, sf).join(up, F.col("l_orderkey") == F.col("o_orderkey"))

    def listing(keep_st, keep_se):
        d = lambda df, depth, i: df.select("collection", F.lit(depth).alias("depth"), i.alias("id"))
        return (d(up.filter(keep_st), "study", st).distinct().unionByName(d(up.filter(keep_st).filter(keep_se), "series", se))
                .unionByName(d(inst.filter(keep_st).filter(keep_se), "instance", F.col("sop"))))

    return V.diff_listing(listing(F.lit(True), F.lit(True)), listing(F.col("o_custkey") % 10 != 3, F.col("o_orderkey") % 97 != 0))
