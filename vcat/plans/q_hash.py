"""Hash roll-ups and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.functions import exprs as X
from vcat.functions import textclean as TC
from vcat.functions.merkle import merkle_by_source, merkle_live, merkle_rollup
from vcat.operators import lifecycle as L
from vcat.plans import fixtures as fx
from vcat.plans.fixtures import table
from vcat.plans.oracle import content, merkle, uuid, with_
from vcat.plans.registry import query

def h1():
    return F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "size"))


def series_hashes(spark, sf):
    return merkle_rollup(fx.items(spark, sf), ["l_orderkey"], h1(), tiebreak=["sop"])


_SE = f"""se AS (SELECT l_orderkey, {merkle('h')} AS hash FROM (
    SELECT l_orderkey, {content('1')} AS h FROM items) GROUP BY 1)"""


@query("a1_merkle_rollup", with_("items", extra=f"""{_SE},
st AS (SELECT o_custkey, {merkle('hash')} AS hash FROM se JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
p AS (SELECT c_nationkey, {merkle('hash')} AS hash FROM st JOIN customer ON c_custkey = o_custkey GROUP BY 1),
c AS (SELECT n_regionkey, {merkle('hash')} AS hash FROM p JOIN nation ON n_nationkey = c_nationkey GROUP BY 1)""")
       + "SELECT r_name, hash FROM c JOIN region ON r_regionkey = n_regionkey")
def a1(spark, sf):
    se = series_hashes(spark, sf)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    st = L.rollup(se, orders, "l_orderkey", "o_orderkey", "o_custkey")
    p = L.rollup(st, table(spark, sf, "customer").select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey", "c_nationkey")
    c = L.rollup(p, table(spark, sf, "nation").select("n_nationkey", "n_regionkey"), "c_nationkey", "n_nationkey", "n_regionkey")
    return c.join(table(spark, sf, "region"), c.n_regionkey == F.col("r_regionkey")).select("r_name", "hash")


@query("a2_merkle_by_source", with_("items", extra=_SE)
       + f"""SELECT o_custkey, {merkle("CASE WHEN o_orderkey % 2 = 0 THEN hash ELSE '' END")} AS src_a,
  {merkle("CASE WHEN o_orderkey % 2 = 1 THEN hash ELSE '' END")} AS src_b, {merkle('hash')} AS all_hash
FROM se JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def a2(spark, sf):
    kids = series_hashes(spark, sf).join(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    even = F.col("o_orderkey") % 2 == 0
    out = merkle_by_source(kids, ["o_custkey"], {
        "src_a": F.when(even, F.col("hash")), "src_b": F.when(~even, F.col("hash")), "all": F.col("hash")},
        tiebreak=["o_orderkey"])
    return out.select("o_custkey", "hashes.src_a", "hashes.src_b", F.col("hashes.all").alias("all_hash"))


@query("a3_series_hash", with_("items") + f"""SELECT l_orderkey, count(DISTINCT source) = 1 AS one_source,
  CASE WHEN min(source) = 'src_a' THEN {merkle('h')} ELSE '' END AS src_a,
  CASE WHEN min(source) = 'src_b' THEN {merkle('h')} ELSE '' END AS src_b, {merkle('h')} AS all_hash
FROM (SELECT *, {content('1')} AS h FROM items) GROUP BY 1""")
def a3(spark, sf):
    out = L.series_rollup(fx.items(spark, sf).withColumn("h", h1()), ["l_orderkey"], "h", "source", ["sop"])
    return out.select("l_orderkey", "one_source", "hashes.src_a", "hashes.src_b", F.col("hashes.all").alias("all_hash"))


_VH = "md5('collection|' || r_regionkey || '|' || v)"


@query("a4_version_hash", f"""SELECT v AS version, {merkle(_VH)} AS src_a, {merkle(f'md5({_VH})')} AS src_b,
  {merkle(f'md5(md5({_VH}))')} AS all_hash FROM region, (VALUES (1), (2)) t(v) GROUP BY 1""")
def a4(spark, sf):
    lv, ed = fx.levels(spark, sf), fx.edges(spark, sf)
    kids = ed["version_collection"].join(
        lv["collection"].select(F.col("uuid").alias("collection_uuid"), "hashes"), "collection_uuid")
    out = merkle_by_source(kids, ["version"], {s: F.col(f"hashes.{s}") for s in ("src_a", "src_b", "all")})
    return out.select("version", "hashes.src_a", "hashes.src_b", F.col("hashes.all").alias("all_hash"))


@query("a5_sources", """SELECT o_custkey, bool_or(o_orderkey % 2 = 0) AS src_a, bool_or(o_orderkey % 2 = 1) AS src_b
FROM orders GROUP BY 1""")
def a5(spark, sf):
    k = F.col("o_orderkey") % 2
    df = table(spark, sf, "orders").select(
        "o_custkey", F.struct((k == 0).alias("src_a"), (k == 1).alias("src_b")).alias("sources"))
    return L.sources_of(df, ["o_custkey"]).select("o_custkey", "sources.src_a", "sources.src_b")


@query("a6_redaction_rollup", with_("items", extra="se AS (SELECT l_orderkey, bool_and(red) AS red FROM items GROUP BY 1)")
       + """SELECT o_custkey, bool_and(red) AS redacted, CAST(count(*) FILTER (red) AS BIGINT) AS redacted_series
FROM se JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def a6(spark, sf):
    se = fx.items(spark, sf).groupBy("l_orderkey").agg(F.bool_and("red").alias("red"))
    return se.join(table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(
        F.bool_and("red").alias("redacted"), F.count_if("red").alias("redacted_series"))


@query("a7_redacted_merkle", with_("items") + f"""SELECT l_orderkey, bool_and(red) AS redacted,
  {merkle("CASE WHEN red THEN '' ELSE h END")} AS hash
FROM (SELECT *, {content('1')} AS h FROM items) GROUP BY 1""")
def a7(spark, sf):
    df = fx.items(spark, sf)
    flags = df.groupBy("l_orderkey").agg(F.bool_and("red").alias("redacted"))
    return merkle_rollup(df, ["l_orderkey"], merkle_live(h1(), F.col("red")), tiebreak=["sop"]).join(flags, "l_orderkey")


@query("a20_timestamps", with_("inst") + """SELECT l_orderkey, CAST(count(*) AS BIGINT) AS series_instances,
  CASE WHEN max(i_rev) = 1 THEN '2021-02-03 04:05:06' ELSE '2022-03-04 05:06:07' END AS max_timestamp,
  CASE WHEN min(i_rev) = 1 THEN '2021-02-03 04:05:06' ELSE '2022-03-04 05:06:07' END AS min_timestamp
FROM inst WHERE i_final = 0 GROUP BY 1""")
def a20(spark, sf):
    df = fx.instance_versions(spark, sf).filter("final_version = 0").withColumn("timestamp", fx.ts())
    out = L.stamp_of(df, ["l_orderkey"], "timestamp", "series_instances")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.select("l_orderkey", "series_instances", F.date_format("max_timestamp", fmt).alias("max_timestamp"),
                      F.date_format("min_timestamp", fmt).alias("min_timestamp"))


@query("q10_self_check", with_("items", extra=_SE) + """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, hash
FROM se WHERE l_orderkey % 50 = 0""")
def q10(spark, sf):
    from vcat.operators.validate import self_check

    rolled = series_hashes(spark, sf)
    stored = rolled.withColumn("stored", F.when(F.col("l_orderkey") % 50 == 0, F.md5("hash")).otherwise(F.col("hash")))
    kids = fx.items(spark, sf).withColumn("h", h1())
    return self_check(stored.select("l_orderkey", "stored"), kids, ["l_orderkey"], "stored", "h", ["sop"]).select(
        "l_orderkey", F.col("rolled").alias("hash"))


@query("d1_web_id_sql", "SELECT p_partkey, replace(replace(lower(p_name || '-' || p_brand), '-', '_'), ' ', '_') AS id FROM part")
def d1(spark, sf):
    X.register_functions(spark)
    return table(spark, sf, "part").selectExpr("p_partkey", "web_id(p_name || '-' || p_brand) AS id")


@query("d2_merkle", with_("items") + f"""SELECT l_suppkey, l_returnflag, {merkle('h')} AS hash
FROM (SELECT *, {content('1')} AS h FROM items) GROUP BY 1, 2""")
def d2(spark, sf):
    return merkle_rollup(fx.items(spark, sf), ["l_suppkey", "l_returnflag"], h1(), tiebreak=["sop"])


# --- scalar functions -----------------------------------------------------------------------------


@query("f1_web_id", "SELECT o_orderkey, replace(replace(lower(o_orderpriority), '-', '_'), ' ', '_') AS id FROM orders")
def f1(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.web_id("o_orderpriority").alias("id"))


@query("f2_object_url", f"""SELECT o_orderkey, 'gs://' || b || '/' || {uuid('series', 'o_orderkey', '1')} || '/x.dcm' AS gcs_url,
  's3://bkt/' || o_orderkey || '/' AS series_url
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'b' || (o_orderkey % 3) END AS b FROM orders)""")
def f2(spark, sf):
    k = F.col("o_orderkey")
    b = F.when(k % 3 > 0, F.concat(F.lit("b"), k % 3))
    return table(spark, sf, "orders").select(
        "o_orderkey", X.object_url("gs", b, X.uuid_of("series", "o_orderkey", F.lit(1)), F.lit("x")).alias("gcs_url"),
        X.object_url("s3", F.lit("bkt"), k.cast("string")).alias("series_url"))


@query("f3_viewer_url", "SELECT o_orderkey, 'https://viewer/v3/?StudyInstanceUIDs=st.' || o_custkey || '&initialSeriesInstanceUID=se.' || o_orderkey AS url FROM orders")
def f3(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.viewer_url(
        "https://viewer/v3/", F.concat(F.lit("st."), "o_custkey"), F.concat(F.lit("se."), "o_orderkey")).alias("url"))


@query("f4_url_parts", "SELECT page_id, split_part(url, '/', 3) AS bucket, array_to_string(string_split(url, '/')[4:], '/') AS name FROM pages")
def f4(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.url_part("url", 2).alias("bucket"), X.url_rest("url").alias("name"))


_F5 = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 3 WHEN 0 THEN 'gs://else/a/' || l_orderkey
  WHEN 1 THEN './a/' || l_orderkey ELSE 'a/' || l_orderkey END AS u FROM lineitem"""


@query("f5_norm_url", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  'gs://bkt/' || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'sub/' END || 'a/' || l_orderkey AS url,
  'gs://bkt/a/' || l_orderkey AS plain FROM ({_F5})""")
def f5(spark, sf):
    k = F.col("l_linenumber") % 3
    a = F.concat(F.lit("a/"), "l_orderkey")
    u = F.when(k == 0, F.concat(F.lit("gs://else/"), a)).when(k == 1, F.concat(F.lit("./"), a)).otherwise(a)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.norm_url(u, "bkt", "sub").alias("url"),
        X.norm_url(u, "bkt").alias("plain"))


@query("f6_doi_number", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 40 AS BIGINT) END AS n FROM orders")
def f6(spark, sf):
    k = F.col("o_orderkey")
    d = F.concat(F.lit("10.5281/"), F.when(k % 3 == 0, "x.").otherwise("x.d"), k % 40)
    return table(spark, sf, "orders").select("o_orderkey", X.doi_number(d).alias("n"))


@query("f7_code_lists", "SELECT p_partkey, 'a;' || p_name AS heads, 'x:' || p_brand || ';-' AS tails FROM part")
def f7(spark, sf):
    heads = F.array(F.lit("a:zz:y"), F.concat("p_name", F.lit(":q")))
    tails = F.array(F.concat(F.lit("h:x:"), "p_brand"), F.lit("none"))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(X.head_of(heads), ";").alias("heads"), F.array_join(X.tail_of(tails), ";", "-").alias("tails"))


@query("f8_code_strings", "SELECT p_partkey, 'SCT:' || p_size || ':' || p_name AS code, p_name AS meaning, 'SCT:' || p_size AS pair FROM part")
def f8(spark, sf):
    c = X.code_str(F.lit("SCT"), F.col("p_size").cast("string"), "p_name")
    return table(spark, sf, "part").select("p_partkey", c.alias("code")).select(
        "*", X.code_part("code", 2).alias("meaning"), X.code_pair("code").alias("pair"))


@query("f9_sig2", """SELECT o_orderkey, CASE WHEN x = 0 THEN 0 ELSE CAST(round(
    round(x, CAST(1 - floor(log10(abs(x))) AS INTEGER)) * 1000000) AS BIGINT) END AS micro
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 0.0 ELSE (o_orderkey % 1009 + 1) / 1024.0 END AS x FROM orders)""")
def f9(spark, sf):
    k = F.col("o_orderkey")
    x = F.when(k % 9 == 0, F.lit(0.0)).otherwise((k % 1009 + 1) / F.lit(1024.0))
    return table(spark, sf, "orders").select("o_orderkey", F.round(X.sig2(x) * 1000000).cast("bigint").alias("micro"))


@query("f10_safe_casts", """SELECT p_partkey, TRY_CAST(x AS BIGINT) AS as_int, CAST(TRY_CAST(x AS DECIMAL(38,9)) AS VARCHAR) AS as_numeric,
  CAST(TRY_CAST(x AS DOUBLE) * 4 AS BIGINT) AS as_float
FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'n/a' WHEN 1 THEN CAST(p_size AS VARCHAR) ELSE p_size || '.25' END AS x
      FROM part WHERE p_partkey % 3 <> 2)
UNION ALL SELECT p_partkey, NULL, p_size || '.250000000', p_size * 4 + 1 FROM part WHERE p_partkey % 3 = 2""")
def f10(spark, sf):
    k = F.col("p_partkey") % 3
    size = F.col("p_size").cast("string")
    x = F.when(k == 0, "n/a").when(k == 1, size).otherwise(F.concat(size, F.lit(".25")))
    return table(spark, sf, "part").select(
        "p_partkey", F.when(~x.contains("."), x.try_cast("bigint")).alias("as_int"),
        x.try_cast("decimal(38,9)").cast("string").alias("as_numeric"),
        (x.try_cast("double") * 4).cast("bigint").alias("as_float"))


@query("f11_coalesce", "SELECT p_partkey, coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_brand END, CASE WHEN p_partkey % 3 = 0 THEN p_type END, p_name) AS x FROM part")
def f11(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", F.coalesce(
        F.when(k % 2 == 0, F.col("p_brand")), F.when(k % 3 == 0, F.col("p_type")), "p_name").alias("x"))


@query("f12_md5", "SELECT doc_id, md5(text) AS md5, md5(text) AS from_b64 FROM documents")
def f12(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5")).select(
        "*", X.md5_from_b64(F.base64(F.unhex("md5"))).alias("from_b64"))


@query("f13_row_sha", """SELECT p_partkey, sha256(concat_ws(chr(1), CAST(p_partkey AS VARCHAR), coalesce(b, chr(0)), p_type)) AS sha
FROM (SELECT *, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS b FROM part)""")
def f13(spark, sf):
    b = F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", X.row_sha("p_partkey", b, "p_type").alias("sha"))


@query("f14_uuid", f"SELECT o_orderkey, {uuid('series', 'o_orderkey', '3')} AS id FROM orders")
def f14(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.uuid_of("series", "o_orderkey", F.lit(3)).alias("id"))


@query("f15_to_gb", """SELECT o_orderkey, CAST(round(round(CASE o_orderkey % 3 WHEN 0 THEN s / 1024 WHEN 1 THEN s * 1024 ELSE s END, 2) * 100) AS BIGINT) AS centi_gb
FROM (SELECT o_orderkey, CAST(o_orderkey % 5000 AS DOUBLE) AS s FROM orders)""")
def f15(spark, sf):
    k = F.col("o_orderkey")
    unit = F.when(k % 3 == 0, "mb").when(k % 3 == 1, "tb").otherwise("gb")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(X.to_gb(k % 5000, unit) * 100).cast("bigint").alias("centi_gb"))


@query("f16_join_list", "SELECT p_partkey, p_type || ', ' || p_brand AS items FROM part")
def f16(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.join_list(F.array("p_type", "p_brand")).alias("items"))


@query("f17_links_to_text", r"""SELECT page_id, md5(regexp_replace(html, '<a\s+[^>]*?href="(.*?)"[^>]*?>(.*?)</a>', '\2 (\1)', 'gis')) AS text_md5 FROM pages""")
def f17(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(TC.links_to_text("html")).alias("text_md5"))


@query("f18_links_to_modal", r"""SELECT page_id, md5(replace(regexp_replace(regexp_replace(h, 'href="([^"]*\.gov[^"]*)"', 'hrefgov="\1"', 'gi'),
  '<a\s+[^>]*?href="(.*?)"[^>]*?>(.*?)</a>', '<a  href="" url="\1" data-toggle="modal" data-target="#external-web-warning" class="external-link">\2<i class="fa-solid fa-external-link external-link-icon" aria-hidden="true"></i></a>', 'gis'),
  'hrefgov="', 'href="')) AS html_md5 FROM (SELECT page_id, replace(html, 'href="/t', 'href="/x.gov/t') AS h FROM pages)""")
def f18(spark, sf):
    h = F.replace("html", F.lit('href="/t'), F.lit('href="/x.gov/t'))
    return table(spark, sf, "pages").select("page_id", F.md5(TC.links_to_modal(h)).alias("html_md5"))


@query("f19_clean_lines", r"""SELECT doc_id, md5(replace(array_to_string(list_filter(string_split(
  replace(replace(replace(text, '[', ''), ']', ' '), '**', ''), chr(10)), lambda x: x <> ''), chr(10)), '\', '')) AS text_md5 FROM documents""")
def f19(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(TC.clean_lines("text")).alias("text_md5"))


@query("f20_normal_name", r"""SELECT p_partkey, lower(CASE WHEN regexp_matches(x, '^[0-9]') THEN 'c_' || x ELSE x END) AS name
FROM (SELECT p_partkey, regexp_replace(translate(trim(h), '/- ', '___'), '[^a-zA-Z0-9_]', '', 'g') AS x
      FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN ' ' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN p_size || '-' ELSE '' END
            || p_name || '/' || p_brand || ' (%)' AS h FROM part))""")
def f20(spark, sf):
    k = F.col("p_partkey")
    h = F.concat(F.when(k % 2 == 0, " ").otherwise(""), F.when(k % 3 == 0, F.concat("p_size", F.lit("-"))).otherwise(""),
                 "p_name", F.lit("/"), "p_brand", F.lit(" (%)"))
    return table(spark, sf, "part").select("p_partkey", TC.normal_name(h).alias("name"))


_CASE_IDS = "CASE WHEN c_custkey % 16 = 5 THEN 'p' || c_custkey || '_q-' || (c_custkey % 120) ELSE c_custkey || '_BreastDX' END"
_PAD = "CASE WHEN length({x}) < {n} THEN lpad({x}, {n}, '0') ELSE {x} END"
_SHORT = "CAST(c_custkey % 4000 AS VARCHAR)"
_CODES = {"same": 0, "breast": 1, "acrin 6698": 2, "acrin format": 3, "acrin flt format": 4, "cc": 5, "switch dash": 6, "3DCT-RT": 7,
          "ispy": 8, "ispy2": 9, "lung_pt": 10, "add colec": 11, "remind": 12, "ea1141": 13, "upenn-gbm": 14, "spinal": 15}


@query("f21_reform_case", f"""SELECT c_custkey, CASE c_custkey % 16 WHEN 0 THEN long WHEN 1 THEN replace(long, 'BreastDX', 'BreastDx')
  WHEN 2 THEN 'ACRIN-6698-' || short WHEN 3 THEN seg || '-' || {_PAD.format(x='short', n=3)} WHEN 4 THEN seg || '_' || {_PAD.format(x='short', n=3)}
  WHEN 5 THEN 'p' || c_custkey || '-q' || {_PAD.format(x="CAST(c_custkey % 120 AS VARCHAR)", n=2)}
  WHEN 6 THEN replace(long, '_', '-') WHEN 7 THEN 'HN_P' || {_PAD.format(x='short', n=3)} WHEN 8 THEN 'ISPY1_' || short
  WHEN 9 THEN 'ISPY2-' || short WHEN 10 THEN 'Lung_Dx-' || short WHEN 11 THEN seg || '-' || short
  WHEN 12 THEN 'ReMIND-' || {_PAD.format(x='short', n=3)} WHEN 13 THEN 'EA1141-' || short
  WHEN 14 THEN left(long, length(long) - 3) ELSE long END AS case_id
FROM (SELECT c_custkey, c_mktsegment AS seg, {_CASE_IDS} AS long, {_SHORT} AS short FROM customer)""")
def f21(spark, sf):
    k = F.col("c_custkey")
    r = k % 16
    long = F.when(r == 5, F.concat(F.lit("p"), k, F.lit("_q-"), k % 120)).otherwise(F.concat(k, F.lit("_BreastDX")))
    ids = F.when(r.isin(0, 1, 5, 6, 14, 15), long).otherwise((k % 4000).cast("string"))
    rule = F.element_at(F.create_map(*[F.lit(x) for n, i in _CODES.items() for x in (i, n)]), r.cast("int"))
    return table(spark, sf, "customer").select("c_custkey", ids.alias("id"), rule.alias("rule"), "c_mktsegment").select(
        "c_custkey", TC.reform_case("id", "c_mktsegment", "rule").alias("case_id"))


@query("f22_parse_options", """SELECT p_partkey, f.form AS form, CASE f.form
    WHEN 'assign' THEN '1>' || p_brand || ';2>' || p_type WHEN 'colorectal' THEN '1>' || p_brand || ' (a, b);2>?'
    WHEN 'ispy2' THEN '1>' || p_brand || ';2>' || p_type ELSE '1>' || p_brand END AS opts
FROM part, (VALUES ('assign'), ('colorectal'), ('ispy2'), ('lidc')) f(form)""")
def f22(spark, sf):
    text = {
        "assign": F.concat(F.lit("1="), "p_brand", F.lit(", 2="), "p_type"),
        "colorectal": F.concat(F.lit("1 - "), "p_brand", F.lit(" (a, b)|2")),
        "ispy2": F.concat(F.lit("1:"), "p_brand", F.lit("\n2: "), "p_type"),
        "lidc": F.concat("p_name", F.lit("\n1="), "p_brand"),
    }
    show = lambda o: F.concat(o["option_code"], F.lit(">"), F.coalesce(o["option_description"], F.lit("?")))
    each = F.array(*[F.struct(F.lit(n).alias("form"), F.array_join(F.transform(TC.parse_options(t, n), show), ";").alias("opts"))
                     for n, t in text.items()])
    return table(spark, sf, "part").select("p_partkey", F.inline(each))


@query("f23_expand_range", """SELECT p_partkey, p_type || i AS name FROM part, range(1, 4) t(i) WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, p_type FROM part WHERE p_partkey % 2 = 1""")
def f23(spark, sf):
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_type", F.lit("1-3"))).otherwise(F.col("p_type"))
    return TC.expand_range(table(spark, sf, "part").select("p_partkey", name.alias("name")), "name")


@query("f24_constants", "SELECT p_partkey, 'Public' AS access, CAST(NULL AS VARCHAR) AS code_value, 0 AS batch FROM part")
def f24(spark, sf):
    null_code = F.lit(None).cast("struct<CodeValue:string,CodingSchemeDesignator:string,CodeMeaning:string>")
    return table(spark, sf, "part").select("p_partkey", F.lit("Public").alias("access"),
                                           null_code["CodeValue"].alias("code_value"), F.lit(0).alias("batch"))


@query("f25_release_timestamp", with_("inst") + """SELECT sop, i_rev AS rev_version,
  CASE WHEN i_init = 1 THEN '2021-02-03 04:05:06' ELSE '2022-03-04 05:06:07' END AS created,
  CASE WHEN i_rev = 1 THEN '2021-02-03 04:05:06' ELSE '2022-03-04 05:06:07' END AS updated FROM inst""")
def f25(spark, sf):
    from vcat.operators.manifests import with_release_times

    out = with_release_times(fx.instance_versions(spark, sf), fx.versions_table(spark), "init_version", "rev_version")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.select("sop", "rev_version", F.date_format("created", fmt).alias("created"),
                      F.date_format("updated", fmt).alias("updated"))
