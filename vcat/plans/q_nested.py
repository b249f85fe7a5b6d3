"""Nested-document and curation queries. The oracles are plain joins of the base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.functions.exprs import first
from vcat.operators import curated as C
from vcat.operators import nested as N
from vcat.plans import documents as D
from vcat.plans.fixtures import items, table
from vcat.plans.oracle import with_
from vcat.plans.registry import query

_G = """g AS (SELECT items.*, p_type, p_brand, row_number() OVER (PARTITION BY l_orderkey ORDER BY sop) AS gn FROM items JOIN part ON p_partkey = l_partkey
  WHERE l_orderkey % 9 <> 0 AND l_orderkey % 17 <> 0)"""
_BASE = """'p' || (l_orderkey % 25) AS "PatientID", 'sr.' || l_orderkey AS "SOPInstanceUID", 'srse.' || l_orderkey AS "SeriesInstanceUID",
  CAST(gn AS INTEGER) AS "measurementGroup_number", 'seg.' || l_suppkey AS "segmentationInstanceUID", 'segse.' || l_suppkey AS "segmentationSeriesUID",
  CAST(l_linenumber AS BIGINT) AS "segmentationSegmentNumber", CAST(l_partkey AS VARCHAR) AS "sourceSegmentedSeriesUID", sop AS "trackingIdentifier",
  md5(sop) AS "trackingUniqueIdentifier" """


def _show(df):
    """Codes as their values."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        out.append(F.col(f"{f.name}.CodeValue").alias(f.name) if kind == "struct" else
                   F.col(f.name).cast("string").alias(f.name) if kind == "decimal" else F.col(f.name))
    return df.select(*out)


def groups(spark, sf):
    return N.measurement_groups(D.reports(spark, sf), D.seg_lookup(spark, sf))


@query("n4_measurement_groups", with_("items", extra=_G) + f"""SELECT {_BASE}, p_type AS finding, p_brand AS "findingSite", 'desc ' || (l_orderkey % 7) AS "SeriesDescription" FROM g""")
def n4(spark, sf):
    return _show(groups(spark, sf).drop("contentSequence"))


@query("n3_facets", with_("items", extra=_G) + """SELECT 'sr.' || l_orderkey AS "SOPInstanceUID", CAST(gn AS INTEGER) AS n, sop AS tracking, p_brand AS site FROM g""")
def n3(spark, sf):
    box = N.unnest(N.structured_reports(D.reports(spark, sf)).select("SOPInstanceUID", F.col("ContentSequence").alias("c")), "c", "b")
    grp = N.unnest(box.select("SOPInstanceUID", F.col("b.ContentSequence").alias("k")), "k", "g", "n")
    kids = "g.ContentSequence"
    return grp.select("SOPInstanceUID", "n", F.explode(N.facet(kids, "TEXT", N.TRACKING_ID)).alias("t"), "g").select(
        "SOPInstanceUID", "n", F.col("t.TextValue").alias("tracking"), F.explode(N.facet(kids, "CODE", N.SITE_SRT, N.SITE_SCT)).alias("s")).select(
        "SOPInstanceUID", "n", "tracking", first("s.ConceptCodeSequence")["CodeValue"].alias("site"))


@query("n1_n2_unnest", """SELECT 'sr.' || l_orderkey AS "SOPInstanceUID", CAST(n AS INTEGER) AS n FROM
  (SELECT l_orderkey, unnest(range(count(*) + 1)) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)""")
def n12_(spark, sf):
    box = N.unnest(D.reports(spark, sf).select("SOPInstanceUID", "ContentSequence"), "ContentSequence", "b")
    return N.unnest(box.select("SOPInstanceUID", F.col("b.ContentSequence").alias("k")), "k", "g", "n").select("SOPInstanceUID", "n")


@query("p11_reports", "SELECT DISTINCT 'sr.' || l_orderkey AS \"SOPInstanceUID\" FROM lineitem WHERE l_orderkey % 9 <> 0 AND l_orderkey % 17 <> 0")
def p11(spark, sf):
    return N.structured_reports(D.reports(spark, sf)).select("SOPInstanceUID")


_EV = """'EV1' AS "Quantity", l_linestatus AS "Value", p_type AS finding, p_brand AS "findingSite" """


@query("n5_qualitative", with_("items", extra=_G) + f"SELECT {_BASE}, {_EV} FROM g WHERE l_orderkey % 2 = 0")
def n5(spark, sf):
    return _show(N.qualitative(groups(spark, sf)))


@query("n5_qualitative_strict", with_("items", extra=_G) + f"SELECT {_BASE}, {_EV} FROM g")
def n5s(spark, sf):
    return _show(N.qualitative(groups(spark, sf), strict=True))


@query("n6_quantitative", with_("items", extra=_G) + f"""SELECT {_BASE}, 'desc ' || (l_orderkey % 7) AS "SeriesDescription", q AS "Quantity", 'u' AS "Units", p_type AS finding, p_brand AS "findingSite",
  CASE q WHEN 'Q' THEN CAST(CAST(l_quantity AS DECIMAL(38,9)) AS VARCHAR) WHEN 'P' THEN CAST(CAST(size AS DECIMAL(38,9)) AS VARCHAR) END AS "Value",
  CASE WHEN q = 'P' AND l_linestatus = 'O' THEN 'R-00317' END AS "derivationModifier", CASE WHEN l_returnflag = 'R' THEN '7771000' END AS "lateralityModifier"
FROM g, (VALUES ('Q'), ('P'), ('N')) t(q)""")
def n6(spark, sf):
    return _show(N.quantitative(groups(spark, sf)))


@query("j11_multi_facet", with_("items", extra=_G) + """SELECT 'sr.' || l_orderkey AS "SOPInstanceUID", sop AS tid, p_type AS finding, p_brand AS site, CAST(l_partkey AS VARCHAR) AS src FROM g""")
def j11(spark, sf):
    return groups(spark, sf).select("SOPInstanceUID", F.col("trackingIdentifier").alias("tid"), F.col("finding.CodeValue").alias("finding"),
                                    F.col("findingSite.CodeValue").alias("site"), F.col("sourceSegmentedSeriesUID").alias("src"))


@query("j12_finding_site", with_("items", extra=_G) + """SELECT 'sr.' || l_orderkey AS "SOPInstanceUID", CAST(gn AS INTEGER) AS n, p_type AS finding, p_brand AS site,
  CASE WHEN l_returnflag = 'R' THEN 'Left' END AS side FROM g""")
def j12(spark, sf):
    q = N.quantitative(groups(spark, sf)).filter(F.col("Quantity.CodeValue") == "N")
    return q.select("SOPInstanceUID", F.col("measurementGroup_number").alias("n"), F.col("finding.CodeValue").alias("finding"),
                    F.col("findingSite.CodeValue").alias("site"), F.col("lateralityModifier.CodeMeaning").alias("side"))


_SEGS = """SELECT 'p' || (l_orderkey % 25) AS "PatientID", 'st.' || (l_orderkey % 100) AS "StudyInstanceUID", 'sgse.' || l_orderkey AS "SeriesInstanceUID",
  'sg.' || l_orderkey AS "SOPInstanceUID", 'for.' || (l_orderkey % 10) AS "FrameOfReferenceUID", 'BINARY' AS "SegmentationType",
  CASE WHEN l_linenumber % 3 <> 0 THEN p_type END AS "AnatomicRegion", CASE WHEN l_linenumber % 3 <> 0 AND l_linenumber % 2 = 0 THEN p_brand END AS "AnatomicRegionModifier",
  CASE WHEN l_linenumber % 3 <> 0 THEN 'T-D0050' END AS "SegmentedPropertyCategory", CASE WHEN l_linenumber % 3 <> 0 THEN p_brand END AS "SegmentedPropertyType",
  'AUTOMATIC' AS "SegmentAlgorithmType", CASE WHEN l_linenumber % 3 <> 0 THEN 'alg' END AS "SegmentAlgorithmName", l_linenumber AS "SegmentNumber",
  md5(sop) AS "TrackingUID", sop AS "TrackingID", CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 4 <> 3 THEN 'imse.' || o_custkey END AS "segmented_SeriesInstanceUID",
  'https://viewer/v3/viewer/?StudyInstanceUIDs=st.' || (l_orderkey % 100) || '&initialSeriesInstanceUID=sgse.' || l_orderkey AS viewer_url
FROM items JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey"""


@query("n7_segmentations", with_("items") + _SEGS)
def n7(spark, sf):
    segs = D.segmentation_docs(spark, sf)
    return _show(N.segmentations(segs, D.with_images(spark, sf, segs)))


@query("j13_right_outer", with_("items") + """SELECT l_orderkey, sop, CASE WHEN o_orderkey % 4 <> 3 THEN o_custkey END AS o_custkey FROM items JOIN orders ON o_orderkey = l_orderkey""")
def j13(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderkey % 4 <> 3").select("o_orderkey", "o_custkey")
    li = items(spark, sf).select("l_orderkey", "sop")
    return o.join(li, o.o_orderkey == li.l_orderkey, "right").select("l_orderkey", "sop", "o_custkey")


@query("n9_n10_safe_first", with_("items") + """SELECT sop, CASE WHEN l_linenumber % 3 <> 0 THEN p_type END AS region FROM items JOIN part ON p_partkey = l_partkey""")
def n9(spark, sf):
    segs = N.unnest(D.segmentation_docs(spark, sf).select("SegmentSequence"), "SegmentSequence", "s")
    region = first("s.AnatomicRegionSequence")
    code = F.when(F.size("s.AnatomicRegionSequence") > 0, F.struct(region["CodeValue"].alias("CodeValue")))
    return segs.select(F.col("s.TrackingID").alias("sop"), code["CodeValue"].alias("region"))


_SLIDE = "sl AS (SELECT items.*, p_type, p_brand, CAST('0.' || lpad(CAST(l_linenumber * 37 AS VARCHAR), 4, '0') AS DOUBLE) AS sp, CAST('0.5' || l_linenumber AS DOUBLE) AS fg FROM items JOIN part ON p_partkey = l_partkey)"


@query("n8_specimen_steps", with_("items", extra=_SLIDE) + """SELECT 'se.' || l_orderkey AS "SeriesInstanceUID", v AS cnc_val, CASE v WHEN '430863003' THEN '311731000' WHEN '1' THEN '2'
  WHEN '430864009' THEN p_type ELSE p_brand END AS ccs_val FROM sl, (VALUES ('430863003'), ('1'), ('430864009'), ('424361007')) t(v) WHERE l_orderkey % 10 <> 9""")
def n8(spark, sf):
    return N.specimen_steps(D.slides(spark, sf)).select("SeriesInstanceUID", "cnc_val", "ccs_val")


_SPACE = "coalesce(min(CASE WHEN l_orderkey % 4 NOT IN (1, 2) THEN sp END), min(fg))"
_SIG = f"CAST(round(round({_SPACE}, CAST(1 - floor(log10(abs({_SPACE}))) AS INTEGER)) * 1000000) AS BIGINT)"


@query("n13_curated_series", with_("items", extra=_SLIDE) + f"""SELECT 'se.' || l_orderkey AS "SeriesInstanceUID", 'SM' AS "Modality",
  CASE WHEN l_orderkey % 10 <> 9 THEN 'Paraffin wax' ELSE '' END AS "embeddingMedium_CodeMeaning", CASE WHEN l_orderkey % 10 <> 9 THEN 'SCT:311731000' ELSE '' END AS "embeddingMedium_code_designator_value_str",
  CASE WHEN l_orderkey % 10 <> 9 THEN regexp_replace(string_agg(DISTINCT p_type || ':SCT:' || p_type, ',' ORDER BY p_type || ':SCT:' || p_type), ':[^,]*', '', 'g') ELSE '' END AS "tissueFixative_CodeMeaning",
  CASE WHEN l_orderkey % 10 <> 9 THEN regexp_replace(string_agg(DISTINCT p_type || ':SCT:' || p_type, ',' ORDER BY p_type || ':SCT:' || p_type), '(^|,)[^:,]*:', '\\1', 'g') ELSE '' END AS "tissueFixative_code_designator_value_str",
  CASE WHEN l_orderkey % 10 <> 9 THEN regexp_replace(string_agg(DISTINCT p_brand || ':SCT:' || p_brand, ',' ORDER BY p_brand || ':SCT:' || p_brand), ':[^,]*', '', 'g') ELSE '' END AS "staining_usingSubstance_CodeMeaning",
  CASE WHEN l_orderkey % 10 <> 9 THEN regexp_replace(string_agg(DISTINCT p_brand || ':SCT:' || p_brand, ',' ORDER BY p_brand || ':SCT:' || p_brand), '(^|,)[^:,]*:', '\\1', 'g') ELSE '' END AS "staining_usingSubstance_code_designator_value_str",
  CASE WHEN l_orderkey % 10 <> 9 THEN 'SCT:' || split_part(min('SCT:' || p_type || ':' || p_type), ':', 2) END AS "primaryAnatomicStructure_code_designator_value_str", CASE WHEN l_orderkey % 10 <> 9 THEN split_part(min('SCT:' || p_type || ':' || p_type), ':', 3) END AS "primaryAnatomicStructure_CodeMeaning",
  CASE WHEN l_orderkey % 10 <> 9 THEN 'SCT:' || split_part(min('SCT:' || p_brand || ':' || p_brand), ':', 2) END AS "primaryAnatomicStructureModifier_code_designator_value_str", CASE WHEN l_orderkey % 10 <> 9 THEN split_part(min('SCT:' || p_brand || ':' || p_brand), ':', 3) END AS "primaryAnatomicStructureModifier_CodeMeaning",
  'DCM:111744' AS "illuminationType_code_designator_value_str", 'Brightfield illumination' AS "illuminationType_CodeMeaning", {_SIG} AS "min_PixelSpacing_2sf",
  CASE WHEN l_orderkey % 2 = 0 THEN max(l_linenumber) * 100 ELSE max(l_linenumber) * 10 END AS "max_TotalPixelMatrixColumns",
  CASE WHEN l_orderkey % 2 = 0 THEN max(l_linenumber) * 200 ELSE max(l_linenumber) * 20 END AS "max_TotalPixelMatrixRows",
  CAST(CASE WHEN bool_or(l_linenumber % 2 = 0) THEN 40 END AS BIGINT) AS "ObjectiveLensPower" FROM sl GROUP BY l_orderkey""")
def n13(spark, sf):
    out = C.curate_series(D.slides(spark, sf))
    cols = [F.array_join(f.name, ",").alias(f.name) if f.dataType.typeName() == "array" else
            F.round(F.col(f.name) * 1000000).cast("bigint").alias(f.name) if f.name == "min_PixelSpacing_2sf" else F.col(f.name)
            for f in out.schema.fields]
    return out.select(*cols)


@query("a12_series_rollup", with_("items", extra=_SLIDE) + """SELECT 'se.' || l_orderkey AS "SeriesInstanceUID", 'c' || (l_orderkey % 5) AS collection_id, max(l_linenumber) * 10 AS columns_max,
  CAST(round(min(CASE WHEN l_orderkey % 4 NOT IN (1, 2) THEN sp END) * 10000) AS BIGINT) AS spacing_min, CASE WHEN l_orderkey % 10 <> 9 THEN min('SCT:' || p_type || ':' || p_type) END AS anatomy FROM sl GROUP BY l_orderkey""")
def a12(spark, sf):
    out = C.series_rollup(D.slides(spark, sf))
    return out.select("SeriesInstanceUID", "collection_id", F.col("_c").alias("columns_max"),
                      F.round(F.col("_s") * 10000).cast("bigint").alias("spacing_min"), F.col("_an").alias("anatomy"))


@query("a13_code_lists", with_("items", extra=_SLIDE) + """SELECT 'se.' || l_orderkey AS "SeriesInstanceUID", 'Paraffin wax:SCT:311731000' AS embedding,
  string_agg(DISTINCT p_type || ':SCT:' || p_type, ',' ORDER BY p_type || ':SCT:' || p_type) AS fixative, string_agg(DISTINCT p_brand || ':SCT:' || p_brand, ',' ORDER BY p_brand || ':SCT:' || p_brand) AS staining
FROM sl WHERE l_orderkey % 10 <> 9 GROUP BY l_orderkey""")
def a13(spark, sf):
    out = C.code_lists(D.slides(spark, sf))
    return out.select("SeriesInstanceUID", *[F.array_join(c, ",").alias(c) for c in ("embedding", "fixative", "staining")])


@query("j14_facet_left_joins", """SELECT o.o_orderkey, a.n AS n_r, b.n AS n_a, c.n AS n_n FROM orders o
LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a ON a.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) b ON b.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) c ON c.l_orderkey = o.o_orderkey""")
def j14(spark, sf):
    flag = F.col("l_returnflag")
    none_if_0 = lambda x: F.nullif(F.count_if(flag == x), F.lit(0).cast("bigint"))
    one = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(none_if_0("R").alias("n_r"), none_if_0("A").alias("n_a"), none_if_0("N").alias("n_n"))
    o = table(spark, sf, "orders").select("o_orderkey")
    return o.join(one, o.o_orderkey == one.l_orderkey, "left").drop("l_orderkey")


_NAMES = sorted((n, code) for code, names in C.BODY_PARTS.items() for n in names)
_SPELL = [n for n, _ in _NAMES] + ["KNEE", "CHEST"]
_WHEN = " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in _NAMES)
_PICK = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_SPELL))
_BP = f"(SELECT items.*, CASE l_partkey % {len(_SPELL)} {_PICK} END AS bp FROM items)"


def _instances(spark, sf):
    spell = F.get(F.array(*[F.lit(x) for x in _SPELL]), (F.col("l_partkey") % len(_SPELL)).cast("int"))
    return items(spark, sf).select(
        F.concat(F.lit("se."), "l_orderkey").alias("SeriesInstanceUID"), F.col("sop").alias("SOPInstanceUID"),
        F.when(F.col("l_linenumber") % 4 == 0, "thin").otherwise(F.concat("l_linenumber", F.lit(".5"))).alias("SliceThickness"),
        spell.alias("BodyPartExamined"), (F.col("l_suppkey") % 5).alias("collection_id"))


@query("p9_body_part", with_("items") + f"SELECT sop, CASE bp {_WHEN} ELSE bp END AS body_part FROM {_BP}")
def p9(spark, sf):
    return _instances(spark, sf).select(F.col("SOPInstanceUID").alias("sop"), C.recode(F.col("BodyPartExamined"), C.BODY_PARTS).alias("body_part"))


@query("p10_cap_list", "SELECT s_suppkey, CASE WHEN s_suppkey % 8 < 5 THEN array_to_string(list_transform(range(s_suppkey % 8 + 1), lambda i: 'x' || i), ',') ELSE 'Various' END AS tags FROM supplier")
def p10(spark, sf):
    tags = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("s_suppkey") % 8), lambda i: F.concat(F.lit("x"), i)), ",")
    return table(spark, sf, "supplier").select("s_suppkey", C.cap_list(tags).alias("tags"))


@query("n12_curated_instance", with_("items") + f"""SELECT 'se.' || l_orderkey AS "SeriesInstanceUID", sop AS "SOPInstanceUID",
  CASE WHEN l_linenumber % 4 <> 0 THEN l_linenumber * 10 + 5 END AS "SliceThickness", CASE bp {_WHEN} ELSE bp END AS "BodyPartExamined",
  CASE WHEN l_suppkey % 5 < 3 THEN 'a,b' ELSE 'Various' END AS cancer_types FROM {_BP}""")
def n12(spark, sf):
    ocm = table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("collection_id"),
                                            F.when(F.col("r_regionkey") < 3, "a,b").otherwise("a,b,c,d,e,f").alias("cancer_types"))
    out = C.curate_instance(_instances(spark, sf), ocm)
    return out.withColumn("SliceThickness", (F.col("SliceThickness") * 10).cast("int"))
