"""Nested documents built from the driver's tables: structured reports (one per order, one group per
line item), segmentations, and slide metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.operators.nested import SEG_CLASS
from vcat.plans.fixtures import items, table

CODES = "array<struct<CodeValue:string,CodingSchemeDesignator:string,CodeMeaning:string>>"
LEAF = f"array<struct<ConceptNameCodeSequence:{CODES},ConceptCodeSequence:{CODES}>>"
MEASURED = f"array<struct<NumericValue:array<string>,MeasurementUnitsCodeSequence:{CODES}>>"
REFS = "array<struct<ReferencedSOPClassUID:string,ReferencedSOPInstanceUID:string,ReferencedSegmentNumber:array<bigint>>>"


def _lit(x):
    return F.lit(x) if isinstance(x, str) else x


def code1(value, scheme, meaning):
    return F.struct(_lit(value).alias("CodeValue"), _lit(scheme).alias("CodingSchemeDesignator"), _lit(meaning).alias("CodeMeaning"))


def codes(value, scheme, meaning):
    return F.array(code1(value, scheme, meaning))


def child(cond, name, concept):
    leaf = F.struct(name.alias("ConceptNameCodeSequence"), concept.alias("ConceptCodeSequence"))
    return F.when(cond, F.array(leaf)).otherwise(F.array().cast(LEAF))


def item(kind, name, concept=None, text=None, uid=None, number=None, ref=None, kids=None):
    null = lambda t: F.lit(None).cast(t)
    return F.struct(
        F.lit(kind).alias("ValueType"), (null("string") if text is None else text).alias("TextValue"),
        (null("string") if uid is None else uid).alias("UID"), name.alias("ConceptNameCodeSequence"),
        (null(CODES) if concept is None else concept).alias("ConceptCodeSequence"),
        (null(MEASURED) if number is None else F.array(F.struct(
            F.array(number).alias("NumericValue"), codes("u", "UCUM", "unit").alias("MeasurementUnitsCodeSequence")))).alias("MeasuredValueSequence"),
        (null(REFS) if ref is None else ref).alias("ReferencedSOPSequence"),
        (F.array().cast(LEAF) if kids is None else kids).alias("ContentSequence"))


def group_rows(spark, sf):
    li = items(spark, sf)
    return li.join(table(spark, sf, "part").select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))


#: Most line items of a partition when orders are listed; above it there are more partitions than the session's.
PART_ROWS = 250_000

#: What the nested groups and segments are built of, besides the order's key.
NARROW = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "size", "p_type", "p_brand")


def per_order(spark, sf):
    """The line items of each order as a list of structs. Nested groups and segments are built from the list after that: the aggregate
    sorts its rows where it has many orders, and spills them, so these are kept small, without the instance key, which is made of the others, and
    there are as many partitions as keep the rows of each few."""
    rows = group_rows(spark, sf).select("l_orderkey", F.struct(*NARROW).alias("_r"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table(spark, sf, "lineitem").count() // PART_ROWS))
    lists = rows.repartition(parts, "l_orderkey").groupBy("l_orderkey").agg(F.collect_list("_r").alias("_rs"))
    return lists.select("l_orderkey", F.transform("_rs", _whole).alias("_rs"))


def _whole(row):
    """A narrow struct with the order's key and the instance key."""
    k = F.col("l_orderkey")
    sop = F.concat_ws(".", *[c.cast("string") for c in (k, *[row[x] for x in ("l_linenumber", "l_partkey", "l_suppkey", "size")])])
    return F.struct(sop.alias("sop"), k.alias("l_orderkey"), *[row[x].alias(x) for x in NARROW])


def reports(spark, sf):
    groups = F.array_sort(F.transform("_rs", lambda r: F.struct(r["sop"].alias("sop"), _group(r).alias("g"))))
    docs = per_order(spark, sf).select("l_orderkey", F.transform(groups, lambda x: x["g"]).alias("_gs"))
    k = F.col("l_orderkey")
    head = F.struct(F.lit("CODE").alias("ValueType"), codes("121058", "DCM", "Procedure reported").alias("ConceptNameCodeSequence"),
                    F.array().cast(kids_type()).alias("ContentSequence"))
    template = F.when(k % 17 == 0, F.array().cast("array<struct<TemplateIdentifier:string,MappingResource:string>>")).otherwise(
        F.array(F.struct(F.when(k % 9 == 0, "1501").otherwise("1500").alias("TemplateIdentifier"), F.lit("DCMR").alias("MappingResource"))))
    box = F.struct(F.lit("CONTAINER").alias("ValueType"), F.concat(F.array(head), "_gs").alias("ContentSequence"))
    return docs.select(
        F.concat(F.lit("p"), k % 25).alias("PatientID"), F.concat(F.lit("sr."), k).alias("SOPInstanceUID"),
        F.concat(F.lit("srse."), k).alias("SeriesInstanceUID"), F.concat(F.lit("desc "), k % 7).alias("SeriesDescription"),
        F.lit("1.2.840.10008.5.1.4.1.1.88.33").alias("SOPClassUID"), template.alias("ContentTemplateSequence"),
        F.array(box).alias("ContentSequence"))


def _group(row):
    """The measurement group of a line item."""
    c = lambda name: row[name]
    even = c("l_orderkey") % 2 == 0
    dcm = lambda v, m: codes(v, "DCM", m)
    site = F.when(even, codes("G-C0E3", "SRT", "Finding Site")).otherwise(codes("363698007", "SCT", "Finding Site"))
    kids = F.array(
        item("TEXT", dcm("112039", "Tracking Identifier"), text=c("sop")),
        item("UIDREF", dcm("112040", "Tracking Unique Identifier"), uid=F.md5(c("sop"))),
        item("UIDREF", dcm("121232", "Source series for segmentation"), uid=c("l_partkey").cast("string")),
        item("IMAGE", dcm("121191", "Referenced Segment"), ref=F.array(F.struct(
            F.lit(SEG_CLASS).alias("ReferencedSOPClassUID"), F.concat(F.lit("seg."), c("l_suppkey")).alias("ReferencedSOPInstanceUID"),
            F.array(c("l_linenumber").cast("bigint")).alias("ReferencedSegmentNumber")))),
        item("CODE", dcm("121071", "Finding"), concept=codes(c("p_type"), "X", c("p_type"))),
        item("CODE", site, concept=codes(c("p_brand"), "Y", c("p_brand")),
             kids=child(c("l_returnflag") == "R", codes("272741003", "SCT", "Laterality"), codes("7771000", "SCT", "Left"))),
        item("CODE", codes("EV1", "99X", "Evaluation"), concept=codes(c("l_linestatus"), "Z", c("l_linestatus"))),
        item("NUM", codes("Q", "99X", "Quantity"), number=c("l_quantity").cast("int").cast("string")),
        item("NUM", codes("P", "99X", "Price"), number=c("size").cast("string"),
             kids=child(c("l_linestatus") == "O", dcm("121401", "Derivation"), codes("R-00317", "SRT", "Mean"))),
        item("NUM", codes("N", "99X", "None"), number=F.lit("n/a")))
    return F.struct(F.lit("CONTAINER").alias("ValueType"), dcm("125007", "Measurement Group").alias("ConceptNameCodeSequence"),
                    kids.alias("ContentSequence"))


def kids_type():
    return (f"array<struct<ValueType:string,TextValue:string,UID:string,ConceptNameCodeSequence:{CODES},ConceptCodeSequence:{CODES},"
            f"MeasuredValueSequence:{MEASURED},ReferencedSOPSequence:{REFS},ContentSequence:{LEAF}>>")


def seg_lookup(spark, sf):
    return table(spark, sf, "supplier").select(F.concat(F.lit("seg."), "s_suppkey").alias("SOPInstanceUID"),
                                               F.concat(F.lit("segse."), "s_suppkey").alias("SeriesInstanceUID"))


REGION = "array<struct<CodeValue:string,CodingSchemeDesignator:string,CodeMeaning:string,AnatomicRegionModifierSequence:%s>>" % CODES
INSTANCES = "array<struct<ReferencedSOPInstanceUID:string>>"


def _segment(row):
    """The segment of a line item."""
    c = lambda name: row[name]
    n = c("l_linenumber")
    some = n % 3 != 0
    modifiers = F.when(n % 2 == 0, codes(c("p_brand"), "Y", c("p_brand"))).otherwise(F.array().cast(CODES))
    region = F.array(F.struct(c("p_type").alias("CodeValue"), F.lit("X").alias("CodingSchemeDesignator"), c("p_type").alias("CodeMeaning"),
                              modifiers.alias("AnatomicRegionModifierSequence")))
    return F.struct(
        n.alias("SegmentNumber"), F.when(some, region).otherwise(F.array().cast(REGION)).alias("AnatomicRegionSequence"),
        F.when(some, codes("T-D0050", "SRT", "Tissue")).otherwise(F.array().cast(CODES)).alias("SegmentedPropertyCategoryCodeSequence"),
        F.when(some, codes(c("p_brand"), "Y", c("p_brand"))).otherwise(F.array().cast(CODES)).alias("SegmentedPropertyTypeCodeSequence"),
        F.lit("AUTOMATIC").alias("SegmentAlgorithmType"),
        F.when(some, F.array(F.lit("alg"))).otherwise(F.array().cast("array<string>")).alias("SegmentAlgorithmName"),
        F.md5(c("sop")).alias("TrackingUID"), c("sop").alias("TrackingID"))


def segmentation_docs(spark, sf):
    k = F.col("l_orderkey")
    docs = per_order(spark, sf).select("l_orderkey", F.array_sort(F.transform("_rs", _segment)).alias("SegmentSequence"))
    ref = F.array(F.struct(F.concat(F.lit("img."), k).alias("ReferencedSOPInstanceUID")))
    none = F.array().cast(INSTANCES)
    pick = lambda i: F.when((k % 5 != 0) & (k % 3 == i), ref).otherwise(none)
    return docs.select(
        F.concat(F.lit("p"), k % 25).alias("PatientID"), F.concat(F.lit("st."), k % 100).alias("StudyInstanceUID"),
        F.concat(F.lit("sgse."), k).alias("SeriesInstanceUID"), F.concat(F.lit("sg."), k).alias("SOPInstanceUID"),
        F.concat(F.lit("for."), k % 10).alias("FrameOfReferenceUID"), F.lit("BINARY").alias("SegmentationType"), F.lit(SEG_CLASS).alias("SOPClassUID"),
        F.lit("SEG").alias("Modality"), "SegmentSequence", F.array(F.struct(pick(0).alias("ReferencedInstanceSequence"))).alias("ReferencedSeriesSequence"),
        pick(1).alias("ReferencedImageSequence"), pick(2).alias("SourceImageSequence"))


def with_images(spark, sf, segs):
    """The segmentations together with the images they refer to."""
    img = table(spark, sf, "orders").filter("o_orderkey % 4 <> 3").select(
        F.concat(F.lit("img."), "o_orderkey").alias("SOPInstanceUID"), F.concat(F.lit("imse."), "o_custkey").alias("SeriesInstanceUID"),
        F.lit("CT").alias("Modality"), F.lit("ct").alias("SOPClassUID"))
    keep = ["SOPInstanceUID", "SeriesInstanceUID", "Modality", "SOPClassUID", "ReferencedSeriesSequence", "ReferencedImageSequence", "SourceImageSequence"]
    return segs.select(*keep).unionByName(img, allowMissingColumns=True)


def slides(spark, sf):
    c = F.col
    k, n = c("l_orderkey"), c("l_linenumber")
    spacing = F.concat(F.lit("0."), F.lpad((n * 37).cast("string"), 4, "0"))
    texts = lambda *x: F.array(*x)
    none = F.array().cast("array<string>")
    step = lambda v, m, concept: F.struct(codes(v, "SCT", m).alias("ConceptNameCodeSequence"), concept.alias("ConceptCodeSequence"))
    steps = F.array(
        F.struct(F.array(step("430863003", "Embedding medium", codes("311731000", "SCT", "Paraffin wax")),
                         step("1", "Other", codes("2", "SCT", "x"))).alias("SpecimenPreparationStepContentItemSequence")),
        F.struct(F.array(step("430864009", "Tissue Fixative", codes(c("p_type"), "SCT", c("p_type"))),
                         step("424361007", "Using substance", codes(c("p_brand"), "SCT", c("p_brand")))).alias("SpecimenPreparationStepContentItemSequence")))
    anatomy = F.array(F.struct(
        c("p_type").alias("CodeValue"), F.lit("SCT").alias("CodingSchemeDesignator"), c("p_type").alias("CodeMeaning"),
        codes(c("p_brand"), "SCT", c("p_brand")).alias("PrimaryAnatomicStructureModifierSequence")))
    spec = F.array(F.struct(anatomy.alias("PrimaryAnatomicStructureSequence"), steps.alias("SpecimenPreparationSequence")))
    path = F.array(F.struct(F.when(n % 2 == 0, "40").otherwise("x").alias("ObjectiveLensPower"),
                            codes("111744", "DCM", "Brightfield illumination").alias("IlluminationTypeCodeSequence")))
    return group_rows(spark, sf).select(
        F.concat(F.lit("se."), k).alias("SeriesInstanceUID"), c("sop").alias("SOPInstanceUID"), F.lit("SM").alias("Modality"),
        F.concat(F.lit("c"), k % 5).alias("collection_id"), F.when(k % 2 == 0, n * 100).alias("TotalPixelMatrixColumns"),
        F.when(k % 2 == 0, n * 200).alias("TotalPixelMatrixRows"), (n * 10).alias("Columns"), (n * 20).alias("Rows"),
        F.when(k % 4 == 1, none).when(k % 4 == 2, texts(F.lit("bad"))).otherwise(texts(spacing, spacing)).alias("PixelSpacing"),
        F.array(F.struct(F.array(F.struct(texts(F.concat(F.lit("0.5"), n)).alias("PixelSpacing"))).alias("PixelMeasuresSequence"))).alias("SharedFunctionalGroupsSequence"),
        path.alias("OpticalPathSequence"),
        F.when(k % 10 != 9, spec).otherwise(F.array().cast(spec_type())).alias("SpecimenDescriptionSequence"))


def spec_type():
    step = f"array<struct<ConceptNameCodeSequence:{CODES},ConceptCodeSequence:{CODES}>>"
    return ("array<struct<PrimaryAnatomicStructureSequence:array<struct<CodeValue:string,CodingSchemeDesignator:string,CodeMeaning:string,"
            f"PrimaryAnatomicStructureModifierSequence:{CODES}>>,SpecimenPreparationSequence:array<struct<SpecimenPreparationStepContentItemSequence:{step}>>>>")
