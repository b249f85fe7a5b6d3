"""Flattening of nested documents: measurement groups of structured reports, their qualitative and
quantitative items, and segmentations.

All facets of a group sit in the group's own child list, so they are taken from it with array
functions and exploded in place. No self join and no shuffle is needed; the only joins are look-ups
of a referenced object by its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.functions.exprs import _c, first, viewer_url

# Standard identifiers of the document classes and concepts.
REPORT_CLASSES = (
    "1.2.840.10008.5.1.4.1.1.88.11", "1.2.840.10008.5.1.4.1.1.88.22", "1.2.840.10008.5.1.4.1.1.88.33",
    "1.2.840.10008.5.1.4.1.1.88.34", "1.2.840.10008.5.1.4.1.1.88.35",
)
SEG_CLASS = "1.2.840.10008.5.1.4.1.1.66.4"
TEMPLATE = ("1500", "DCMR")
GROUP_MEANING = "Measurement Group"
TRACKING_ID, TRACKING_UID, SOURCE_SERIES = ("112039", "DCM"), ("112040", "DCM"), ("121232", "DCM")
FINDING, SITE_SRT, SITE_SCT = ("121071", "DCM"), ("G-C0E3", "SRT"), ("363698007", "SCT")
DERIVATION, LATERALITY = ("121401", "DCM"), ("272741003", "SCT")

CODE = "struct<CodeValue:string,CodingSchemeDesignator:string,CodeMeaning:string>"

#: Most rows of a look-up that every executor gets whole (two ids a row); beyond it the planner shuffles the groups to meet it.
LOOKUP_ROWS = 1_000_000


def is_code(c: Column, code: tuple[str, str]) -> Column:
    return (c["CodeValue"] == code[0]) & (c["CodingSchemeDesignator"] == code[1])


def unnest(df: DataFrame, col: str, out: str, pos: str | None = None) -> DataFrame:
    """One row per array element; with ``pos`` also its 0-based position. Empty arrays drop the row."""
    rest = [c for c in df.columns if c != col]
    if pos:
        return df.select(*rest, F.posexplode(col).alias(pos, out))
    return df.select(*rest, F.explode(col).alias(out))


def facet(items, value_type: str, *codes: tuple[str, str]) -> Column:
    """The children of a value type whose concept name is one of the codes."""
    def test(x):
        name = first(x["ConceptNameCodeSequence"])
        hit = None
        for code in codes:
            hit = is_code(name, code) if hit is None else hit | is_code(name, code)
        ok = x["ValueType"] == value_type
        return ok if hit is None else ok & hit

    return F.filter(_c(items), test)


def structured_reports(dm: DataFrame) -> DataFrame:
    """Reports of the measurement template."""
    t = first("ContentTemplateSequence")
    return dm.filter(F.col("SOPClassUID").isin(*REPORT_CLASSES) & (F.size("ContentTemplateSequence") > 0)
                     & (t["TemplateIdentifier"] == TEMPLATE[0]) & (t["MappingResource"] == TEMPLATE[1]))


def measurement_groups(dm: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """One row per group and combination of its facets. A group without one of the facets drops out.

    The group number is the position within its container, so with several containers in a document
    the number alone is not a key; rows are formed within one group, never across containers.
    ``lookup`` (SOPInstanceUID, SeriesInstanceUID) resolves the segmentation; default ``dm``. The groups are far wider than it is, so they are
    not shuffled for one of at most ``LOOKUP_ROWS`` rows, which are counted for that.
    """
    rows = structured_reports(dm).select("PatientID", "SOPInstanceUID", "SeriesInstanceUID", "SeriesDescription", "ContentSequence")
    boxes = unnest(rows, "ContentSequence", "_box").withColumn("_kids", F.col("_box.ContentSequence")).drop("_box")
    groups = unnest(boxes, "_kids", "contentSequence", "measurementGroup_number").filter(
        (F.col("contentSequence.ValueType") == "CONTAINER")
        & (first("contentSequence.ConceptNameCodeSequence")["CodeMeaning"] == GROUP_MEANING))
    kids = "contentSequence.ContentSequence"
    facets = {
        "trackingUniqueIdentifier": F.transform(facet(kids, "UIDREF", TRACKING_UID), lambda x: x["UID"]),
        "trackingIdentifier": F.transform(facet(kids, "TEXT", TRACKING_ID), lambda x: x["TextValue"]),
        "finding": F.transform(facet(kids, "CODE", FINDING), lambda x: first(x["ConceptCodeSequence"])),
        "findingSite": F.transform(facet(kids, "CODE", SITE_SRT, SITE_SCT), lambda x: first(x["ConceptCodeSequence"])),
        "sourceSegmentedSeriesUID": F.transform(facet(kids, "UIDREF", SOURCE_SERIES), lambda x: x["UID"]),
        "_seg": F.transform(
            F.filter(facet(kids, "IMAGE"), lambda x: first(x["ReferencedSOPSequence"])["ReferencedSOPClassUID"] == SEG_CLASS),
            lambda x: first(x["ReferencedSOPSequence"])),
    }
    for name, values in facets.items():
        groups = groups.select("*", F.explode(values).alias(name))
    groups = groups.withColumns({
        "segmentationInstanceUID": F.col("_seg.ReferencedSOPInstanceUID"),
        "segmentationSegmentNumber": first("_seg.ReferencedSegmentNumber")}).drop("_seg")
    seg = (dm if lookup is None else lookup).select(
        F.col("SOPInstanceUID").alias("segmentationInstanceUID"), F.col("SeriesInstanceUID").alias("segmentationSeriesUID"))
    if lookup is not None and lookup.count() <= LOOKUP_ROWS:
        seg = F.broadcast(seg)
    return groups.join(seg, "segmentationInstanceUID")


_GROUP = ("PatientID", "SOPInstanceUID", "SeriesInstanceUID", "measurementGroup_number", "segmentationInstanceUID",
          "segmentationSeriesUID", "segmentationSegmentNumber", "sourceSegmentedSeriesUID", "trackingIdentifier",
          "trackingUniqueIdentifier")


def _findings(kids) -> Column:
    return F.transform(facet(kids, "CODE", FINDING), lambda x: first(x["ConceptCodeSequence"]))


def _modifier(item: Column, code: tuple[str, str]) -> Column:
    """Concept of the item's first child if that child is named by the code, else a struct of NULLs."""
    child = first(item["ContentSequence"])
    value = first(child["ConceptCodeSequence"])
    hit = is_code(first(child["ConceptNameCodeSequence"]), code)
    fields = ("CodeValue", "CodingSchemeDesignator", "CodeMeaning")
    return F.named_struct(*[x for f in fields for x in (F.lit(f), F.when(hit, value[f]))])


def qualitative(mg: DataFrame, strict: bool = False) -> DataFrame:
    """CODE items of each group, with its finding and site.

    By default the finding and site items are left out the way the published table does: by comparing
    the concept's *meaning* with the two code values and its scheme with theirs, which leaves out every
    DCM and SRT concept; and only SRT sites count. ``strict`` leaves out exactly the finding and site
    items and accepts both site codes.
    """
    kids = "contentSequence.ContentSequence"
    sites = facet(kids, "CODE", SITE_SRT, SITE_SCT) if strict else facet(kids, "CODE", SITE_SRT)
    rows = mg.select(*_GROUP, F.explode(facet(kids, "CODE")).alias("_i"), _findings(kids).alias("_f"),
                     F.transform(sites, lambda x: first(x["ConceptCodeSequence"])).alias("_s"))
    name = first("_i.ConceptNameCodeSequence")
    if strict:
        keep = ~(is_code(name, FINDING) | is_code(name, SITE_SRT) | is_code(name, SITE_SCT))
    else:
        differs = lambda code: (name["CodeMeaning"] != code[0]) & (name["CodingSchemeDesignator"] != code[1])
        keep = differs(FINDING) & differs(SITE_SRT)
    rows = rows.filter(keep).select(*_GROUP, name.alias("Quantity"), first("_i.ConceptCodeSequence").alias("Value"), "_s",
                                    F.explode("_f").alias("finding"))
    return rows.select("*", F.explode("_s").alias("findingSite")).drop("_s")


def quantitative(mg: DataFrame) -> DataFrame:
    """NUM items of each group with value, unit, and the derivation and laterality modifiers."""
    kids = "contentSequence.ContentSequence"
    sites = F.transform(facet(kids, "CODE", SITE_SRT, SITE_SCT), lambda x: F.named_struct(
        F.lit("site"), first(x["ConceptCodeSequence"]), F.lit("side"), _modifier(x, LATERALITY)))
    rows = mg.select(*_GROUP, "SeriesDescription", F.explode(facet(kids, "NUM")).alias("_i"), _findings(kids).alias("_f"), sites.alias("_s"))
    measured = first("_i.MeasuredValueSequence")
    rows = rows.select(
        *_GROUP, "SeriesDescription", first("_i.ConceptNameCodeSequence").alias("Quantity"),
        _modifier(F.col("_i"), DERIVATION).alias("derivationModifier"),
        first(measured["NumericValue"]).try_cast("decimal(38,9)").alias("Value"),
        first(measured["MeasurementUnitsCodeSequence"]).alias("Units"), "_s", F.explode("_f").alias("finding"))
    return rows.select("*", F.explode("_s").alias("_x")).select(
        "*", F.col("_x.site").alias("findingSite"), F.col("_x.side").alias("lateralityModifier")).drop("_s", "_x")


def segmentations(dm: DataFrame, all_: DataFrame, viewer: str = "https://viewer/v3/viewer/") -> DataFrame:
    """One row per segment, with the series it segments where that can be found by any of three
    reference paths; segments without a match stay."""
    segs = dm.filter(F.col("SOPClassUID") == SEG_CLASS).select(
        "PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "FrameOfReferenceUID", "SegmentationType",
        F.explode("SegmentSequence").alias("_g"))
    region = first("_g.AnatomicRegionSequence")
    code = lambda x: F.when(x.isNotNull(), F.struct(*[x[f].alias(f) for f in ("CodeValue", "CodingSchemeDesignator", "CodeMeaning")]))
    flat = segs.select(
        "PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "FrameOfReferenceUID", "SegmentationType",
        code(region).alias("AnatomicRegion"), first(region["AnatomicRegionModifierSequence"]).alias("AnatomicRegionModifier"),
        first("_g.SegmentedPropertyCategoryCodeSequence").alias("SegmentedPropertyCategory"),
        first("_g.SegmentedPropertyTypeCodeSequence").alias("SegmentedPropertyType"),
        F.col("_g.SegmentAlgorithmType").alias("SegmentAlgorithmType"), first("_g.SegmentAlgorithmName").alias("SegmentAlgorithmName"),
        F.col("_g.SegmentNumber").alias("SegmentNumber"), F.col("_g.TrackingUID").alias("TrackingUID"), F.col("_g.TrackingID").alias("TrackingID"))
    by_series = first(first("ReferencedSeriesSequence")["ReferencedInstanceSequence"])["ReferencedSOPInstanceUID"]
    refs = all_.filter((F.col("Modality") == "SEG") & (F.col("SOPClassUID") == SEG_CLASS)).select(
        F.col("SOPInstanceUID").alias("_seg"),
        F.coalesce(by_series, first("ReferencedImageSequence")["ReferencedSOPInstanceUID"],
                   first("SourceImageSequence")["ReferencedSOPInstanceUID"]).alias("_ref"))
    found = refs.join(all_.select(F.col("SOPInstanceUID").alias("_ref"), F.col("SeriesInstanceUID").alias("segmented_SeriesInstanceUID")), "_ref")
    return found.drop("_ref").join(flat, F.col("_seg") == F.col("SOPInstanceUID"), "right").drop("_seg").withColumn(
        "viewer_url", viewer_url(viewer, "StudyInstanceUID", "SeriesInstanceUID"))


def specimen_steps(df: DataFrame, key: str = "SeriesInstanceUID") -> DataFrame:
    """Preparation steps of the first specimen: concept name and concept of every content item."""
    steps = df.select(key, F.explode(first("SpecimenDescriptionSequence")["SpecimenPreparationSequence"]).alias("_a"))
    items = steps.select(key, F.explode("_a.SpecimenPreparationStepContentItemSequence").alias("_b"))
    names = items.select(key, F.explode("_b.ConceptNameCodeSequence").alias("_n"), "_b")
    rows = names.select(key, "_n", F.explode("_b.ConceptCodeSequence").alias("_v"))
    return rows.select(
        key, F.col("_n.CodeMeaning").alias("cnc_cm"), F.col("_n.CodingSchemeDesignator").alias("cnc_csd"), F.col("_n.CodeValue").alias("cnc_val"),
        F.col("_v.CodeMeaning").alias("ccs_cm"), F.col("_v.CodingSchemeDesignator").alias("ccs_csd"), F.col("_v.CodeValue").alias("ccs_val"))
