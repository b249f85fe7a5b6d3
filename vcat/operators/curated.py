"""Curated image metadata, per instance and per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.functions.exprs import code_pair, code_part, code_str, first, head_of, sig2, tail_of
from vcat.operators.nested import specimen_steps

# Spellings of the examined body part and the code each stands for.
BODY_PARTS = {
    "ABDOMEN": ("PORT ABDOMEN", "J BRZUSZNA", "ABD", "BD BD MR ABDOME", "BD CT ABD WO_W", "J brzuszna"),
    "PELVIS": ("Pelvis",),
    "ABDOMENPELVIS": (
        "PET_ABDOMEN_PEL", "CT ABD PELVIS", "ABD PEL", "ABD PELV", "ABDOMEN PEL", "ABDOMEN PELVIS", "ABDOMEN TO PEL",
        "ABDOMEN_PELVIS", "ABDPEL", "ABDOMEN_PELVIS C", "PET_ABDOMEN_PELV"),
    "CHEST": (
        "TH CT CHEST WO", "SPI CHEST 5MM", "PORT CHEST", "PET_CT SCAN CHE", "CTA CHEST", "CT CHEST W_ENHA", "CT CHEST WITH C",
        "CT CHEST WO CE", "AP PORTABLE CHE", "CHEST COMPUTED", "CHEST INF", "CHEST NO GRID", "CHEST PE", "Chest",
        "CT CHEST W_ENHAN", "CHEST COMPUTED T", "PET_CT SCAN CHES", "AP PORTABLE CHES", "CHEST (THORAX) W"),
    "BRAIN": ("MR BRAIN W CON", "MR NEURO BRAIN", "BRAIN W/WO_AH", "BRAIN W/WO_AH32"),
    "CHESTABDPELVIS": (
        "CHEST_TO_PELVIS", "CAP", "CAP INFUSION", "CHABDPELV", "CHEST ABD PEL", "CHEST ABD PELVI", "CHEST TO PEL",
        "CHEST TO PELVIS", "CHEST_ABD_PEL", "CHEST ABD PELVIS"),
    "CSPINE": ("CERVICAL_SPINE",),
    "CHESTABDOMEN": ("THORAXABD", "CT_CHABD", "CHEST ABDOMEN", "CHEST_ABDOMEN", "CHEST/ABD"),
    "KIDNEY": ("CT 3PHASE REN", "Kidney"),
    "THORAX": ("THORAX CT _AH05", "THORAX CT _OT01", "CT THORAX W CNT", "Thorax"),
    "HEADNECK": ("HEAD_NECK", "HEAD-AND-NECK", "HEAD-NECK", "HEADANDNECK"),
    "LSSPINE": ("LUMBO-SACRAL SP", "LUMBO-SACRAL SPI"),
    "NECKCHESTABDPELV": ("NECK TO PELVIS", "NECKCHESTABDPEL"),
    "TSPINE": ("THORACIC SPINE",),
    "WHOLEBODY": ("WHOLE BODY",),
}
# Concept names of specimen preparation (scheme, value).
EMBEDDING, FIXATIVE, SUBSTANCE = ("SCT", "430863003"), ("SCT", "430864009"), ("SCT", "424361007")


def recode(c: Column, codes: dict[str, tuple[str, ...]]) -> Column:
    """Spelling to code by a constant map; other values stay. The map is a literal, so no join."""
    pairs = [F.lit(x) for code, names in codes.items() for name in names for x in (name, code)]
    return F.coalesce(F.get(F.array(F.try_element_at(F.create_map(*pairs), c)), F.lit(0)), c)


def cap_list(c: Column, most: int = 5) -> Column:
    return F.when(F.size(F.split(c, ",")) <= most, c).otherwise(F.lit("Various"))


def curate_instance(df: DataFrame, ocm: DataFrame, body_map: dict | None = None) -> DataFrame:
    """Numeric slice thickness, canonical body part, and the collection's cancer types (capped)."""
    o = ocm.select("collection_id", cap_list(F.col("cancer_types")).alias("cancer_types"))
    return df.join(o, "collection_id").select(
        "SeriesInstanceUID", "SOPInstanceUID", F.col("SliceThickness").try_cast("double").alias("SliceThickness"),
        recode(F.col("BodyPartExamined"), body_map or BODY_PARTS).alias("BodyPartExamined"), "cancer_types")


def _code_of(c: Column) -> Column:
    return code_str(c["CodingSchemeDesignator"], c["CodeValue"], c["CodeMeaning"])


def series_rollup(df: DataFrame) -> DataFrame:
    """Per series: extremes of the image size, spacing, and one code string per concept. Where several
    values exist the smallest one is taken, so that the result does not depend on row order."""
    spec = first("SpecimenDescriptionSequence")
    anatomy = first(spec["PrimaryAnatomicStructureSequence"])
    path = first("OpticalPathSequence")
    shared = first(first("SharedFunctionalGroupsSequence")["PixelMeasuresSequence"])
    narrow = df.select(
        "SeriesInstanceUID", "Modality", "collection_id", path["ObjectiveLensPower"].alias("power"), "TotalPixelMatrixColumns",
        "TotalPixelMatrixRows", "Columns", "Rows", first("PixelSpacing").try_cast("double").alias("spacing"),
        first(shared["PixelSpacing"]).try_cast("double").alias("fg_spacing"), _code_of(anatomy).alias("anatomy"),
        _code_of(first(anatomy["PrimaryAnatomicStructureModifierSequence"])).alias("modifier"),
        _code_of(first(path["IlluminationTypeCodeSequence"])).alias("light"))
    return narrow.groupBy("SeriesInstanceUID").agg(
        F.min("Modality").alias("Modality"), F.array_join(F.array_sort(F.collect_set("collection_id")), ",").alias("collection_id"),
        F.min("power").alias("ObjectiveLensPower"), F.max("TotalPixelMatrixColumns").alias("_tc"), F.max("TotalPixelMatrixRows").alias("_tr"),
        F.max("Columns").alias("_c"), F.max("Rows").alias("_r"), F.min("spacing").alias("_s"), F.min("fg_spacing").alias("_fs"),
        F.min("anatomy").alias("_an"), F.min("modifier").alias("_mo"), F.min("light").alias("_li"))


def code_lists(df: DataFrame) -> DataFrame:
    """Per series: the distinct codes of embedding medium, fixative and staining substance, in one
    grouping. Distinct rows first, so that the many instances of a large series reduce early."""
    steps = specimen_steps(df)
    is_ = lambda n: (F.col("cnc_csd") == n[0]) & (F.col("cnc_val") == n[1])
    kind = F.when(is_(EMBEDDING), "e").when(is_(FIXATIVE), "f").when(is_(SUBSTANCE), "s")
    rows = steps.select("SeriesInstanceUID", kind.alias("_k"), code_str("ccs_cm", "ccs_csd", "ccs_val").alias("_v")).filter(
        "_k IS NOT NULL").distinct()
    lst = lambda k: F.array_sort(F.collect_list(F.when(F.col("_k") == k, F.col("_v"))))
    return rows.groupBy("SeriesInstanceUID").agg(lst("e").alias("embedding"), lst("f").alias("fixative"), lst("s").alias("staining"))


def curate_series(df: DataFrame) -> DataFrame:
    """The series-level table. Roll-up and code lists are both grouped by series, so joining them moves
    no further data."""
    j = series_rollup(df).join(code_lists(df), "SeriesInstanceUID", "left")
    empty = F.array().cast("array<string>")
    named = {"embeddingMedium": "embedding", "tissueFixative": "fixative", "staining_usingSubstance": "staining"}
    cols = []
    for out, c in named.items():
        cols += [F.coalesce(head_of(c), empty).alias(f"{out}_CodeMeaning"),
                 F.coalesce(tail_of(c), empty).alias(f"{out}_code_designator_value_str")]
    for out, c in (("primaryAnatomicStructure", "_an"), ("primaryAnatomicStructureModifier", "_mo"), ("illuminationType", "_li")):
        cols += [code_pair(c).alias(f"{out}_code_designator_value_str"), code_part(c, 2).alias(f"{out}_CodeMeaning")]
    return j.select(
        "SeriesInstanceUID", "Modality", *cols, sig2(F.coalesce("_s", "_fs")).alias("min_PixelSpacing_2sf"),
        F.coalesce("_tc", "_c").alias("max_TotalPixelMatrixColumns"), F.coalesce("_tr", "_r").alias("max_TotalPixelMatrixRows"),
        F.col("ObjectiveLensPower").try_cast("bigint").alias("ObjectiveLensPower"))
