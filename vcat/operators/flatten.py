"""From level and edge tables to the flattened, joined and published tables.

The large joins are series edge with instance and with the flattened upper levels. No join side is
forced to be broadcast: the lookups are small and Spark broadcasts them while they stay below its size
threshold, and beyond it the same plan runs as a shuffled join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.functions.exprs import bucket_for, object_url, pack_hash, pack_hashes, pack_id, unpack_hash, unpack_hashes, unpack_id, web_id

# Bucket by access type: (development, public on one cloud, public on the other); no public bucket for
# data that is not public.
BUCKETS = {
    "Open": ("arch-open", "open-data", "open-data"),
    "Cr": ("arch-cr", "open-cr", "open-data-cr"),
    "Defaced": ("arch-defaced", "open-defaced", "open-data-two"),
    "Redacted": ("arch-redacted", None, None),
}
DEV_REST = "arch-excluded"

_SPAN = ("init_version", "rev_version", "final_version")
_COMMON = ("uuid", "min_timestamp", "max_timestamp", "hashes", "sources", *_SPAN, "redacted")


def _prefixed(df: DataFrame, prefix: str, common, *plain) -> DataFrame:
    narrow = {"uuid": pack_id, "hash": pack_hash}
    cols = [x for c in common for x in (pack_hashes(df, c, f"{prefix}_{c}") if c == "hashes" else [narrow.get(c, F.col)(c).alias(f"{prefix}_{c}")])]
    return df.select(*plain, *cols)


def widened(df: DataFrame) -> DataFrame:
    """Flattened rows with the ids and hashes that are narrow as text."""
    cols, types = {}, dict(df.dtypes)
    for c in df.columns:
        name = c.split(":", 1)[0]
        if name not in cols:
            cols[name] = (unpack_hashes(df.columns, name) if c != name else unpack_id(c) if c.endswith("_uuid") and types[c] == "binary"
                          else unpack_hash(c) if c == "i_hash" and types[c] == "binary" else F.col(c)).alias(name)
    return df.select(*cols.values())


def all_flattened(levels: dict[str, DataFrame], edges: dict[str, DataFrame], narrow: bool = False) -> DataFrame:
    """One row per instance and version: the five levels joined along the edges.

    Ids and hashes are what every join shuffles; they go through the joins as narrow columns and are text again in the result, or,
    with ``narrow``, where ``widened`` is called on what is made of it."""
    v = _prefixed(levels["version"], "v", ("min_timestamp", "max_timestamp", "hashes", "sources"), "version", "previous_version")
    c = _prefixed(levels["collection"], "c", _COMMON, "collection_id", "collection_uid")
    p = _prefixed(levels["patient"], "p", _COMMON, "submitter_case_id", "case_id")
    st = _prefixed(levels["study"], "st", _COMMON, "study_instance_uid", "study_instances")
    se = _prefixed(levels["series"], "se", (*_COMMON, "excluded"), "series_instance_uid", "series_instances",
                   "source_doi", "source_url", "versioned_source_doi")
    i = _prefixed(levels["instance"], "i", ("uuid", "timestamp", "hash", "source", "size", "excluded", *_SPAN, "redacted"),
                  "sop_instance_uid", "mitigation", "ingestion_url")

    def step(upper, edge, child, pk, ck, parent_col, child_col):
        e = edge.select(pack_id(pk).alias(parent_col), pack_id(ck).alias(child_col))
        return upper.join(e, parent_col).join(child, child_col)

    vc = edges["version_collection"].select("version", pack_id("collection_uuid").alias("c_uuid"))
    up = v.join(vc, "version").join(c, "c_uuid")
    up = step(up, edges["collection_patient"], p, "collection_uuid", "patient_uuid", "c_uuid", "p_uuid")
    up = step(up, edges["patient_study"], st, "patient_uuid", "study_uuid", "p_uuid", "st_uuid")
    up = step(up, edges["study_series"], se, "study_uuid", "series_uuid", "st_uuid", "se_uuid")
    # Instances meet their edge first; the wide upper rows are joined to that once.
    low = edges["series_instance"].select(pack_id("series_uuid").alias("se_uuid"), pack_id("instance_uuid").alias("i_uuid")).join(i, "i_uuid")
    out = up.join(low, "se_uuid")
    cited = F.concat(F.lit("https://doi.org/"), "versioned_source_doi").alias("versioned_source_url")
    out = out.select(*[x for c in out.columns for x in ((c, cited) if c == "versioned_source_doi" else (c,))])
    return out if narrow else widened(out)


def source_stack_flat(stack: dict[str, DataFrame]) -> DataFrame:
    """Natural-key flatten of the one-to-many source stack."""
    c = stack["collection"].select("collection_id", F.col("hash").alias("c_hash"), F.col("redacted").alias("c_redacted"))
    p = stack["patient"].select("submitter_case_id", "collection_id", F.col("hash").alias("p_hash"), F.col("redacted").alias("p_redacted"))
    st = stack["study"].select("study_instance_uid", "submitter_case_id", F.col("hash").alias("st_hash"), F.col("redacted").alias("st_redacted"))
    se = stack["series"].select(
        "series_instance_uid", "study_instance_uid", F.col("hash").alias("se_hash"), F.col("excluded").alias("se_excluded"),
        F.col("redacted").alias("se_redacted"), "source_doi", "source_url", "versioned_source_doi",
        F.concat(F.lit("https://doi.org/"), "versioned_source_doi").alias("versioned_source_url"), "analysis_result")
    i = stack["instance"].select(
        "series_instance_uid", "sop_instance_uid", F.col("hash").alias("i_hash"), "ingestion_url", "size",
        F.col("excluded").alias("i_excluded"), "version", F.col("redacted").alias("i_redacted"), "mitigation")
    return (c.join(p, "collection_id").join(st, "submitter_case_id").join(se, "study_instance_uid")
            .join(i, "series_instance_uid"))


def _bucket(slot: int) -> Column:
    out = None
    for kind, names in BUCKETS.items():
        value = F.lit(names[slot])
        out = F.when(F.col("type") == kind, value) if out is None else out.when(F.col("type") == kind, value)
    return out.otherwise(F.lit(DEV_REST if slot == 0 else None))


def with_access(df: DataFrame, access: DataFrame, sunset: DataFrame) -> DataFrame:
    """Type, access and sunset of each row's DOI, with defaults where a lookup has none."""
    a = access.select("source_doi", F.col("type").alias("_t"), F.col("access").alias("_a"))
    s = sunset.select("source_doi", F.col("metadata_sunset").cast("bigint").alias("_s"))
    return df.join(a, "source_doi", "left").join(s, "source_doi", "left").withColumns({
        "type": F.coalesce("_t", F.lit("Open")), "access": F.coalesce("_a", F.lit("Public")),
        "metadata_sunset": F.coalesce("_s", F.lit(0).cast("bigint"))}).drop("_t", "_a", "_s")


_DESCRIBES = ("collection_id", "source_doi", "source_url", "i_source", "version", "i_excluded", "i_redacted")


def described(flat: DataFrame, *more: str) -> DataFrame:
    """The distinct values of all columns that sources and versioned DOIs are made of; ``more`` takes the place of those of the DOIs. What reads these
    columns alone, and takes no account of repeated rows, gives the same from this small table as from the flattened rows."""
    return flat.select(*_DESCRIBES, *(more or ("versioned_source_doi", "i_rev_version"))).distinct()


def narrow(flat: DataFrame, version: int | None, *cols: str) -> DataFrame:
    """The flattened rows with what sources are made of and some columns of the public rows of one version (none: of all); of other rows, these are NULL."""
    shown = ~F.col("i_excluded") & ~F.col("i_redacted")
    shown = shown if version is None else (F.col("version") == version) & shown
    return flat.select(*_DESCRIBES, *[F.when(shown, F.col(c)).alias(c) for c in cols if c not in _DESCRIBES])


def all_sources(flat: DataFrame, access: DataFrame, sunset: DataFrame, analysis: DataFrame) -> DataFrame:
    """One row per collection, DOI and source, with access, buckets and analysis-result flag. The
    distinct runs before the lookups, so these join a small table."""
    basics = flat.select(F.col("collection_id").alias("collection_name"), web_id("collection_id").alias("collection_id"),
                         "source_doi", "source_url", F.col("i_source").alias("source")).distinct()
    out = with_access(basics, access, sunset)
    ar = analysis.select("source_doi", F.col("analysis_result_id").alias("_ar"))
    return out.join(ar, "source_doi", "left").select(
        *out.columns, F.col("_ar").isNotNull().alias("analysis_result"), F.coalesce("_ar", F.lit("")).alias("analysis_result_id"),
        _bucket(0).alias("dev_bucket"), _bucket(1).alias("pub_gcs_bucket"), _bucket(2).alias("pub_aws_bucket"))


def all_joined(flat: DataFrame, sources: DataFrame) -> DataFrame:
    """Flattened rows with the attributes of their source; rows without a DOI drop out."""
    s = sources.select(
        "source_doi", F.col("collection_name").alias("collection_id"), "source", "type", "access", "metadata_sunset",
        "analysis_result", "dev_bucket", "pub_gcs_bucket", "pub_aws_bucket")
    return flat.join(s, ["source_doi", "collection_id"])


def public(df: DataFrame) -> DataFrame:
    return df.filter((F.col("access") == "Public") & ~F.col("i_excluded") & ~F.col("i_redacted"))


def limited(df: DataFrame) -> DataFrame:
    return df.filter(F.col("access") == "Limited")


def excluded(df: DataFrame) -> DataFrame:
    return df.filter(F.col("access") == "Excluded")


def current(df: DataFrame, version: int) -> DataFrame:
    return df.filter((F.col("version") == version) & (F.col("metadata_sunset") == 0))


def add_default_column(df: DataFrame, name: str, value) -> DataFrame:
    """New column with a default; where it exists already, its NULLs are filled."""
    return df.withColumn(name, F.coalesce(name, F.lit(value)) if name in df.columns else F.lit(value))


def newest_versioned_doi(df: DataFrame, own: str = "src_b", other: str = "src_a") -> DataFrame:
    """Versioned DOI per DOI. In-house rows take that of the newest revised instances, with ties kept;
    the other source has none, hence ''. A DOI fed by both sources yields a row for each.

    The rows are first reduced to one per (DOI, versioned DOI, revision)."""
    rows = df.filter(F.col("i_source") == own).groupBy("source_doi").agg(F.max("i_rev_version").alias("newest"))
    few = df.select("source_doi", "versioned_source_doi", "i_rev_version").distinct()
    mine = few.join(rows, "source_doi").filter(F.col("i_rev_version") == F.col("newest")).select(
        "source_doi", "versioned_source_doi").distinct()
    theirs = df.filter(F.col("i_source") == other).select("source_doi", F.lit("").alias("versioned_source_doi")).distinct()
    return mine.unionByName(theirs)


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest row per key, one only. An aggregate, so that rows are reduced before the shuffle;
    a window would move and sort them all."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)


def auxiliary(df: DataFrame, licenses: DataFrame, newest: DataFrame, target: str, version: int, merged: bool = False,
              without_doi: tuple[str, ...] = ("APOLLO",), images: DataFrame | None = None) -> DataFrame:
    """The published per-instance table: renamed columns, urls, licence and versioned DOI. Collections in
    ``without_doi`` are published with a blank one. ``images``: image metadata by SOPInstanceUID, as struct column ``_image`` of the result; rows
    without any drop out. They are joined before ids, hashes and urls are spelled out."""
    bucket = bucket_for(target, version, merged)
    j = (df.drop("versioned_source_doi").join(licenses.select("source_doi", "license_url", "license_long_name", "license_short_name"), "source_doi")
         .join(newest, "source_doi"))
    if images is not None:
        j = j.join(images.select(F.col("SOPInstanceUID").alias("sop_instance_uid"), F.struct(*[c for c in images.columns if c != "SOPInstanceUID"]).alias("_image")), "sop_instance_uid")
    j, col = widened(j), F.col
    return j.select(
        col("collection_id").alias("collection_name"), web_id("collection_id").alias("collection_id"),
        col("c_min_timestamp").alias("collection_timestamp"), col("c_hashes.all").alias("collection_hash"),
        col("c_init_version").alias("collection_init_version"), col("c_rev_version").alias("collection_revised_version"),
        col("submitter_case_id").alias("PatientID"), "case_id", col("p_hashes.all").alias("patient_hash"),
        col("p_init_version").alias("patient_init_version"), col("p_rev_version").alias("patient_revised_version"),
        col("study_instance_uid").alias("StudyInstanceUID"), col("st_uuid").alias("study_uuid"), "study_instances",
        col("st_hashes.all").alias("study_hash"), col("st_init_version").alias("study_init_version"),
        col("st_rev_version").alias("study_revised_version"), col("st_final_version").alias("study_final_version"),
        col("series_instance_uid").alias("SeriesInstanceUID"), col("se_uuid").alias("series_uuid"),
        object_url("gs", bucket, "se_uuid").alias("series_gcs_url"),
        object_url("s3", "pub_aws_bucket", "se_uuid").alias("series_aws_url"),
        F.when(col("collection_id").isin(*without_doi), "").otherwise(col("source_doi")).alias("Source_DOI"),
        col("source_url").alias("Source_URL"), "versioned_source_doi", "series_instances",
        col("se_hashes.all").alias("series_hash"), col("se_init_version").alias("series_init_version"),
        col("se_rev_version").alias("series_revised_version"), col("se_final_version").alias("series_final_version"),
        col("sop_instance_uid").alias("SOPInstanceUID"), col("i_uuid").alias("instance_uuid"),
        object_url("gs", bucket, "se_uuid", "i_uuid").alias("gcs_url"), bucket.alias("gcs_bucket"),
        object_url("s3", "pub_aws_bucket", "se_uuid", "i_uuid").alias("aws_url"), col("pub_aws_bucket").alias("aws_bucket"),
        col("i_size").alias("instance_size"), col("i_hash").alias("instance_hash"),
        col("i_init_version").alias("instance_init_version"), col("i_rev_version").alias("instance_revised_version"),
        col("i_final_version").alias("instance_final_version"), "license_url", "license_long_name", "license_short_name",
        "submitter_case_id", F.lit("Public").alias("Access"), *(["_image"] if images is not None else []))


def mutable_metadata(df: DataFrame, licenses: DataFrame) -> DataFrame:
    """Attributes that may change between versions, over all versions of the public data."""
    lic = licenses.select("source_doi", "license_long_name", "license_short_name", "license_url")
    # Distinct before the lookup, on the parts of the urls: a licence adds no rows per DOI, and the shuffled rows stay narrow.
    # A bucket counts only where it makes a url.
    named = F.col("se_uuid").isNotNull() & F.col("i_uuid").isNotNull()
    # Narrow rows are spread by their series already, so that they are made distinct where they are.
    ids = [c if t == "binary" else pack_id(c).alias(c) for c, t in df.select("st_uuid", "se_uuid", "i_uuid").dtypes]
    few = df.select(
        *ids, F.when(named, F.col("pub_gcs_bucket")).alias("_gcs"),
        F.when(named, F.col("pub_aws_bucket")).alias("_aws"), "access", "source_url", "source_doi", "versioned_source_doi").distinct()
    rows = few.withColumns({c: unpack_id(c) for c in ("st_uuid", "se_uuid", "i_uuid")}).select(
        F.col("st_uuid").alias("crdc_study_uuid"), F.col("se_uuid").alias("crdc_series_uuid"), F.col("i_uuid").alias("crdc_instance_uuid"),
        object_url("gs", "_gcs", "se_uuid", "i_uuid").alias("gcs_url"), object_url("s3", "_aws", "se_uuid", "i_uuid").alias("aws_url"),
        "access", "source_url", "source_doi", "versioned_source_doi")
    return rows.join(lic.distinct(), "source_doi")


def dicom_all(aux: DataFrame, ocm: DataFrame, arm: DataFrame, dm: DataFrame) -> DataFrame:
    """Published table + collection attributes + image metadata, one wide row per instance. Where the published rows were made with their ``images``,
    they have met ``dm`` while they were narrow."""
    ar = arm.select(F.lower("source_doi").alias("_ld"), "analysis_result_id").distinct()
    withar = aux.join(ar, F.lower("Source_DOI") == F.col("_ld"), "left").drop("_ld")
    meta = ocm.select(
        F.col("collection_id"), F.col("TumorLocations").alias("collection_tumorLocation"),
        F.col("Species").alias("collection_species"), F.col("CancerTypes").alias("collection_cancerType"))
    pre = withar.join(meta, "collection_id").drop(
        "PatientID", "StudyInstanceUID", "SeriesInstanceUID", "submitter_case_id", "study_instances", "series_instances",
        "study_final_version", "series_final_version", "instance_final_version").withColumnsRenamed({
            "study_uuid": "crdc_study_uuid", "series_uuid": "crdc_series_uuid", "instance_uuid": "crdc_instance_uuid"})
    if "_image" in pre.columns:
        return pre.select("SOPInstanceUID", *[c for c in pre.columns if c not in ("SOPInstanceUID", "_image")], *[F.col(f"_image.{c}") for c in dm.columns if c != "SOPInstanceUID"])
    return pre.join(dm, "SOPInstanceUID")
