"""Collection and analysis-result metadata, licences, tags, and the matching of source files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.functions.exprs import _c, join_list, web_id

# --- counts and lists per group -------------------------------------------------------------------


def cases_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of patients per collection or DOI."""
    return df.groupBy(*keys).agg(F.count_distinct("submitter_case_id").alias("cases"))


def list_of(df: DataFrame, keys: list[str], col: str, out: str, sep: str = ", ") -> DataFrame:
    """Sorted list of the distinct values of a group as text. Rows are made distinct before they are
    grouped, so a group's task sees its few values and not its rows."""
    few = df.select(*keys, col).filter(F.col(col).isNotNull()).distinct()
    return few.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(col)), sep).alias(out))


def modalities_per(df: DataFrame, dm: DataFrame, keys: list[str]) -> DataFrame:
    """Modalities per group, from the image metadata."""
    m = dm.select(F.col("SOPInstanceUID").alias("sop_instance_uid"), "Modality")
    return list_of(df.select(*keys, "sop_instance_uid").join(m, "sop_instance_uid"), keys, "Modality", "modalities")


# --- catalogue records ----------------------------------------------------------------------------


def _source_doi(s: Column) -> Column:
    return F.coalesce(s["concept_doi"], s["source_doi"])


def catalog_records_to_tables(records: DataFrame, analysis: DataFrame) -> dict[str, DataFrame]:
    """Licence, programme and collection tables from the nested catalogue records."""
    s = F.col("s")
    src = records.select("collection_name", F.explode("sources").alias("s"))
    original = src.select(
        _source_doi(s).alias("source_doi"), F.col("collection_name").alias("source_name"), F.lit("original_data").alias("source_type"),
        s["license"]["url"].alias("license_url"), s["license"]["long_name"].alias("license_long_name"),
        s["license"]["short_name"].alias("license_short_name"))
    results = analysis.select(
        "source_doi", F.col("analysis_result_id").alias("source_name"), F.lit("analysis_result").alias("source_type"),
        F.col("license.url").alias("license_url"), F.col("license.long_name").alias("license_long_name"),
        F.col("license.short_name").alias("license_short_name"))
    return {
        "licenses": original.unionByName(results),
        "programs": records.select("collection_id", F.col("program").alias("program_id")).distinct(),
        "collections": records.select(
            "collection_name", "collection_id", join_list("cancer_types").alias("cancer_types"),
            join_list("tumor_locations").alias("tumor_locations"), "species",
            F.coalesce(join_list("supporting_data"), F.lit("")).alias("supporting_data"), F.col("program").alias("program_id"), "status", "updated"),
    }


_FIELDS = ("source_id", "source_title", "source_type", "source_doi", "source_url", "license", "citation")


def _license(c) -> Column:
    c = _c(c)
    return F.struct(c["url"].alias("license_url"), c["long_name"].alias("license_long_name"), c["short_name"].alias("license_short_name"))


def collection_metadata(records: DataFrame, analysis: DataFrame, current: DataFrame, dm: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Nested metadata per collection: its own sources, then the analysis results that use it, each
    with its modalities; case count and description.

    current: rows of the current public version; descriptions: collection_id, description."""
    s = F.col("_s")
    own = records.select("collection_name", "collection_id", F.posexplode("sources").alias("_pos", "_s")).select(
        "collection_name", F.lit(0).alias("_kind"), "_pos", F.col("collection_id").alias("source_id"), s["title"].alias("source_title"),
        F.lit("original_data").alias("source_type"), _source_doi(s).alias("source_doi"),
        F.coalesce(F.concat(F.lit("https://doi.org/"), s["concept_doi"]), s["source_url"]).alias("source_url"),
        _license(s["license"]).alias("license"), s["citation"].alias("citation"))
    used = current.select(F.col("collection_id").alias("collection_name"), "source_doi").distinct()
    extra = used.join(analysis, "source_doi").select(
        "collection_name", F.lit(1).alias("_kind"), F.lit(0).alias("_pos"), web_id("analysis_result_id").alias("source_id"),
        F.col("title").alias("source_title"), F.lit("analysis_result").alias("source_type"), "source_doi", "source_url",
        _license("license").alias("license"), "citation")
    mods = modalities_per(current.withColumnRenamed("collection_id", "collection_name"), dm, ["collection_name", "source_url"]).withColumnRenamed("source_url", "_u")
    rows = own.unionByName(extra)
    rows = rows.join(mods, (rows["collection_name"] == mods["collection_name"]) & (F.lower("source_url") == F.col("_u")), "left").select(
        rows["collection_name"], "_kind", "_pos", *_FIELDS, F.coalesce("modalities", F.lit("")).alias("modalities"))
    body = F.struct(*_FIELDS, "modalities", F.lit("Public").alias("Access"), F.col("modalities").alias("ImageTypes"))
    # A collection has as many sources as it has DOIs: a short list.
    nested = rows.groupBy("collection_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_kind", "_pos", F.col("source_doi").alias("_d"), body.alias("_b")))), lambda x: x["_b"]).alias("sources"))
    counts = cases_per(current.withColumnRenamed("collection_id", "collection_name"), ["collection_name"]).withColumnRenamed("cases", "subjects")
    base = catalog_records_to_tables(records, analysis)["collections"]
    d = descriptions.select(F.col("collection_id").alias("_wid"), "description")
    out = (base.join(nested, "collection_name", "left").join(counts, "collection_name", "left")
           .join(d, web_id("collection_name") == F.col("_wid"), "left").drop("_wid"))
    return out.select("*", F.col("supporting_data").alias("SupportingData"), F.col("program_id").alias("Program")).withColumns({
        "subjects": F.coalesce("subjects", F.lit(0).cast("bigint")), "description": F.coalesce("description", F.lit(""))})


def analysis_metadata(analysis: DataFrame, current: DataFrame, dm: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Metadata per analysis result. DOIs match without regard to case."""
    low = current.withColumn("_doi", F.lower("source_doi"))
    mods = modalities_per(low, dm, ["_doi"])
    counts = cases_per(low, ["_doi"])
    d = descriptions.select(F.col("id").alias("analysis_result_id"), "description")
    base = analysis.select(
        "analysis_result_name", "analysis_result_id", F.col("title").alias("analysis_result_title"), "source_doi", "source_url",
        join_list("cancer_types").alias("cancer_types"), join_list("tumor_locations").alias("tumor_locations"),
        join_list("collections").alias("collections"), "updated", F.col("license.url").alias("license_url"),
        F.col("license.long_name").alias("license_long_name"), F.col("license.short_name").alias("license_short_name"), "citation",
        F.lower("source_doi").alias("_doi"))
    return base.join(mods, "_doi", "left").join(counts, "_doi", "left").join(d, "analysis_result_id", "left").select(
        *[c for c in base.columns if c != "_doi"], F.coalesce("cases", F.lit(0).cast("bigint")).alias("subjects"),
        F.coalesce("modalities", F.lit("")).alias("modalities"), F.coalesce("description", F.lit("")).alias("description"),
        F.col("analysis_result_id").alias("ID"), F.col("analysis_result_title").alias("Title"), F.lit("Public").alias("Access"))


# --- versions -------------------------------------------------------------------------------------


def version_metadata(versions: DataFrame) -> DataFrame:
    """Hash and release date per version."""
    return versions.select("version", F.col("hashes.all").alias("version_hash"), F.to_date("max_timestamp").alias("version_timestamp"))


def latest_for_modality(aux: DataFrame, dm: DataFrame, modality: str, versions: DataFrame) -> DataFrame:
    """Newest version per collection that revised an instance of the modality, with its timestamp."""
    m = dm.filter(F.col("Modality") == modality).select("SOPInstanceUID")
    newest = aux.join(m, "SOPInstanceUID", "left_semi").groupBy("collection_name", "collection_id").agg(
        F.max("instance_revised_version").alias("version"))
    return newest.join(versions.select("version", "max_timestamp"), "version")


def last_update(collections: DataFrame, versions: DataFrame) -> DataFrame:
    """Release time of the last revision of every live collection."""
    return collections.filter("final_version = 0").select("collection_id", F.col("rev_version").alias("version")).join(
        versions.select("version", F.col("max_timestamp").alias("updated")), "version").select("collection_id", "updated")


def latest_release(history) -> Column:
    """Newest release of a history array, by its ``data_release`` compared number by number
    ("37.0" is newer than "9.0")."""
    keyed = F.transform(_c(history), lambda h: F.named_struct(
        F.lit("k"), F.transform(F.split(h["data_release"], r"\."), lambda x: x.cast("int")), F.lit("r"), h["data_release"]))
    return F.array_max(keyed)["r"]


# --- tags -----------------------------------------------------------------------------------------


def tag_rollup(ocm: DataFrame, results: DataFrame) -> DataFrame:
    """Tags of the collections an analysis result draws on, found by DOI: distinct trimmed lists and
    counts. Every list is exploded on its own; exploding them together would multiply them.

    ocm: collection_id, CancerTypes, TumorLocations (comma lists), sources (source_doi, ImageTypes);
    results: analysis_result_name, source_doi."""
    rows = ocm.filter("CancerTypes IS NOT NULL AND TumorLocations IS NOT NULL").select(
        "collection_id", "CancerTypes", "TumorLocations", F.inline("sources"))
    j = rows.filter("ImageTypes IS NOT NULL").join(results.select("analysis_result_name", "source_doi"), "source_doi")
    slot = lambda n, c: F.transform(F.split(c, ","), lambda x: F.named_struct(F.lit("kind"), F.lit(n), F.lit("tag"), F.trim(x)))
    tags = F.concat(slot("c", F.col("CancerTypes")), slot("l", F.col("TumorLocations")), slot("m", F.col("ImageTypes")), slot("o", F.col("collection_id")))
    few = j.select("analysis_result_name", "source_doi", F.inline(tags)).distinct()
    pick = lambda k: F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("tag")))), ", ")
    return few.groupBy("analysis_result_name", "source_doi").agg(
        pick("c").alias("cancer_types"), pick("l").alias("tumor_locations"), pick("m").alias("modalities"), pick("o").alias("collections"),
        F.count_if(F.col("kind") == "o").alias("n_collections")).withColumn("analysis_result_id", web_id("analysis_result_name"))


# --- descriptions and public licences -------------------------------------------------------------


def fill_descriptions(descriptions: DataFrame, sources: DataFrame, slides: DataFrame, titles: DataFrame) -> DataFrame:
    """Descriptions of the public, unexpired collections, with a pointer to the pathology page where
    the collection has slides.

    descriptions: collection_id, description; sources: collection_name, access, metadata_sunset;
    slides: collection_id, source_url; titles: collection_name, title."""
    live = sources.filter("access = 'Public' AND metadata_sunset = 0").select(F.col("collection_name").alias("collection_id")).distinct()
    p = slides.select("collection_id", "source_url").distinct()
    t = titles.select(F.col("collection_name").alias("_n"), "title")
    j = descriptions.join(live, "collection_id", "left_semi").join(p, "collection_id", "left").join(
        t, (F.col("collection_id") == F.col("_n")) & F.col("source_url").isNotNull(), "left")
    more = F.concat(
        "description", F.lit('<p>Please see the <a href="'), "source_url", F.lit('" target="_blank">'), "collection_id", F.lit(": "), "title",
        F.lit("</a>) wiki page to learn more about the histopathology images and to obtain any supporting metadata for this collection.</p>"))
    return j.select(web_id("collection_id").alias("collection_id"),
                    F.when(F.col("source_url").isNotNull(), more).otherwise(F.col("description")).alias("description")).distinct()


def licensed_public(flat: DataFrame, access: DataFrame, sunset: DataFrame, version: int, source: str) -> DataFrame:
    """Collections of one source whose data is public and not past its sunset. The rows shrink to one
    per collection and DOI before the lookups."""
    few = flat.filter(F.col("i_source") == source).select("collection_id", "source_doi").distinct()
    s = sunset.select("source_doi", F.col("metadata_sunset").cast("bigint").alias("_s"))
    a = access.select("source_doi", F.col("access").alias("_a"))
    j = few.join(a, "source_doi", "left").join(s, "source_doi", "left")
    return j.filter("(_a IS NULL OR _a = 'Public')").filter(F.col("_s").isNull() | (F.col("_s") >= version)).select(
        F.col("collection_id").alias("collection_name")).distinct()


# --- downloads and files --------------------------------------------------------------------------


def _as_list(df: DataFrame, c: str) -> Column:
    return F.col(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.array(c)


def filter_downloads(df: DataFrame, kinds: list[str], file_types: list[str] | None = None, no_requirements: bool = False,
                     not_only: str | None = None) -> DataFrame:
    """Downloads of the given kinds (``download_type`` is text or a list). Optionally of given file
    types, without requirements, or with more than a single file type."""
    low = F.transform(_as_list(df, "download_type"), lambda x: F.lower(x))
    out = df.filter(F.arrays_overlap(low, F.array(*[F.lit(k.lower()) for k in kinds])))
    if no_requirements:
        out = out.filter(F.coalesce("download_requirements", F.lit("")) == "")
    if file_types:
        if isinstance(df.schema["file_type"].dataType, T.ArrayType):
            out = out.filter(F.arrays_overlap("file_type", F.array(*[F.lit(t) for t in file_types])))
        else:
            out = out.filter(F.col("file_type").rlike("|".join(file_types)))
    if not_only:
        out = out.filter(~_as_list(df, "file_type").eqNullSafe(F.array(F.lit(not_only))))
    return out


# What counts as a likely clinical download.
CLINICAL_KINDS = ["other", "clinical data", "image annotations"]
TABULAR = ["XLSX", "XLS", "CSV"]


def likely_clinical(df: DataFrame) -> DataFrame:
    return filter_downloads(df, CLINICAL_KINDS, TABULAR, no_requirements=True)


def parent_of(downloads: DataFrame, collections: DataFrame) -> DataFrame:
    """The collection that lists each download, '' if none does. Of several the lowest id is taken."""
    owner = collections.select(F.explode("collection_downloads").alias("id"), F.struct(
        F.col("id").alias("parent_id"), F.col("slug").alias("parent_slug")).alias("_p")).groupBy("id").agg(F.min("_p").alias("_p"))
    return downloads.join(owner, "id", "left").select(
        *downloads.columns, F.coalesce(F.col("_p.parent_id").cast("string"), F.lit("")).alias("parent_id"),
        F.coalesce("_p.parent_slug", F.lit("")).alias("parent_slug"))


def source_status(hash_map: DataFrame, flat: DataFrame) -> DataFrame:
    """Every source file with the instance made from it, found by file hash; blanks where there is none."""
    j = hash_map.join(flat.withColumnRenamed("source_file_hash", "hash"), "hash", "left")
    return j.withColumnRenamed("hash", "md5_hash").na.fill("")


def _plain(c) -> Column:
    return F.translate(_c(c), "/-", "__")


def match_by_suffix(files: DataFrame, urls: DataFrame, file_col: str = "file", url_col: str = "url") -> DataFrame:
    """Files whose name ends with the name of a url, separators (``/ - _``) being equal.

    A suffix test is no equi-join, and matching on the base name first would pair all files of a
    common name. Each file therefore lists its own suffixes (one per separator), and those join the
    urls exactly: the output holds true matches only. Only suffixes of as many parts as some url has are
    listed (a few small numbers), so that short ones that all files share are not shuffled."""
    parts = F.split(_plain(file_col), "_")
    n = F.size(parts)
    depths = [r[0] for r in urls.select(F.size(F.split(_plain(url_col), "_"))).distinct().collect()]
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (n - i + 1).isin(depths))
    suffixes = F.transform(starts, lambda i: F.array_join(F.slice(parts, i, n), "_"))
    f = files.select(file_col, F.explode(suffixes).alias("_k"))
    return f.join(urls.select(F.col(url_col), _plain(url_col).alias("_k")), "_k").drop("_k")


def path_hashes(files: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Package files with the hash found in the source listing by normalised path, and those without.
    files: path; listing: path, hash."""
    key = lambda c: F.regexp_replace(F.translate(F.col(c), "-", "_"), r"^\.?/", "")
    f, s = files.withColumn("_k", key("path")), listing.select(key("path").alias("_k"), "hash")
    return f.join(s, "_k").drop("_k"), f.join(s, "_k", "left_anti").drop("_k")


def unlisted(files: DataFrame, names: DataFrame, col: str = "name") -> DataFrame:
    """Input files that the configuration never mentions."""
    return files.join(names.select(col).distinct(), col, "left_anti")


def exclude(df: DataFrame, **lists) -> DataFrame:
    """Drop rows by lists of ids, one per column: short Python lists or DataFrames with that column."""
    for col, ids in lists.items():
        if isinstance(ids, DataFrame):
            df = df.join(ids.select(col).distinct(), col, "left_anti")
        elif ids:
            df = df.filter(~F.coalesce(F.col(col).isin(list(ids)), F.lit(False)))
    return df

