"""Catalogue inputs derived from the driver's tables.

region, nation, customer, orders and lineitem play collection, patient, study, series and instance.
Two releases exist; which objects are in which release follows from the keys alone, so level and
edge tables are plain projections of the base tables: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vcat.functions.exprs import uuid_sql
from vcat.sources.publish import store

LAST = 2  # newest release
TIMESTAMPS = {1: "2021-02-03 04:05:06", 2: "2022-03-04 05:06:07"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ts_sql(rev: str = "rev_version") -> str:
    return f"CAST(CASE WHEN {rev} = 1 THEN '{TIMESTAMPS[1]}' ELSE '{TIMESTAMPS[2]}' END AS TIMESTAMP_NTZ)"


def ts(rev: str = "rev_version"):
    return F.expr(ts_sql(rev))


# The fixtures are SQL expression text: one call per column instead of one per operator.
_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_ITEMS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus",
    f"concat_ws('.', l_orderkey, l_linenumber, l_partkey, l_suppkey, {_CENTS}) AS sop", f"{_CENTS} AS size",
    "l_orderkey % 10 <> 7 AND NOT (l_orderkey % 10 = 1 AND l_linenumber = 1) AS p1", "l_orderkey % 10 <> 3 AS p2",
    "l_orderkey % 10 = 5 AS chg", "l_quantity = 50 AS excluded", "CASE WHEN l_orderkey % 2 = 0 THEN 'src_a' ELSE 'src_b' END AS source",
    "(l_linenumber = 2 AND l_orderkey % 20 IN (0, 5)) OR l_orderkey % 100 = 40 AS red",
)


def items(spark, sf) -> DataFrame:
    """The instances with their attributes: a projection of the base table, like the levels."""
    return table(spark, sf, "lineitem").selectExpr(*_ITEMS)


def content_sql(rev: str) -> str:
    return f"md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, size, CASE WHEN chg AND {rev} = 2 THEN 'r' END))"


def content_hash(rev) -> F.Column:
    """Content hash at a release: a column name or a literal."""
    if isinstance(rev, str):
        return F.expr(content_sql(rev))
    return F.md5(F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "size",
        F.when(F.col("chg") & (rev == 2), "r")))


def _spans(df: DataFrame, p1: str, p2: str, chg: str) -> DataFrame:
    """One row per version of an object, from its presence in both releases and whether it changed."""
    rows = ((f"{p1} AND {p2} AND {chg}", 1, 1, 1), (f"{p1} AND {p2} AND {chg}", 1, 2, 0), (f"{p1} AND {p2} AND NOT {chg}", 1, 1, 0),
            (f"{p1} AND NOT {p2}", 1, 1, 1), (f"NOT {p1} AND {p2}", 2, 2, 0))
    spans = ", ".join(f"CASE WHEN {w} THEN named_struct('init_version', {a}, 'rev_version', {b}, 'final_version', {c}) END" for w, a, b, c in rows)
    return df.selectExpr("*", f"inline(filter(array({spans}), s -> s IS NOT NULL))")


def instance_versions(spark, sf) -> DataFrame:
    return _spans(items(spark, sf), "p1", "p2", "chg")


def series_versions(spark, sf) -> DataFrame:
    return _spans(table(spark, sf, "orders"), "(o_orderkey % 10 <> 7)", "(o_orderkey % 10 <> 3)", "(o_orderkey % 10 IN (1, 5))")


def upper_versions(spark, sf, name) -> DataFrame:
    return _spans(table(spark, sf, name), "true", "true", "true")


def _hash3(h: str) -> str:
    return f"named_struct('src_a', {h}, 'src_b', md5({h}), 'all', md5(md5({h}))) AS hashes"


_BOTH = "named_struct('src_a', true, 'src_b', true) AS sources"


def _level(df, level, key, *cols, sources=_BOTH):
    return df.selectExpr(
        *cols, f"{uuid_sql(level, key, 'rev_version')} AS uuid", f"{ts_sql()} AS min_timestamp", f"{ts_sql()} AS max_timestamp",
        _hash3(f"md5(concat_ws('|', '{level}', {key}, rev_version))"), sources, "init_version", "rev_version", "final_version",
        "false AS redacted")


_DOI = "concat('10.5281/d.', o_orderkey % 40)"


def doi():
    return F.expr(_DOI)


_STORED: dict[tuple, DataFrame] = {}


def stored(spark, sf, name: str, make: Callable[[], DataFrame], key: str | None = None, by: str | None = None) -> DataFrame:
    """A small result that several queries share: written at first use, read by every query of the application after that."""
    at = (spark.sparkContext.applicationId, str(sf), name)
    if at not in _STORED:
        _STORED[at] = store(make(), key, by)
    return _STORED[at]


def levels(spark, sf) -> dict[str, DataFrame]:
    return {
        "version": versions_table(spark),
        "collection": _level(upper_versions(spark, sf, "region"), "collection", "r_regionkey", "r_name AS collection_id",
                             f"{uuid_sql('collection_uid', 'r_regionkey', '0')} AS collection_uid"),
        "patient": _level(upper_versions(spark, sf, "nation"), "patient", "n_nationkey", "n_name AS submitter_case_id",
                          f"{uuid_sql('case', 'n_nationkey', '0')} AS case_id"),
        "study": _level(upper_versions(spark, sf, "customer"), "study", "c_custkey", "concat('st.', c_custkey) AS study_instance_uid",
                        "c_custkey % 11 AS study_instances"),
        "series": _level(series_versions(spark, sf), "series", "o_orderkey", "concat('se.', o_orderkey) AS series_instance_uid",
                         "o_orderkey % 7 AS series_instances", f"{_DOI} AS source_doi", f"concat('https://doi.org/', {_DOI}) AS source_url",
                         f"concat({_DOI}, '.v', rev_version) AS versioned_source_doi", "false AS excluded",
                         sources="named_struct('src_a', o_orderkey % 2 = 0, 'src_b', o_orderkey % 2 = 1) AS sources"),
        "instance": instance_versions(spark, sf).selectExpr(
            "sop AS sop_instance_uid", f"{uuid_sql('instance', 'sop', 'rev_version')} AS uuid", f"{ts_sql()} AS timestamp",
            f"{content_sql('rev_version')} AS hash", "source", "size", "excluded", "init_version", "rev_version", "final_version",
            "false AS redacted", "CAST(NULL AS STRING) AS mitigation", "concat('gs://in/', l_orderkey, '/', sop, '.dcm') AS ingestion_url"),
    }


def versions_table(spark) -> DataFrame:
    return spark.range(1, LAST + 1).selectExpr("CAST(id AS INT) AS version", "CAST(id - 1 AS INT) AS previous_version").selectExpr(
        "*", f"{ts_sql('version')} AS min_timestamp", f"{ts_sql('version')} AS max_timestamp", _hash3("md5(concat('version|', version))"), _BOTH)


def _alive(v: int) -> str:
    return f"(rev_version <= {v} AND ({v} <= final_version OR final_version = 0))"


def _edge(df, parent, pkey, child, ckey, parent_rev) -> DataFrame:
    """Parent/child pairs. ``parent_rev(v)`` is the revision of the parent that is alive at release v."""
    # A parent revision that covers several releases lists an unchanged child at its first one only.
    at = []
    for v in range(1, LAST + 1):
        again = f"({_alive(v - 1)} AND {parent_rev(v - 1)} <=> {parent_rev(v)})" if v > 1 else "false"
        at.append(f"CASE WHEN {_alive(v)} AND NOT {again} THEN {v} END")
    pairs = df.selectExpr("*", f"explode(filter(array({', '.join(at)}), x -> x IS NOT NULL)) AS _v")
    return pairs.selectExpr(f"{uuid_sql(parent, pkey, parent_rev('_v'))} AS {parent}_uuid", f"{uuid_sql(child, ckey, 'rev_version')} AS {child}_uuid")


def _series_rev(key):
    return lambda v: f"(CASE WHEN {key} % 10 IN (1, 5) THEN {v} WHEN {key} % 10 = 7 THEN 2 ELSE 1 END)"


def edges(spark, sf) -> dict[str, DataFrame]:
    each = lambda v: f"{v}"  # noqa: E731  collections, patients and studies are revised in every release
    return {
        "version_collection": upper_versions(spark, sf, "region").selectExpr(
            "rev_version AS version", f"{uuid_sql('collection', 'r_regionkey', 'rev_version')} AS collection_uuid"),
        "collection_patient": _edge(upper_versions(spark, sf, "nation"), "collection", "n_regionkey",
                                    "patient", "n_nationkey", each),
        "patient_study": _edge(upper_versions(spark, sf, "customer"), "patient", "c_nationkey",
                               "study", "c_custkey", each),
        "study_series": _edge(series_versions(spark, sf), "study", "o_custkey", "series", "o_orderkey", each),
        "series_instance": _edge(instance_versions(spark, sf), "series", "l_orderkey", "instance", "sop",
                                 _series_rev("l_orderkey")),
    }


def redactions(spark, sf) -> DataFrame:
    """Withdrawn instances at every version that holds them, with the uuids and lifespans of all levels."""
    at = ", ".join(f"CASE WHEN {_alive(v)} THEN {v} END" for v in range(1, LAST + 1))
    i = instance_versions(spark, sf).filter("red").selectExpr("*", f"explode(filter(array({at}), x -> x IS NOT NULL)) AS _v")
    rev = _series_rev("l_orderkey")("_v")
    up = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(
        table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("o_orderkey", "o_custkey", "c_nationkey", "n_regionkey")
    above = [x for p, level, key in (("st", "study", "o_custkey"), ("p", "patient", "c_nationkey"), ("c", "collection", "n_regionkey"))
             for x in (f"{uuid_sql(level, key, '_v')} AS {p}_uuid", f"_v AS {p}_rev_version", f"CASE WHEN _v < {LAST} THEN _v ELSE 0 END AS {p}_final_version")]
    return i.join(up, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        f"{uuid_sql('instance', 'sop', 'rev_version')} AS i_uuid", "rev_version AS i_rev_version", "final_version AS i_final_version",
        f"{uuid_sql('series', 'l_orderkey', rev)} AS se_uuid", f"{rev} AS se_rev_version",
        f"CASE WHEN l_orderkey % 10 = 3 THEN 1 WHEN l_orderkey % 10 IN (1, 5) AND {rev} = 1 THEN 1 ELSE 0 END AS se_final_version",
        *above, "_v AS version")


# --- lookups (40 DOIs) ----------------------------------------------------------------------------


def _dois(spark) -> DataFrame:
    return spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("10.5281/d."), "id").alias("source_doi"))


def access_lookup(spark) -> DataFrame:
    k = F.col("k")
    return _dois(spark).filter((k % 4 != 3)).select(
        "source_doi", F.when(k % 4 == 0, "Open").when(k % 4 == 1, "Cr").otherwise("Defaced").alias("type"),
        F.when(k == 0, "Limited").when(k == 1, "Excluded").alias("access"))


def sunset_lookup(spark) -> DataFrame:
    return _dois(spark).filter("k = 2").select("source_doi", F.lit("1").alias("metadata_sunset"))


def analysis_lookup(spark) -> DataFrame:
    return _dois(spark).filter("k % 10 = 8").select(
        "source_doi", F.concat(F.lit("res_"), "k").alias("analysis_result_id"))


def license_lookup(spark) -> DataFrame:
    return _dois(spark).filter("k <> 9").select(
        "source_doi", F.concat(F.lit("https://lic/"), F.col("k") % 3).alias("license_url"),
        F.concat(F.lit("License "), F.col("k") % 3).alias("license_long_name"),
        F.concat(F.lit("L"), F.col("k") % 3).alias("license_short_name"))


def source_stack(spark, sf) -> dict[str, DataFrame]:
    """Current state of the in-house data: one row per object, natural and foreign keys, one hash."""
    hash_of = lambda lv, key: F.md5(F.concat_ws("|", F.lit(lv), key)).alias("hash")
    no = F.lit(False)
    return {
        "collection": table(spark, sf, "region").select(
            F.col("r_name").alias("collection_id"), hash_of("c", "r_regionkey"), no.alias("redacted"),
            F.col("r_regionkey").alias("_k")),
        "patient": table(spark, sf, "nation").select(
            F.col("n_name").alias("submitter_case_id"),
            F.col("n_regionkey").alias("_p"), hash_of("p", "n_nationkey"), no.alias("redacted"),
            F.col("n_nationkey").alias("_k")),
        "study": table(spark, sf, "customer").select(
            F.concat(F.lit("st."), "c_custkey").alias("study_instance_uid"),
            F.concat(F.lit("NATION_"), "c_nationkey").alias("submitter_case_id"),
            hash_of("st", "c_custkey"), no.alias("redacted")),
        "series": table(spark, sf, "orders").select(
            F.concat(F.lit("se."), "o_orderkey").alias("series_instance_uid"),
            F.concat(F.lit("st."), "o_custkey").alias("study_instance_uid"),
            hash_of("se", "o_orderkey"), no.alias("excluded"), doi().alias("source_doi"),
            F.concat(F.lit("https://doi.org/"), doi()).alias("source_url"),
            (F.col("o_orderkey") % 10 == 8).alias("analysis_result"), no.alias("redacted"),
            F.concat(doi(), F.lit(".v1")).alias("versioned_source_doi")),
        "instance": items(spark, sf).select(
            F.col("sop").alias("sop_instance_uid"),
            F.concat(F.lit("se."), "l_orderkey").alias("series_instance_uid"),
            content_hash('1').alias("hash"),
            F.concat(F.lit("gs://in/"), "l_orderkey", F.lit("/"), "sop", F.lit(".dcm")).alias("ingestion_url"),
            "size", "excluded", F.lit(1).alias("version"), no.alias("redacted"),
            F.lit(None).cast("string").alias("mitigation")),
    }
