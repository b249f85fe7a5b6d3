"""Checks and comparisons. Each returns the offending rows (or the differences) as a DataFrame; an
empty result is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.functions.exprs import pack_id
from vcat.functions.merkle import merkle_rollup
from vcat.operators.lifecycle import duplicates, same_hash

__all__ = [
    "unique_ids", "multi_parent", "duplicates", "expected_listing", "diff_listing", "hierarchy_mismatch",
    "unmatched", "fingerprint", "compare_datasets", "diff_tables", "diff_rows", "compare_hash_trees",
    "self_check", "hash_mismatch", "missing_count", "check_metadata_tables", "outer_status",
]


def _or(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)


# --- ids ------------------------------------------------------------------------------------------


def unique_ids(*levels: DataFrame, col: str = "uuid") -> DataFrame:
    """Number of ids over all levels, and of distinct ones. Counted per id first, so that copies of one
    id meet after a map-side reduction."""
    ids = reduce(DataFrame.unionByName, [d.select(col) for d in levels])
    if ids.schema[col].dataType == T.StringType():
        ids = ids.select(pack_id(col).alias(col))
    return ids.groupBy(col).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_ids"), F.count("*").alias("n_distinct"))


def multi_parent(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Children found under more than one parent, with those parents."""
    pairs = df.select(child, parent).distinct()
    bad = pairs.groupBy(child).agg(F.count("*").alias("n_parents")).filter("n_parents > 1")
    return pairs.join(bad, child)


# --- listings -------------------------------------------------------------------------------------


def expected_listing(df: DataFrame, max_version: int, grain: str = "instance", bucket: str = "pub_gcs_bucket",
                     public: bool = True) -> DataFrame:
    """Object names that should be in each bucket, from the joined catalogue."""
    rows = df.filter((F.col("se_rev_version") <= max_version) & ~F.col("i_redacted") & F.col(bucket).isNotNull())
    if public:
        rows = rows.filter(~F.col("i_excluded"))
    name = F.col("se_uuid") if grain == "series" else F.concat("se_uuid", F.lit("/"), "i_uuid", F.lit(".dcm"))
    return rows.select(F.col(bucket).alias("bucket"), name.alias("name")).distinct()


def diff_listing(expected: DataFrame, found: DataFrame, key: list[str] | None = None) -> DataFrame:
    """``unexpected`` and ``unfound`` names. One full outer join of both lists."""
    key = key or expected.columns
    e = expected.select(*key).distinct().withColumn("_e", F.lit(True))
    f = found.select(*key).distinct().withColumn("_f", F.lit(True))
    j = e.join(f, key, "full_outer").filter(F.col("_e").isNull() | F.col("_f").isNull())
    return j.select(*key, F.when(F.col("_e").isNull(), "unexpected").otherwise("unfound").alias("problem"))


def unmatched(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys on one side only."""
    x = a.select(*key).withColumn("_a", F.lit(True))
    y = b.select(*key).withColumn("_b", F.lit(True))
    j = x.join(y, key, "full_outer").filter(F.col("_a").isNull() | F.col("_b").isNull())
    return j.select(*key, F.when(F.col("_a").isNull(), "right").otherwise("left").alias("side"))


def outer_status(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """added / dropped / both for every key."""
    x, y = a.withColumn("_a", F.lit(True)), b.withColumn("_b", F.lit(True))
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "dropped").otherwise("both")
    return x.select(*key, "_a").join(y.select(*key, "_b"), key, "full_outer").select(*key, status.alias("status"))


def hierarchy_mismatch(catalogue: DataFrame, metadata: DataFrame, key: str, parents: list[str]) -> DataFrame:
    """Instances whose patient, study or series differs between catalogue and image metadata."""
    m = metadata.select(key, *[F.col(p).alias(f"dm_{p}") for p in parents])
    return catalogue.select(key, *parents).join(m, key).filter(_or([F.col(p) != F.col(f"dm_{p}") for p in parents]))


# --- fingerprints ---------------------------------------------------------------------------------


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint of a table and its number of rows. As copies of a row would cancel
    out in the xor, each distinct row enters once; rows are reduced to a hash before they are shuffled."""
    doc = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    rows = df.select(F.xxhash64(doc).alias("_h"), F.md5(doc).alias("_m"))
    once = rows.groupBy("_h", "_m").agg(F.count("*").alias("_n"))
    return once.agg(F.bit_xor("_h").alias("fingerprint"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"))


def compare_datasets(spark: SparkSession, a: str, b: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """Fingerprints of two databases, table by table; NULL where a table is missing."""
    def prints(db):
        names = [t.name for t in spark.catalog.listTables(db) if t.name not in skip and t.tableType != "TEMPORARY"]
        parts = [fingerprint(spark.table(f"{db}.{n}")).withColumn("table_name", F.lit(n)) for n in names]
        return reduce(DataFrame.unionByName, parts)

    x = prints(a).selectExpr("table_name", "fingerprint AS a_fp", "n_rows AS a_rows")
    y = prints(b).selectExpr("table_name", "fingerprint AS b_fp", "n_rows AS b_rows")
    same = F.coalesce((F.col("a_fp") == F.col("b_fp")) & (F.col("a_rows") == F.col("b_rows")), F.lit(False))
    return x.join(y, "table_name", "full_outer").withColumn("equal", same)


# --- table differences ----------------------------------------------------------------------------


def diff_tables(a: DataFrame, b: DataFrame, key: str, compat: bool = False) -> DataFrame:
    """Changed values side by side (``a_x``, ``b_x``), NULL where they agree; keys match without regard
    to case. ``compat`` keeps the plain ``!=`` test, under which a change from or to NULL and a row on
    one side only do not count."""
    cols = [c for c in a.columns if c in b.columns]
    l, r = a.alias("a"), b.alias("b")
    low = lambda c: F.lower(c.cast("string"))
    j = l.join(r, low(F.col(f"a.{key}")) == low(F.col(f"b.{key}")), "full_outer")
    A, B = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    if compat:
        j = j.filter(_or([A(c) != B(c) for c in cols]))
        same = lambda c: A(c) == B(c)
    else:
        j = j.filter(_or([~A(c).eqNullSafe(B(c)) for c in cols]))
        same = lambda c: A(c).eqNullSafe(B(c))
    pairs = [x for c in cols if c != key for x in (
        F.when(~F.coalesce(same(c), F.lit(False)), A(c)).alias(f"a_{c}"),
        F.when(~F.coalesce(same(c), F.lit(False)), B(c)).alias(f"b_{c}"))]
    return j.select(F.coalesce(A(key), B(key)).alias(key), *pairs)


def diff_rows(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Rows added, dropped, changed or unchanged; a changed row yields one line per differing cell."""
    cols = [c for c in a.columns if c not in key]
    text = F.struct(*[F.col(c).cast("string").alias(c) for c in cols])
    x, y = a.select(*key, text.alias("_a")), b.select(*key, text.alias("_b"))
    j = x.join(y, key, "full_outer")
    cells = F.filter(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_a.{c}").alias("old"), F.col(f"_b.{c}").alias("new"))
                  for c in cols]), lambda s: ~s["old"].eqNullSafe(s["new"]))
    status = (F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "dropped")
              .when(F.size(cells) > 0, "changed").otherwise("unchanged"))
    blank = F.array(F.struct(*[F.lit(None).cast("string").alias(n) for n in ("column", "old", "new")]))
    j = j.withColumn("status", status)
    return j.select(*key, "status", F.inline(F.when(F.col("status") == "changed", cells).otherwise(blank)))


# --- hash trees -----------------------------------------------------------------------------------


def compare_hash_trees(a: list[DataFrame], b: list[DataFrame], names: list[str]) -> DataFrame:
    """Top-down comparison of two catalogues. Each level: id, parent, hash. Below the top, only children
    of parents whose hashes differ are read, so equal subtrees cost one semi join and no more."""
    found, differing = [], None
    for i, name in enumerate(names):
        x, y = a[i], b[i]
        if differing is not None:
            x = x.join(differing, x["parent"] == differing["_id"], "left_semi")
            y = y.join(differing, y["parent"] == differing["_id"], "left_semi")
        x = x.select("id", F.col("hash").alias("a_hash"), F.lit(True).alias("_a"))
        y = y.select("id", F.col("hash").alias("b_hash"), F.lit(True).alias("_b"))
        problem = (F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b")
                   .when(~same_hash(F.col("a_hash"), F.col("b_hash")), "differs"))
        j = x.join(y, "id", "full_outer").withColumn("problem", problem).filter("problem IS NOT NULL")
        found.append(j.select(F.lit(name).alias("level"), "id", "problem"))
        differing = j.filter("problem = 'differs'").select(F.col("id").alias("_id"))
    return reduce(DataFrame.unionByName, found)


def self_check(parents: DataFrame, children: DataFrame, key: list[str], stored: str, h: str,
               tiebreak: list[str] | None = None) -> DataFrame:
    """Parents whose stored hash is not the roll-up of their stored children."""
    rolled = merkle_rollup(children, key, h, "rolled", tiebreak)
    return parents.select(*key, F.col(stored).alias("stored")).join(rolled, key, "left").filter(
        ~same_hash(F.col("stored"), F.col("rolled")))


def hash_mismatch(manifest: DataFrame, files: DataFrame, key: str = "url") -> DataFrame:
    """Files whose content hash is not the manifest's, and manifest entries without a file."""
    f = files.select(key, F.col("md5").alias("found_md5"))
    return manifest.select(key, F.col("md5").alias("md5")).join(f, key, "left").filter(
        ~F.col("md5").eqNullSafe(F.col("found_md5")))


def missing_count(df: DataFrame, col: str) -> DataFrame:
    """Number of rows lacking a value."""
    return df.agg(F.count_if(F.col(col).isNull() | (F.col(col) == "")).alias("missing"), F.count("*").alias("n_rows"))


def check_metadata_tables(spark: SparkSession, db: str, table_meta: DataFrame, column_meta: DataFrame,
                          patients: DataFrame, id_col: str = "dicom_patient_id") -> DataFrame:
    """Clinical tables against their dictionaries: tables and columns must agree, patients be known."""
    names = [t.name for t in spark.catalog.listTables(db) if t.tableType not in ("VIEW", "TEMPORARY")]
    rows = [(n, c.name) for n in names for c in spark.table(f"{db}.{n}").schema]
    real = spark.createDataFrame(rows, "table_name string, column string")
    tables = unmatched(real.select("table_name").distinct(), table_meta.select("table_name").distinct(), ["table_name"])
    cols = unmatched(real, column_meta.select("table_name", "column").distinct(), ["table_name", "column"])
    out = tables.select("table_name", F.lit(None).cast("string").alias("item"),
                        F.concat(F.lit("table_"), "side").alias("problem")).unionByName(
        cols.select("table_name", F.col("column").alias("item"), F.concat(F.lit("column_"), "side").alias("problem")))
    known = patients.select(F.col(patients.columns[0]).alias(id_col)).distinct()
    for n in names:
        t = spark.table(f"{db}.{n}")
        if id_col in t.columns:
            strange = t.select(id_col).distinct().join(known, id_col, "left_anti")
            out = out.unionByName(strange.select(F.lit(n).alias("table_name"), F.col(id_col).alias("item"),
                                                 F.lit("patient_unknown").alias("problem")))
    return out
