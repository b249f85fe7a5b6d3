"""Clinical tables: read, normalise, stack batches, recast, profile, and describe them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.functions.textclean import reform_case
from vcat.sources.readers import line_numbers, load_ndjson

SOURCE_BATCH, CASE_ID = "source_batch", "dicom_patient_id"
MOST_VALUES = 20


# --- reading --------------------------------------------------------------------------------------


def normal_header(parts: list[str]) -> str:
    """Column name from the parts of a header: joined by ``_``; ``/``, ``-`` and blanks become ``_``,
    other marks go, a leading digit gets ``c_``, all lower case."""
    text = re.sub(r"[/\- ]", "_", "_".join(p for p in parts if p).strip())
    text = re.sub(r"[^a-zA-Z_0-9]", "", text)
    return ("c_" + text if text[:1].isdigit() else text).lower()


def header_names(rows: list[list[str]]) -> list[str]:
    """Names from one or more header rows. In every row but the last, a blank cell of a spanning header
    takes the value to its left."""
    parts: list[list[str]] = [[] for _ in rows[0]]
    for i, row in enumerate(rows):
        last, held = i == len(rows) - 1, ""
        for j, cell in enumerate(row):
            cell = "" if cell is None else str(cell)
            if last or cell:
                held = cell
            parts[j].append(held)
    return [normal_header(p) for p in parts]


def read_clinical(spark: SparkSession, spec: dict) -> DataFrame:
    """One source file by its description: path, sep, headrows, skip_rows, skip_cols, max_row, pivot,
    filter_rows (column name) with collection.

    Row numbers count from 0 at the first line of a file; a folder of files that repeat their header
    rows reads like one file. Only the header rows reach the driver.
    """
    raw = spark.read.csv(spec["path"], sep=spec.get("sep", ","), header=False)
    width = len(raw.columns)
    numbered = line_numbers(raw).withColumnsRenamed({c: f"_{i}" for i, c in enumerate(raw.columns)})
    if spec.get("pivot"):
        # Rows and columns change places. Such tables list their fields downwards, so they are short.
        cells = numbered.select("_row", F.posexplode(F.array(*[f"_{i}" for i in range(width)])).alias("_col", "_v"))
        n = numbered.count()
        numbered = cells.groupBy("_col").pivot("_row", list(range(n))).agg(F.first("_v")).select(
            *[F.col(str(i)).alias(f"_{i}") for i in range(n)], F.col("_col").cast("bigint").alias("_row"))
        width = n
    keep = [i for i in range(width) if i not in spec.get("skip_cols", ())]
    numbered = numbered.select("_row", *[f"_{i}" for i in keep])
    heads = sorted(spec.get("headrows", [0]))
    first = numbered.filter(F.col("_row").isin(heads)).groupBy("_row").agg(*[F.min(f"_{i}").alias(f"_{i}") for i in keep])
    top = {r["_row"]: [r[f"_{i}"] for i in keep] for r in first.collect()}
    names = header_names([top[h] for h in heads])
    body = numbered.filter(~F.col("_row").isin([*heads, *spec.get("skip_rows", ()), 0]))
    if spec.get("max_row", -1) > -1:
        body = body.filter(F.col("_row") <= spec["max_row"])
    out = body.drop("_row").toDF(*names)
    if spec.get("filter_rows"):
        out = out.filter(F.col(normal_header([spec["filter_rows"]])) == spec["collection"])
    return out


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[normal_header([c]) for c in df.columns])


def stack_batches(*dfs: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """Batches under each other with their number. The patient column of later batches takes the name
    of the first one's; columns a batch lacks are NULL."""
    parts = []
    for i, df in enumerate(dfs):
        if ids and ids[i] != ids[0]:
            df = df.withColumnRenamed(ids[i], ids[0])
        parts.append(df.withColumn(SOURCE_BATCH, F.lit(i)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def recast(df: DataFrame, id_col: str) -> DataFrame:
    """Float columns holding whole numbers only become integers; one aggregate row decides for all."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name != id_col]
    if not floats:
        return df
    whole = df.agg(*[F.bool_and(F.coalesce(F.col(c) == F.floor(c), F.lit(True))).alias(c) for c in floats]).first()
    return df.withColumns({c: F.col(c).cast("bigint") for c in floats if whole[c]})


# --- profiling ------------------------------------------------------------------------------------


def _cells(df: DataFrame) -> DataFrame:
    numeric = lambda f: isinstance(f.dataType, T.NumericType)
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").cast("string").alias("value"),
                 (F.col(f"`{f.name}`").cast("double") if numeric(f) else F.lit(None).cast("double")).alias("num"))
        for f in df.schema.fields])))


def profile(df: DataFrame, most: int = MOST_VALUES) -> DataFrame:
    """Per column: number of distinct values (NULL counts as one, shown as ``null``), their sorted list
    if there are at most ``most``, and the range of a numeric column.

    Values are made distinct per column first, so neither a common value nor a column of unique ids is
    gathered in one task; lists are formed for the short columns only.
    """
    values = _cells(df).groupBy("column", "value", "num").agg(F.count("*").alias("_n"))
    stats = values.groupBy("column").agg(
        F.count("*").alias("n_values"), F.min("num").alias("rng_min"), F.max("num").alias("rng_max"), F.sum("_n").alias("n_rows"))
    # One row per column of the table, so this side is as small as the schema.
    short = stats.filter(F.col("n_values") <= most).select("column")
    order = F.struct(F.col("value").isNull().alias("_null"), F.col("num").alias("_num"), F.coalesce("value", F.lit("null")).alias("_v"))
    lists = values.join(F.broadcast(short), "column", "left_semi").groupBy("column").agg(
        F.transform(F.array_sort(F.collect_list(order)), lambda x: x["_v"]).alias("values"))
    return stats.join(lists, "column", "left")


def column_metadata(df: DataFrame, collection: str, table: str, case_col: str, labels: dict[str, str] | None = None,
                    headers: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per column: label, type, and its value list where that is short."""
    labels, headers = labels or {}, headers or {}
    rows = [(i, f.name, labels.get(f.name, f.name), _type_name(f.dataType), headers.get(f.name, [f.name])) for i, f in enumerate(df.schema.fields)]
    cols = df.sparkSession.createDataFrame(rows, "position int, column string, column_label string, data_type string, original_column_headers array<string>")
    p = profile(df).select("column", "values", "n_values")
    quoted = lambda v: F.when(F.lower(v) == "nan", F.concat(F.lit('"'), v, F.lit('"'))).otherwise(v)
    codes = F.transform("values", lambda v: F.named_struct(F.lit("option_code"), quoted(v), F.lit("option_description"), F.lit(None).cast("string")))
    return cols.join(p, "column", "left").select(
        F.lit(collection).alias("collection_id"), F.lit(table).alias("table_name"), "position", "column", "column_label", "data_type",
        (F.col("column") == case_col).alias("case_col"), "original_column_headers", codes.alias("values"),
        F.when(F.col("values").isNotNull(), "derived from inspection of values").alias("values_source"))


def _type_name(t: T.DataType) -> str:
    return {"string": "String", "bigint": "int", "double": "float", "boolean": "bool"}.get(t.simpleString(), t.simpleString())


def attach_dictionary(meta: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Labels and options of a provided dictionary replace the derived ones.
    dictionary: column, label, opts (array of option_code, option_description)."""
    d = dictionary.select("column", F.col("label").alias("_l"), F.col("opts").alias("_o"))
    has = F.size(F.coalesce("_o", F.array().cast("array<struct<option_code:string,option_description:string>>"))) > 0
    return meta.join(d, "column", "left").withColumns({
        "column_label": F.coalesce("_l", "column_label"),
        "values": F.when(has, F.col("_o")).otherwise(F.col("values")),
        "values_source": F.when(has, "provided dictionary").otherwise(F.col("values_source"))}).drop("_l", "_o").select(*meta.columns)


def table_metadata(tables: DataFrame, history: DataFrame, version: str, now: str) -> DataFrame:
    """One row per table with when and from what it was added, last changed, and changed before that.

    tables: table_name, post_process_src, md5, and any descriptive columns; history: the rows of the
    last version. A table whose source file or its md5 differs is updated; the former update becomes
    its prior state."""
    keep = ["version_table_added", "table_added_datetime", "post_process_src_added_md5", "version_table_prior", "post_process_src_prior_md5",
            "version_table_updated", "table_updated_datetime", "post_process_src_updated_md5"]
    h = history.select("table_name", F.struct(F.col("post_process_src").alias("src"), *keep).alias("_h"))
    j = tables.join(h, "table_name", "left")
    new = F.col("_h").isNull()
    file_name = lambda c: F.substring_index(c, "/", -1)
    changed = ~new & ((file_name(F.col("_h.src")) != file_name(F.col("post_process_src"))) | (F.col("md5") != F.col("_h.post_process_src_updated_md5")))
    ver, time, md5 = F.lit(version), F.lit(now), F.col("md5")
    old = lambda c: F.col(f"_h.{c}")
    by = {
        "version_table_added": F.when(new, ver).otherwise(old("version_table_added")),
        "table_added_datetime": F.when(new, time).otherwise(old("table_added_datetime")),
        "post_process_src_added_md5": F.when(new, md5).otherwise(old("post_process_src_added_md5")),
        "version_table_prior": F.when(new, ver).when(changed, old("version_table_updated")).otherwise(old("version_table_prior")),
        "post_process_src_prior_md5": F.when(new, md5).when(changed, old("post_process_src_updated_md5")).otherwise(old("post_process_src_prior_md5")),
        "version_table_updated": F.when(new | changed, ver).otherwise(old("version_table_updated")),
        "table_updated_datetime": F.when(new | changed, time).otherwise(old("table_updated_datetime")),
        "post_process_src_updated_md5": F.when(new | changed, md5).otherwise(old("post_process_src_updated_md5")),
    }
    return j.select(*[c for c in tables.columns if c != "md5"], *[c.alias(n) for n, c in by.items()])


def with_case_id(df: DataFrame, id_col: str, collection, rule: str | Column) -> DataFrame:
    """Patient id as the image side writes it, in front."""
    coll = F.lit(collection) if isinstance(collection, str) else collection
    return df.select(reform_case(F.col(id_col).cast("string"), coll, rule).alias(CASE_ID), "*")


def split_by_collection(df: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
    """A programme-wide table split by the collections that know its patients; collections without any
    do not occur. Write it with ``partitionBy("collection_id")`` to get one table per collection.
    known: collection_id, PatientID."""
    k = known.select("collection_id", F.col("PatientID").alias("_id")).distinct()
    j = df.join(k, F.col(id_col).cast("string") == F.col("_id"))
    return j.select("collection_id", F.col("_id").alias(CASE_ID), F.lit(0).alias(SOURCE_BATCH), *df.columns)


def load_clinical(spark: SparkSession, files: dict[str, tuple[str, str | None]]) -> dict[str, DataFrame]:
    """Clinical tables from their newline-delimited JSON files: name -> (path, declared schema)."""
    return {name: load_ndjson(spark, path, schema) for name, (path, schema) in files.items()}
