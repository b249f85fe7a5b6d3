"""Outputs: tables, exports, published datasets with their views, schema annotation, clustering."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder for intermediate results: below the shared folder the cluster names in
    ``spark.checkpoint.dir``, or below the session's warehouse where that is unset. It lies in a folder of the application, which
    can be removed with it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/vcat-{uuid.uuid4().hex}"


def scratch_db(spark: SparkSession, name: str) -> str:
    """A fresh database whose tables live in a scratch folder."""
    db = f"vcat_{name}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_dir(spark)}'")
    return db


def materialize(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Write a result to a table, truncating or appending."""
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def settle(df: DataFrame) -> DataFrame:
    """Write a result to the scratch folder and read it back. Its lineage ends there, and its size is
    known from then on: the planner broadcasts it while it is below the threshold, and only then."""
    path = f"{scratch_dir(df.sparkSession)}/t"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(df: DataFrame, key: str | None = None, by: str | None = None) -> DataFrame:
    """A table that many readers share, written once: with ``key`` its rows are spread by it and sorted, so that scans start on all cores and lookups skip row groups; with
    ``by`` it has a folder for each value, so that a filter on it reads those alone."""
    path = f"{scratch_dir(df.sparkSession)}/t"
    laid = df
    if key is not None:
        laid = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key).sortWithinPartitions(key)
    writer = laid.write if by is None else laid.write.partitionBy(by)
    writer.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def export_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def export_dataset(spark: SparkSession, db: str, out: str, overwrite: bool = True) -> list[str]:
    """Every table of a database, views left out, to ZSTD Parquet. Returns the names."""
    names = sorted(t.name for t in spark.catalog.listTables(db) if "view" not in t.name and t.tableType not in ("VIEW", "TEMPORARY"))
    for n in names:
        spark.table(f"{db}.{n}").write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").parquet(f"{out}/{n}")
    return names


def view_text(spark: SparkSession, db: str, view: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{view}").filter("col_name = 'View Text'").select("data_type").collect()
    return rows[0][0]


def publish_dataset(spark: SparkSession, src: str, dst: str, tables: list[str] | None = None, skips: tuple[str, ...] = (),
                    copy_views: bool = True) -> None:
    """Copy tables, then re-create the views with their text pointed at the new database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {dst}")
    found = [t for t in spark.catalog.listTables(src) if t.tableType != "TEMPORARY"]
    wanted = [t for t in found if t.name not in skips and (tables is None or t.name in tables)]
    for t in wanted:
        if t.tableType != "VIEW":
            spark.table(f"{src}.{t.name}").write.mode("overwrite").saveAsTable(f"{dst}.{t.name}")
    for t in wanted:
        if copy_views and t.tableType == "VIEW":
            text = view_text(spark, src, t.name).replace(f"{src}.", f"{dst}.").replace(f"`{src}`.", f"`{dst}`.")
            spark.sql(f"CREATE OR REPLACE VIEW {dst}.{t.name} AS {text}")


def publish_current(spark: SparkSession, prefix: str, version: int, name: str | None = None, tables: list[str] | None = None) -> str:
    """The alias database of the newest version: one view per table of ``{prefix}_v{version}``."""
    src, dst = f"{prefix}_v{version}", name or f"{prefix}_current"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {dst}")
    for t in spark.catalog.listTables(src):
        if t.tableType != "TEMPORARY" and (tables is None or t.name in tables):
            spark.sql(f"CREATE OR REPLACE VIEW {dst}.{t.name} AS SELECT * FROM {src}.{t.name}")
    return dst


def build_derived(spark: SparkSession, db: str, steps: list[tuple[str, Callable[[SparkSession], DataFrame], T.StructType | None]],
                  only: list[str] | None = None) -> list[str]:
    """Build derived tables in order, each annotated and twinned with a ``_view``. A step reads the
    tables of the steps before it, so nothing is computed twice."""
    made = []
    for name, make, partial in steps:
        if only is not None and name not in only:
            continue
        df = make(spark)
        (annotate_schema(df, partial) if partial else df).write.mode("overwrite").saveAsTable(f"{db}.{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name}_view AS SELECT * FROM {db}.{name}")
        made.append(name)
    return made


def _annotated(t: T.DataType, partial: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType) and isinstance(partial, T.StructType):
        notes = {f.name: f for f in partial.fields}
        fields = []
        for f in t.fields:
            p = notes.get(f.name)
            meta = {**f.metadata, **({"comment": p.metadata["comment"]} if p is not None and "comment" in p.metadata else {})}
            fields.append(T.StructField(f.name, _annotated(f.dataType, p.dataType) if p is not None else f.dataType, f.nullable, meta))
        return T.StructType(fields)
    if isinstance(t, T.ArrayType):
        inner = partial.elementType if isinstance(partial, T.ArrayType) else partial
        return T.ArrayType(_annotated(t.elementType, inner), t.containsNull)
    return t


def annotate_schema(df: DataFrame, partial: T.StructType) -> DataFrame:
    """Copy column descriptions from a partial schema onto a result, also inside records."""
    return df.to(_annotated(df.schema, partial))


def clustered_write(df: DataFrame, name: str, cols: list[str], mode: str = "overwrite") -> None:
    """Table whose files cover narrow ranges of the clustering columns, so that filters on them skip
    files and row groups. The range of each file is kept in ``{name}_zones``; appending adds the new files to it."""
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.mode(mode).saveAsTable(name)
    spark = df.sparkSession
    rows = spark.table(name).select(F.col("_metadata.file_name").alias("file"), *cols)  # names are unique within the table's one folder
    if mode == "append" and spark.catalog.tableExists(f"{name}_zones"):
        rows = rows.join(spark.table(f"{name}_zones").select("file"), "file", "left_anti")
    zones = rows.groupBy("file").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in cols for f in (F.min, F.max)])
    zones.write.mode(mode).saveAsTable(f"{name}_zones")


def read_range(spark: SparkSession, name: str, col: str, low=None, high=None) -> DataFrame:
    """Rows of a clustered table with ``low <= col <= high`` (None: open on that side), from the files whose range meets that one. Files that the
    zones don't know, as others may have written them, are read as well, so no row is missed. Names of files are all that the driver sees."""
    within = lambda least, most: reduce(and_, [F.col(c) >= v if up else F.col(c) <= v for c, v, up in ((most, low, True), (least, high, False)) if v is not None], F.lit(True))
    hit = F.coalesce(within(f"min_{col}", f"max_{col}"), F.lit(False))
    known = dict(spark.table(f"{name}_zones").select("file", hit).collect())
    table = spark.table(name)
    files = [f for f in map(unquote, table.inputFiles()) if known.get(f.rsplit("/", 1)[1], True)]
    if not files:
        return table.filter(F.lit(False))
    return spark.read.schema(table.schema).parquet(*files).filter(F.col(col).isNotNull() & within(col, col))
