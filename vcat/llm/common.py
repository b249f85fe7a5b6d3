"""What the operators share: settled tables in the shared folder, and keys that null columns can't break."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; below the warehouse only where that is unset, as in tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_settled"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def settle(df: DataFrame, name: str = "t") -> DataFrame:
    """Write a result to the shared folder and read it back: lineage ends there, whole, for every executor
    that may be lost later. The folder belongs to the application and can go with it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, want: str) -> str:
    """A column name that the table doesn't hold yet."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want += "_"
    return want


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, whatever the optimizer does to columns that a lambda refers to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def equal(a: DataFrame, b: DataFrame, on: list[str]) -> Column:
    """Join condition: all these columns are equal, nulls too. ``b`` has them under other names: an ``_r_`` in front."""
    cond = F.lit(True)
    for c in on:
        cond = cond & a[c].eqNullSafe(b[f"_r_{c}"])
    return cond


def join_equal(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Columns of ``a`` and the others of ``b``; rows meet where ``on`` are equal, nulls too."""
    b = b.withColumnsRenamed({c: f"_r_{c}" for c in on})
    return a.join(b, equal(a, b, on), how).drop(*(f"_r_{c}" for c in on))


def ranked(df: DataFrame, keys: list[str], order: list[Column], rank: str = "rank", total: str = "total") -> DataFrame:
    """``df``, written, with each row's place (from 0) among the rows of its ``keys``, and their number. Rows are sorted by ranges, so a key with any
    share of them is many partitions; what is summed in order is a count for each key and partition."""
    by = [*(F.col(c).asc_nulls_first() for c in keys), *order]
    laid = settle(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    parts = laid.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_begin", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    if keys:
        totals = join_equal(parts, parts.groupBy(*keys).agg(F.sum("_n").alias(total)), keys)
    else:
        totals = parts.withColumn(total, F.sum("_n").over(Window.partitionBy()))
    out = join_equal(laid, settle(totals.drop("_n", "_first"), "parts"), [*keys, "_part"])
    return out.withColumn(rank, F.col("_begin") + F.col("_at")).drop("_at", "_part", "_begin")
