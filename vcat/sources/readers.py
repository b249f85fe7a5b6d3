"""Inputs: manifests, file listings, lookups, declared or inferred loads, and level tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.functions.exprs import SOURCES

# Other spellings of the manifest columns.
MANIFEST_COLUMNS = {
    "Filename": "ingestion_url", "Patient ID": "submitter_case_id", "patientID": "submitter_case_id",
    "Study Instance UID": "study_instance_uid", "StudyInstanceUID": "study_instance_uid",
    "Series Instance UID": "series_instance_uid", "SeriesInstanceUID": "series_instance_uid",
    "SOP Instance UID": "sop_instance_uid", "SOPInstanceUID": "sop_instance_uid", "md5_hash": "hash",
}


def _trimmed(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_manifest(spark: SparkSession, path: str, sep: str | None = None, renames: dict[str, str] | None = None) -> DataFrame:
    """Delimited manifest with a header; cells are trimmed, columns get their catalogue names. Tab or
    comma follows from the file name unless given."""
    sep = sep or ("\t" if path.endswith((".tsv", ".txt")) else ",")
    return _trimmed(spark.read.csv(path, sep=sep, header=True).withColumnsRenamed(renames or MANIFEST_COLUMNS))


#: Files of up to so many bytes are hashed as one cell, longer ones are streamed in blocks.
WHOLE, BLOCK = 64 << 20, 4 << 20


def open_stream(uri: str) -> BinaryIO:
    """The bytes of a file as a stream, as they are stored: local, or wherever pyarrow reaches (HDFS, S3, GCS)."""
    if uri.startswith("file:"):
        return open("/" + uri.removeprefix("file:").lstrip("/"), "rb")
    scheme, rest = uri.split("://", 1)
    store, path = fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")
    return store.open_input_stream(path, compression=None)


def _streamed_md5(open_with: Callable[[str], BinaryIO]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, uri in enumerate(batch.column(0).to_pylist()):
                md5 = hashlib.md5(usedforsecurity=False)
                with open_with(uri) as stream:
                    while block := stream.read(BLOCK):
                        md5.update(block)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([md5.hexdigest()]), batch.column(1).slice(i, 1)], ["ingestion_url", "hash", "size"])

    return run


def file_manifest(spark: SparkSession, directory: str, exclude_suffixes: tuple[str, ...] = (), include: str | None = None,
                  done: DataFrame | None = None, whole: int = WHOLE, open_with: Callable[[str], BinaryIO] = open_stream) -> DataFrame:
    """Files below a directory with md5 and size. Names and the list of files already done are applied
    to the listing; only then is any content read: of files of up to ``whole`` bytes one per row, and of longer ones in
    blocks from ``open_with(path)``, as a cell can not hold more than 2 GB. Spark's listing leaves out empty files."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    keep = F.lit(True)
    for s in exclude_suffixes:
        keep = keep & ~F.col("path").endswith(s)
    if include:
        keep = keep & F.contains("path", F.lit(include))
    rows = listing.filter(keep)
    if done is not None:
        rows = rows.join(done.select(F.col("ingestion_url").alias("path")).distinct(), "path", "left_anti")
    url, size = F.col("path").alias("ingestion_url"), F.col("length").alias("size")
    short = rows.filter(F.col("length") <= whole).select(url, F.md5("content").alias("hash"), size)
    # Rows are paths only, far too small for adaptive execution to see the work behind them: their number of tasks is given.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = rows.filter(F.col("length") > whole).select(url, size).repartition(tasks, "ingestion_url")
    return short.unionByName(long.mapInArrow(_streamed_md5(open_with), "ingestion_url string, hash string, size bigint"))


def read_lookup_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON array of objects; comments, single quotes and unquoted names are accepted."""
    return (spark.read.schema(schema).option("multiLine", True).option("allowComments", True)
            .option("allowSingleQuotes", True).option("allowUnquotedFieldNames", True).json(path))


def load_ndjson(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, skip: int = 0, sep: str = ",") -> DataFrame:
    """CSV with declared or inferred types. ``skip`` leading lines of each file are left out (one of
    them the header, if the schema is declared)."""
    reader = spark.read.option("sep", sep)
    if schema is None and skip <= 1:
        return reader.csv(path, header=True, inferSchema=True)
    if schema is not None and skip <= 1:
        return reader.schema(schema).csv(path, header=skip == 1)
    if schema is None:
        raise ValueError("skipping more than the header needs a declared schema")
    body = line_numbers(spark.read.text(path)).filter(F.col("_row") >= skip)
    ddl = schema if isinstance(schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return body.select(F.from_csv("value", ddl, {"sep": sep}).alias("r")).select("r.*")


def line_numbers(df: DataFrame) -> DataFrame:
    """Rows of a text or CSV scan with their 0-based line number within their file as ``_row``.

    Lines are numbered within each file block by their order in the scan; the number of lines before a
    block comes from one count per block, which is all that is shuffled."""
    base = df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_i"))
    blocks = base.groupBy("_f", "_b").agg(F.min("_i").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_f", "_b", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return base.join(offsets, ["_f", "_b"]).select(*df.columns, (F.col("_i") - F.col("_first") + F.col("_before")).alias("_row"))


# --- level tables ---------------------------------------------------------------------------------

STRUCTS = {"hashes": (*SOURCES, "all"), "sources": SOURCES, "revised": SOURCES}
VERSION_COLS = ("init_version", "rev_version", "final_version", "version", "previous_version")


def read_level_table(df: DataFrame) -> DataFrame:
    """A level table as the relational side delivers it (composites unpacked into ``name_field``
    columns, integers as they come) in catalogue shape: structs, 32-bit versions."""
    out: list[Column] = []
    packed = {f"{s}_{f}": s for s, fields in STRUCTS.items() for f in fields}
    done = set()
    for c in df.columns:
        s = packed.get(c)
        if s is None:
            out.append(F.col(c).cast("int").alias(c) if c in VERSION_COLS else F.col(c))
        elif s not in done:
            done.add(s)
            out.append(F.struct(*[F.col(f"{s}_{f}").alias(f) for f in STRUCTS[s] if f"{s}_{f}" in df.columns]).alias(s))
    return df.select(*out)


def unpack_level_table(df: DataFrame) -> DataFrame:
    """The reverse: structs to ``name_field`` columns, as a relational table can hold them."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            out += [F.col(f"{f.name}.{x}").alias(f"{f.name}_{x}") for x in f.dataType.names]
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_jdbc_level(spark: SparkSession, url: str, table: str, key: str | None = None, parts: int = 1, **options) -> DataFrame:
    """Level table over JDBC, in ``parts`` ranges of a numeric key so that executors read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and parts > 1:
        lo, hi = spark.read.format("jdbc").option("url", url).option("query", f"SELECT min({key}) AS lo, max({key}) AS hi FROM {table}").options(**options).load().first()
        reader = reader.option("partitionColumn", key).option("lowerBound", lo).option("upperBound", hi).option("numPartitions", parts)
    return read_level_table(reader.load())


# Column types on the relational side.
SQL_TYPES = {
    "string": "TEXT", "int": "BIGINT", "bigint": "BIGINT", "double": "DOUBLE PRECISION", "float": "DOUBLE PRECISION",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMPTZ", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BYTEA",
    "array<string>": "TEXT[]",
}


def sql_type(t: T.DataType) -> str:
    """Relational type of a column; nested types become JSONB, anything unknown TEXT."""
    name = t.simpleString()
    if name in SQL_TYPES:
        return SQL_TYPES[name]
    if isinstance(t, T.DecimalType):
        return "NUMERIC"
    return "JSONB" if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else "TEXT"


def jdbc_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = [f.name for f in df.schema.fields if sql_type(f.dataType) == "JSONB"]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    """Integers are widened to 64 bits and nested columns become JSON text; the driver's dialect does the rest."""
    ready = jdbc_ready(df)
    ready = ready.withColumns({f.name: F.col(f.name).cast("long") for f in ready.schema.fields if f.dataType in (T.ByteType(), T.ShortType(), T.IntegerType())})
    ready.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()
