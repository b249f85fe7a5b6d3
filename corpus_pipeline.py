"""The corpus pipeline: documents in, packed training sequences out.

Every stage is (name, function); a function takes (spark, docs, sf_dir), ``docs`` being all rows its predecessor kept, and returns a
DataFrame. All but the last return the columns of ``docs``, which may be more than those of the table and have any names. Results of ``run`` are
written between stages, in the folder shared by the cluster.

Nulls, empty texts, repeated rows and empty tables are dealt with as the operators' docstrings say: a document of no text is scored by its
shape, is no duplicate of anything, leaks nothing and is packed as its end id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vcat.llm import minhash, ordinal, pack, templates
from vcat.llm.common import free_name, settle, table

#: A document stays if its probability of the best grade reaches this.
LEAST_TAIL = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the rated ones, takes for clean."""
    model = ordinal.train(docs, table(spark, sf_dir, "labels").withColumn("grade", ordinal.rating()))
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c != "text"}  # a column may have the name of a result
    scored = ordinal.classify(docs.withColumnsRenamed(names), model).filter(F.col("tail") >= LEAST_TAIL)
    scored = scored.select("text", *names.values())
    return scored.withColumnsRenamed({v: k for k, v in names.items()}).select(*(f"`{c}`" for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id. Of repeated rows (equal
    id and text) one stays. Different texts of one id are documents of their own."""
    texts = docs.select("doc_id", "text")
    again = settle(docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "again")
    hashed = texts.join(again, "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("text_hash")).distinct()
    mixed = settle(hashed.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "mixed")
    if mixed.isEmpty():
        gone = minhash.near_duplicates(texts, k=5, percent=80).filter("NOT kept").select("doc_id", F.lit(None).cast("long").alias("text_hash")).distinct()
    else:
        gone = _later_copies(texts, mixed)
    gone = settle(gone, "gone")
    key = free_name(docs, "_text_hash")
    left = docs.join(gone.filter("text_hash IS NULL").select("doc_id"), "doc_id", "left_anti").select(*(docs[c] for c in docs.columns)).withColumn(key, F.xxhash64("text"))
    some = gone.filter("text_hash IS NOT NULL").toDF("_gone_id", "_gone_hash")
    left = left.join(some, (left["doc_id"] == some["_gone_id"]) & (left[key] == some["_gone_hash"]), "left_anti")
    one = left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", key])
    return left.join(again, "doc_id", "left_anti").unionByName(one).select(*(f"`{c}`" for c in docs.columns))


def _later_copies(texts: DataFrame, mixed: DataFrame) -> DataFrame:
    """``doc_id, text_hash`` of the near copies to remove, where the ids in ``mixed`` have several texts; the hash is null for other ids."""
    own = texts.join(mixed, "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64("doc_id", "text").alias("key"), "text")
    own = settle(own.dropDuplicates(["doc_id", "text_hash"]), "own")
    alone = texts.join(mixed, "doc_id", "left_anti").unionByName(own.select(F.col("key").alias("doc_id"), "text"))
    found = minhash.near_duplicates(alone, k=5, percent=80).select(F.col("doc_id").alias("key"), "component_id").filter("key IS NOT NULL").distinct()
    named = settle(found.join(own.drop("text"), "key", "left").select("key", "component_id", F.coalesce("doc_id", "key").alias("doc_id"), "text_hash"), "named")
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "key"))["key"].alias("first"))
    return named.join(first, "component_id").filter("key <> first").select("doc_id", "text_hash")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return templates.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in training sequences."""
    return pack.pack(pack.tokenize(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("packing", packing)]
#: A fitted model, similarities and a packing are nothing that SQL expresses; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
