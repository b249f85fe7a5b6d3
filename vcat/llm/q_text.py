"""Queries of the operators on texts and vectors that work on Arrow batches."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from vcat.llm import collide, licenses, minhash, ordinal, pack
from vcat.llm.common import table
from vcat.llm.registry import query


@query("op3_super_minhash")
def op3_super_minhash(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"), k=2, percent=80)


@query("op2_collision_counting")
def op2_collision_counting(spark, sf):
    return collide.near_vectors(table(spark, sf, "embeddings").select("vec_id", "label", "embedding"), least=0.98)


@query("op9_sum_of_squares")
def op9_sum_of_squares(spark, sf):
    pieces = pack.tokenize(table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return pack.pack(pieces)


@query("op10_license_scan")
def op10_license_scan(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text")).drop("places")


@query("op4_ordinal_quality")
def op4_ordinal_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = ordinal.train(docs, table(spark, sf, "labels").withColumn("grade", ordinal.rating()))
    out = ordinal.classify(docs, model).drop("text")
    return out.withColumn("kept", F.col("tail") >= 0.5)
