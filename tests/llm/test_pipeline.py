import corpus_pipeline
from pyspark.sql import functions as F

from vcat.llm.common import settle

from .test_minhash import plain

SF = "/root/testdata/sf0.001"
TOXIC = "You are an idiot, a pathetic loser and a stupid moron. Worthless trash, disgusting scum, you clown. "


def test_stages_act_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    text = docs.filter("n_chars BETWEEN 1500 AND 4000 AND lang = 'en'").orderBy("doc_id").first().text
    planted = spark.createDataFrame([(10_000, text + " once more"), (10_001, text.replace(" the ", " the the ", 1) + " and again"), (10_002, text[:700] + " " + item + " " + text[700:]),
                                     (10_003, None), (10_004, ""), (None, "A text without id."), (10_005, TOXIC * 3)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(planted).withColumns({"grade": F.lit("g"), "tail": F.lit(1), "component_id": F.lit(None).cast("string"), "_text_hash": F.array(F.lit(1))})
    sf = SF.replace("0.001", "0.01")  # more ratings to learn from
    quality = settle(corpus_pipeline.quality(spark, docs, sf))
    assert quality.dtypes == docs.dtypes and 0 < quality.count() < docs.count()

    once = settle(corpus_pipeline.near_duplicates(spark, docs.unionByName(docs.limit(5)), sf))
    assert once.dtypes == docs.dtypes
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = plain(rows, 5, 80)
    want = sorted([d for d, _ in rows if d is None or groups[d][1] == d], key=str)
    assert sorted([r.doc_id for r in once.collect()], key=str) == want

    pure = settle(corpus_pipeline.decontaminate(spark, docs, SF))
    assert pure.dtypes == docs.dtypes
    kept = {r.doc_id for r in pure.collect()}
    assert 10_002 not in kept and {10_000, 10_003, 10_004, None} <= kept
    assert {d for d, t in rows if t and item in t}.isdisjoint(kept)


def test_run_and_empty_table(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 100
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_texts_of_one_id_are_judged_apart(spark):
    words = lambda a: " ".join(f"{a}{i}" for i in range(60))
    rows = [(1, words("a")), (3, words("a") + " end"), (3, words("b")), (3, words("b")), (4, words("c")), (4, words("d")), (2, words("e")), (9, words("d") + " end"), (None, words("a"))]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted((r.doc_id or 0, r.text[:1]) for r in out.collect()) == [(0, "a"), (1, "a"), (2, "e"), (3, "b"), (4, "c"), (4, "d")]
