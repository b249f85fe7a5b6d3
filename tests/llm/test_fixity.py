from pyspark.sql import functions as F

from vcat.llm import fixity


def tree(spark, rows):
    d = spark.createDataFrame(rows, "archive string, offset long, record string, length int")
    return fixity.build_tree(fixity.digest(d, "archive", "offset"), leaf=256, fanout=4)


def test_damage_is_located(spark):
    rows = [(f"a{k}", i * 100, f"rec {k} {i}" * 5, 0) for k in range(3) for i in range(200)]
    b = [r for r in rows if r[:2] != ("a1", 5000)]
    b = [(*r[:2], r[2] + "!", 0) if r[:2] == ("a2", 19900) else r for r in b] + [("a1", 999_999, "new", 0), ("a9", 0, None, 0)]
    got = sorted((r.archive, r.offset, r.fault) for r in fixity.audit(tree(spark, rows), tree(spark, b), 4).collect())
    assert got == [("a1", 5000, "missing"), ("a1", 999_999, "extra"), ("a2", 19900, "changed"), ("a9", 0, "extra")]


def test_equal_empty_null_and_repeated(spark):
    rows = [(None, None, None, None), ("x", 0, "", 0), ("x", 0, "", 0)]
    assert fixity.audit(tree(spark, rows), tree(spark, rows), 4).count() == 0
    assert [r.fault for r in fixity.audit(tree(spark, rows), tree(spark, rows[:2]), 4).collect()] == ["changed"]
    assert sorted(r.fault for r in fixity.audit(tree(spark, rows), tree(spark, []), 4).collect()) == ["missing", "missing"]
    assert fixity.audit(tree(spark, []), tree(spark, []), 4).count() == 0


def test_written_warc_has_the_laid_out_bytes(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "é" * i + "\r\n") for i in range(20)], "page_id long, url string, html string")
    recs = pages.select(F.lit("w").alias("archive"), "page_id", fixity.warc_record(F.col("url"), F.col("html"), F.col("page_id")).alias("record"))
    laid = fixity.lay_out(fixity.digest(recs, "archive", "page_id", "record"), ["page_id"])
    fixity.write_warc(laid, str(tmp_path / "w"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").rglob("part-*")))
    for r in laid.collect():
        assert raw[r.offset:r.offset + r.length].decode() == r.record and raw[r.offset:].startswith(b"WARC/1.1\r\n")
