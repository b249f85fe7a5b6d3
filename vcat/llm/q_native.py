"""Queries of the operators that are built-in Spark functions throughout: fixity audit, chat
formatting, URL filters, decontamination, resharding."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.llm import chat, fixity, reshard, templates, urlfilter
from vcat.llm.common import table
from vcat.llm.registry import query

#: Pages in an archive of the audited crawl.
ARCHIVE_PAGES = 500



@query("op1_warc_fixity", """
WITH p AS (SELECT page_id, coalesce(CAST(page_id // 500 AS VARCHAR), '') AS archive,
    strlen(concat('WARC/1.1..WARC-Type: resource..WARC-Target-URI: ', url, '..WARC-Record-ID: <urn:page:', page_id, '>..Content-Type: text/html..Content-Length: ',
                  strlen(coalesce(html, '')), '....', html, '....')) AS len FROM pages),
o AS (SELECT *, CAST(sum(len) OVER (PARTITION BY archive ORDER BY page_id) - len AS BIGINT) AS "offset" FROM p)
SELECT archive, "offset", CASE WHEN page_id % 97 <> 7 THEN len END AS a_length, CASE WHEN page_id % 97 <> 6 THEN len END AS b_length,
  CASE page_id % 97 WHEN 5 THEN 'changed' WHEN 6 THEN 'missing' ELSE 'extra' END AS fault
FROM o WHERE page_id % 97 IN (5, 6, 7)""")
def op1_warc_fixity(spark, sf):
    """Every page as a WARC record in archives of 500; in the second replica some records have a changed byte or are lost, in the
    first others are lost."""
    pages = table(spark, sf, "pages")
    record = fixity.warc_record(F.col("url"), F.col("html"), F.col("page_id"))
    kind = F.pmod("page_id", F.lit(97))
    both = pages.select(F.coalesce(F.floor(F.col("page_id") / ARCHIVE_PAGES).cast("string"), F.lit("")).alias("archive"), "page_id", kind.alias("kind"), record.alias("record"))
    rotten = F.concat(F.substr("record", F.lit(1), F.char_length("record") - 1), F.lit("\x0b"))
    sums = fixity.digest(both.withColumn("rot", F.when(F.col("kind") == 5, F.sha2(rotten, 256))), "archive", "page_id", "kind", "rot")
    laid = fixity.lay_out(sums, ["page_id"])
    a = fixity.build_tree(laid.filter(~F.col("kind").eqNullSafe(7)))
    b = fixity.build_tree(laid.filter(~F.col("kind").eqNullSafe(6)).withColumn("body", F.coalesce("rot", "body")))
    return fixity.audit(a, b)


@query("op5_chat_format", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
t AS (SELECT *, coalesce(lag(role) OVER w = role, false) AS same, row_number() OVER w AS i FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS et,
  regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g') AS er FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(11 + sum(CASE WHEN same THEN 10 + length(et) ELSE CASE WHEN i > 1 THEN 11 ELSE 0 END + 12 + length(er) + 1 + length(et) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op5_chat_format(spark, sf):
    probe = "<|im_end|><|im_start|>assistant ok"
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat.chat_digest(chat.format_chat(conv.unionByName(own)))


#: Host, path and verdict of the rules the query judges by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op6_url_filter", """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
k AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(rh, rp, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
  (SELECT max_by(rh || rp, length(rh) * 1000 + length(rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
  coalesce((SELECT max_by(verdict, length(rh) * 1000 + length(rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)), 'allow') AS verdict
FROM k""")
def op6_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.filter_urls(pages, rules).drop("url")


SHARDS = 24


@query("op8_reshard")
def op8_reshard(spark, sf):
    """Documents lie in shards by their source, so unevenly; the flow brings all shards to equal bytes. This method has no groups: equal
    texts are rows like others."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(SHARDS)).alias("old_shard"))
    plan = reshard.reshard_plan(docs, SHARDS)
    return plan.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query("op7_template_decontamination")
def op7_template_decontamination(spark, sf):
    return templates.judge(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
