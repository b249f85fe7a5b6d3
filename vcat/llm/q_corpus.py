"""Queries of the operators on whole corpora and conversations: mixing, structure repair, manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from vcat.llm import manifest, mixing, repair
from vcat.llm.common import join_equal, table
from vcat.llm.registry import query


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(range(1, CAST(length({text}) AS INT) + 1), lambda i: CAST(ascii(substr({text}, CAST(i AS INT), 1)) AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda c, b: {byte}), 4294967295)"


def _leaf_sql(n_chars: str) -> str:
    def part(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    return f"sha256({' || '.join(map(part, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


@query("op11_pivotal_mixing")
def op11_pivotal_mixing(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def _body_sql(c: str) -> str:
    return f"(regexp_replace({c}, '[\\x20\\x09-\\x0D]+$', ''))"


def _arc_sql(q: str, keep: dict[str, str], to: str) -> str:
    """The cheapest way on from a state: over the row, then by rows inserted before it."""
    kept = "".join(f"CASE WHEN NOT gone AND initial = '{i}' THEN struct_pack(c := {x}.c + cut, s := 'K' || {x}.s) END, " for i, x in keep.items())
    return f"least({kept}CASE WHEN NOT gone THEN struct_pack(c := {to}.c + cut + 1, s := 'R' || {to}.s) END, struct_pack(c := {q}.c + 2, s := 'D' || {q}.s))"


def _insert_sql(*states: str) -> str:
    return "least(" + ", ".join(f"struct_pack(c := {x}.c + {5 * k}, s := '{'I' * k}' || {x}.s)" for k, x in enumerate(states)) + ")"


@query("op12_auction_repair", f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM c WHERE k <> 0
  UNION ALL SELECT conv_id, turn, role, text FROM c WHERE k = 3),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, {_body_sql('text')} AS body, substr(role, 1, 1) AS initial FROM d),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM o),
r AS (SELECT *, body = '' AS is_blank, body <> '' AND again AS is_again, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS is_cut,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS wrong FROM t),
g AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate,
  count(*) FILTER (is_cut) AS truncated, count(*) FILTER (wrong) AS illegal FROM r GROUP BY 1),
w AS (SELECT conv_id, i, initial, is_blank OR is_again AS gone, CASE WHEN is_cut THEN 5 ELSE 0 END AS cut FROM r),
b AS (SELECT conv_id, n AS i, struct_pack(c := 0, s := '') AS z, struct_pack(c := 10, s := 'II') AS y, struct_pack(c := 5, s := 'I') AS u, struct_pack(c := 0, s := '') AS a FROM g
  UNION ALL SELECT conv_id, i, {_insert_sql('z', 'u', 'a')}, {_insert_sql('y', 'u', 'a')}, {_insert_sql('u', 'a')}, {_insert_sql('a', 'u')} FROM (
    SELECT b.conv_id, b.i - 1 AS i, {_arc_sql('z', {'s': 'y', 'u': 'u'}, 'u')} AS z, {_arc_sql('y', {'u': 'u'}, 'u')} AS y, {_arc_sql('u', {'a': 'a'}, 'a')} AS u, {_arc_sql('a', {'u': 'u'}, 'u')} AS a
    FROM b JOIN w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.i = b.i)),
best AS (SELECT conv_id, z.c AS cost, z.s AS audit FROM b WHERE i = 0),
walk AS (SELECT conv_id, audit, 1 AS k, 1 AS i, 'z' AS q, CAST('' AS VARCHAR) AS line, false AS made FROM best
  UNION ALL SELECT walk.conv_id, audit, k + 1, walk.i + CASE WHEN e = 'I' THEN 0 ELSE 1 END,
    CASE WHEN e = 'D' THEN q WHEN e = 'K' THEN substr(role, 1, 1) WHEN q = 'u' THEN 'a' ELSE 'u' END,
    CASE e WHEN 'K' THEN role || ':' || text WHEN 'D' THEN '' WHEN 'R' THEN CASE WHEN q = 'u' THEN 'assistant:' ELSE 'user:' END || text ELSE CASE WHEN q = 'u' THEN 'assistant:' ELSE 'user:' END END, e <> 'D'
  FROM (SELECT *, substr(audit, k, 1) AS e FROM walk WHERE k <= length(audit)) walk LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM walk.conv_id AND r.i = walk.i),
h AS (SELECT conv_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (made), '')) AS repaired_sha256 FROM walk GROUP BY 1)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM a.conv_id""")
def op12_auction_repair(spark, sf):
    """Conversations with rows dropped, emptied, stripped of their stops, repeated or given to the user, by a hash of conversation and turn."""
    space, conv = F.lit(" "), table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(place.cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conv.filter(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"), text.alias("text"),
                                         F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_")).drop("_")
    told = repair.digest(repair.repair(rows))
    all_ids = conv.select("conv_id").distinct()
    none = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return join_equal(all_ids, told, ["conv_id"], "left").withColumns({**none, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))})


_FOLD = "list_reduce({path}, lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN substr(x, 2) || a ELSE a || substr(x, 2) END))"
_STEP = "CASE WHEN b.hash IS NULL THEN 'A' WHEN b.j < a.j THEN 'L' || b.hash ELSE 'R' || b.hash END"


@query("op13_postorder_manifest", f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf, CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} END AS forged FROM documents),
leaves AS (SELECT *, row_number() OVER w - 1 AS i FROM d WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
tree AS (SELECT coalesce(lang, '') AS lang, lang IS NULL AS none, 0 AS h, i AS j, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL SELECT lang, none, h + 1, j // 2, sha256(string_agg(hash, '' ORDER BY j)), (max(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, none, h, j // 2),
tops AS (SELECT lang, none, hash, row_number() OVER (ORDER BY none DESC, lang) - 1 AS i FROM tree WHERE n = 1),
crown AS (SELECT 0 AS h, i AS j, hash, count(*) OVER () AS n FROM tops
  UNION ALL SELECT h + 1, j // 2, sha256(string_agg(hash, '' ORDER BY j)), (max(n) + 1) // 2 FROM crown WHERE n > 1 GROUP BY h, j // 2),
low AS (SELECT l.doc_id, l.lang, l.i, list({_STEP} ORDER BY a.h) AS path FROM leaves l
  JOIN tree a ON a.lang = coalesce(l.lang, '') AND a.none = (l.lang IS NULL) AND a.n > 1 AND a.j = l.i // CAST(2 ** a.h AS BIGINT)
  LEFT JOIN tree b ON b.lang = a.lang AND b.none = a.none AND b.h = a.h AND b.j = xor(a.j, 1) GROUP BY 1, 2, 3),
high AS (SELECT t.i, list({_STEP} ORDER BY a.h) AS path FROM tops t JOIN crown a ON a.n > 1 AND a.j = t.i // CAST(2 ** a.h AS BIGINT)
  LEFT JOIN crown b ON b.h = a.h AND b.j = xor(a.j, 1) GROUP BY 1),
p AS (SELECT l.doc_id, l.leaf, l.forged, t.hash AS subroot, list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path FROM leaves l
  JOIN tops t ON t.lang = coalesce(l.lang, '') AND t.none = (l.lang IS NULL)
  LEFT JOIN low ON low.i = l.i AND low.lang IS NOT DISTINCT FROM l.lang LEFT JOIN high ON high.i = t.i),
f AS (SELECT *, (SELECT hash FROM crown WHERE n = 1) AS root, sha256(array_to_string(list_transform(path, lambda x: substr(x, 2)), '')) AS proof_sha256,
  {_FOLD.format(path='list_concat([coalesce(forged, leaf)], path)')} AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f""")
def op13_postorder_manifest(spark, sf):
    """Parts are languages; the rows checked are those as stored, some with a wrong number of characters."""
    docs = table(spark, sf, "documents")
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    wrong = [*own[:3], F.col("n_chars") + 1, own[4]]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select(F.col("lang").alias("part"), F.col("doc_id").alias("id"), manifest.leaf_hash(*own).alias("leaf"), F.when(hit, manifest.leaf_hash(*wrong)).alias("forged"))
    return manifest.check(manifest.build_manifest(rows)).withColumnRenamed("id", "doc_id")
