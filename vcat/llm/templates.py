"""Benchmark decontamination by templates (operator 7), with Spark expressions only.

A text becomes a row of tokens in which numbers, units behind numbers and names (capitalised words within a
sentence; words in capitals throughout are words like others) are typed placeholders and
everything else is a lower-case word. Windows of ``width`` tokens are hashed and joined with those of the benchmark, so that a question
with other numbers or names is met too. On one diagonal (offset between text and item) the slots are compared: a value of the item that stands
for two values of the text, or two values for one, isn't a renaming, and such windows don't count.

A document leaks an item if ``least`` windows of a diagonal count, or all windows of an item that has fewer. Windows of which more than half are
placeholders say nothing and are not used. A text of fewer than ``width`` tokens is one window. An item of fewer is also found
word by word inside any text, be it a single word; with other values it is found as a whole text only.

All windows are joined by their words too, values included and letter case not: so copies are found whatever their placeholders and whatever stands
before them, and windows of too many placeholders count for nothing else. The first word of an item is
read both as a word and as a name, as what stands before it in a text decides there.

The windows of the benchmark are joined by hash: broadcast by the planner where they are small, shuffled where not. The document side is not
grouped before the join; only what matches is.

Defined results: null or empty text: no tokens, no leaks. Null ids: the document is told by its text alone. Repeated rows: each of them leaks. Empty benchmark: no
leaks. Other columns are kept by ``remove_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import free_name, let, settle

#: Words that are units behind a number.
UNITS = ("mm cm m km in ft yd mi mg g kg lb oz t ml cl l gal s sec min h hr hrs day days week weeks month months year years hour hours minute minutes second seconds "
         "meter meters metre metres mile miles foot feet inch inches yard yards gram grams kilogram kilograms pound pounds liter liters litre litres percent degrees "
         "dollar dollars euro euros cent cents usd eur gbp mph kmh kb mb gb tb hz khz mhz ghz w kw v").split()
_WHITE = "[ \t\n\x0b\f\r]+"
#: Marks that don't belong to a word at either end.
_MARKS = ".,;:!?\"'`()[]{}<>|*#&%$€£~^_=+-/\\“”‘’«»…–—"
_STOPS = (".", "!", "?", ":")


#: Texts in which this is not found have neither numbers nor names, so nothing but words: no digit, and no capital (or letter of a later Unicode) in
#: any word that doesn't follow a stop.
_PLACEHOLDER = r"[0-9]|(?:^|[^\s.!?:])\s++[^\s\p{IsUppercase}\p{Lt}\p{Cn}]*+[\p{IsUppercase}\p{Lt}\p{Cn}]"


def _clean(text: Column) -> Column:
    # small letters of the capitals, so that "ß" is "ss" as in a copy in capitals; the optimizer would drop F.upper right below F.lower
    return F.lower(F.translate(F.upper(text), _MARKS, ""))


def _literal(text: Column) -> Column:
    """Token hashes of a text that is words throughout."""
    return F.array_remove(F.transform(F.split(_clean(text), _WHITE), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def _typed(text: Column, lead: bool) -> Column:
    """Array of (k, v, w): hash of the canonical token; the value of a placeholder, else null; hash of the word itself. Words of marks alone are
    left out. ``lead``: the first word may be a name too."""
    def one(words: Column, lows: Column, w: Column, i: Column, low: Column) -> Column:
        before = F.get(words, i - 1)
        digits = low.between("0", "9\uffff")
        unit = F.get(lows, i - 1).between("0", "9\uffff") & low.isin(*UNITS)
        core = F.translate(w, _MARKS, "")
        name = ((i > 0) | F.lit(lead)) & (F.lower(core) != core) & (F.upper(core) != core) & ~F.coalesce(F.right(before, F.lit(1)).isin(*_STOPS), F.lit(False))
        kind = F.when(digits, F.lit("<number>")).when(unit, F.lit("<unit>")).when(name, F.lit("<name>"))
        return let(kind, lambda c: F.when(low != "", F.struct(F.xxhash64(F.coalesce(c, low)).alias("k"), F.when(c.isNotNull(), low).alias("v"), F.xxhash64(low).alias("w"))))

    def whole(words: Column, lows: Column) -> Column:
        return F.filter(F.transform(words, lambda w, i: let(F.get(lows, i), lambda low: one(words, lows, w, i, low))), lambda x: x.isNotNull())

    return let(F.split(text, _WHITE), lambda ws: let(F.split(_clean(text), _WHITE), lambda ls: whole(ws, ls)))


def _tokens(df: DataFrame, text: str, *keep: str, lead: bool = False) -> DataFrame:
    """``keep, k, v, w``: token hashes, placeholder values and, null in a text of nothing but words, word hashes, as columns, so that each is computed once."""
    t = F.col(text)
    typed = df.select(*keep, text, F.when(F.lit(lead) | t.rlike(_PLACEHOLDER), _typed(t, lead)).alias("t"))
    words = F.when(t.isNotNull(), _literal(t))
    return typed.select(*keep, F.coalesce(F.col("t.k"), words).alias("k"), F.coalesce("t.v", F.transform(words, lambda _: F.lit(None).cast("string"))).alias("v"), F.col("t.w").alias("w"))


def _hash(k: str, width: int) -> Column:
    """The hash of the ``width`` tokens from ``pos`` on."""
    return F.xxhash64(*(F.get(k, F.col("pos") + j) for j in range(width)))


def _windows(tokens: DataFrame, width: int, shorter: list[int], *keep: str) -> DataFrame:
    """``keep, n, long, pos, h`` of a text of ``n`` tokens: the hash of every window of ``width`` canonical tokens, or of all tokens where they are
    fewer (``long`` is 0), of every window of ``width`` words where that is another one, and of every window of as many words as ``shorter`` lists.

    Places are exploded first and hashed as columns then, in generated code, where lambdas over arrays of hashes would not be. The outer forms, as for the others the
    optimizer adds a filter on the array, which computes it once more."""
    words = F.coalesce("w", "k").alias("_words")
    each = tokens.select(*keep, F.size("k").alias("n"), "k", "w", *([words] if shorter else []), F.posexplode_outer("k").alias("pos", "_k"))
    starts = F.col("pos") + width <= F.col("n")
    whole = F.when(starts, _hash("k", width)).when((F.col("pos") == 0) & (F.col("n") < width), F.xxhash64("k"))
    each = each.withColumn("_whole", whole)
    literal = F.when(starts & F.col("w").isNotNull(), _hash("w", width))
    both = F.array(F.col("_whole"), F.nullif(literal, F.col("_whole")), *(F.when(F.col("pos") + s <= F.col("n"), _hash("_words", s)) for s in shorter))
    hashes = both if shorter else F.when(F.col("w").isNull(), F.array("_whole")).otherwise(both)
    laid = each.select(*keep, "n", "pos", F.posexplode_outer(hashes).alias("_i", "h")).filter("h IS NOT NULL")
    if not shorter:
        return laid.select(*keep, "n", (F.col("_i") * width).alias("long"), "pos", "h")
    return laid.select(*keep, "n", F.get(F.array(*map(F.lit, [0, width, *shorter])), F.col("_i")).alias("long"), "pos", "h")


def _slots(v: str, pos: str, width: int) -> Column:
    """(place, value) of the placeholders of a window."""
    inside = F.transform(F.slice(v, F.col(pos) + 1, width), lambda x, j: F.struct(j.alias("at"), x.alias("value")))
    return F.filter(inside, lambda x: x["value"].isNotNull())


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 8, least: int = 5) -> DataFrame:
    """``doc_id, text_hash, item_id, windows, item_windows, slots_agree`` of every document and item that share a diagonal; ``leaks`` says
    whether it is enough."""
    # nothing but marks before the first token, so that it is the first word
    texts = benchmark.filter("text IS NOT NULL").select("item_id", F.ltrim("text", F.lit(_MARKS + " \t\n\x0b\f\r")).alias("text")).distinct()
    texts = texts.withColumn("text_no", F.xxhash64("item_id", "text"))  # two texts of one item are told apart
    own = ["item_id", "text_no"]
    numbered = settle(_tokens(texts, "text", *own), "items")
    shorter = sorted(r.n for r in numbered.select(F.size("k").alias("n")).filter((F.col("n") > 0) & (F.col("n") < width)).distinct().collect())
    slotted = _slots("v", "pos", width).alias("item_slots")
    item = _windows(numbered, width, shorter, *own, "v").filter(~F.col("long").isin(*shorter) | (F.col("long") == F.col("n")))
    item = item.select(*own, "n", "long", F.lit(False).alias("lead"), F.col("pos").alias("item_pos"), "h", slotted)
    # the first word is a name where the text before it ends in no stop
    named = _windows(_tokens(texts, "text", *own, lead=True), width, [], *own, "v").filter("long = 0 AND pos = 0")
    item = item.unionByName(named.select(*own, "n", "long", F.lit(True).alias("lead"), F.col("pos").alias("item_pos"), "h", slotted))
    item = item.withColumn("typed", F.col("long") == 0).withColumn("exact", ~F.col("typed") | (F.size("item_slots") == 0))
    item = settle(item.filter(~F.col("typed") | (F.size("item_slots") * 2 <= F.least(F.lit(width), "n"))), "windows")
    sizes = item.groupBy(*own, F.greatest(F.col("n") - (width - 1), F.lit(1)).alias("item_windows")).agg(F.count_distinct(F.when(F.col("typed"), F.col("item_pos"))).alias("typed_windows"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    hit = settle(_windows(_tokens(texts, "text", "doc_id", "text_hash"), width, shorter, "doc_id", "text_hash").select("doc_id", "text_hash", "pos", "h").join(item.drop("item_slots", "n"), "h").select(
        "doc_id", "text_hash", "text_no", "pos", "item_pos", "lead", "typed", "exact", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct(), "hits")
    # only texts that met a window with placeholders are looked at again
    slotted = item.filter("NOT exact").select("text_no", "item_pos", "lead", "item_slots").distinct()
    renamed = hit.filter("NOT exact")
    asked = settle(renamed.select("doc_id", "text_hash").distinct(), "asked")
    values = _tokens(_same(texts, asked, ["doc_id", "text_hash"], "left_semi").distinct(), "text", "doc_id", "text_hash").select("doc_id", "text_hash", "v")
    met = settle(_same(renamed.join(slotted, ["text_no", "item_pos", "lead"]), values, ["doc_id", "text_hash"], "inner").withColumn("slots", _slots("v", "pos", width)).drop("v"), "met")
    line = ["doc_id", "text_hash", "text_no", "diagonal"]
    pair = F.explode(F.arrays_zip("slots", "item_slots")).alias("p")
    slots = met.filter(F.size("slots") > 0).select(*line, "pos", "item_pos", pair).select(*line, "item_pos", F.col("p.slots.value").alias("mine"), F.col("p.item_slots.value").alias("own"))
    # values of one diagonal that don't go one to one
    two = slots.groupBy(*line, "own").agg(F.count_distinct("mine").alias("n")).filter("n > 1").select(*line, F.col("own").alias("value"), F.lit("own").alias("side"))
    back = slots.groupBy(*line, "mine").agg(F.count_distinct("own").alias("n")).filter("n > 1").select(*line, F.col("mine").alias("value"), F.lit("mine").alias("side"))
    bad = two.unionByName(back)
    both = slots.select(*line, "item_pos", F.col("own").alias("value"), F.lit("own").alias("side")).unionByName(
        slots.select(*line, "item_pos", F.col("mine").alias("value"), F.lit("mine").alias("side")))
    off = _same(both, bad, [*line, "value", "side"], "left_semi").select(*line, "item_pos").distinct()
    counted = _same(hit, off.withColumn("off", F.lit(True)), [*line, "item_pos"], "left")
    fits = F.col("off").isNull()
    lines = counted.groupBy(*line).agg(
        F.count_distinct(F.when(F.col("exact") | fits, F.col("item_pos"))).alias("windows"), F.count_distinct(F.when(F.col("typed") & fits, F.col("item_pos"))).alias("typed_met"),
        F.max(F.coalesce("off", F.lit(False))).alias("some_off"))
    # windows of too many placeholders don't raise the bar for a text with other values
    enough = (F.col("windows") >= F.least(F.lit(least), "item_windows")) | ((F.col("typed_windows") > 0) & (F.col("typed_met") >= F.least(F.lit(least), "typed_windows")))
    return lines.join(sizes, "text_no").groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("windows").alias("windows"), F.max_by("item_windows", "windows").alias("item_windows"), (~F.min("some_off")).alias("slots_agree"), F.max(enough).alias("leaks"))


def _same(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on equal columns, nulls being equal, with the left side's columns and the right side's others."""
    names = {c: f"_r_{i}" for i, c in enumerate(on)}
    right = right.withColumnsRenamed(names)
    cond = F.lit(True)
    for c, r in names.items():
        cond = cond & left[c].eqNullSafe(right[r])
    return left.join(right, cond, how).drop(*names.values()) if how != "left_semi" else left.join(right, cond, how)


def judge(docs: DataFrame, benchmark: DataFrame, width: int = 8, least: int = 5) -> DataFrame:
    """A row per document: ``doc_id, contaminated, n_items`` leaked, the smallest ``item_id`` of them, the most ``windows`` that one of them counts."""
    leaks = find_leaks(docs, benchmark, width, least).filter("leaks").groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_items"), F.min("item_id").alias("item_id"), F.max("windows").alias("windows"))
    told = _same(docs.select("doc_id", F.xxhash64("text").alias("text_hash")), leaks, ["doc_id", "text_hash"], "left")
    return told.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", F.coalesce("windows", F.lit(0)).alias("windows"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 8, least: int = 5) -> DataFrame:
    """``docs`` without those that leak an item."""
    leaks = find_leaks(docs.select("doc_id", "text"), benchmark, width, least).filter("leaks").select("doc_id", "text_hash").distinct()
    leaks = settle(leaks, "leaks")
    key = free_name(docs, "_text_hash")
    mine = docs.withColumn(key, F.xxhash64("text"))
    gone = leaks.toDF("_leak_id", "_leak_hash")
    return mine.join(gone, mine["doc_id"].eqNullSafe(gone["_leak_id"]) & mine[key].eqNullSafe(gone["_leak_hash"]), "left_anti").drop(key)
