"""Chat formatting with Spark expressions only (operator 5).

Turns are collected as structs and sorted; every turn becomes one string piece by looking at its
neighbour in the array, so that adjacent turns of one role share a block; the pieces are concatenated.
All array work is linear in the number of turns. A conversation is one cell by definition.

Template of a block: ``<|im_start|>`` role newline text (``<|im_sep|>`` text)* ``<|im_end|>`` newline.
A text can't hold a control string after escaping: in ``<``, any backslashes, ``|`` one backslash more is
put before the bar. In a role, ``%`` and newline are written ``%25`` and ``%0A`` as well.

Defined results: null role, text: empty. Null turn numbers come first; ties go by role, then text; repeated
rows are repeated turns. Null ``conv_id``: one conversation of its own. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import let

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
START_RE, SEP_RE, END_RE = r"<\|im_start\|>", r"<\|im_sep\|>", "<\\|im_end\\|>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", "<$1|")


def _escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chat(conversations: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and its loss mask ``runs``, an array of (chars, loss) that covers
    the formatted text from start to end: before each text the run of its markup, then the run of the text, at last the closing."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def piece(all_turns: Column, t: Column, i: Column) -> Column:
        same = (i > 0) & (F.get(all_turns, i - 1)["role"] == t["role"])
        opening = F.concat(F.when(i > 0, END).otherwise(""), F.lit(START), _escape_role(t["role"]), F.lit("\n"))
        return F.struct(F.when(same, SEP).otherwise(opening).alias("markup"), escape(t["text"]).alias("text"),
                        t["role"].isin(*loss_roles).alias("loss"))

    def runs(p: Column) -> Column:
        return F.array(F.struct(F.char_length(p["markup"]).alias("chars"), F.lit(False).alias("loss")),
                       F.struct(F.char_length(p["text"]).alias("chars"), p["loss"].alias("loss")))

    closing = F.array(F.struct(F.lit(len(END)).alias("chars"), F.lit(False).alias("loss")))
    pieces = turns.select("conv_id", let(F.col("turns"), lambda ts: F.transform(ts, lambda t, i: piece(ts, t, i))).alias("pieces"))
    return pieces.select(
        "conv_id",
        F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["markup"], p["text"])), ""), F.lit(END)).alias("formatted"),
        F.concat(F.flatten(F.transform("pieces", runs)), closing).alias("runs"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text, loss), read back from ``formatted`` and its mask: blocks are split at their ends, texts at the
    separators; the mask has every second run for a text, in the same order."""
    def block(b: Column) -> Column:
        inner = F.substr(b, F.lit(len(START) + 1))
        role = F.substring_index(inner, "\n", 1)
        texts = F.split(F.substr(inner, F.char_length(role) + 2), SEP_RE)
        return F.transform(texts, lambda t: F.struct(_unescape_role(role).alias("role"), t.alias("raw")))

    blocks = F.split("formatted", END_RE)
    found = F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), block))

    def with_mask(runs: Column, t: Column, i: Column) -> Column:
        run = F.get(runs, 2 * i + 1)
        return F.struct(t["role"].alias("role"), unescape(t["raw"]).alias("text"), (run["loss"] & (run["chars"] == F.char_length(t["raw"]))).alias("loss"))

    turns = let(F.col("runs"), lambda runs: F.transform(found, lambda t, i: with_mask(runs, t, i)))
    return formatted.select("conv_id", "formatted", turns.alias("turns"))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Digests of what is read back."""
    back = read_chat(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    cols = back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), loss.alias("loss"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
    return cols.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
