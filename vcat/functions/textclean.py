"""Text clean-up of descriptions and of the option strings found in data dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vcat.functions.exprs import _c

# An anchor: its url stands between equal quotes ($1), as $2, its content is $3.
_ANCHOR = r"""(?is)<a\s[^>]*?href=(["'])URL\1[^>]*>(.*?)</a>"""
_LINK = _ANCHOR.replace("URL", "(.*?)")
_LINK_NOT_GOV = _ANCHOR.replace("URL", r"((?:(?!\1|\.gov).)*)")
# Fixed value: markup of the warning dialogue.
_MODAL = (
    '<a  href="" url="$2" data-toggle="modal" data-target="#external-web-warning" class="external-link">'
    '$3<i class="fa-solid fa-external-link external-link-icon" aria-hidden="true"></i></a>'
)


def links_to_text(c) -> Column:
    """``<a href="u">t</a>`` becomes ``t (u)``."""
    return F.regexp_replace(_c(c), _LINK, r"$3 ($2)")


def links_to_modal(c) -> Column:
    """Links open a warning dialogue first, except those to .gov sites."""
    return F.regexp_replace(_c(c), _LINK_NOT_GOV, _MODAL)


def clean_lines(c) -> Column:
    """Drop Markdown link brackets, bold marks, empty lines and escape characters."""
    text = F.replace(F.replace(F.replace(_c(c), F.lit("["), F.lit("")), F.lit("]"), F.lit(" ")), F.lit("**"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    return F.replace(F.array_join(lines, "\n"), F.lit("\\"), F.lit(""))


# How a dictionary writes its option list. form: (separator of options, separator of
# code and description), both regular expressions.
OPTION_FORMS = {
    "colorectal": (r"[|,]\s*(?![^()]*\))", " - "),
    "ispy2": ("\n", ":"),
    "lidc": ("\n", "="),
    "assign": (",", "="),
}


def parse_options(c, form: str) -> Column:
    """Option text to an array of (option_code, option_description)."""
    sep, inner = OPTION_FORMS[form]
    opts = F.transform(F.split(_c(c), sep), lambda x: F.trim(x))
    if form == "lidc":
        opts = F.filter(opts, lambda x: F.contains(x, F.lit("=")))
    opts = F.filter(opts, lambda x: x != "")
    return F.transform(opts, lambda o: F.struct(
        F.trim(F.get(F.split(o, inner), F.lit(0))).alias("option_code"),
        F.trim(F.get(F.split(o, inner), F.lit(1))).alias("option_description")))


def expand_range(df: DataFrame, name: str) -> DataFrame:
    """``name1-3`` becomes the three rows name1, name2, name3; other names stay."""
    c = F.col(name)
    ranged = c.rlike("[0-9]-[0-9]$")
    lo = F.when(ranged, F.substring(F.right(c, F.lit(3)), 1, 1).cast("int"))
    hi = F.when(ranged, F.right(c, F.lit(1)).cast("int"))
    root = F.expr(f"left(`{name}`, length(`{name}`) - 3)")
    many = F.transform(
        F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>")),
        lambda j: F.concat(root, j.cast("string")))
    return df.withColumn(name, F.explode(F.when(ranged, many).otherwise(F.array(c))))


def normal_name(c) -> Column:
    """Column-safe name: ``/ - space`` become underscores, other marks go, a leading digit gets ``c_``."""
    x = F.regexp_replace(F.translate(F.trim(_c(c)), "/- ", "___"), "[^a-zA-Z0-9_]", "")
    return F.lower(F.when(x.rlike("^[0-9]"), F.concat(F.lit("c_"), x)).otherwise(x))


# Rule names of the case id reform.
CASE_RULES = (
    "same", "breast", "acrin 6698", "acrin format", "acrin flt format", "cc", "switch dash", "3DCT-RT",
    "ispy", "ispy2", "lung_pt", "add colec", "remind", "ea1141", "upenn-gbm", "spinal",
)


def _pad(c: Column, n: int) -> Column:
    """Left-pad with zeros; longer values are kept (``lpad`` alone would cut them)."""
    return F.lpad(c, F.greatest(F.length(c), F.lit(n)), F.lit("0"))


def reform_case(c, coll, rule) -> Column:
    """Case id as the image side writes it, by the named rule."""
    c, coll = _c(c), _c(coll)
    rule = F.lit(rule) if rule in CASE_RULES else _c(rule)
    parts = F.split(c, "_")
    tail = F.split(F.get(parts, F.lit(1)), "-")
    by_rule = {
        "same": c,
        "breast": F.replace(c, F.lit("BreastDX"), F.lit("BreastDx")),
        "acrin 6698": F.concat(F.lit("ACRIN-6698-"), c),
        "acrin format": F.concat(coll, F.lit("-"), _pad(c, 3)),
        "acrin flt format": F.concat(coll, F.lit("_"), _pad(c, 3)),
        "cc": F.concat(F.get(parts, F.lit(0)), F.lit("-"), F.get(tail, F.lit(0)), _pad(F.get(tail, F.lit(1)), 2)),
        "switch dash": F.replace(c, F.lit("_"), F.lit("-")),
        "3DCT-RT": F.concat(F.lit("HN_P"), _pad(c, 3)),
        "ispy": F.concat(F.lit("ISPY1_"), c),
        "ispy2": F.concat(F.lit("ISPY2-"), c),
        "lung_pt": F.concat(F.lit("Lung_Dx-"), c),
        "add colec": F.concat(coll, F.lit("-"), c),
        "remind": F.concat(F.lit("ReMIND-"), _pad(c, 3)),
        "ea1141": F.concat(F.lit("EA1141-"), c),
        "upenn-gbm": F.substring(c, F.lit(1), F.greatest(F.length(c) - 3, F.lit(0))),
        "spinal": c,
    }
    out = None
    for name, value in by_rule.items():
        out = F.when(rule == name, value) if out is None else out.when(rule == name, value)
    return out
