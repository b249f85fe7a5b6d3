"""Column expressions shared by all operators. Everything here is a built-in Spark expression, so it
stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SOURCES = ("src_a", "src_b")
LIVE = 0  # final version of an object that still exists


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def web_id(c) -> Column:
    """Lower case, with dashes and blanks turned into underscores."""
    return F.translate(F.lower(_c(c)), "- ", "__")


WEB_ID_SQL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION web_id(x STRING) RETURNS STRING "
    "RETURN translate(lower(x), '- ', '__')"
)


def register_functions(spark) -> None:
    """Make ``web_id`` callable from SQL text; Catalyst inlines it."""
    spark.sql(WEB_ID_SQL)


# --- urls -----------------------------------------------------------------------------------------


def object_url(scheme: str, bucket, series, inst=None, ext: str = ".dcm") -> Column:
    """``scheme://bucket/series/`` or ``scheme://bucket/series/inst.dcm``; NULL if any part is NULL."""
    parts = [F.lit(f"{scheme}://"), _c(bucket), F.lit("/"), _c(series), F.lit("/")]
    if inst is not None:
        parts += [_c(inst), F.lit(ext)]
    return F.concat(*parts)


def viewer_url(base: str, study, series) -> Column:
    return F.concat(
        F.lit(base + "?StudyInstanceUIDs="), _c(study), F.lit("&initialSeriesInstanceUID="), _c(series)
    )


def url_part(c, i: int) -> Column:
    return F.get(F.split(_c(c), "/"), F.lit(i))


def url_rest(c) -> Column:
    """The object name: what follows ``scheme://bucket/``."""
    return F.substr(_c(c), F.char_length(F.substring_index(_c(c), "/", 3)) + 2)


def norm_url(c, bucket: str, subdir: str | None = None) -> Column:
    """Full url of a manifest entry, which may be absolute, ``./relative`` or relative to the bucket."""
    c = _c(c)
    prefix = f"gs://{bucket}/"
    rel = F.regexp_replace(c, r"^\./", "")
    if subdir:
        rel = F.concat(F.lit(f"{subdir}/"), rel)
    return F.concat(F.lit(prefix), F.when(c.startswith("gs://"), url_rest(c)).otherwise(rel))


# --- identifiers and hashes -----------------------------------------------------------------------


def doi_number(c) -> Column:
    return F.get(F.split(_c(c), r"\."), F.lit(2)).try_cast("bigint")


def md5_from_b64(c) -> Column:
    return F.lower(F.hex(F.unbase64(_c(c))))


def row_sha(*cols) -> Column:
    """sha256 of a row; NULL cells are marked so that they differ from empty ones."""
    cells = [F.coalesce(_c(c).cast("string"), F.lit("\u0000")) for c in cols]
    return F.sha2(F.concat_ws("\u0001", *cells), 256)


def uuid_sql(level: str, key: str, rev: str) -> str:
    """SQL text of a name-based id, from the SQL text of key and revision."""
    h = f"md5(concat_ws('|', '{level}', {key}, {rev}))"
    parts = ", ".join(f"substring({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat_ws('-', {parts})"


def uuid_of(level: str, key, rev) -> Column:
    """Name-based id of one version of an object. It depends on the object only, so a retried task
    produces the same id."""
    if isinstance(key, str) and isinstance(rev, str):
        return F.expr(uuid_sql(level, key, rev))
    h = F.md5(F.concat_ws("|", F.lit(level), _c(key).cast("string"), _c(rev).cast("string")))
    return F.concat_ws(
        "-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    )


_PAD = 17  # zero bytes after an id that is no uuid, which tell it from the 16 bytes of one that is


_UUID = r"\A[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"


def pack_id(c) -> Column:
    """An id as a narrow key for joins and groups: the 16 bytes of a lower-case uuid, the bytes of any other text with a pad. Different ids have different keys."""
    c = _c(c)
    padded = F.concat(c.cast("binary"), F.lit(bytes(_PAD)))
    return F.coalesce(F.when(c.rlike(_UUID), F.unhex(F.translate(c, "-", ""))), padded)


def unpack_id(c) -> Column:
    """The id of a key made by ``pack_id``."""
    c = _c(c)
    text = F.lower(F.concat_ws("-", *[F.hex(F.substring(c, a, n)) for a, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 6))]))
    return F.when(F.length(c) == 16, text).otherwise(F.substr(c, F.lit(1), F.length(c) - _PAD).cast("string"))


_MD5 = r"\A[0-9a-f]{32}\z"


def pack_hash(c) -> Column:
    """A hash as a narrow column for shuffles: the 16 bytes of a lower-case md5, the bytes of any other text with a pad. Different texts stay different, but not their order."""
    c = _c(c)
    padded = F.concat(c.cast("binary"), F.lit(bytes(_PAD)))
    return F.coalesce(F.when(c.rlike(_MD5), F.unhex(c)), padded)


def unpack_hash(c) -> Column:
    """The text of a hash made by ``pack_hash``."""
    c = _c(c)
    return F.when(F.length(c) == 16, F.lower(F.hex(c))).otherwise(F.substr(c, F.lit(1), F.length(c) - _PAD).cast("string"))


def pack_hashes(df, c: str, name: str) -> list[Column]:
    """The hashes of a struct as narrow plain columns ``name:field``, and whether there is a struct where it may be NULL."""
    there = [F.col(c).isNotNull().alias(f"{name}:")] if df.schema[c].nullable else []
    return [pack_hash(F.col(c)[x]).alias(f"{name}:{x}") for x in df.schema[c].dataType.names] + there


def unpack_hashes(columns: list[str], name: str) -> Column:
    """The struct of the columns made by ``pack_hashes``, which are among ``columns``."""
    made = [c for c in columns if c.startswith(f"{name}:")]
    out = F.struct(*[unpack_hash(c).alias(c[len(name) + 1:]) for c in made if c != f"{name}:"])
    return F.when(F.col(f"{name}:"), out) if f"{name}:" in made else out


# --- code strings ---------------------------------------------------------------------------------


def first(arr) -> Column:
    """First element, NULL for an empty or NULL array."""
    return F.get(_c(arr), F.lit(0))


def head_of(arr) -> Column:
    """Element-wise: the text before the first colon (all of it if there is none)."""
    return F.transform(_c(arr), lambda x: F.substring_index(x, ":", 1))


def tail_of(arr) -> Column:
    """Element-wise: the text after the first colon, NULL if there is none."""
    return F.transform(_c(arr), lambda x: F.when(F.instr(x, ":") > 0, F.regexp_replace(x, "^[^:]*:", "")))


def code_str(a, b, c) -> Column:
    return F.concat(_c(a), F.lit(":"), _c(b), F.lit(":"), _c(c))


def code_part(c, i: int) -> Column:
    return F.get(F.split(_c(c), ":"), F.lit(i))


def code_pair(c) -> Column:
    return F.concat(code_part(c, 0), F.lit(":"), code_part(c, 1))


# --- numbers and lists ----------------------------------------------------------------------------


def sig2(c) -> Column:
    """Round to two significant figures; 0 stays 0. ``round`` needs a constant scale in Spark, so the
    value is scaled to two digits before the point and back."""
    c = _c(c)
    e = F.floor(F.log10(F.abs(c))) - 1
    up, down = F.pow(F.lit(10.0), -e), F.pow(F.lit(10.0), e)
    return F.when(c == 0, F.lit(0.0)).otherwise(
        F.when(e < 0, F.round(c * up) / up).otherwise(F.round(c / down) * down)
    )


def to_gb(size, unit) -> Column:
    size, unit = _c(size).cast("double"), _c(unit)
    gb = F.when(unit == "mb", size / 1024).when(unit == "tb", size * 1024).otherwise(size)
    return F.round(gb, 2)


def join_list(c) -> Column:
    return F.array_join(_c(c), ", ")


# --- version lifespans ----------------------------------------------------------------------------


def alive_at(v, rev="rev_version", final="final_version") -> Column:
    """Closed interval [rev, final], where a final version of 0 is open-ended."""
    v = F.lit(v) if isinstance(v, int) else v
    return (_c(rev) <= v) & ((v <= _c(final)) | (_c(final) == LIVE))


def touched_by(v: int, rev="rev_version", final="final_version") -> Column:
    """The wider predicate used when withdrawing data: also objects that ended before ``v``. A final
    version of 0 satisfies ``final <= v`` too, so every live object matches; results depend on that."""
    return (_c(final) <= v) | alive_at(v, rev, final)


def versions_alive(last: int, rev="rev_version", final="final_version") -> Column:
    """Array of the versions at which a row is alive, up to ``last``: explode it to join lifespans with
    versions without a range join."""
    end = F.least(F.when(_c(final) == LIVE, F.lit(last)).otherwise(_c(final)), F.lit(last))
    return F.when(_c(rev) <= end, F.sequence(_c(rev), end)).otherwise(F.array().cast("array<int>"))


def bucket_for(target: str, version: int, merged: bool, pub="pub_gcs_bucket", rev="se_rev_version",
               source="i_source", collection="collection_id") -> Column:
    """Public bucket, or the staging bucket of a series revised in this version and not yet merged."""
    if target == "pub" or merged:
        return _c(pub)
    staging = F.concat(F.lit(f"v{version}_"), _c(source), F.lit("_"), web_id(collection))
    return F.when(_c(rev) == version, staging).otherwise(_c(pub))
