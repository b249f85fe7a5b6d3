"""SQL text shared by the oracles: the same fixtures written as common table expressions, independent
of the level and edge tables (the flattened rows come from joins on natural keys)."""

from __future__ import annotations


def uuid(level: str, key: str, rev: str) -> str:
    h = f"md5('{level}|' || ({key}) || '|' || ({rev}))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12))")


def content(rev: str) -> str:
    return ("md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, size, "
            f"CASE WHEN chg AND {rev} = 2 THEN 'r' END))")


def merkle(h: str) -> str:
    return f"coalesce(CASE WHEN string_agg({h}, '') = '' THEN '' ELSE md5(string_agg({h}, '' ORDER BY {h})) END, '')"


ALIVE = "({a}_rev <= {v} AND ({v} <= {a}_final OR {a}_final = 0))"

ITEMS = """items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus,
    concat_ws('.', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS sop,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS size,
    (l_orderkey % 10 <> 7 AND NOT (l_orderkey % 10 = 1 AND l_linenumber = 1)) AS p1,
    (l_orderkey % 10 <> 3) AS p2, (l_orderkey % 10 = 5) AS chg, (l_quantity = 50) AS excluded,
    CASE WHEN l_orderkey % 2 = 0 THEN 'src_a' ELSE 'src_b' END AS source,
    ((l_linenumber = 2 AND l_orderkey % 20 IN (0, 5)) OR l_orderkey % 100 = 40) AS red
  FROM lineitem)"""


def spans(base: str, p1: str, p2: str, chg: str, a: str) -> str:
    rows = [(f"{p1} AND {p2} AND {chg}", 1, 1, 1), (f"{p1} AND {p2} AND {chg}", 1, 2, 0),
            (f"{p1} AND {p2} AND NOT {chg}", 1, 1, 0), (f"{p1} AND NOT {p2}", 1, 1, 1),
            (f"NOT {p1} AND {p2}", 2, 2, 0)]
    return " UNION ALL ".join(
        f"SELECT *, {x} AS {a}_init, {y} AS {a}_rev, {z} AS {a}_final FROM {base} WHERE {w}" for w, x, y, z in rows)


INST = f"inst AS (SELECT *, {content('i_rev')} AS hash, {uuid('instance', 'sop', 'i_rev')} AS i_uuid FROM ({spans('items', 'p1', 'p2', 'chg', 'i')}))"
SER = ("ser AS (SELECT *, " + uuid("series", "o_orderkey", "se_rev") + " AS se_uuid, '10.5281/d.' || (o_orderkey % 40) AS doi, "
       "o_orderkey % 40 AS k FROM ("
       + spans("orders", "(o_orderkey % 10 <> 7)", "(o_orderkey % 10 <> 3)", "(o_orderkey % 10 IN (1, 5))", "se") + "))")

FLAT = f"""flat AS (
  SELECT v.version, r_regionkey, r_name AS collection_id, n_nationkey, n_name AS submitter_case_id, c_custkey,
    'st.' || c_custkey AS study_instance_uid, o_orderkey, 'se.' || o_orderkey AS series_instance_uid,
    sop AS sop_instance_uid, se_uuid, i_uuid, {uuid('study', 'c_custkey', 'v.version')} AS st_uuid,
    {uuid('patient', 'n_nationkey', 'v.version')} AS p_uuid, {uuid('collection', 'r_regionkey', 'v.version')} AS c_uuid,
    v.version AS up_rev, CASE WHEN v.version = 1 THEN 1 ELSE 0 END AS up_final,
    se_init, se_rev, se_final, i_init, i_rev, i_final, doi AS source_doi, 'https://doi.org/' || doi AS source_url,
    doi || '.v' || se_rev AS versioned_source_doi, k, hash AS i_hash, size AS i_size, source AS i_source,
    excluded AS i_excluded, red, l_linenumber, l_orderkey
  FROM (VALUES (1), (2)) v(version)
  JOIN inst ON {ALIVE.format(a='i', v='v.version')}
  JOIN ser ON o_orderkey = l_orderkey AND {ALIVE.format(a='se', v='v.version')}
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""

TYPE = "CASE WHEN k % 4 = 1 THEN 'Cr' WHEN k % 4 = 2 THEN 'Defaced' ELSE 'Open' END"
ACCESS = "CASE WHEN k = 0 THEN 'Limited' WHEN k = 1 THEN 'Excluded' ELSE 'Public' END"
SUNSET = "CASE WHEN k = 2 THEN 1 ELSE 0 END"
DEV = "CASE WHEN k % 4 = 1 THEN 'arch-cr' WHEN k % 4 = 2 THEN 'arch-defaced' ELSE 'arch-open' END"
GCS = "CASE WHEN k % 4 = 1 THEN 'open-cr' WHEN k % 4 = 2 THEN 'open-defaced' ELSE 'open-data' END"
AWS = "CASE WHEN k % 4 = 1 THEN 'open-data-cr' WHEN k % 4 = 2 THEN 'open-data-two' ELSE 'open-data' END"

JOINED = f"""joined AS (SELECT *, i_source AS source, {TYPE} AS type, {ACCESS} AS access, {SUNSET} AS metadata_sunset,
    (k % 10 = 8) AS analysis_result, {DEV} AS dev_bucket, {GCS} AS pub_gcs_bucket, {AWS} AS pub_aws_bucket FROM flat)"""
PUBLIC = "public_rows AS (SELECT * FROM joined WHERE access = 'Public' AND NOT i_excluded)"
CURRENT = "current_rows AS (SELECT * FROM public_rows WHERE version = 2 AND metadata_sunset = 0)"
LICENSES = """licenses AS (SELECT '10.5281/d.' || i AS source_doi, 'https://lic/' || (i % 3) AS license_url,
    'License ' || (i % 3) AS license_long_name, 'L' || (i % 3) AS license_short_name FROM range(40) t(i) WHERE i <> 9)"""

_ORDER = [("items", ITEMS, []), ("inst", INST, ["items"]), ("ser", SER, []), ("flat", FLAT, ["inst", "ser"]),
          ("joined", JOINED, ["flat"]), ("public_rows", PUBLIC, ["joined"]), ("current_rows", CURRENT, ["public_rows"]),
          ("licenses", LICENSES, [])]


def with_(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding the named fixtures and what they depend on."""
    need = set()

    def add(n):
        need.add(n)
        for name, _, deps in _ORDER:
            if name == n:
                for d in deps:
                    add(d)

    for n in names:
        add(n)
    parts = [text for name, text, _ in _ORDER if name in need] + ([extra] if extra else [])
    return "WITH " + ",\n".join(parts) + "\n"
