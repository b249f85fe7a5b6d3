"""Registered queries against their oracle. A fast selection runs by default; VCAT_ALL=1 runs all."""

import os
import re

import pytest
from conftest import SF

import __spark_entry__ as entry

QUICK = [
    "a1_merkle_rollup", "a3_series_hash", "a7_redacted_merkle", "d2_merkle", "f5_norm_url", "f9_sig2", "f17_links_to_text",
    "f18_links_to_modal", "f21_reform_case", "f22_parse_options", "j1_all_flattened", "j3_all_sources", "v1_classify",
    "v3_existence", "v4_skip_mask", "v5_v6_apply_version", "v8_retire", "v15_rollback", "v15_rollback_named",
    "v16_upsert_instances", "v17_delete_instances", "v18_reroll", "m2_series_rollup", "m7_delete_redacted", "x5_bundle_manifest",
    "x7_series_objects", "q3_listing_diff", "q7_diff_tables", "q8_diff_rows", "q9_compare_hash_trees", "n4_measurement_groups",
    "n5_qualitative_strict", "n6_quantitative", "n7_segmentations", "n13_curated_series", "n14_collection_metadata", "c1_read_clinical",
    "c5_profile", "c7_table_metadata", "s2_file_manifest", "s12_publish_dataset", "t1_ingest_manifests", "q13_metadata_agreement",
]
NAMES = sorted(n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)) if os.environ.get("VCAT_ALL") else QUICK


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, cur.fetchall())


def test_every_query_has_an_oracle():
    own = {n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)}  # the optional ones have tests of their own
    assert own <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 5
