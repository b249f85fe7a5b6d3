import itertools
import zlib
from collections import defaultdict

import pytest

from vcat.llm import reshard


def test_flow_is_cheapest():
    cost = [[0, 3, 5], [2, 0, 1], [4, 4, 0]]
    flow = reshard.min_cost_flow([4, 3, 2], [3, 3, 3], lambda i, j: cost[i][j])
    assert [sum(a for i, _, a in flow if i == k) for k in range(3)] == [4, 3, 2]
    best = min(sum(x[i][j] * cost[i][j] for i in range(3) for j in range(3)) for x in _all([4, 3, 2], [3, 3, 3]))
    assert sum(cost[i][j] * a for i, j, a in flow) == best
    with pytest.raises(ValueError):
        reshard.min_cost_flow([5], [4], lambda i, j: 0)


def _all(supply, capacity):
    def rows(s):
        return [(a, b, s - a - b) for a in range(s + 1) for b in range(s + 1 - a)]

    return [x for x in itertools.product(*map(rows, supply)) if all(sum(r[j] for r in x) <= capacity[j] for j in range(3))]


def test_only_surplus_moves():
    moves = reshard.plan_transfers({0: 100, 1: 10, -1: 10}, 3)
    assert sum(a for i, j, a in moves if i == j) == 50


def test_equal_bytes_gapless_slots_nulls_and_repeats(docs):
    rows = [(i % 300 if i % 50 else None, None if i % 41 == 0 else "é" * (i % 97), 0 if i % 3 else [None, 7, 99, 2][i % 4]) for i in range(2000)]
    out = reshard.reshard_plan(docs(rows, "doc_id long, text string, old_shard int"), 8, block_rows=50).collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in out:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(out) == 2000 and set(size) == set(range(8))
    assert max(size.values()) - min(size.values()) < 2 * 200
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in out) == sorted(
        (-1 if d is None else d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in rows)


def test_empty_table_and_written_files(spark, docs, tmp_path):
    assert reshard.reshard_plan(docs([], "doc_id long, text string, old_shard int"), 4).count() == 0
    d = docs([(i, "x" * 20, 0 if i < 90 else 1) for i in range(100)], "doc_id long, text string, old_shard int")
    reshard.reshard(d, str(tmp_path / "o"), 2)
    back = spark.read.parquet(str(tmp_path / "o"))
    assert back.filter("_from = 0").count() == 90 and back.filter("_from = 1").count() == 0  # nothing leaves shard 1
