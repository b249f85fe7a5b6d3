"""Merkle roll-up: the hash of a parent is md5 over the sorted, concatenated hashes of its children.

md5 reads its input strictly in order, so one parent's hash can not be combined from partial hashes.
What can be spread over the cluster is the sorting and the concatenation, and that is what happens
here, with no limit on the number of children:

1. rows are range-partitioned by (parent, hash, tie-break) and sorted, so that a parent holding a
   large share of all rows covers many partitions instead of one task;
2. each Arrow batch of sorted rows hashes the parents that lie wholly inside it, straight from the
   Arrow string buffer, and passes on one concatenated piece for the parent at each edge;
3. only those pieces are brought together by parent, in sorted order, and streamed through md5.

Memory is bounded by one Arrow batch in every step. NULL and empty hashes add nothing; a parent whose
children are all empty gets the empty string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.functions.exprs import pack_hash, unpack_hash

EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"

_OUT = [
    T.StructField("_hash", T.StringType()),
    T.StructField("_lo", T.StringType()),
    T.StructField("_hi", T.StringType()),
    T.StructField("_piece", T.StringType()),
]


def _run_starts(table: pa.RecordBatch, n_keys: int) -> list[int]:
    """Row numbers at which a new parent begins."""
    n = table.num_rows
    if n == 1:
        return [0]
    new = None
    for i in range(n_keys):
        a, b = table.column(i).slice(0, n - 1), table.column(i).slice(1)
        step = pc.if_else(
            pc.or_(pc.is_null(a), pc.is_null(b)),
            pc.xor(pc.is_null(a), pc.is_null(b)),
            pc.fill_null(pc.not_equal(a, b), False),
        )
        new = step if new is None else pc.or_(new, step)
    return [0] + (pc.indices_nonzero(new).to_numpy() + 1).tolist()


def _offsets_and_bytes(col: pa.Array):
    n, start = len(col), col.offset
    fmt = "q" if pa.types.is_large_string(col.type) else "i"
    offsets = memoryview(col.buffers()[1]).cast(fmt)[start:start + n + 1]
    data = col.buffers()[2]
    return offsets, memoryview(data) if data is not None else memoryview(b"")


def _hash_batches(n_keys: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts = _run_starts(batch, n_keys)
            offsets, data = _offsets_and_bytes(batch.column(n_keys))
            ends = starts[1:] + [batch.num_rows]
            last = len(starts) - 1
            hashes, lows, highs, pieces = [], [], [], []
            for i, (a, b) in enumerate(zip(starts, ends)):
                raw = data[offsets[a]:offsets[b]]
                if 0 < i < last:
                    hashes.append(hashlib.md5(raw).hexdigest() if len(raw) else "")
                    lows.append(None), highs.append(None), pieces.append(None)
                else:
                    hashes.append(None)
                    lows.append(str(data[offsets[a]:offsets[a + 1]], "utf-8"))
                    highs.append(str(data[offsets[b - 1]:offsets[b]], "utf-8"))
                    pieces.append(str(raw, "utf-8"))
            keys = [batch.column(i).take(pa.array(starts, pa.int64())) for i in range(n_keys)]
            texts = [pa.array(x, pa.string()) for x in (hashes, lows, highs, pieces)]
            arrays = [a.cast(f.type) for a, f in zip(keys + texts, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def _fold_batches(n_keys: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, md5, filled = None, None, False

        def closed():
            cols = [pa.array([k], f.type) for k, f in zip(key, schema)]
            cols.append(pa.array([md5.hexdigest() if filled else ""], pa.string()))
            return pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            whole = batch.filter(pc.is_valid(batch.column(n_keys)))
            if whole.num_rows:
                arrays = [whole.column(i).cast(schema.field(i).type) for i in range(n_keys + 1)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            part = batch.filter(pc.is_null(batch.column(n_keys)))
            done = []
            for row in range(part.num_rows):
                k = tuple(part.column(i)[row].as_py() for i in range(n_keys))
                if k != key:
                    if key is not None:
                        done.append(closed())
                    key, md5, filled = k, hashlib.md5(), False
                text = part.column(n_keys + 3)[row].as_py()
                if text:
                    md5.update(text.encode())
                    filled = True
            if done:
                table = pa.Table.from_batches(done).combine_chunks()
                yield from table.to_batches()
        if key is not None:
            yield closed()

    return run


def merkle_rollup(df: DataFrame, keys: list[str], h: str | Column, out: str = "hash",
                  tiebreak: list[str] | None = None) -> DataFrame:
    """One row per ``keys`` with the Merkle hash of its rows' ``h``.

    ``tiebreak`` columns (say the child's key) spread equal hashes of one parent over several
    partitions; their order has no influence on the result.
    """
    h = F.col(h) if isinstance(h, str) else h
    extra = [c for c in (tiebreak or []) if c not in keys]
    # Hashes and tie-breaks are shuffled as narrow columns, in the order of the texts.
    narrow = df.select(*keys, pack_hash(F.coalesce(h, F.lit(""))).alias("_p"), *([F.xxhash64(*extra).alias("_t")] if extra else []))
    text = unpack_hash("_p")
    spread = narrow.repartitionByRange(*keys, text, *(["_t"] if extra else []))
    placed = spread.select(*keys, text.alias("_h")).sortWithinPartitions(*keys, "_h")

    key_fields = [narrow.schema[k] for k in keys]
    mid = T.StructType(key_fields + _OUT)
    end = T.StructType(key_fields + [T.StructField(out, T.StringType())])
    arrow = lambda s: pa.schema([(f.name, _arrow_type(f.dataType)) for f in s.fields])
    hashed = placed.mapInArrow(_hash_batches(len(keys), arrow(mid)), mid)
    gathered = hashed.repartition(*keys).sortWithinPartitions(*keys, "_lo", "_hi")
    return gathered.mapInArrow(_fold_batches(len(keys), arrow(end)), end)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def merkle_by_source(df: DataFrame, keys: list[str], hashes: dict[str, Column], out: str = "hashes",
                     tiebreak: list[str] | None = None) -> DataFrame:
    """Several Merkle hashes per parent in one pass: a struct column with one field per entry."""
    names = list(hashes)
    slots = F.array(*[
        F.struct(F.lit(n).alias("_slot"), F.coalesce(h, F.lit("")).alias("_v")) for n, h in hashes.items()
    ])
    extra = [c for c in (tiebreak or []) if c not in keys]
    tall = df.select(*keys, *extra, F.inline(slots))
    # Only one slot has to keep its empty rows, so that every parent is present.
    tall = tall.filter((F.col("_slot") == names[-1]) | (F.col("_v") != ""))
    rolled = merkle_rollup(tall, [*keys, "_slot"], "_v", "_m", extra)
    pick = [F.coalesce(F.max(F.when(F.col("_slot") == n, F.col("_m"))), F.lit("")).alias(n) for n in names]
    return rolled.groupBy(*keys).agg(*pick).select(*keys, F.struct(*names).alias(out))


def merkle_live(h: Column, redacted: Column) -> Column:
    """Child hash as it enters a roll-up after withdrawal: a withdrawn child adds nothing."""
    return F.when(~redacted, h).otherwise(F.lit(""))
