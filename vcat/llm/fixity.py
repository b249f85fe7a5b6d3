"""Merkle fixity audit of WARC replicas (operator 1).

A record's leaf hash covers its type, offset, length and bytes. Ordered ranges of offsets, not ordinals, are the nodes: a range
of ``leaf`` bytes holds the records that begin in it, and ``fanout`` ranges make the next larger one, up to the archive's root. So a node
has few children whatever the archive's size, a lost record changes its own range only, and an archive with a third of
all rows is as many nodes as its bytes. The audit compares roots, then joins, level by level, only the children of nodes that differ.

Everything is built-in Spark functions; trees are written level by level. Defined results: null payload: empty bytes; its
record still has a hash. Null archive: '', null offset or length: 0. Repeated rows are one leaf with their number, so a
missing repeat is found as ``changed``. Empty replicas: every record
of the other one is ``missing`` or ``extra``. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vcat.llm.common import settle

LEAF, FANOUT = 1 << 16, 16


def warc_record(url: Column, payload: Column, record_id: Column) -> Column:
    """Text of a WARC/1.1 resource record, its closing line ends included; length in UTF-8 bytes."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def lay_out(digests: DataFrame, order: list[str]) -> DataFrame:
    """``offset`` of each record in its ``archive``, in the given order. An archive is a file of bounded size."""
    before = Window.partitionBy("archive").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return digests.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def write_warc(records: DataFrame, out: str) -> None:
    """WARC files, one for each ``archive``, of records laid out: ``record`` ends in two line ends, which the writer puts back."""
    cut = F.substr("record", F.lit(1), F.char_length("record") - 4)
    (records.select("archive", "offset", cut.alias("value")).repartition("archive").sortWithinPartitions("archive", "offset")
     .select("archive", "value").write.partitionBy("archive").option("lineSep", "\r\n\r\n").text(out))


def digest(records: DataFrame, *keep: str) -> DataFrame:
    """``length`` and ``body`` (hash of the bytes) of each ``record``; the bytes themselves go no further than the scan."""
    payload = F.coalesce(F.col("record").cast("binary"), F.lit(bytearray()))
    return records.select(*keep, F.octet_length(payload).cast("long").alias("length"), F.sha2(payload, 256).alias("body"))


def leaves(digests: DataFrame) -> DataFrame:
    """``archive, offset, length, hash`` of digests (archive, offset, length, body); repeated rows are one leaf with their number."""
    d = digests.select(F.coalesce(F.col("archive").cast("string"), F.lit("")).alias("archive"), F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
                       F.coalesce("length", F.lit(0)).cast("long").alias("length"), F.coalesce("body", F.lit("")).alias("body"))
    return d.groupBy("archive", "offset", "length", "body").agg(F.count("*").alias("n")).select(
        "archive", "offset", "length", F.sha2(F.concat_ws("|", "offset", "length", "body", "n"), 256).alias("hash"))


def build_tree(digests: DataFrame, leaf: int = LEAF, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of the tree, records first, the roots (one for each archive) last. A level's nodes: ``archive, node, hash``; node n of level k
    covers offsets n * leaf * fanout^(k-1) onwards."""
    bottom = settle(leaves(digests).withColumn("node", F.floor(F.col("offset") / leaf).cast("long")), "leaves")
    low = bottom.groupBy("archive", "node").agg(F.sort_array(F.collect_list(F.struct("offset", "hash"))).alias("c"))
    levels = [bottom, settle(low.select("archive", "node", _joined("c")), "level")]
    top = levels[-1].agg(F.max("node").alias("m")).first()["m"] or 0
    while True:
        up = levels[-1].groupBy("archive", F.floor(F.col("node") / fanout).cast("long").alias("node")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("node").alias("n"), "hash"))).alias("c"))
        levels.append(settle(up.select("archive", "node", _joined("c")), "level"))
        top //= fanout
        if not top:
            return levels


def _joined(children: str) -> Column:
    return F.sha2(F.array_join(F.transform(children, lambda x: x["hash"]), ""), 256).alias("hash")


def audit(replica_a: list[DataFrame], replica_b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Records that differ: ``archive, offset, a_length, b_length, fault``; fault is ``changed``, ``missing`` (in b) or ``extra`` (in b)."""
    a, b = list(replica_a), list(replica_b)
    suspects = None
    for k in range(max(len(a), len(b)) - 1, 0, -1):
        x, y = (_at(t, k, fanout) for t in (a, b))
        if suspects is not None:  # only below nodes that differ
            up = suspects.select("archive", F.col("node").alias("up"))
            x, y = (t.withColumn("up", F.floor(F.col("node") / fanout).cast("long")).join(up, ["archive", "up"], "left_semi").drop("up") for t in (x, y))
        both = x.select("archive", "node", F.col("hash").alias("ha")).join(y.select("archive", "node", F.col("hash").alias("hb")), ["archive", "node"], "full")
        suspects = settle(both.filter(~F.col("ha").eqNullSafe(F.col("hb"))).select("archive", "node"), "suspects")

    def side(t: DataFrame, name: str) -> DataFrame:
        own = t[0].join(suspects, ["archive", "node"], "left_semi")
        return own.groupBy("archive", "offset").agg(F.max("length").alias(f"{name}_length"), F.sort_array(F.collect_list("hash")).alias(f"h{name}"))

    both = side(a, "a").join(side(b, "b"), ["archive", "offset"], "full").filter(~F.col("ha").eqNullSafe(F.col("hb")))
    fault = F.when(F.col("hb").isNull(), "missing").when(F.col("ha").isNull(), "extra").otherwise("changed")
    return both.select("archive", "offset", "a_length", "b_length", fault.alias("fault"))


def _at(tree: list[DataFrame], k: int, fanout: int) -> DataFrame:
    """Level k; of a tree that is lower, its root at node 0 carried up."""
    if k < len(tree):
        return tree[k].select("archive", "node", "hash")
    t = tree[-1].select("archive", "node", "hash")
    for _ in range(k - len(tree) + 1):
        t = t.withColumn("hash", F.sha2("hash", 256))
    return t
