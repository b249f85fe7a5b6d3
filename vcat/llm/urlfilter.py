"""URL filter rules by a sorted sweep (operator 6), with Spark expressions only.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's.
A host becomes a key of reversed labels, each closed by a low byte, so that a rule's host and all subdomains are one
interval of keys; within a rule's host, its path prefix is an interval of paths. Both families are nested. Interval
ends and keys are sorted together; the stack of active rules after each end is known from the rules alone, and a
key takes the last stack before it. The first sweep gives the stack of active rule hosts, the second the innermost
path rule of each active host; the rule with the longest host wins, then the longest path.

Every sweep runs over range partitions of distinct keys: a host or url with a third of all rows is one key. What reaches
over a block's border is one stack per block.

Defined results: null url or one without ``://``: empty host and path, no rule, the default verdict. Rules with null
host, path or verdict are left out; of rules with equal host and path the larger verdict holds (``block`` over ``allow``).
Repeated rows stay. Empty tables give no rows, or the default verdict. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vcat.llm.common import ascii_lower, settle

DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(F.substr(rest, F.char_length(host) + 1), "^[^?#]*", 0), F.lit(""))
    return ascii_lower(host), path


def _host_key(host: Column) -> Column:
    labels = F.transform(F.reverse(F.split(host, r"\.")), lambda x: F.concat(x, F.lit("\x01")))
    return F.array_join(labels, "").cast("binary")


def _past(key: Column) -> Column:
    """Above every string that starts with the key: no UTF-8 text holds the byte FF."""
    return F.concat(key, F.lit(bytearray(b"\xff")))


def sweep(points: DataFrame, events: DataFrame, state: str) -> DataFrame:
    """The ``state`` of the last event at or before each point's ``key``. ``events`` (key, state), its keys distinct, states not null."""
    payload = [c for c in points.columns if c != "key"]
    both = events.select("key", F.lit(0).alias("is_point"), F.col(state).alias("_state")).unionByName(
        points.select("key", F.lit(1).alias("is_point"), *payload), allowMissingColumns=True)
    blocks = settle(both.repartitionByRange("key", "is_point").withColumn("_block", F.spark_partition_id()), "sweep")
    last = blocks.groupBy("_block").agg(F.max_by("_state", F.when(F.col("is_point") == 0, F.col("key"))).alias("_last"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    carried = last.select("_block", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    seen = F.last("_state", ignorenulls=True).over(Window.partitionBy("_block").orderBy("key", "is_point").rowsBetween(Window.unboundedPreceding, 0))
    swept = blocks.withColumn("_seen", seen).filter("is_point = 1").join(carried, "_block", "left")
    return swept.select("key", *payload, F.coalesce("_seen", "_carried").alias(state))


def _host_events(rules: DataFrame) -> DataFrame:
    hosts = rules.select("host").distinct()
    labels = F.split("host", r"\.")
    suffixes = hosts.select("host", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("n"), labels.alias("l")).select(
        "host", "n", F.array_join(F.slice("l", F.size("l") - F.col("n") + 1, F.col("n")), ".").alias("up"))
    stacks = suffixes.join(hosts.select(F.col("host").alias("up")), "up").groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("n", "up"))).alias("s"))  # as many as the host has labels at most
    keyed = stacks.select(_host_key(F.col("host")).alias("key"), F.transform("s", lambda x: x["up"]).alias("stack"))
    return keyed.unionByName(keyed.select(_past(F.col("key")).alias("key"), F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack")))


def _path_key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("#"), path).cast("binary")


def _path_events(rules: DataFrame) -> DataFrame:
    own = F.struct(F.concat("host", "path").alias("rule"), "verdict")
    known = rules.select("host", F.col("path").alias("up"), own.alias("outer"))
    prefixes = rules.select("host", "path", F.explode(F.sequence(F.lit(0), F.char_length("path"))).alias("n")).filter(F.col("n") < F.char_length("path"))
    parents = prefixes.select("host", "path", "n", F.substr("path", F.lit(1), F.col("n")).alias("up")).join(known, ["host", "up"]).groupBy("host", "path").agg(
        F.max_by("outer", "n").alias("outer"))
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    keyed = rules.join(parents, ["host", "path"], "left").select(
        _path_key(F.col("host"), F.col("path")).alias("key"), own.alias("found"), F.coalesce("outer", none).alias("outer"))
    return keyed.select("key", "found").unionByName(keyed.select(_past(F.col("key")).alias("key"), F.col("outer").alias("found")))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the winning rule, else null) and ``verdict``; columns of these
    names are replaced."""
    rules = settle(rules.dropna(subset=["host", "path", "verdict"]).groupBy(ascii_lower(F.col("host")).alias("host"), "path").agg(F.max("verdict").alias("verdict")), "rules")
    host, path = host_and_path(F.col(url))
    pages = pages.drop(*(c for c in pages.columns if c.lower() in ("rule", "verdict") or c.lower() in ("host", "path") and c != url))
    pages = pages.withColumns({"host": host, "path": path})
    keys = settle(pages.select("host", "path").distinct(), "urls")
    hosts = keys.select("host").distinct().select(_host_key(F.col("host")).alias("key"), "host")
    active = sweep(hosts, _host_events(rules), "stack").filter(F.size("stack") > 0).select("host", "stack")
    probes = keys.join(active, "host").select("host", "path", F.posexplode("stack").alias("depth", "rule_host"))
    # labels that hold the separator byte themselves can't pass for a subdomain
    fits = (F.col("host") == F.col("rule_host")) | F.col("host").endswith(F.concat(F.lit("."), F.col("rule_host")))
    probes = probes.filter(fits).withColumn("key", _path_key(F.col("rule_host"), F.col("path")))
    # the sweep keeps to the probe's own host: a key of another one can't be the last event inside an interval that is open
    found = sweep(probes, _path_events(rules), "found").filter(F.col("found.rule").isNotNull())
    best = found.groupBy("host", "path").agg(F.max_by("found", "depth").alias("found"))
    judged = pages.join(best, ["host", "path"], "left")
    return judged.select(*[c for c in pages.columns if c not in ("host", "path")], "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce("found.verdict", F.lit(default)).alias("verdict"))
