"""Version lifecycle: what changed between the catalogue and its sources, the rows and edges of the
next version, retirement, rollback, and upkeep of the in-house source stack.

Every object version is one row with ``uuid``, ``init_version``, ``rev_version``, ``final_version``
(0 while it lives). Joins are on (parent, natural key), which is unique, so no join key is hot even
when one parent holds most of the objects.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vcat.functions.exprs import LIVE, SOURCES, pack_hash, pack_hashes, pack_id, unpack_hash, unpack_hashes, unpack_id, uuid_of
from vcat.functions.merkle import EMPTY_MD5, merkle_by_source, merkle_rollup
from vcat.sources.publish import settle


def _any(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _all(cols) -> Column:
    return reduce(lambda a, b: a & b, cols)


# --- roll-ups -------------------------------------------------------------------------------------


def rollup(children: DataFrame, parents: DataFrame, child_key: str, edge_child: str, edge_parent: str,
           h: str = "hash") -> DataFrame:
    """Merkle hash per parent. ``parents`` maps a child key to its parent key."""
    kids = parents.select(F.col(edge_parent), F.col(edge_child).alias(child_key)).join(
        children.select(child_key, h), child_key)
    return merkle_rollup(kids, [edge_parent], h, h, [child_key])


def series_rollup(df: DataFrame, keys: list[str], h: str, source: str, tiebreak=None) -> DataFrame:
    """Hash of a series from its instances, filed under their one source and under ``all``;
    ``one_source`` is false where the instances disagree."""
    src = df.groupBy(*keys).agg(F.min(source).alias("_lo"), F.max(source).alias("_hi"))
    rolled = merkle_rollup(df, keys, h, "_h", tiebreak)
    parts = [F.when(F.col("_lo") == s, F.col("_h")).otherwise("").alias(s) for s in SOURCES]
    return rolled.join(src, keys).select(
        *keys, (F.col("_lo") == F.col("_hi")).alias("one_source"),
        F.struct(*parts, F.col("_h").alias("all")).alias("hashes"))


def sources_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """A parent has a source if any child has it."""
    return df.groupBy(*keys).agg(
        F.struct(*[F.bool_or(F.col(f"sources.{s}")).alias(s) for s in SOURCES]).alias("sources"))


def stamp_of(df: DataFrame, keys: list[str], ts: str, count_name: str) -> DataFrame:
    """Newest and oldest child timestamp and the number of children."""
    return df.groupBy(*keys).agg(
        F.count("*").alias(count_name), F.max(ts).alias("max_timestamp"), F.min(ts).alias("min_timestamp"))


# --- source id lists ------------------------------------------------------------------------------


def presence(ids_a: DataFrame, ids_b: DataFrame, key: list[str]) -> DataFrame:
    """Ids offered by either source, with a presence flag per source."""
    a = ids_a.select(*key, F.lit(True).alias("src_a"), F.lit(False).alias("src_b"))
    b = ids_b.select(*key, F.lit(False).alias("src_a"), F.lit(True).alias("src_b"))
    return a.unionByName(b).groupBy(*key).agg(F.bool_or("src_a").alias("src_a"), F.bool_or("src_b").alias("src_b"))


def first_source(ids_a: DataFrame, ids_b: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Ids of the first source that has any for the parent; the second one counts only where the first
    has none. Only the parents of the first source take part in the join, once each."""
    taken = ids_a.select(*parent).distinct()
    a = ids_a.select(*parent, key, F.lit("src_a").alias("source"))
    b = ids_b.select(*parent, key, F.lit("src_b").alias("source")).join(taken, parent, "left_anti")
    return a.unionByName(b)


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Ids listed more than once by a source."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


# --- classification -------------------------------------------------------------------------------


def skip_mask(prev: DataFrame, src: DataFrame, configured: DataFrame, limited: DataFrame, key: str) -> DataFrame:
    """Which sources to leave alone per object: the configured pairs, everything with limited access,
    and sources that neither the catalogue nor the source itself has the object for.

    prev, src: key, sources; configured: key, source; limited: key.
    """
    cfg = configured.groupBy(key).agg(*[F.bool_or(F.col("source") == s).alias(f"_c_{s}") for s in SOURCES])
    lim = limited.select(key).distinct().withColumn("_lim", F.lit(True))
    j = (prev.select(key, F.col("sources").alias("_p")).join(src.select(key, F.col("sources").alias("_s")), key, "full_outer")
         .join(cfg, key, "left").join(lim, key, "left"))
    has = lambda side, s: F.coalesce(F.col(f"{side}.{s}"), F.lit(False))
    flags = [
        (F.coalesce(f"_c_{s}", F.lit(False)) | F.coalesce("_lim", F.lit(False))
         | (F.col("_p").isNotNull() & ~has("_p", s) & ~has("_s", s))).alias(s)
        for s in SOURCES
    ]
    return j.select(key, F.struct(*flags).alias("skipped"))


def revised_sources(old: str, new: str, skipped: str) -> Column:
    """Per source: its hash differs from ours and the source is not skipped."""
    h = lambda side, s: F.coalesce(F.col(f"{side}_hashes.{s}"), F.lit(""))
    return F.struct(*[((h(old, s) != h(new, s)) & ~F.col(f"{skipped}.{s}")).alias(s) for s in SOURCES])


def classify(prev: DataFrame, src: DataFrame, key: list[str], skip: DataFrame | None = None,
             skip_key: list[str] | None = None, name: str | None = None) -> DataFrame:
    """Status of every object: new, revised, renamed, unchanged or retired.

    prev: key, uuid, init_version, hashes, sources [, name] of live objects; src: key, hashes, sources
    [, name] as offered. An object lives on if a source offers it, or if one of its sources is skipped
    (it can not be asked then). Objects offered only by skipped sources are left out.
    """
    # Plain columns instead of one struct for a side: those that nobody reads are not shuffled. Ids and hashes are shuffled as narrow columns.
    extra = [name] if name else []

    def side(df, at, *cols):
        plain = [(pack_id(c) if c == "uuid" else F.col(c)).alias(f"{at}_{c}") for c in (*cols, *extra)]
        return df.select(*key, F.lit(True).alias(at), *plain, *pack_hashes(df, "hashes", f"{at}_hashes"))

    j = side(prev, "_old", "uuid", "init_version", "sources").join(side(src, "_new", "sources"), key, "full_outer")
    j = j.withColumns({f"{at}_hashes": unpack_hashes(j.columns, f"{at}_hashes") for at in ("_old", "_new")})
    none = F.struct(*[F.lit(False).alias(x) for x in SOURCES])
    if skip is not None:
        j = j.join(skip.select(*skip_key, F.col("skipped").alias("_m")), skip_key, "left")
        j = j.withColumn("_skip", F.coalesce("_m", none)).drop("_m")
    else:
        j = j.withColumn("_skip", none)
    flag = lambda side, x: F.coalesce(F.col(f"{side}.{x}"), F.lit(False))
    held = _any([flag("_old_sources", x) & flag("_skip", x) for x in SOURCES])
    offered = _any([flag("_new_sources", x) & ~flag("_skip", x) for x in SOURCES])
    whole = _all([flag("_skip", x) for x in SOURCES])
    j = j.withColumn("revised", revised_sources("_old", "_new", "_skip"))
    renamed = F.lit(False)
    if name:
        renamed = F.col("_new").isNotNull() & (F.col(f"_old_{name}") != F.col(f"_new_{name}"))
    status = (F.when(F.col("_old").isNull() & offered, "new")
              .when(F.col("_old").isNull(), None)
              .when(whole, "unchanged")
              .when(F.col("_new").isNull() & ~held, "retired")
              .when(_any([F.col(f"revised.{x}") for x in SOURCES]), "revised")
              .when(renamed, "renamed")
              .otherwise("unchanged"))
    # a skipped source can't be asked, so it keeps what it had; of the others the offer holds, also where it is gone
    per_source = {x: (F.when(F.col(f"_skip.{x}"), F.coalesce(f"_old_hashes.{x}", F.lit(""))).otherwise(F.coalesce(f"_new_hashes.{x}", F.lit(""))),
                      F.when(F.col(f"_skip.{x}"), flag("_old_sources", x)).otherwise(flag("_new_sources", x))) for x in SOURCES}
    more = [f.name for f in prev.schema["hashes"].dataType.fields if f.name not in SOURCES]
    hashes = F.struct(*[per_source[x][0].alias(x) for x in SOURCES], *[F.coalesce(f"_new_hashes.{x}", f"_old_hashes.{x}").alias(x) for x in more])
    has = F.struct(*[per_source[x][1].alias(x) for x in SOURCES])
    gone = F.col("status") == "retired"
    out = j.withColumn("status", status).filter("status IS NOT NULL")
    names = [F.coalesce(F.col(f"_new_{name}"), F.col(f"_old_{name}")).alias(name)] if name else []
    return out.select(
        *key, *names, "status", "revised", unpack_id("_old_uuid").alias("old_uuid"),
        F.col("_old_init_version").alias("old_init"),
        F.when(gone, F.col("_old_hashes")).otherwise(hashes).alias("hashes"),
        F.when(gone, F.col("_old_sources")).otherwise(has).alias("sources"))


#: Attributes that a new object has from the start.
NEW_OBJECT = {"excluded": False, "redacted": False}


def apply_version(level: DataFrame, classified: DataFrame, key: list[str], name: str, version: int,
                  offered: DataFrame | None = None) -> DataFrame:
    """Rows of the level after the version: revised and retired rows are closed at ``version - 1``,
    new and revised objects get a row, unchanged rows stay as they are.

    A revised object keeps all attributes of its old row but those that ``offered`` brings (key and
    any of the level's attributes; null: not offered). New objects are neither excluded nor redacted.
    ``classified`` is of rows of the level (``old_uuid``).
    """
    closers = classified.filter(F.col("status").isin("revised", "retired", "renamed"))
    managed = {"uuid": uuid_of(name, F.concat_ws("|", *key), F.lit(version)), "init_version": F.coalesce("old_init", F.lit(version)),
               "rev_version": F.lit(version), "final_version": F.lit(LIVE)}
    born = classified.filter(F.col("status").isin("new", "revised", "renamed"))
    given = [c for c in born.columns if c in level.columns and c not in managed]
    carried = [c for c in level.columns if c not in managed and c not in given]
    brought = [c for c in carried if offered is not None and c in offered.columns]
    if brought:
        born = born.join(offered.select(*key, F.struct(*brought).alias("_offer")), key, "left")
    born = born.select("old_uuid", "status", *[managed.get(c, F.col(c)).alias(c) for c in level.columns if c not in carried], *(["_offer"] if brought else []))

    def value(c: str, old: Column | None) -> Column:
        """An attribute of a new row: what is offered, else that of the old row."""
        found = [F.col(f"_offer.{c}")] if c in brought else []
        found += [old] if old is not None else []
        found += [F.lit(NEW_OBJECT[c])] if c in NEW_OBJECT else []
        return F.coalesce(*found, F.lit(None).cast(level.schema[c].dataType)).alias(c)

    # New objects have no old row: joined on a null uuid they would all meet in one task.
    has_old = F.col("old_uuid").isNotNull() & (F.col("status") != "new") if carried else F.lit(False)
    fresh = born.filter(~has_old).select(*[value(c, None) if c in carried else c for c in level.columns])
    # The level is shuffled once: its rows meet those that close them and those that take their attributes. Ids and hashes are narrow there.
    hashed = [f.name for f in level.schema.fields if f.name == "hashes"]
    own = [c for c in level.columns if c not in ("uuid", *hashed)]
    left = level.select(pack_id("uuid").alias("_id"), *own, *[x for c in hashed for x in pack_hashes(level, c, c)])
    right = closers.select(pack_id("old_uuid").alias("_id"), F.lit(False).alias("_born"))
    if carried:
        told = [c for c in born.columns if c not in ("old_uuid", "status", "uuid", "_offer", *hashed)]
        next_rows = born.filter(has_old)
        right = right.unionByName(next_rows.select(
            pack_id("old_uuid").alias("_id"), F.lit(True).alias("_born"), pack_id("uuid").alias("_n_uuid"), *[F.col(c).alias(f"_n_{c}") for c in told],
            *[x for c in hashed if c in given for x in pack_hashes(next_rows, c, f"_n_{c}")], *(["_offer"] if brought else [])), allowMissingColumns=True)
    j = left.join(right, "_id", "left")
    new = F.coalesce("_born", F.lit(False))

    def row(c: str) -> Column:
        old = unpack_id("_id") if c == "uuid" else unpack_hashes(j.columns, c) if c in hashed else F.col(c)
        kept = F.when(F.col("_born").isNotNull(), F.lit(version - 1)).otherwise(old) if c == "final_version" else old
        if not carried:
            return kept.alias(c)
        now = value(c, old) if c in carried else unpack_id("_n_uuid") if c == "uuid" else unpack_hashes(j.columns, f"_n_{c}") if c in hashed else F.col(f"_n_{c}")
        return F.when(new, now).otherwise(kept).alias(c)

    return j.select(*[row(c) for c in level.columns]).unionByName(fresh)


def clone_version(edges: DataFrame, version: int) -> DataFrame:
    """The next version starts with the edges of the one before."""
    return edges.filter(F.col("version") == version - 1).withColumn("version", F.lit(version))


def next_edges(parents: DataFrame, children: DataFrame, key: list[str], parent: str, child: str, version: int) -> DataFrame:
    """Edges added by a version: every parent revised in it, with its children alive in it. Unchanged
    children are shared with the previous revision of the parent; nothing is copied.

    key: natural key of the parent, a column of both sides.
    """
    p = parents.filter(F.col("rev_version") == version).select(*key, F.col("uuid").alias(f"{parent}_uuid"))
    c = children.filter((F.col("final_version") == LIVE) & (F.col("rev_version") <= version)).select(
        *key, F.col("uuid").alias(f"{child}_uuid"))
    return p.join(c, key).select(f"{parent}_uuid", f"{child}_uuid")


def retire(levels: dict[str, DataFrame], edges: dict[str, DataFrame], order: list[str], gone: DataFrame,
           version: int) -> dict[str, DataFrame]:
    """Close the objects in ``gone`` (uuid, at the first level of ``order``) and all that hangs below."""
    out, ids = {}, gone.select("uuid").distinct()
    for i, name in enumerate(order):
        hit = ids.withColumn("_gone", F.lit(True))
        out[name] = levels[name].join(hit, "uuid", "left").withColumn(
            "final_version", F.when(F.col("_gone") & (F.col("final_version") == LIVE), F.lit(version - 1))
            .otherwise(F.col("final_version"))).drop("_gone")
        if i + 1 < len(order):
            child = order[i + 1]
            ids = edges[f"{name}_{child}"].join(
                ids.withColumnRenamed("uuid", f"{name}_uuid"), f"{name}_uuid", "left_semi").select(
                F.col(f"{child}_uuid").alias("uuid")).distinct()
    return out


def rename(live: DataFrame, id_map: DataFrame, src: DataFrame, key: str, name: str) -> DataFrame:
    """Objects whose source name changed while the permanent id is the same. The id map is matched to
    source names without regard to case."""
    ids = id_map.select(F.lower(name).alias("_l"), key)
    named = src.select(F.lower(name).alias("_l"), F.col(name).alias("new_name")).join(ids, "_l")
    return live.join(named, key).filter(F.col(name) != F.col("new_name")).select(
        key, F.col(name).alias("old_name"), "new_name")


def prune_to_revised(children: DataFrame, edges: DataFrame, parents: DataFrame, parent: str, child: str) -> DataFrame:
    """Only children of the given (revised) parents: unchanged subtrees are never read further."""
    keep = edges.join(parents.select(F.col("uuid").alias(f"{parent}_uuid")), f"{parent}_uuid", "left_semi").select(
        F.col(f"{child}_uuid").alias("uuid"))
    return children.join(keep, "uuid", "left_semi")


def same_hash(a: Column, b: Column) -> Column:
    """Equality of roll-up hashes; NULL, '' and the md5 of nothing all mean "no content"."""
    n = lambda c: F.when(c == EMPTY_MD5, "").otherwise(F.coalesce(c, F.lit("")))
    return n(a) == n(b)


def verify_rollup(rolled: DataFrame, offered: DataFrame, key: list[str], h: str = "hash") -> DataFrame:
    """Objects whose rebuilt hash is not the one the source announced."""
    j = rolled.select(*key, F.col(h).alias("rolled")).join(offered.select(*key, F.col(h).alias("announced")), key, "full_outer")
    return j.filter(~same_hash(F.col("rolled"), F.col("announced")))


def is_noop(version_row: DataFrame, prev_row: DataFrame, h: str = "hash") -> DataFrame:
    """One row telling whether a version equals its predecessor and can be dropped."""
    both = version_row.select(F.col(h).alias("_h")).unionByName(prev_row.select(F.col(h).alias("_h")))
    return both.agg((F.count_distinct("_h") == 1).alias("noop"))


def predecessor(level: DataFrame, key: list[str], version: int) -> DataFrame:
    """For every object revised in ``version``, the row that came before it."""
    n = F.col("rev_version")
    older = n < version
    return level.filter(n <= version).groupBy(*key).agg(
        F.bool_or(n == version).alias("_hit"), F.max_by(F.when(older, F.col("uuid")), F.when(older, n)).alias("prior_uuid"),
        F.max(F.when(older, n)).alias("prior_version")).filter("_hit AND prior_uuid IS NOT NULL").drop("_hit")


def _without_parents(edges: DataFrame, gone: DataFrame, pk: str, ck: str) -> DataFrame:
    """The edges whose parent is not among ``gone``. Ids go through the join as narrow keys, and the edges are not sorted for it: the parents
    of a partition, several times fewer, are hashed."""
    text = [c for c in (pk, ck) if edges.schema[c].dataType == T.StringType()]
    key = pack_id("uuid") if pk in text else F.col("uuid")
    kept = edges.withColumns({c: pack_id(c) for c in text}).join(gone.select(key.alias(pk)).hint("shuffle_hash"), pk, "left_anti")
    return kept.withColumns({c: unpack_id(c) for c in text}).select(*edges.columns)


def rollback(levels: dict[str, DataFrame], edges: dict[str, DataFrame], order: list[str], version: int,
             only: list[str] | None = None, name: str = "collection_id"):
    """Undo a version: drop the rows it made, re-open the rows it closed, drop the edges of dropped
    parents. With ``only``, just for the named objects of the first level and all below them.

    ``edges["version_<first level>"]`` (version, uuid) and ``levels["version"]``, where given, lose the
    version as well; with ``only`` its edges to dropped objects lead to those that are open again.
    """
    out_levels, out_edges, ids = {}, {}, None
    if only is not None:
        ids = levels[order[0]].filter(F.col(name).isin(only)).select("uuid")
    for i, lv in enumerate(order):
        df = levels[lv]
        made = F.col("rev_version") == version
        reopened = F.when(F.col("final_version") == version - 1, F.lit(LIVE)).otherwise(F.col("final_version"))
        child = order[i + 1] if i + 1 < len(order) else None
        gone = df.filter(made).select("uuid")
        if ids is None:
            out_levels[lv] = df.filter(~made).withColumn("final_version", reopened)
        else:
            hit = F.coalesce("_hit", F.lit(False))
            marked = df.join(ids.distinct().withColumn("_hit", F.lit(True)), "uuid", "left")
            out_levels[lv] = marked.filter(~(made & hit)).withColumn(
                "final_version", F.when(hit, reopened).otherwise(F.col("final_version"))).drop("_hit")
            gone = gone.join(ids, "uuid", "left_semi")
        if child:
            e, pk, ck = edges[f"{lv}_{child}"], f"{lv}_uuid", f"{child}_uuid"
            out_edges[f"{lv}_{child}"] = _without_parents(e, gone, pk, ck)
            if ids is not None:
                ids = e.join(ids.withColumnRenamed("uuid", pk), pk, "left_semi").select(F.col(ck).alias("uuid"))
    top = f"version_{order[0]}"
    if top in edges:
        first, pk = levels[order[0]], f"{order[0]}_uuid"
        mine = F.col("version") == version
        if only is None:
            out_edges[top] = edges[top].filter(~mine)
        else:
            named = first.filter(F.col(name).isin(only))
            dropped = named.filter(F.col("rev_version") == version).select(F.col("uuid").alias(pk))
            back = named.filter(F.col("final_version") == version - 1).select(F.lit(version).alias("version"), F.col("uuid").alias(pk))
            out_edges[top] = edges[top].join(dropped, pk, "left_anti").select("version", pk).unionByName(back)
    if "version" in levels and only is None:
        out_levels["version"] = levels["version"].filter(F.col("version") != version)
    return out_levels, out_edges


# --- the in-house source stack --------------------------------------------------------------------

STACK = (  # level, its key, its parent's key
    ("collection", "collection_id", None),
    ("patient", "submitter_case_id", "collection_id"),
    ("study", "study_instance_uid", "submitter_case_id"),
    ("series", "series_instance_uid", "study_instance_uid"),
    ("instance", "sop_instance_uid", "series_instance_uid"),
)


def upsert_stack(stack: dict[str, DataFrame], manifest: DataFrame, doi: str, version: int,
                 versioned_doi: str | None = None) -> dict[str, DataFrame]:
    """Bring a manifest in: missing levels are created; instances are added, or updated where the hash
    changed; touched series get the lower-cased DOI, its url and the versioned DOI. Where a manifest
    names two parents of an object, the smaller one is taken; of two rows for one instance the larger.

    manifest: collection_id, submitter_case_id, study_instance_uid, series_instance_uid,
    sop_instance_uid, hash, size, ingestion_url.
    """
    out = {}
    for level, key, parent in STACK[:4]:
        # The rows of one level are far fewer than the manifest's: reduce first, then compare.
        offered = manifest.groupBy(key).agg(F.min(parent).alias(parent)) if parent else manifest.select(key).distinct()
        old = stack[level]
        if level == "series":
            low = doi.lower()
            cited = {"source_doi": F.lit(low), "source_url": F.lit(f"https://doi.org/{low}"),
                     "versioned_source_doi": F.lit(versioned_doi.lower() if versioned_doi else None).cast("string")}
            cited = {c: v for c, v in cited.items() if c in old.columns}
            old = old.join(offered.select(key).withColumn("_hit", F.lit(True)), key, "left").withColumns(
                {c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in cited.items()}).drop("_hit")
            offered = offered.withColumns(cited)
        fresh = offered.join(stack[level].select(key), key, "left_anti").withColumns({c: F.lit(v) for c, v in NEW_OBJECT.items() if c in old.columns})
        fresh = fresh.select(*[F.col(f.name) if f.name in fresh.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema.fields])
        out[level] = old.unionByName(fresh)
    inst, key = stack["instance"], "sop_instance_uid"
    new = manifest.groupBy(key).agg(F.max(F.struct("series_instance_uid", "hash", "size", "ingestion_url")).alias("_n"))
    j = inst.withColumn("_o", F.lit(True)).join(new, key, "full_outer")
    changed = F.col("_n").isNotNull() & (F.col("_o").isNull() | ~F.col("hash").eqNullSafe(F.col("_n.hash")))
    take = lambda c: F.when(changed, F.col(f"_n.{c}")).otherwise(F.col(c)).alias(c)
    over = {"version": F.when(changed, F.lit(version)).otherwise(F.col("version")).alias("version"),
            "redacted": F.coalesce("redacted", F.lit(False)).alias("redacted"),
            "excluded": F.coalesce("excluded", F.lit(False)).alias("excluded")}
    moved = ("series_instance_uid", "hash", "size", "ingestion_url")
    out["instance"] = j.select(*[take(c) if c in moved else over.get(c, F.col(c)) for c in inst.columns])
    return out


def delete_from_stack(stack: dict[str, DataFrame], instances: DataFrame | None = None, doi: str | None = None,
                      versioned_doi: str | None = None) -> dict[str, DataFrame]:
    """Remove instances by list, or whole series by DOI, then every parent left without children."""
    out = dict(stack)
    series, inst = stack["series"], stack["instance"]
    if doi is not None or versioned_doi is not None:
        hit = (F.col("source_doi") == doi) if doi is not None else (F.col("versioned_source_doi") == versioned_doi)
        hit = F.coalesce(hit, F.lit(False))
        out["instance"] = inst = inst.join(series.filter(hit), "series_instance_uid", "left_anti")
        series = series.filter(~hit)
    if instances is not None:
        out["instance"] = inst = inst.join(instances.select("sop_instance_uid"), "sop_instance_uid", "left_anti")
    below, out["series"] = inst, series
    for (level, key, _) in reversed(STACK[:4]):
        out[level] = out[level].join(below.select(key), key, "left_semi")
        below = out[level]
    return out


def reroll(stack: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Hashes of all levels, bottom-up; '' for an object without children."""
    out, below = {"instance": stack["instance"]}, stack["instance"]
    for i in range(3, -1, -1):
        level, key, _ = STACK[i]
        rolled = merkle_rollup(below, [key], "hash", "_rolled", [STACK[i + 1][1]])
        out[level] = stack[level].join(rolled, key, "left").withColumn(
            "hash", F.coalesce("_rolled", F.lit(""))).drop("_rolled")
        below = out[level]
    return out


def propagate_doi(series: DataFrame, a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """DOI of each series; the later source overrides the earlier one."""
    return (series.join(a.select(key, F.col("source_doi").alias("_a")), key, "left")
            .join(b.select(key, F.col("source_doi").alias("_b")), key, "left")
            .withColumn("source_doi", F.coalesce("_b", "_a")).drop("_a", "_b"))


def doi_renames(catalogue: DataFrame, source: DataFrame) -> DataFrame:
    """Same DOI, other name. Both: doi, name."""
    c = catalogue.select(F.lower("doi").alias("doi"), F.col("name").alias("old_name"))
    s = source.select(F.lower("doi").alias("doi"), F.col("name").alias("new_name"))
    return c.join(s, "doi").filter(F.col("old_name") != F.col("new_name"))


def maintain_ids(id_map: DataFrame, ids: DataFrame) -> DataFrame:
    """Permanent ids: vanished names go, a name that only changed case gets a row with the same id, a
    new name gets a new id. id_map: name, id; ids: name."""
    now = ids.select("name").distinct()
    kept = id_map.join(now.select(F.lower("name").alias("_l")).distinct(), F.lower("name") == F.col("_l"), "left_semi")
    fresh = now.join(id_map.select("name"), "name", "left_anti")
    by_case = id_map.groupBy(F.lower("name").alias("_l")).agg(F.min("id").alias("_id"))
    added = fresh.join(by_case, F.lower("name") == F.col("_l"), "left").select(
        "name", F.coalesce("_id", uuid_of("id", "name", F.lit(0))).alias("id"))
    return kept.select("name", "id").unionByName(added)


#: Aggregates that a level has of its children: the column, and the children's column it sums (none: their number).
COUNTS = {"series": ("series_instances", None), "study": ("study_instances", "series_instances")}


def aggregates_of(kids: DataFrame, keys: list[str], parent: str) -> DataFrame:
    """What parents have of their children besides hashes, in one pass: sources, and of number, newest and oldest timestamp what the children can tell.
    The lowest level has one ``timestamp``, those above ``min_timestamp`` and ``max_timestamp``."""
    out = [F.struct(*[F.bool_or(F.col(f"sources.{s}")).alias(s) for s in SOURCES]).alias("sources")]
    high, low = ("max_timestamp", "min_timestamp") if "max_timestamp" in kids.columns else ("timestamp", "timestamp")
    if high in kids.columns:
        out += [F.max(high).alias("max_timestamp"), F.min(low).alias("min_timestamp")]
    if parent in COUNTS:
        name, summed = COUNTS[parent]
        if summed is None:
            out.append(F.count("*").alias(name))
        elif summed in kids.columns:
            out.append(F.sum(summed).alias(name))
    return kids.groupBy(*keys).agg(*out)


class BuildError(ValueError):
    """A build that does not agree with what the sources announced."""


def written(df: DataFrame, level: str, settle: Callable, **bad: Column) -> DataFrame:
    """``df``, settled. Rows that are ``bad`` are counted while it is written, with no further scan, and stop the build."""
    seen = Observation()
    out = settle(df.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in bad.items()]))
    found = {n: k for n, k in seen.get.items() if k}
    if found:
        raise BuildError(f"{level}: " + ", ".join(f"{k} rows with {n.replace('_', ' ')}" for n, k in found.items()))
    return out


def changed_parents(levels: dict[str, DataFrame], announced: dict[str, DataFrame], path: list[tuple[str, str]], settle: Callable) -> DataFrame:
    """Keys of the objects right above the lowest level that are new, gone or have another hash at a source: a descent that compares a level only below
    what differs in the one above. ``announced``: keys, ``hashes`` and ``sources`` of every level above the lowest, as the sources tell them."""
    keys, front = [k for _, k in path], None
    for i, (name, _) in enumerate(path[:-1]):
        sides = [levels[name].filter(F.col("final_version") == LIVE), announced[name]]
        if front is not None:
            sides = [d.join(front, keys[:i], "left_semi") for d in sides]
        front = settle(classify(*sides, keys[:i + 1]).filter("status <> 'unchanged'").select(*keys[:i + 1]))
    return front


def build_version(levels: dict[str, DataFrame], offered: DataFrame, path: list[tuple[str, str]], version: int, skip: DataFrame | None = None,
                  skip_key: list[str] | None = None, settle: Callable = settle, attributes: dict[str, DataFrame] | None = None,
                  names: dict[str, str] | None = None, announced: dict[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """A release from the one before: (rows of all levels and of the version, edges added).

    path: (level, key column) from the top down; a level holds the key columns of all levels above it. ``offered``: what
    the sources hold of the lowest level, with ``hashes``, ``sources`` and any attributes. Levels above get hashes, sources, timestamps and numbers from
    their children as they are after the build; only parents of changed children are rolled up, the others keep what is
    stored. ``attributes``: by level, its keys and what else the sources say of its objects (names, DOIs), which new and revised ones take. ``names``: by level, the
    attribute that is a name; an object with another name is revised though its hash is not. ``settle`` writes each level's result, so that levels above read it and
    don't compute it again.

    ``announced``: what the sources tell of the levels above the lowest (keys, ``hashes``, ``sources``). With it only the lowest objects below
    what differs are looked at, and a roll-up that is not the announced one, at a source that is not skipped, stops the build (``BuildError``).
    """
    all_names, keys = [n for n, _ in path], [k for _, k in path]
    attributes, names, announced = attributes or {}, names or {}, announced or {}
    rows, edges, offer = {}, {}, offered
    front = changed_parents(levels, announced, path, settle) if announced else None
    for i in range(len(path) - 1, -1, -1):
        name, key, lowest = all_names[i], keys[:i + 1], i == len(path) - 1
        live = levels[name].filter(F.col("final_version") == LIVE)
        if lowest and front is not None:
            live, offer = (d.join(front, keys[:i], "left_semi") for d in (live, offer))
        if name in attributes:
            offer = offer.join(attributes[name], key, "left")
        called = names.get(name)
        if called:
            was = live.select(*key, F.col(called).alias("_was"))
            told = F.col(called) if called in offer.columns else F.lit(None).cast("string")
            offer = offer.join(was, key, "left").withColumn(called, F.coalesce(told, "_was")).drop("_was")
        if name in announced and not lowest:
            offer = _agreed(offer, announced[name], key, skip, skip_key, name, settle)
        # Unchanged objects are neither closed nor born, nor do they touch their parents: they are not written.
        status = settle(classify(live, offer, key, skip if lowest else None, skip_key, called).filter("status <> 'unchanged'").drop("revised"))
        rows[name] = settle(apply_version(levels[name], status, key, name, version, offer))
        if not lowest:
            edges[f"{name}_{all_names[i + 1]}"] = next_edges(rows[name], rows[all_names[i + 1]], key, name, all_names[i + 1], version)
        now = rows[name].filter(F.col("final_version") == LIVE)
        told = now.schema["hashes"].dataType.names
        each = {x: unpack_hash(f"_h_{x}") for x in told}  # narrow until they are rolled up
        slots = {**{x: each[x] for x in SOURCES}, "all": each.get("all", F.concat(*[each[x] for x in SOURCES]))}
        narrow = [pack_hash(f"hashes.{x}").alias(f"_h_{x}") for x in told]
        if i:
            up, parent = keys[:i], all_names[i - 1]
            touched = status.select(*up).distinct()
            hashed = now.select(*up, F.xxhash64(keys[i]).alias("_tie"), *narrow).join(touched, up, "left_semi")
            built = merkle_by_source(hashed, up, slots, tiebreak=["_tie"]).join(aggregates_of(now.join(touched, up, "left_semi"), up, parent), up)
            built = built.select(*[c for c in built.columns if c in ("hashes", "sources") or c in levels[parent].columns])
            stored = levels[parent].filter(F.col("final_version") == LIVE).join(touched, up, "left_anti")
            offer = built.unionByName(stored.select(*up, "hashes", "sources"), allowMissingColumns=True)
        else:
            edges[f"version_{name}"] = now.select(F.lit(version).alias("version"), F.col("uuid").alias(f"{name}_uuid"))
            one = now.withColumn("version", F.lit(version))
            rows["version"] = merkle_by_source(one.select("version", keys[0], *narrow), ["version"], slots, tiebreak=[keys[0]]).join(aggregates_of(one, ["version"], "version"), "version").withColumn(
                "previous_version", F.lit(version - 1))
    return rows, edges


def _agreed(offer: DataFrame, announced: DataFrame, key: list[str], skip: DataFrame | None, skip_key: list[str] | None, level: str, settle: Callable) -> DataFrame:
    """Roll-ups, unless one is not what the sources announced. With objects skipped below a level, nothing announced for it has to come out."""
    told = offer.join(announced.select(*key, F.col("hashes").alias("_told")), key, "left")
    held = dict.fromkeys(SOURCES, F.lit(False))
    if skip is not None:
        if not set(skip_key) <= set(key):
            return offer
        told = told.join(skip.select(*skip_key, F.col("skipped").alias("_held")), skip_key, "left")
        held = {s: F.coalesce(F.col(f"_held.{s}"), F.lit(False)) for s in SOURCES}
    wrong = _any([~same_hash(F.col(f"hashes.{s}"), F.col(f"_told.{s}")) & ~held[s] for s in SOURCES])
    return written(told, level, settle, another_hash_than_announced=F.col("_told").isNotNull() & wrong).select(*offer.columns)
