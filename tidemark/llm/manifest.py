"""Merkle manifest of a table, as digest-to-children records in Spark tables.

Rows are leaves; the leaves of a group form a binary tree, the groups'
subroots a tree over them. Eight levels of a tree are kept as one record:
the digest of the segment's top leads to the nodes below it, level by level.
A record is addressed by content, so equal segments share one.

Building: places come from a range-partitioned sort and the counts of its
partitions, then each round folds runs of 256 nodes into one record, so that
log256(n) rounds reach the top whatever the size of a group.

Proving: requests descend from the root. Requests that still share their
path travel as one row; at every record the next eight digits of their
places choose the child, the children not chosen are collected, and at the
leaves the path, gathered from the top, is reversed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store

LEVELS = 8  # of a record
WIDTH = 1 << LEVELS


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree (the group), n (its leaves), place (from 0), leaf and
    what is carried along. ``groups``: tree, n, number (place of the group),
    subroot. ``records`` and ``top``: for the groups' trees and the tree over
    them, one table (digest, height, levels) per tier, lowest first."""

    leaves: DataFrame
    groups: DataFrame
    records: list[DataFrame]
    top: list[DataFrame]
    n_groups: int
    root: str | None


def field(c: Column) -> Column:
    """``-`` for null, else the value's count of UTF-8 bytes, a colon, the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def digest_of(*cols: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in cols]).cast("binary"), 256)


def placed(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with n, the rows of their tree, and place, from 0 by ``order`` in it."""
    key = [tree, *order]
    laid = store(rows.repartitionByRange(*key).sortWithinPartitions(*key).select(
        "*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("row")), name)
    of_tree = Window.partitionBy("p_tree")  # at most one row per partition and tree
    parts = (laid.groupBy(F.col(tree).alias("p_tree"), F.col("pid").alias("p_pid")).agg(F.min("row").alias("first"), F.count("*").alias("c"))
             .withColumn("n", F.sum("c").over(of_tree))
             .withColumn("before", F.sum("c").over(of_tree.orderBy("p_pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")))
    return laid.join(parts, (F.col("pid") == F.col("p_pid")) & F.col(tree).eqNullSafe(F.col("p_tree"))).select(
        *rows.columns, "n", (F.col("before") + F.col("row") - F.col("first")).alias("place"))


def _folded(level: Column) -> Column:
    """The level above: every two neighbours, or a last single one, become their digest."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), lambda i: F.sha2(F.concat(
        F.get(level, i * 2), F.coalesce(F.get(level, i * 2 + 1), F.lit(""))).cast("binary"), 256))


def _build(nodes: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """Nodes (tree, n, place, digest) to (tops (tree, digest), records per tier)."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    tops, records = nodes.filter("n = 1").select("tree", "digest"), []
    while most > 1:
        height = F.when(F.col("n") > WIDTH, LEVELS).otherwise(F.length(F.bin(F.col("n") - 1)))
        runs = nodes.filter("n > 1").groupBy("tree", "n", F.shiftright("place", LEVELS).alias("place")).agg(
            F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("run"))
        folded = runs.withColumn("height", height).withColumn("levels", F.aggregate(
            F.sequence(F.lit(1), F.col("height")), F.array(F.transform("run", lambda r: r["digest"])),
            lambda acc, _: F.concat(acc, F.array(_folded(F.element_at(acc, -1))))))
        tier = store(folded.select("tree", F.ceil(F.col("n") / WIDTH).alias("n"), "place", "height", "levels",
                                   F.element_at("levels", -1)[0].alias("digest")), name)
        records.append(tier.groupBy("digest").agg(F.first("height").alias("height"), F.first("levels").alias("levels")))
        nodes = tier.select("tree", "n", "place", "digest")
        tops = tops.union(nodes.filter("n = 1").select("tree", "digest"))
        most = -(-most // WIDTH)
    return tops, records


def build(rows: DataFrame, group: str = "tree", order: tuple[str, ...] = ("id", "leaf"), digest: str = "leaf") -> Manifest:
    """Manifest of ``rows``: leaves are their ``digest``, in ``order`` per
    ``group`` (null first), groups in order of their value (null first, text
    bytewise). An empty table has no root."""
    leaves = store(placed(rows, group, list(order), "leaves"), "leaves-placed")
    tops, records = _build(leaves.select(F.col(group).alias("tree"), "n", "place", F.col(digest).alias("digest")), "records")
    sizes = leaves.filter("place = 0").select(F.col(group).alias("s_tree"), F.col("n").alias("size"))
    ranked = placed(tops.withColumn("all", F.lit(0)), "all", ["tree"], "groups").select("tree", "digest", "place", F.col("n").alias("count"))
    groups = store(ranked.join(sizes, F.col("tree").eqNullSafe(F.col("s_tree"))).select(
        "tree", F.col("size").alias("n"), F.col("place").alias("number"), F.col("digest").alias("subroot"), "count"), "subroots")
    over, top = _build(groups.select(F.lit(0).alias("tree"), F.col("count").alias("n"), F.col("number").alias("place"),
                                     F.col("subroot").alias("digest")), "top-records")
    found = over.first()
    return Manifest(leaves.withColumnRenamed(group, "tree").withColumnRenamed(digest, "leaf"), groups.drop("count"), records, top,
                    (groups.agg(F.max("count")).first()[0] or 0), found["digest"] if found else None)


def _unselected(levels: Column, height: Column, place: Column) -> Column:
    """The sibling beside the path at every level of a record, topmost first:
    (digest, null where the node stands alone, and whether it is to the left)."""
    def beside(k: Column) -> Column:
        at = F.call_function("shiftright", place, k).cast("int")
        return F.struct(F.get(F.get(levels, k), at.bitwiseXOR(F.lit(1))).alias("digest"), (at.bitwiseAND(F.lit(1)) == 1).alias("left"))
    return F.transform(F.sequence(height - 1, F.lit(0), F.lit(-1)), beside)


def _descend(state: DataFrame, records: DataFrame, tier: int, wanted: DataFrame | None) -> DataFrame:
    """One record further down, for trees that reach this tier; rows are
    (tree, n, subroot, place, digest, path)."""
    spread = F.col("n") > F.lit(WIDTH ** tier)
    child = lambda x, i: F.struct((F.shiftleft("place", LEVELS) + i).alias("place"), x.alias("digest"), F.concat(
        "path", _unselected(F.col("levels"), F.col("height"), i)).alias("path"))
    below = state.filter(spread).join(records, "digest").select("tree", "n", "subroot", F.inline(
        F.transform(F.get("levels", F.lit(0)), child)))
    if wanted is not None:
        prefix = wanted.select(F.col("tree").alias("w_tree"), F.shiftright("place", LEVELS * tier).alias("w_place")).distinct()
        below = below.join(prefix, F.col("tree").eqNullSafe(F.col("w_tree")) & (F.col("place") == F.col("w_place")), "left_semi")
    return store(below.union(state.filter(~spread).select(*below.columns)), "descent")


def prove(m: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """One row per leaf (per row of ``wanted``, some of ``m.leaves``): its
    columns, subroot and ``siblings``, an array (digest, left) with one entry
    per level from the leaf to the root; a digest is null where the node
    stands alone. Leaves at one place are not to be repeated in ``wanted``."""
    spark = m.leaves.sparkSession
    none = F.array().cast("array<struct<digest:string,left:boolean>>")
    leaves = m.leaves if wanted is None else wanted
    state = spark.range(0 if m.root is None else 1).select(
        F.lit(0).alias("tree"), F.lit(m.n_groups).cast("long").alias("n"), F.lit(m.root).cast("string").alias("subroot"),
        F.lit(0).cast("long").alias("place"), F.lit(m.root).cast("string").alias("digest"), none.alias("path"))
    groups_wanted = None if wanted is None else m.groups.join(
        wanted.select(F.col("tree").alias("w_tree")).distinct(), F.col("tree").eqNullSafe(F.col("w_tree")), "left_semi").select(
        F.lit(0).alias("tree"), F.col("number").alias("place"))
    for tier in reversed(range(len(m.top))):
        state = _descend(state, m.top[tier], tier, groups_wanted)
    found = state.select(F.col("place").alias("number"), F.col("digest").alias("f_digest"), "path").join(m.groups, "number")
    state = found.select("tree", "n", "subroot", F.lit(0).cast("long").alias("place"), F.col("f_digest").alias("digest"), "path")
    for tier in reversed(range(1, len(m.records))):
        state = _descend(state, m.records[tier], tier, wanted)
    if m.records:
        state = state.join(m.records[0], "digest", "left")
    else:
        state = state.withColumns({"height": F.lit(None).cast("int"), "levels": F.lit(None).cast("array<array<string>>")})
    asked = leaves.groupBy(F.col("tree").alias("a_tree"), F.shiftright("place", LEVELS).alias("a_place")).agg(
        F.collect_list(F.struct(*[c for c in leaves.columns if c not in ("tree", "n")])).alias("asked"))
    met = state.join(asked, F.col("tree").eqNullSafe(F.col("a_tree")) & (F.col("place") == F.col("a_place")))
    last = lambda r: F.when(F.col("height").isNull(), none).otherwise(
        _unselected(F.col("levels"), F.col("height"), r["place"].bitwiseAND(F.lit(WIDTH - 1))))
    return met.select("tree", "n", "subroot", F.inline(F.transform("asked", lambda r: F.struct(
        r.alias("row"), F.reverse(F.concat("path", last(r))).alias("siblings"))))).select("tree", "n", "subroot", "row.*", "siblings")


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that ``leaf`` gives with these siblings."""
    return F.aggregate(siblings, leaf, lambda at, s: F.sha2(F.when(s["digest"].isNull(), at).when(
        s["left"], F.concat(s["digest"], at)).otherwise(F.concat(at, s["digest"])).cast("binary"), 256))


def proof_digest(siblings: Column) -> Column:
    return F.sha2(F.array_join(F.transform(siblings, lambda s: s["digest"]), "").cast("binary"), 256)


def audit(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", count_col: str = "n_chars",
          cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), every: int = 7) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, leaf, subroot, root,
    proof_sha256, folded_root, verified. Where ``every`` divides the CRC-32 of
    the id's decimal text, the leaf presented has 1 added to ``count_col``.

    Null columns have their own mark in a leaf; a null group comes first, a
    null id first in its group, and neither is tampered with. Equal ids of a
    group are ordered by leaf; repeated rows are leaves each. A null or
    empty text is an ordinary leaf, an empty table gives an empty result;
    other columns are ignored.
    """
    of = {c: F.col(f"`{c}`") for c in cols}
    more = {**of, count_col: of[count_col].cast("decimal(20,0)") + 1}  # exact beyond any long
    tampered = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % every == 0
    rows = store(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").cast("string").alias("tree"), digest_of(*of.values()).alias("leaf"),
        F.when(tampered & of[count_col].isNotNull(), digest_of(*more.values())).alias("other")), "leaf-digests")
    m = build(rows)
    folded = fold(F.coalesce("other", "leaf"), F.col("siblings"))
    return prove(m).select(
        F.col("id").alias(id_col), "leaf", "subroot", F.lit(m.root).cast("string").alias("root"), proof_digest(F.col("siblings")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
