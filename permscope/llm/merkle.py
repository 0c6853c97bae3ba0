"""Operator 13: Merkle manifest of a dataset as a content-addressed DAG, with a proof for every row.

A row is a leaf: the SHA-256 of its fields.  Per group (``lang``) the leaves in
ascending ``doc_id`` order form a binary tree, the groups' roots in order form
another one above.  Nodes are stored ``DEPTH`` levels at a time: a record says
which descendants (level by level) a digest stands for, and is found by that
digest alone.

Proofs come from a descent.  Requests start at the root and go down one record
at a time: the binary digits of the wanted rank pick a child at each level, the
child not picked joins the path, and at the end the path is reversed, since a
proof runs from the leaf up.  Requests that go the same way travel as one row
until their ways part, so no digest is a hot join key; each row meets one record
of at most ``2 ** DEPTH`` children, whatever the number of rows or the share of
one group.  Ranks come from a range shuffle and the counts of the partitions
before, so no task holds a whole group.  Everything is DataFrame code.

Cases: a null field counts as ``-``; null doc_ids come first in their group,
the null group comes first of all; rows that share a doc_id are ordered by
their leaf, equal rows are equal leaves at neighbouring ranks; an empty text is
``0:``; long texts are hashed whole, by the JVM's streaming digest; an empty
table has no root and gives no row; columns other than the named ones are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from permscope.llm.tables import stored

DEPTH = 8  # levels a record spans
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def _ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` (with ``grp``) and ``rank``, the place within the group in the given order.

    ``order`` has to start with the group.
    """
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("at", 33).cast("int")), name)
    # one row per partition and group in it
    held = placed.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = held.select("part", "grp", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(base, ["part", "grp"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _height(n: Column) -> Column:
    """Levels above ``n`` nodes until one remains, at most DEPTH."""
    h = F.lit(0)
    for k in range(DEPTH):
        h = F.when(n > (1 << k), k + 1).otherwise(h)
    return h


def _levels(children: Column, height: Column) -> Column:
    """Digests of ``children`` and of each level above them, as an array of arrays."""
    def up(levels: Column, _: Column) -> Column:
        low = F.element_at(levels, -1)
        high = F.transform(F.sequence(F.lit(0), F.floor((F.size(low) - 1) / 2).cast("int")),
                           lambda i: F.sha2(F.concat(F.get(low, 2 * i), F.coalesce(F.get(low, 2 * i + 1), F.lit(""))), 256))
        return F.concat(levels, F.array(high))

    steps = F.when(height > 0, F.sequence(F.lit(1), height)).otherwise(F.expr("array()").cast("array<int>"))
    return F.aggregate(steps, F.array(children), up)


@dataclass
class Tree:
    """Records of one forest, ``records[k]`` above level ``k * DEPTH``; ``roots``: grp, n, root."""

    records: list[DataFrame]
    roots: DataFrame


def build(leaves: DataFrame, carry: list[str], name: str) -> Tree:
    """Trees over ``grp, rank, digest`` and the columns ``carry``, which the lowest records keep."""
    count = leaves.groupBy("grp").agg(F.count("*").alias("n"))
    count = stored(count, f"{name}-groups")
    most = count.agg(F.max("n")).first()[0] or 0
    records, tops, nodes, step = [], [], leaves, 0
    while True:
        more = carry if step == 0 else []
        node = F.struct("rank", "digest", *more)
        rows = (nodes.groupBy("grp", F.floor(F.col("rank") / (1 << DEPTH)).cast("long").alias("up"))
                .agg(F.array_sort(F.collect_list(node)).alias("nodes")).join(count, "grp"))
        left = F.ceil(F.col("n") / F.lit(1 << DEPTH * step))  # nodes of the group at this level
        rows = rows.withColumn("levels", _levels(F.col("nodes.digest"), _height(left)))
        rows = rows.select("grp", "n", F.col("up").alias("rank"), F.element_at(F.element_at("levels", -1), 1).alias("digest"),
                           "levels", *([F.transform("nodes", lambda x: F.struct(*(x[c].alias(c) for c in carry))).alias("carried")]
                                       if more else []))
        rows = stored(rows, f"{name}-records")
        # the content decides the digest: equal subtrees are one record
        records.append(rows.select("digest", F.size("levels").alias("high"), "levels", *(["carried"] if more else []))
                       .dropDuplicates(["digest", "high"]))
        done = F.col("n") <= (1 << DEPTH * (step + 1))
        tops.append(rows.where(done).select("grp", "n", F.col("digest").alias("root"), F.size("levels").alias("high"),
                                            F.lit(step).alias("step")))
        step += 1
        if most <= 1 << DEPTH * step:
            break
        nodes = rows.where(~done).select("grp", "rank", "digest")
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    return Tree(records, roots)


# one level of a path: the digest beside ours (null: alone in its run) and whether it is the left one
_DOWN = """cast(transform(if(high > 1, sequence(high - 2, 0, -1), cast(array() as array<int>)),
                          level -> struct(get(levels[level], shiftright(i, level) ^ 1) as sibling,
                                          (shiftright(i, level) & 1) = 1 as left))
                as array<struct<sibling:string,left:boolean>>)"""


def descend(tree: Tree, start: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """A row for each leaf below the roots in ``start``, with the records' carried columns.

    ``start`` has ``grp, root, high, step, path`` and any others, which stay;
    ``rank``, ``digest`` are the leaf's.  ``path`` grows by one step a level, from
    the root down.  ``wanted`` (grp, rank) keeps the descent on the ways to
    those leaves.
    """
    front = None
    for k in range(len(tree.records) - 1, -1, -1):
        here = start.where(F.col("step") == k).withColumns({"digest": F.col("root"), "rank": F.lit(0).cast("long")})
        front = here if front is None else front.unionByName(here)
        if wanted is not None:
            ways = wanted.select("grp", F.shiftright("rank", DEPTH * (k + 1)).alias("rank")).distinct()
            front = front.join(ways, ["grp", "rank"], "left_semi")
        rows = front.join(tree.records[k], ["digest", "high"])
        children = F.expr(f"transform(levels[0], (d, i) -> struct(d as digest, i as i, {_DOWN} as down))")
        if k == 0:
            children = F.arrays_zip(children.alias("child"), F.col("carried").alias("leaf"))
        else:
            children = F.transform(children, lambda c: F.struct(c.alias("child")))
        rows = rows.withColumn("x", F.explode(children))
        new = {"rank": F.col("rank") * (1 << DEPTH) + F.col("x.child.i"), "digest": F.col("x.child.digest"),
               "path": F.concat("path", "x.child.down"), "high": F.lit(DEPTH + 1)}
        front = rows.select(*(new.get(c, F.col(c)).alias(c) for c in front.columns), *(["x.leaf.*"] if k == 0 else []))
    if wanted is not None:
        front = front.join(wanted.select("grp", "rank").distinct(), ["grp", "rank"], "left_semi")
    return front


@dataclass
class Manifest:
    """``groups``: the tree of each group over its rows; ``top``: the tree over the groups' roots."""

    groups: Tree
    top: Tree

    def root(self) -> str | None:
        row = self.top.roots.first()
        return row["root"] if row else None


def write_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
                   claim: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``claim`` replaces fields in a second leaf, ``claimed``, kept for later checks."""
    own = [F.col(f"`{c}`") for c in fields]
    claimed = [(claim or {}).get(c, F.col(f"`{c}`")) for c in fields]
    group = F.col(f"`{group_col}`").cast("string")
    leaves = stored(docs.select(group.alias("group"), encoded(group).alias("grp"), F.col(f"`{id_col}`").cast("long").alias("id"),
                                leaf_digest(own).alias("digest"), leaf_digest(claimed).alias("claimed")), "leaves")
    ranked = _ranked(leaves, [F.col("group"), F.col("id"), F.col("digest"), F.col("claimed")], "ranked").drop("group")
    groups = build(ranked, ["id", "claimed"], "group")
    value = F.expr("if(grp = '-', null, substr(grp, instr(grp, ':') + 1))")  # back from its encoding
    subroots = groups.roots.select(value.alias("value"), F.lit("").alias("grp"), F.col("root").alias("digest"),
                                   F.col("grp").alias("sub"), F.col("high").alias("sub_high"), F.col("step").alias("sub_step"))
    above = _ranked(stored(subroots, "subroots"), [F.col("value")], "subranked").drop("value")
    return Manifest(groups, build(above, ["sub", "sub_high", "sub_step"], "top"))


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``grp, rank, id, leaf, claimed, subroot, root, path`` of every row, or of the ``wanted`` (grp, rank).

    ``path`` runs from the leaf to the root.
    """
    none = F.expr("cast(array() as array<struct<sibling:string,left:boolean>>)")
    tops = descend(manifest.top, manifest.top.roots.select("grp", "root", "high", "step", none.alias("path")))
    start = tops.select(F.col("sub").alias("grp"), F.col("digest").alias("root"), F.col("sub_high").alias("high"),
                        F.col("sub_step").alias("step"), "path", F.col("root").alias("whole"))
    found = descend(manifest.groups, start, wanted)
    return found.select("grp", "rank", "id", F.col("digest").alias("leaf"), "claimed", F.col("root").alias("subroot"),
                        F.col("whole").alias("root"), F.reverse("path").alias("path"))


def siblings(path: Column) -> Column:
    """The digests a proof lists, from the leaf up."""
    return F.transform(F.filter(path, lambda s: s["sibling"].isNotNull()), lambda s: s["sibling"])


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the digests of ``path`` give."""
    def up(below: Column, s: Column) -> Column:
        return F.sha2(F.when(s["left"], F.concat(s["sibling"], below))
                      .otherwise(F.concat(below, F.coalesce(s["sibling"], F.lit("")))), 256)

    return F.aggregate(path, leaf, up)
